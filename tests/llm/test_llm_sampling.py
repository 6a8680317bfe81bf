"""Samples are cut by a hash bound before they are ranked, and stay those with the smallest hashes."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskstream.llm import language_id, quality_fm, sampling


def test_a_bound_leaves_little_more_than_wanted(spark):
    ids = spark.range(300_000).withColumnRenamed("id", "doc_id")
    share = sampling.share_for(2000, 300_000)
    left = ids.filter(sampling.smallest_hashes("doc_id", share))
    assert 2000 <= left.count() < 3000
    order = [F.xxhash64("doc_id"), "doc_id"]
    first = [r.doc_id for r in left.orderBy(*order).limit(2000).collect()]
    assert first == [r.doc_id for r in ids.orderBy(*order).limit(2000).collect()]
    assert ids.filter(sampling.smallest_hashes("doc_id", sampling.share_for(10, 5))).count() == 300_000


def test_no_task_ranks_a_whole_language(spark, monkeypatch):
    """What reaches the rank is bounded by the sample, not by the rows of the language."""
    seen = []
    ranked = Window.partitionBy

    def partition_by(*columns):
        seen.append(columns)
        return ranked(*columns)

    docs = spark.range(60_000).selectExpr("id AS doc_id", "'some words of text' AS text", "'en' AS lang")
    monkeypatch.setattr(Window, "partitionBy", staticmethod(partition_by))
    taken = []
    real = sampling.smallest_hashes
    monkeypatch.setattr(sampling, "smallest_hashes", lambda key, share: taken.append(key) or real(key, share))
    model = language_id.train(docs, sample_rows=100)
    assert model.languages == ["en"] and seen and taken
    labelled = docs.filter(~language_id.split(F.col("doc_id")))
    share = sampling.share_for(100, labelled.count())
    assert labelled.filter(real("doc_id", share)).count() < 400


def test_quality_sample_is_bounded_before_it_is_sorted(spark, monkeypatch):
    taken = []
    real = sampling.smallest_hashes
    monkeypatch.setattr(sampling, "smallest_hashes", lambda key, share: taken.append(share) or real(key, share))
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('word ', id) AS text", "10L AS n_chars")
    labels = spark.range(3000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality", "0 AS toxic")
    quality_fm.train(docs, labels, 50)
    assert taken and taken[0] < 0.1
