"""The pipeline, stage by stage, against what each stage is meant to do."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskstream.llm import jaccard_join, pieces, secrets, storage

WORDS = " ".join(f"story{k} tells of the people and their town" for k in range(30))


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    """Given documents with planted cases behind them."""
    path = tmp_path_factory.mktemp("corpus")
    given = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    item = max((r.text for r in items.collect()), key=len)
    extra = [
        (10_001, None, None, None, None),
        (10_002, "123 456 --- 789", "en", "s", 15),
        (10_003, WORDS, "en", "s", len(WORDS)),
        (10_004, WORDS + " once", "en", "s", len(WORDS) + 5),
        (10_005, WORDS.replace("story", "tale") + " " + item, "en", "s", 1),
        (10_006, WORDS.replace("story", "saga") + ' token = "abcdef0123456789"', "en", "s", 1),
    ]
    given.unionByName(spark.createDataFrame(extra, given.schema)).write.parquet(f"{path}/documents.parquet")
    items.write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def steps(spark, folder):
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        found.append((name, docs, {r.doc_id: r for r in docs.collect()}))
    return found


def test_stages_keep_the_columns_of_documents(spark, folder, steps):
    columns = spark.read.parquet(f"{folder}/documents.parquet").dtypes
    assert [name for name, _, _ in steps] == ["language", "near_duplicates", "decontamination", "secrets", "tokens"]
    assert all(docs.dtypes == columns for _, docs, _ in steps[:-1])


def test_decisions_take_effect(steps, spark, folder):
    language, unique, clean, hidden, tokens = (rows for _, _, rows in steps)
    every = {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert every - language.keys() >= {10_001, 10_002} and len(every - language.keys()) <= 4
    assert 10_003 in unique and 10_004 not in unique
    classes = jaccard_join.join(steps[0][1]).collect()
    assert unique.keys() == {r.class_id for r in classes}
    assert 10_005 in unique and 10_005 not in clean
    assert clean.keys() == hidden.keys() == tokens.keys()
    assert "abcdef0123456789" not in hidden[10_006].text and "[SECRET]" in hidden[10_006].text
    assert all(r.n_chars == len(r.text) and not secrets.find(r.text) for r in hidden.values())
    untouched = [d for d, r in clean.items() if not secrets.find(r.text)]
    assert all(hidden[d].text == clean[d].text for d in untouched)


def test_decontamination_against_brute_force(spark, folder, steps):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def windows(text):
        words = pattern.findall(text.translate(lower))
        return {tuple(words[k : k + 10]) for k in range(len(words) - 9)}

    known = set().union(*(windows(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()))
    before, after = steps[1][2], steps[2][2]
    assert after.keys() == {d for d, r in before.items() if not windows(r.text) & known}


def test_tokens_equal_the_library(steps):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_file())
    for doc_id, row in steps[-1][2].items():
        ids = library.encode(steps[-2][2][doc_id].text, add_bos=True, add_eos=True)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.ids == ids and row.n_tokens == len(ids)


def test_repeated_rows_and_clashing_names_in_every_stage(spark, folder):
    """Each stage by itself, on documents with more columns, some of names that the operators use, and every row twice."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs.selectExpr("*", "1 AS class_id", "'x' AS version", "2 AS n_hit", "'y' AS spans", "3 AS id", "0.5 AS score")
    twice = odd.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        once, both = (sorted(map(str, stage(spark, d, folder).collect())) for d in (odd, twice))
        assert sorted([*once, *once]) == both, name
        assert stage(spark, odd, folder).columns == odd.columns, name
    tokens = corpus_pipeline.tokens(spark, twice, folder)
    assert tokens.count() == twice.count() and tokens.columns[:2] == ["doc_id", "ids"]


def test_run_applies_all_stages(spark, folder, steps):
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, whole.collect())) == sorted(map(str, steps[-1][2].values()))


def test_pipeline_of_no_documents(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/documents.parquet").filter(F.lit(False)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_dropped_ids_by_broadcast_or_shuffle(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    small = {name: sorted(map(str, stage(spark, docs, folder).collect())) for name, stage in corpus_pipeline.STAGES[1:3]}
    monkeypatch.setattr(storage, "BROADCAST_BYTES", -1)
    for name, stage in corpus_pipeline.STAGES[1:3]:
        frame = stage(spark, docs, folder)
        assert "Broadcast" not in frame._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(str, frame.collect())) == small[name]
    assert storage.broadcast_if_small(docs.select("doc_id"), 1 << 20).count() == docs.count()
