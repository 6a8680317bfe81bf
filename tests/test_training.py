"""Training, evaluation, persistence, and scoring with the fitted forest."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import queries
from riskstream import jobs
from riskstream.functions.cleaning import fill_features
from riskstream.plans import training
from riskstream.schemas import MODEL_FEATURES
from riskstream.sinks.reports import keyed_messages, publish_text
from checks import derived
from riskstream.sources.models import load_pipeline, pipeline_scorer
from riskstream.sources.tables import TableStore


@pytest.fixture(scope="module")
def fitted(spark, sf):
    return queries._training(spark, sf)


def test_held_out_quality(fitted):
    assert fitted.metrics["auc"] > 0.9
    assert fitted.metrics["f1"] > 0.85
    assert (fitted.metrics["total_rows"], fitted.metrics["fraud_rows"]) == (500, 50)


def test_forest_has_the_published_shape(fitted):
    assembler, forest = fitted.model.stages
    assert assembler.getInputCols() == ["Time", *[f"V{i}" for i in range(1, 29)], "Amount"]
    assert forest.getNumTrees == 80 and forest.getMaxDepth() == 8


def test_held_out_rows_were_not_fitted_on(spark, sf, fitted):
    held_out = fitted.predictions.count()
    assert 60 < held_out < 140


def test_saved_model_scores_the_same(spark, sf, fitted, tmp_path):
    training.save_pipeline(fitted.model, str(tmp_path / "model"))
    training.save_pipeline(fitted.model, str(tmp_path / "model"))
    rows = derived.labelled_rows(spark, sf)
    probability = vector_to_array("probability")[1]
    one = [r[0] for r in fitted.model.transform(rows).orderBy("Time").select(probability).collect()]
    two = [r[0] for r in load_pipeline(str(tmp_path / "model")).transform(rows).orderBy("Time").select(probability).collect()]
    assert one == two


def test_scorer_keeps_every_event_and_column(spark, sf, fitted):
    events = fill_features(derived.events_with_signals(spark, sf))
    scored = pipeline_scorer(fitted.model)(events)
    assert scored.columns == [*events.columns, "ml_probability"]
    assert scored.count() == 1000
    assert scored.filter(~F.col("ml_probability").between(0, 1)).isEmpty()


def test_scorer_uses_the_event_amount(spark, sf, fitted):
    rows = derived.labelled_rows(spark, sf)
    direct = fitted.model.transform(rows).select("Time", vector_to_array("probability")[1].alias("p"))
    packed = pipeline_scorer(fitted.model)(rows.withColumnRenamed("Amount", "amount"))
    joined = packed.select("Time", "ml_probability").join(direct, "Time")
    assert joined.count() == 500 and joined.filter("ml_probability <> p").isEmpty()


def test_train_and_score_jobs(spark, sf, tmp_path):
    data, model, metrics = (str(tmp_path / n) for n in ("data", "model", "metrics"))
    derived.labelled_rows(spark, sf).write.option("header", True).csv(data)
    jobs.main(["train", "--data", data, "--model", model, "--metrics", metrics])
    record = spark.read.json(metrics).first()
    assert record.model_path == model and record.total_rows == 500 and len(record.features) == 30
    events = derived.payment_events(spark, sf).drop("n", "ml_probability")
    timed = events.withColumn("timestamp", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")).drop("event_time")
    publish_text(keyed_messages(timed), str(tmp_path / "messages"))
    jobs.main(
        ["score", "--store", str(tmp_path / "store"), "--model", model, "--checkpoint", str(tmp_path / "cp")]
        + ["--messages", str(tmp_path / "messages"), "--once"]
    )
    assert TableStore(spark, str(tmp_path / "store")).read("transactions").count() == 1000


def walked(nodes, values):
    """The leaf's class shares for one row: thresholds from the root down, as the saved nodes state them."""
    node = nodes[0]
    while node.leftChild >= 0:
        left = values[node.split.featureIndex] <= node.split.leftCategoriesOrThreshold[0]
        node = nodes[node.leftChild if left else node.rightChild]
    total = sum(node.impurityStats)
    return [share / total for share in node.impurityStats]


def test_probabilities_are_those_of_the_saved_thresholds(spark, sf, fitted, tmp_path):
    """Every tree of the saved forest walked by hand, for every row, batch and stream scorer alike."""
    path = str(tmp_path / "model")
    training.save_pipeline(fitted.model, path)
    saved = spark.read.parquet(*[str(p) for p in (tmp_path / "model" / "stages").glob("1_*/data")]).collect()
    trees = {}
    for row in saved:
        trees.setdefault(row.treeID, {})[row.nodeData.id] = row.nodeData
    assert len(trees) == 80 and all(0 in nodes for nodes in trees.values())
    rows = derived.labelled_rows(spark, sf).orderBy("Time")
    inputs = [[float(r[name]) for name in MODEL_FEATURES] for r in rows.collect()]
    expected = [sum(walked(nodes, values)[1] for nodes in trees.values()) / 80 for values in inputs]
    scored = load_pipeline(path).transform(rows).orderBy("Time").select(vector_to_array("probability")[1]).collect()
    assert [r[0] for r in scored] == pytest.approx(expected, abs=1e-9)
    packed = pipeline_scorer(load_pipeline(path))(rows.withColumnRenamed("Amount", "amount"))
    assert [r.ml_probability for r in packed.orderBy("Time").collect()] == pytest.approx(expected, abs=1e-9)
    depth = {}
    for nodes in trees.values():
        depth[0] = 0
        for k in sorted(nodes):
            for child in (nodes[k].leftChild, nodes[k].rightChild):
                if child >= 0:
                    depth[child] = depth[k] + 1
        assert max(depth[k] for k in nodes) <= 8
