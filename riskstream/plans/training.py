"""Training and evaluation of the fraud model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.operators.rebalance import class_counts, random_split, with_class_weight
from riskstream.plans import metrics
from riskstream.schemas import LABEL, MODEL_FEATURES
from riskstream.sources.labelled import complete_rows
from riskstream.sources.models import fraud_probability

# --- fixed values: forest settings of the published model ---
FOREST = {"numTrees": 80, "maxDepth": 8, "seed": 42}
TRAINING_SHARE = 0.8
MODEL_TYPE = "Spark ML RandomForestClassifier"
# --- end of fixed values ---


def assembler() -> VectorAssembler:
    """The thirty inputs as one vector; rows must be complete."""
    return VectorAssembler(inputCols=list(MODEL_FEATURES), outputCol="features")


def forest(**overrides) -> RandomForestClassifier:
    settings = {**FOREST, **overrides}
    return RandomForestClassifier(
        featuresCol="features", labelCol=LABEL, weightCol="class_weight", **settings
    )


def fraud_pipeline(**overrides) -> Pipeline:
    return Pipeline(stages=[assembler(), forest(**overrides)])


def area_under_roc(predictions: DataFrame) -> float:
    """Exact, unlike the evaluator's, which bins the scores of large tables."""
    scored = predictions.select(fraud_probability(), LABEL)
    return metrics.area_under_roc(scored, "ml_probability", LABEL).first().auc


def weighted_f1(predictions: DataFrame) -> float:
    """F1 averaged over classes by their share; a rare class hardly moves it."""
    return metrics.weighted_f1(predictions, LABEL, "prediction").first().f1


@dataclass
class Training:
    model: PipelineModel
    predictions: DataFrame
    metrics: dict


def train(labelled: DataFrame, split=random_split, model_path: str = "", **forest_settings) -> Training:
    """Fit on one part of the complete rows and evaluate on the other.

    ``split`` takes the weighted rows and returns both parts. The weights come from all rows.
    The rows are held for the counts, the fit and the evaluation; the forest is grown level by
    level over all partitions, so no step gathers the data.
    """
    complete = complete_rows(labelled).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = class_counts(complete)
        fitting, held_out = split(with_class_weight(complete, counts))
        # the copy leaves the training summary behind: it holds the session, which tasks cannot always be sent
        model = fraud_pipeline(**forest_settings).fit(fitting).copy()
        predictions = model.transform(held_out).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            auc, f1 = area_under_roc(predictions), weighted_f1(predictions)
        finally:
            predictions.unpersist()
    finally:
        complete.unpersist()
    record = {
        "model_type": MODEL_TYPE,
        "total_rows": sum(counts),
        "normal_rows": counts[0],
        "fraud_rows": counts[1],
        "auc": auc,
        "f1": f1,
        "features": list(MODEL_FEATURES),
        "model_path": model_path,
    }
    return Training(model, model.transform(held_out), record)


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def metrics_record(spark: SparkSession, record: dict) -> DataFrame:
    """The training record as one row."""
    schema = (
        "model_type string, total_rows bigint, normal_rows bigint, fraud_rows bigint, "
        "auc double, f1 double, features array<string>, model_path string"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame([tuple(record[name] for name in names)], schema)


def prediction_rows(predictions: DataFrame) -> DataFrame:
    """Label, prediction and fraud probability of scored rows."""
    return predictions.select(
        F.col("Time").alias("row_time"), F.col(LABEL).alias("label"), "prediction", fraud_probability()
    )
