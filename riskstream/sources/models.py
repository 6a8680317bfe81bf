"""Fitted pipelines as scorers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.schemas import MODEL_FEATURES

Scorer = Callable[[DataFrame], DataFrame]


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fraud_probability():
    """Probability of the fraud class from the model's probability vector."""
    return vector_to_array("probability").getItem(1).alias("ml_probability")


def model_inputs(events: DataFrame) -> DataFrame:
    """The thirty inputs under their training names beside the event as one struct."""
    inputs = [F.col("amount" if name == "Amount" else name).alias(name) for name in MODEL_FEATURES]
    return events.select(*inputs, F.struct(*events.columns).alias("event"))


def pipeline_scorer(model: PipelineModel) -> Scorer:
    """A function that adds ``ml_probability`` to events, batch or streaming.

    The model sees the thirty inputs under their training names next to the event as one
    struct. So its input ``Amount`` cannot clash with the event's ``amount``, and its own
    vector columns never reach the caller.
    """

    def score(events: DataFrame) -> DataFrame:
        return model.transform(model_inputs(events)).select("event.*", fraud_probability())

    return score
