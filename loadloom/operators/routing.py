"""Hash-based choice between two models, and the prediction-scaling wrapper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadloom import names
from loadloom.functions import digest_parity, scaled, text_digest

# The names users of the routed predictions see.
MODEL_A = "Model A"
MODEL_B = "Model B"


def goes_to_a(key: Column | str = names.KEY) -> Column:
    """Odd digests go to A, even ones to B, and so does a missing key."""
    return F.coalesce(digest_parity(text_digest(key)) == 1, F.lit(False))


def assign(df: DataFrame, key: str = names.KEY) -> DataFrame:
    """The model each row belongs to, decided by its key alone: every run and every batch agrees."""
    return df.withColumn("model", F.when(goes_to_a(key), MODEL_A).otherwise(MODEL_B))


def route(df: DataFrame, prediction_a: str, prediction_b: str, key: str = names.KEY) -> DataFrame:
    """``Prediction`` and ``model`` per row, from two prediction columns on that row."""
    chosen = F.when(goes_to_a(key), F.col(prediction_a)).otherwise(F.col(prediction_b))
    return assign(df.withColumn("Prediction", chosen), key).drop(prediction_a, prediction_b)


def route_scored(df: DataFrame, score_a, score_b, key: str = names.KEY, outputs: list[str] | None = None) -> DataFrame:
    """Each row is scored by its own model only, so the work is that of one model.

    Both branches read ``df``: write it first if making it costs more than scanning it twice.
    """
    outputs = outputs or names.PREDICTED
    a = score_a(df.filter(goes_to_a(key))).select(*df.columns, *outputs).withColumn("model", F.lit(MODEL_A))
    b = score_b(df.filter(~goes_to_a(key))).select(*df.columns, *outputs).withColumn("model", F.lit(MODEL_B))
    return a.unionByName(b)


def rescale(df: DataFrame, predictions: list[str], factor: float = 1.3) -> DataFrame:
    """Every prediction times a factor."""
    return df.withColumns({c: scaled(c, factor) for c in predictions})
