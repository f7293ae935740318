"""Regression metrics and comparisons of predictions.

Each report is one aggregate over the scored rows: all targets and all metrics in the same pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadloom import names
from loadloom.functions import absolute_error
from loadloom.functions.literals import to_number
from loadloom.operators.keys import align_on_key


def _both(actual: str, predicted: str) -> Column:
    return F.col(actual).isNotNull() & F.col(predicted).isNotNull()


def metrics_per_target(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """A10: ``target, rows, mse, rmse, mae, r2``; ``pairs`` maps a target to its actual and predicted column.

    Rows lacking either value are left out. A constant target has r2 1.0 if every residual is zero, else 0.0.
    """
    aggs, rows = [], []
    for i, (target, (actual, predicted)) in enumerate(pairs.items()):
        both = _both(actual, predicted)
        y = F.when(both, F.col(actual).cast("double"))
        residual = F.when(both, F.col(actual).cast("double") - F.col(predicted).cast("double"))
        aggs += [
            F.count(residual).alias(f"n{i}"),
            F.avg(residual * residual).alias(f"mse{i}"),
            F.avg(F.abs(residual)).alias(f"mae{i}"),
            F.var_pop(y).alias(f"var{i}"),
        ]
        mse, var = F.col(f"mse{i}"), F.col(f"var{i}")
        # Mean of squares over population variance equals the usual ratio of sums.
        r2 = (
            F.when(var > 0, 1.0 - mse / var)
            .when(mse == 0, F.lit(1.0))
            .when(mse.isNotNull(), F.lit(0.0))
        )
        rows.append(
            F.struct(
                F.lit(target).alias("target"),
                F.col(f"n{i}").alias("rows"),
                mse.alias("mse"),
                F.sqrt(mse).alias("rmse"),
                F.col(f"mae{i}").alias("mae"),
                r2.alias("r2"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def metrics_uniform(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``mse, mae, r2``, each the plain mean over targets."""
    return metrics_per_target(df, pairs).agg(
        F.avg("mse").alias("mse"), F.avg("mae").alias("mae"), F.avg("r2").alias("r2")
    )


def axis_range(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """The common range of actual and predicted values, per target."""
    aggs, rows = [], []
    for i, (target, (actual, predicted)) in enumerate(pairs.items()):
        aggs += [
            F.least(F.min(actual), F.min(predicted)).alias(f"lo{i}"),
            F.greatest(F.max(actual), F.max(predicted)).alias(f"hi{i}"),
        ]
        rows.append(
            F.struct(F.lit(target).alias("target"), F.col(f"lo{i}").alias("low"), F.col(f"hi{i}").alias("high"))
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def long_pairs(
    df: DataFrame, pairs: Mapping[str, tuple[str, str]], keep: Sequence[str] = (names.TIME,)
) -> DataFrame:
    """``keep, target, actual, predicted``, a row per target; no shuffle."""
    rows = [
        F.struct(
            F.lit(target).alias("target"),
            F.col(actual).cast("double").alias("actual"),
            F.col(predicted).cast("double").alias("predicted"),
        )
        for target, (actual, predicted) in pairs.items()
    ]
    return df.select(*keep, F.inline(F.array(*rows)))


def chart_points(
    df: DataFrame, pairs: Mapping[str, tuple[str, str]], pixels: int = 1000, time: str = names.TIME
) -> DataFrame:
    """M14 for drawing: of each target, series and pixel column the first, last, lowest and highest point.

    ``target, series, pixel, points`` and a time and value of each; lines through these points cover the same pixels as lines
    through all rows, and there are at most ``pixels`` rows per series whatever the table holds. Pixel columns divide the range of
    times evenly. Rows without a time, and missing or NaN values, draw nothing. Of equal values the earliest is taken, of equal
    times the lowest value first and the highest last.
    """
    if pixels < 1:
        raise ValueError("pixels must be at least 1")
    dtype = df.schema[time].dataType
    dated = df.filter(F.col(time).isNotNull())
    ends = dated.agg(to_number(F.min(time), dtype).alias("a"), to_number(F.max(time), dtype).alias("b"))
    start = ends.select("a").scalar()
    width = ends.select(F.expr(f"(b - a) div {int(pixels)} + 1")).scalar()
    series = [
        F.struct(F.lit(target).alias("target"), F.lit(name).alias("series"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("value"))
        for target, both in pairs.items() for name, c in zip(("actual", "predicted"), both, strict=True)
    ]
    points = dated.select(time, ((to_number(F.col(time), dtype) - start) / width).cast("bigint").alias("pixel"), F.inline(F.array(*series)))
    points = points.filter(F.col("value").isNotNull())
    value, at = F.col("value"), F.col(time)
    by_time, by_value = F.struct(at, value), F.struct(value, at)
    ends = {"first": F.min(by_time), "last": F.max(by_time), "low": F.min(by_value), "high": F.max_by(by_value, F.struct(value, -to_number(at, dtype)))}
    rows = points.groupBy("target", "series", "pixel").agg(F.count(F.lit(1)).alias("points"), *[c.alias(n) for n, c in ends.items()])
    parts = [F.col(n)[f].alias(f"{n}_{label}") for n in ends for f, label in ((time, "time"), ("value", "value"))]
    return rows.select("target", "series", "pixel", "points", *parts)


def _comparison(df: DataFrame, actual: str, old: str, new: str) -> DataFrame:
    def rmse(predicted: str) -> Column:
        residual = F.col(actual) - F.col(predicted)
        return F.sqrt(F.avg(residual * residual))

    return df.agg(
        F.avg(absolute_error(actual, old)).alias("mae_old"),
        F.avg(absolute_error(actual, new)).alias("mae_new"),
        rmse(old).alias("rmse_old"),
        rmse(new).alias("rmse_new"),
    ).withColumn("promote", F.coalesce(F.col("mae_new") < F.col("mae_old"), F.lit(False)))


def champion_challenger(
    df: DataFrame, actual: str = names.TARGETS[0], old: str = "prediction_old", new: str = "prediction_new"
) -> DataFrame:
    """M7 for rows that carry both predictions: one row of errors, and whether the new model wins.

    Only the first target decides; a tie keeps the old model.
    """
    return _comparison(df, actual, old, new)


def champion_challenger_tables(
    actuals: DataFrame,
    old: DataFrame,
    new: DataFrame,
    key: str = names.KEY,
    actual: str = names.TARGETS[0],
    value: str = "prediction",
) -> DataFrame:
    """M7 for predictions that arrive as keyed tables (J1): only keys present in all three count."""
    rows = align_on_key(actuals, {"old": old, "new": new}, key, [actual], value)
    return _comparison(rows, actual, f"{value}_old", f"{value}_new")


def with_errors(df: DataFrame, actual: str, predictions: Sequence[str]) -> DataFrame:
    """``error_<suffix>`` beside each ``prediction_<suffix>`` column, ``error_<name>`` beside any other."""
    named = {p: "error" + p.removeprefix("prediction") if p.startswith("prediction") else f"error_{p}" for p in predictions}
    return df.withColumns({name: absolute_error(actual, p) for p, name in named.items()})


def mean_importance(df: DataFrame) -> DataFrame:
    """Importance per feature, averaged over the per-target models (``feature, target, importance`` rows)."""
    return df.groupBy("feature").agg(F.avg("importance").alias("importance"))


def top_features(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most important features, ties by name; none for ``n = 0``."""
    return df.orderBy(F.desc("importance"), F.asc("feature")).limit(n)
