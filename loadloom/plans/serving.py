"""Prediction tables built from scored rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadloom import names
from loadloom.operators.columns import fan_out, stack_by_name


def prediction_table(
    train: DataFrame,
    test: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    keep: Sequence[str] = (names.KEY, *names.WEATHER),
    outputs: Sequence[str] = tuple(names.PREDICTED),
) -> DataFrame:
    """Rows of both sets with their predictions. ``score`` adds the output columns, or one array ``predictions``."""
    scored = score(stack_by_name(train, test))
    if "predictions" in scored.columns:
        return scored.select(*keep, *fan_out("predictions", list(outputs)))
    return scored.select(*keep, *[F.col(c) for c in outputs])
