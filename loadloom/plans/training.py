"""Assembly, training and judging in one go."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from loadloom import names
from loadloom.operators.columns import to_double
from loadloom.operators.evaluate import champion_challenger, metrics_uniform
from loadloom.operators.lookup import WEATHER_FEATURE, FunctionFeature, Lookup, assemble
from loadloom.operators.models import Boosting, Forest, TargetModels, fit_per_target

FEATURES = [*names.MODEL_INPUTS, names.INTERACTION]


def training_frame(train: DataFrame, features: DataFrame, key_checked: bool = False) -> DataFrame:
    """Train rows with their flow columns taken from the feature table, and the weather interaction."""
    base = to_double(train.drop(*names.FLOWS), names.WEATHER)
    lookup = Lookup(features, names.FLOWS, key_checked=key_checked)
    return assemble(base, [lookup], [WEATHER_FEATURE], [names.STAMP])


def testing_frame(test: DataFrame) -> DataFrame:
    """Test rows keep their own flow columns."""
    return assemble(to_double(test, names.WEATHER), (), [WEATHER_FEATURE], [names.STAMP])


@dataclass(frozen=True)
class Trained:
    models: TargetModels
    metrics: DataFrame


def train_and_judge(
    train: DataFrame,
    test: DataFrame,
    features: DataFrame,
    model: Boosting | Forest,
    targets: Sequence[str] = tuple(names.TARGETS),
    outputs: Sequence[str] = tuple(names.PREDICTED),
) -> Trained:
    """Fit on the assembled train rows and report errors on the assembled test rows."""
    models = fit_per_target(training_frame(train, features), model, FEATURES, targets, outputs)
    pairs = {t: (t, o) for t, o in zip(targets, outputs, strict=True)}
    return Trained(models, metrics_uniform(models.score(testing_frame(test)), pairs))


def score_batch(
    models: TargetModels,
    df: DataFrame,
    lookups: Sequence[Lookup] = (),
    functions: Sequence[FunctionFeature] = (),
) -> DataFrame:
    """M6 for rows that lack some inputs: those are looked up or computed first; columns at hand are kept as they are."""
    needed = []
    for source in lookups:
        absent = [c for c in source.features if source.as_names.get(c, c) not in df.columns]
        if absent:
            needed.append(replace(source, features=absent))
    absent = [f for f in functions if f.output not in df.columns]
    return models.score(assemble(df, needed, absent))


def compare_models(test: DataFrame, old: TargetModels, new: TargetModels, target: str = names.TARGETS[0]) -> DataFrame:
    """M7 for two models: both score the same row, so nothing is joined; one pass gives all errors."""
    rows = testing_frame(test)
    first = old.outputs[target]
    scored = old.score(rows).withColumnRenamed(first, "prediction_old").drop(*old.outputs.values())
    scored = new.score(scored).withColumnRenamed(new.outputs[target], "prediction_new")
    return champion_challenger(scored, target)
