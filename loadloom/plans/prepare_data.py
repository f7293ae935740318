"""From raw readings to stored, keyed train and test tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadloom import names
from loadloom.functions import epoch_key, load_stamp, parse_time
from loadloom.operators import prepare
from loadloom.operators.columns import clean_names, without
from loadloom.operators.contracts import coerce
from loadloom.operators.ranking import in_time_order, split_frames, temporal_split
from loadloom.operators.synthetic import continue_series
from loadloom.sources.tables import append


def raw_readings(df: DataFrame, time_format: str | None = None) -> DataFrame:
    """Cleaned names, parsed time, calendar columns and the raw contract."""
    df = without(clean_names(df), [names.LEFTOVER])
    if dict(df.dtypes)[names.TIME] == "string":
        df = df.withColumn(names.TIME, parse_time(names.TIME, time_format))
    return coerce(prepare.with_calendar(df), names.RAW_SCHEMA)


def prepared(
    df: DataFrame,
    profile: DataFrame | None = None,
    domains: Mapping[str, list[int]] | None = names.DOMAINS,
    keep: Sequence[str] | None = None,
    truncate_calendar: bool = True,
) -> DataFrame:
    """Raw readings to model-ready rows, keyed by epoch second unless the frame has a key.

    Without a profile the frame is fitted on itself; pass the profile of an earlier fit to put a later batch on the
    same scale, or that of the train rows to keep the test rows out of the statistics.
    """
    df = _keyed(df)
    if profile is None:
        profile = prepare.fit(df, domains=domains)
    keep = keep or [names.KEY, names.TIME, *names.TARGETS]
    out = prepare.apply(df, profile, keep, names.CALENDAR if truncate_calendar else ())
    schema = names.PREPARED_SCHEMA
    if not truncate_calendar:
        schema = type(schema)([f for f in schema.fields if f.name not in names.CALENDAR])
    return coerce(out, schema)


def _keyed(raw: DataFrame) -> DataFrame:
    return raw if names.KEY in raw.columns else raw.withColumn(names.KEY, epoch_key(names.TIME))


def prepared_parts(
    raw: DataFrame, test_size: float = 0.2, fit_on: str = "all", domains: Mapping[str, list[int]] | None = names.DOMAINS
) -> tuple[DataFrame, DataFrame]:
    """Prepared train and test rows.

    ``fit_on="all"`` takes the statistics over all rows before the split, ``"train"`` over the train rows only.
    """
    raw = _keyed(raw)
    train, test = split_frames(raw, test_size)
    profile = prepare.fixed(prepare.fit(raw if fit_on == "all" else train, domains=domains))
    return prepared(train, profile), prepared(test, profile)


def prepared_split(
    raw: DataFrame, test_size: float = 0.2, fit_on: str = "all", domains: Mapping[str, list[int]] | None = names.DOMAINS
) -> DataFrame:
    """The same as one frame with a ``split`` column, for reports over both parts in one pass."""
    split = temporal_split(_keyed(raw), test_size)
    base = split if fit_on == "all" else split.filter(F.col("split") == "train")
    profile = prepare.fit(base, domains=domains)
    return prepared(split, profile, keep=[names.KEY, names.TIME, *names.TARGETS, "split"])


def store_parts(
    train: DataFrame,
    test: DataFrame,
    train_table: str,
    test_table: str,
    at: datetime | None = None,
    in_order: bool = True,
) -> None:
    """Append both parts, with one load stamp for the run.

    Rows are stored in time order (O1), so each file covers a short stretch of time and later filters on time skip most
    of the files. That is one shuffle by ranges of time and key; leave it out where the input already comes in order.
    """
    stamp = load_stamp(at)
    for part, table in ((train, train_table), (test, test_table)):
        stamped = part.withColumn(names.STAMP, stamp)
        append(in_time_order(stamped) if in_order else stamped, table)


def synthetic_batch(raw: DataFrame, marked: DataFrame, rows: int = 1008, seed: int = 0) -> DataFrame:
    """Prepared rows that continue ``marked`` in time with the moments of ``raw`` (M11), fitted on themselves."""
    measures = [c for c in without(clean_names(raw), [names.LEFTOVER, names.TIME, names.KEY]).columns]
    more = continue_series(clean_names(raw), measures, rows, marked=marked, seed=seed)
    return prepared(raw_readings(more)).withColumn(names.STAMP, load_stamp())
