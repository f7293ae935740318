"""Key lookups and named functions that add features to a frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadloom import names
from loadloom.operators.columns import unused, without
from loadloom.operators.skew import Skew, fits_broadcast, key_columns, narrowed_to, skew_of, skew_safe_join


@dataclass(frozen=True)
class Lookup:
    """Features taken from a keyed table; ``as_names`` renames them on the way.

    ``key`` is one column or several, ``base_key`` their names in the base. ``key_checked`` says that the table was
    checked when it was written (see ``sources.tables.create_keyed_table``); otherwise a requested key that the table
    repeats is an error, since it would multiply rows. Keys nobody asks for, and NULL ones, do not matter.
    """

    table: DataFrame
    features: Sequence[str]
    key: str | Sequence[str] = names.KEY
    base_key: str | Sequence[str] | None = None
    as_names: Mapping[str, str] = field(default_factory=dict)
    key_checked: bool = False


@dataclass(frozen=True)
class SqlFunction:
    """A named scalar function whose body is one SQL expression over its arguments."""

    name: str
    arguments: Mapping[str, str]
    returns: str
    body: str

    def create(self, spark: SparkSession, temporary: bool = True) -> SqlFunction:
        args = ", ".join(f"{a} {t}" for a, t in self.arguments.items())
        kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
        spark.sql(f"CREATE OR REPLACE {kind} {self.name}({args}) RETURNS {self.returns} RETURN {self.body}")
        return self

    def bind(self, bindings: Mapping[str, str]) -> Column:
        """The call, with each argument bound to a column by name. The planner inlines the body."""
        return F.call_function(self.name, *[F.col(bindings[a]) for a in self.arguments])


@dataclass(frozen=True)
class FunctionFeature:
    """A function's result as a feature column."""

    function: SqlFunction
    output: str
    bindings: Mapping[str, str]


WEATHER_INTERACTION = SqlFunction(
    name="loadloom_weather_interaction",
    arguments={"temperature": "DOUBLE", "humidity": "DOUBLE", "wind_speed": "DOUBLE"},
    returns="DOUBLE",
    body="temperature * humidity * wind_speed",
)

WEATHER_FEATURE = FunctionFeature(
    function=WEATHER_INTERACTION,
    output=names.INTERACTION,
    bindings={"temperature": "Temperature", "humidity": "Humidity", "wind_speed": "Wind_Speed"},
)


def look_up(base: DataFrame, lookup: Lookup, skew: Skew | None = None) -> DataFrame:
    """Every base row once, with the features of its key, NULL where the table lacks the key.

    The table is brought to one row per key with a count, combined before the one shuffle that the join needs anyway;
    reading a feature of a key with more than one row fails the job. The result is lazy and the same for every way the
    join may be planned. For a small base only the table's rows for its keys are taken.
    """
    own, keys = key_columns(lookup.key), key_columns(lookup.base_key or lookup.key)
    features = [lookup.as_names.get(c, c) for c in lookup.features]
    picked = lookup.table.select(
        *[F.col(a).alias(b) for a, b in zip(own, keys, strict=True)],
        *[F.col(c).alias(name) for c, name in zip(lookup.features, features, strict=True)],
    )
    copies = unused("_copies", base, picked)
    narrow = fits_broadcast(base) and not fits_broadcast(picked)
    if narrow:
        picked = narrowed_to(picked, base, keys)
    if not lookup.key_checked:
        picked = picked.groupBy(*keys).agg(*[F.any_value(c).alias(c) for c in features], F.count(F.lit(1)).alias(copies))
    joined = base.join(picked, keys, "left") if narrow else skew_safe_join(base, picked, keys, "left", skew)
    ordered = joined.select(*base.columns, *features, *([] if lookup.key_checked else [copies]))
    if lookup.key_checked:
        return ordered
    refused = F.raise_error(F.lit(f"lookup: key ({', '.join(own)}) is requested and repeated in the table"))
    checked = {c: F.when(F.col(copies) > 1, refused).otherwise(F.col(c)) for c in features}
    return ordered.withColumns(checked).drop(copies)


def look_up_keys(keys: DataFrame, table: DataFrame, key: str | Sequence[str], features: Sequence[str]) -> DataFrame:
    """Features for a list of requested keys. Unknown keys stay, with NULL features; each request gives one row.

    A short list is broadcast to the table's scan; a list too long for that is joined like any other frame.
    """
    return look_up(keys, Lookup(table, features, key))


def assemble(
    base: DataFrame,
    lookups: Sequence[Lookup] = (),
    functions: Sequence[FunctionFeature] = (),
    exclude: Sequence[str] = (),
) -> DataFrame:
    """A training set: base columns, looked-up features, function results, less the excluded columns.

    Lookups come before functions, so a function may use a looked-up feature. Hot keys are found once for each key, on
    the key columns of the bare base; no lookup evaluates those before it.
    """
    df, known = base, {}
    for lookup in lookups:
        keys = tuple(key_columns(lookup.base_key or lookup.key))
        if keys not in known and set(keys) <= set(base.columns) and not fits_broadcast(lookup.table):
            known[keys] = Skew({}) if fits_broadcast(base) else skew_of(base, keys)
        df = look_up(df, lookup, known.get(keys))
    for feature in functions:
        df = df.withColumn(feature.output, feature.function.create(df.sparkSession).bind(feature.bindings))
    return without(df, exclude)
