"""A keyed table kept up to date from a stream of rows and deletions, the latest row per key winning.

Layout below the target folder, everything divided into a fixed number of parts by a hash of the key:

* ``log/batch=N/part=P``: the winners among the rows of micro-batch N. A batch that runs again rewrites its own folder, so
  replays change nothing, and no batch ever copies the table.
* ``base/upto=N/part=P``: winners of all batches up to N, written by ``compact`` for the parts that those batches touched;
  every other part stays where an earlier compaction put it.

* ``settings/parts=P`` and ``settings/watermark=M``: the number of parts, fixed by the first sync, and the event time (micros)
  before which rows come too late.
* ``late/batch=N``: rows of micro-batch N that came too late. They are not taken in.

The state is resolved on read, part by part: one without log rows is read as it is, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom.operators.ranking import row_hash
from loadloom.operators.skew import key_columns
from loadloom.session import make_folder, numbered_folders, remove

# Parts of a table that is begun without a number of its own.
PARTS = 64
PART = "_part"


def winners(df: DataFrame, key: str | Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row with the highest version per key, equal versions decided by a hash of the row.

    Losers go before the shuffle, also those of a hot key. Columns of any type are carried along.
    """
    keys = key_columns(key)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*version, row_hash(df))).alias("_w")
    return df.groupBy(*keys).agg(newest).select(*[F.col(c) if c in keys else F.col(f"_w.{c}") for c in df.columns])


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """A stream over parquet at a folder or a single file."""
    # A pattern matches a file and a folder alike; a streaming source refuses the plain path of a file.
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(pattern)


def _write(df: DataFrame, path: str, key: str | Sequence[str], parts: int, moved: Iterable[int] = ()) -> None:
    """The rows by part, in place of what a failed run left. Parts of ``moved`` get a folder even if they have no rows."""
    spark = df.sparkSession
    remove(spark, path)
    for p in moved:
        make_folder(spark, f"{path}/{PART}={p}")
    part = F.pmod(F.xxhash64(*key_columns(key)), F.lit(parts)).cast("int")
    df.withColumn(PART, part).write.mode("append").partitionBy(PART).parquet(path)


def settled_parts(spark: SparkSession, target: str, parts: int | None = None) -> int:
    """The number of parts that the table keeps; ``parts``, or 64, if it has none yet. Asking for another is an error."""
    found = numbered_folders(spark, f"{target}/settings", "parts", finished=False)
    if not found:
        make_folder(spark, f"{target}/settings/parts={PARTS if parts is None else parts}")
        found = numbered_folders(spark, f"{target}/settings", "parts", finished=False)
    if len(found) != 1 or parts not in (None, found[0]):
        raise ValueError(f"{target} has {found} parts, not {parts}")
    return found[0]


def watermark(spark: SparkSession, target: str) -> int | None:
    """Event time in micros before which rows come too late; None as long as no compaction has set it."""
    return max(numbered_folders(spark, f"{target}/settings", "watermark", finished=False), default=None)


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def sync(
    stream: DataFrame, target: str, key: str | Sequence[str], version: Sequence[str], parts: int | None = None,
    time: str | None = None,
) -> None:
    """Take in everything the stream has not delivered yet, then stop. The checkpoint lives beside the data.

    ``parts`` is fixed by the first sync. With ``time``, an event time, rows older than the watermark that ``compact`` keeps are
    set apart (``read_late``): the deletions they might undo are no longer known. Rows without a time are taken in.
    """
    parts = settled_parts(stream.sparkSession, target, parts)

    def take_in(batch: DataFrame, number: int) -> None:
        mark = watermark(batch.sparkSession, target) if time else None
        if mark is not None:
            late = F.coalesce(_micros(time) < mark, F.lit(False))
            batch.filter(late).write.mode("overwrite").parquet(f"{target}/late/batch={number}")
            batch = batch.filter(~late)
        _write(winners(batch, key, version), f"{target}/log/batch={number}", key, parts)

    (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{target}/checkpoint")
        .foreachBatch(take_in)
        .start()
        .awaitTermination()
    )


def read_late(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Rows that came too late, with the ``batch`` that brought them."""
    if not numbered_folders(spark, f"{target}/late", "batch"):
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(0))
    full = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
    return spark.read.schema(full).parquet(f"{target}/late")


@dataclass(frozen=True)
class Layout:
    """Where each part of the base lies, the parts of each batch of the log, and the last batch in either."""

    base: dict[int, str]
    log: dict[str, list[int]]
    last: int

    @property
    def touched(self) -> set[int]:
        return {p for parts in self.log.values() for p in parts}

    def paths(self, parts: set[int]) -> list[str]:
        own = [path for p, path in self.base.items() if p in parts]
        return own + [f"{path}/{PART}={p}" for path, found in self.log.items() for p in found if p in parts]


def layout(spark: SparkSession, target: str) -> Layout:
    """Folder names only: as many as parts times unfolded batches."""
    bases, base = numbered_folders(spark, f"{target}/base", "upto"), {}
    for n in bases:  # later ones replace
        for p in numbered_folders(spark, f"{target}/base/upto={n}", PART, finished=False):
            base[p] = f"{target}/base/upto={n}/{PART}={p}"
    upto = bases[-1] if bases else -1
    batches = [n for n in numbered_folders(spark, f"{target}/log", "batch") if n > upto]
    log = {f"{target}/log/batch={n}": numbered_folders(spark, f"{target}/log/batch={n}", PART, finished=False) for n in batches}
    return Layout(base, log, batches[-1] if batches else upto)


def _resolved(spark, at: Layout, parts: set[int], schema, key, version) -> DataFrame:
    return winners(spark.read.schema(schema).parquet(*at.paths(parts)), key, version)


def read_state(
    spark: SparkSession, target: str, schema: T.StructType, key: str | Sequence[str], version: Sequence[str],
    deleted: str | None = None,
) -> DataFrame:
    """The current row of every key. ``deleted`` names a BOOLEAN column: a key whose latest row has it true is gone.

    Only parts with log rows are grouped by key; the others hold each key once already.
    """
    at = layout(spark, target)
    touched, still = at.touched, set(at.base) - at.touched
    state = spark.createDataFrame([], schema)
    if still:
        state = spark.read.schema(schema).parquet(*at.paths(still))
    if touched:
        moved = _resolved(spark, at, touched, schema, key, version)
        state = state.unionByName(moved) if still else moved
    if deleted:
        state = state.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)
    return state


def compact(
    spark: SparkSession, target: str, schema: T.StructType, key: str | Sequence[str], version: Sequence[str],
    parts: int | None = None, deleted: str | None = None, time: str | None = None, keep_for: timedelta | None = None,
) -> None:
    """Fold the log into the base: the parts it touched are written anew, the others stay.

    Readers use the new parts once they are finished; older folders stay for running readers until ``vacuum``. Deletions
    are kept as rows, so that a late row cannot bring a key back.

    With ``deleted``, ``time`` and ``keep_for`` deletions are kept so long only: the watermark moves to the latest event time less
    ``keep_for``, never back, deletions older than it leave, and rows older than it are too late from then on. The watermark is
    stored before the deletions go, so a run that fails in between loses nothing.
    """
    parts = settled_parts(spark, target, parts)
    at = layout(spark, target)
    if not at.log:
        return
    if keep_for is None:
        _write(_resolved(spark, at, at.touched, schema, key, version), f"{target}/base/upto={at.last}", key, parts)
        return
    if deleted is None or time is None:
        raise ValueError("keep_for needs the columns deleted and time")
    latest = spark.read.schema(schema).parquet(*at.paths(at.touched)).agg(F.max(_micros(time))).first()[0]
    marks = [watermark(spark, target), None if latest is None else latest - keep_for // timedelta(microseconds=1)]
    mark = max([m for m in marks if m is not None], default=None)
    if mark is None:
        _write(_resolved(spark, at, at.touched, schema, key, version), f"{target}/base/upto={at.last}", key, parts)
        return
    make_folder(spark, f"{target}/settings/watermark={mark}")
    # Of a part that the log left alone, the files' statistics mostly tell that no deletion in it has expired.
    old = F.coalesce(F.col(deleted) & (_micros(time) < mark), F.lit(False))
    still = [p for p in at.base if p not in at.touched]
    moved = set(at.touched)
    if still:
        number = F.pmod(F.xxhash64(*key_columns(key)), F.lit(parts)).cast("int")
        rows = spark.read.schema(schema).parquet(*at.paths(set(still))).filter(F.col(deleted) & old)
        moved |= {r[0] for r in rows.select(number).distinct().collect()}
    state = _resolved(spark, at, moved, schema, key, version).filter(~old)
    # A part whose rows have all expired must still take the place of its older folder.
    _write(state, f"{target}/base/upto={at.last}", key, parts, moved)


def vacuum(spark: SparkSession, target: str) -> None:
    """Remove folded batches and parts of the base that newer ones replace; no reader may be at work on them."""
    at = layout(spark, target)
    bases = numbered_folders(spark, f"{target}/base", "upto")
    for n in numbered_folders(spark, f"{target}/log", "batch"):
        if bases and n <= bases[-1]:
            remove(spark, f"{target}/log/batch={n}")
    current = set(at.base.values())
    for n in bases:
        for p in numbered_folders(spark, f"{target}/base/upto={n}", PART, finished=False):
            if (path := f"{target}/base/upto={n}/{PART}={p}") not in current:
                remove(spark, path)
