"""A keyed table in versions that share files: publish, append, read at a version, what changed, point lookups.

Rows are divided into a fixed number of parts by a hash of their key. Layout below the target folder:

* ``data/version=N/part=P``: rows that version N wrote for part P.
* ``manifest/version=N``: one row per folder that version N consists of, with its row count, two checksums and the size of its
  key filter. Its finished write is the commit; a version without one does not exist, and is written over.
* ``filters/version=N``: a Bloom filter over the keys of each folder that N wrote, as bitmaps of 32,768 bits.
* ``changes/version=N``: rows that differ from version N - 1, for streams.

A version that leaves a part as it was names the same folder, so two versions are compared by the folders they do not share. One
writer at a time; any number of readers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom import names
from loadloom.operators.changes import as_updates, change_set
from loadloom.operators.keys import assert_key, unseen_rows
from loadloom.operators.ranking import row_hash
from loadloom.operators.skew import fits_broadcast, key_columns
from loadloom.session import numbered_folders, remove

PART = "part"
#: Bits per key and bits asked for each; bits of one bitmap.
BITS, PROBES, BITMAP = 12, 6, 32_768
#: Requested keys that are broadcast at most, where the planner cannot tell their size.
MOST_REQUESTS = 100_000
MANIFEST = "part int, path string, parts int, key string, rows bigint, sum decimal(38,0), xor bigint, bits bigint"


def part_of(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts).cast("bigint")).cast("int")


def versions(spark: SparkSession, target: str) -> list[int]:
    """Committed versions, oldest first."""
    return numbered_folders(spark, f"{target}/manifest", "version")


@dataclass(frozen=True)
class Version:
    """What a version consists of. ``folders`` has a row per folder: as many as parts times unfolded appends."""

    number: int
    parts: int
    keys: list[str]
    folders: DataFrame

    def paths(self) -> list[tuple[int, str]]:
        return [(r["part"], r["path"]) for r in self.folders.select("part", "path").sort("part", "path").collect()]


def version(spark: SparkSession, target: str, number: int | None = None) -> Version | None:
    """A committed version, the last one by default; None if there is none."""
    found = versions(spark, target)
    if number is None:
        number = found[-1] if found else None
    elif number not in found:
        raise ValueError(f"{target} has no version {number}")
    if number is None:
        return None
    rows = spark.read.schema(MANIFEST).parquet(f"{target}/manifest/version={number}")
    one = rows.select("parts", "key").first()
    return Version(number, one["parts"], one["key"].split(","), rows.where("path is not null"))


def _read(spark: SparkSession, target: str, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """The rows of some folders, with ``part`` as a partition column that the planner can prune by."""
    if not paths:
        return spark.createDataFrame([], schema).withColumn(PART, F.lit(0))
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())]))
    return reader.option("basePath", f"{target}/data").parquet(*[f"{target}/{p}" for p in paths]).select(*schema.names, PART)


def schema_of(spark: SparkSession, target: str) -> T.StructType:
    """Columns of the table, kept by the first version as an empty file."""
    return spark.read.parquet(f"{target}/schema").schema


def read(spark: SparkSession, target: str, number: int | None = None) -> DataFrame:
    """All rows of a version."""
    at = version(spark, target, number)
    schema = schema_of(spark, target)
    return _read(spark, target, [p for _, p in at.paths()], schema).drop(PART)


def _checks(df: DataFrame) -> list[Column]:
    """Counts and two sums over rows in any order; equal ones are taken for equal parts."""
    one = row_hash(df)
    return [
        F.count(F.lit(1)).alias("rows"), F.sum(one.cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64(one, *_plain(df))).alias("xor"),
    ]


def _plain(df: DataFrame) -> list[Column]:
    return [F.hash(F.to_json(f.name)) if isinstance(f.dataType, T.MapType) else F.hash(f.name) for f in df.schema.fields]


def _positions(keys: Sequence[str], bits: Column) -> Column:
    return F.transform(F.array(*[F.xxhash64(*keys, F.lit(i)) for i in range(PROBES)]), lambda h: F.pmod(h, bits))


def _filters(rows: DataFrame, sizes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(part, bucket, bitmap) over the keys of rows with ``part``; ``sizes`` (part, bits) is as small as the manifest."""
    each = rows.select(PART, *keys).join(sizes, PART).select(PART, F.explode(_positions(keys, F.col("bits"))).alias("bit"))
    bucket = F.floor(F.col("bit") / BITMAP)
    return each.groupBy(PART, bucket.alias("bucket")).agg(F.bitmap_construct_agg(F.col("bit") % BITMAP).alias("bitmap"))


def _commit(spark: SparkSession, target: str, number: int, kept: DataFrame, added: DataFrame, parts: int, keys: Sequence[str]) -> int:
    """Writes the rows ``added`` (with ``part``), their filters, and last the manifest with the folders ``kept``."""
    data = f"{target}/data/version={number}"
    # One task a part; choose parts so that one is a few hundred MB.
    added.repartition(F.col(PART)).write.mode("overwrite").partitionBy(PART).parquet(data)
    schema = T.StructType([f for f in added.schema.fields if f.name != PART])
    stored = spark.read.schema(added.schema).parquet(data)
    bits = F.ceil(F.col("rows") * BITS / BITMAP) * BITMAP
    sums = stored.groupBy(PART).agg(*_checks(spark.createDataFrame([], schema))).withColumn("bits", bits.cast("bigint"))
    common = {"parts": F.lit(parts), "key": F.lit(",".join(keys))}
    sums = sums.withColumns({"path": F.concat(F.lit(f"data/version={number}/{PART}="), F.col(PART))} | common)
    wanted = T.StructType.fromDDL(MANIFEST).names
    new = spark.createDataFrame(sums.select(*wanted).collect(), MANIFEST)  # a row per part
    _filters(stored, new.select(PART, "bits"), keys).write.mode("overwrite").parquet(f"{target}/filters/version={number}")
    # A row without a folder keeps the settings of an empty version.
    empty = spark.createDataFrame([(-1, None, parts, ",".join(keys), 0, None, None, 0)], MANIFEST)
    rows = kept.select(*wanted).unionByName(new).unionByName(empty)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest/version={number}")
    return number


def publish(df: DataFrame, target: str, key: str | Sequence[str] = names.KEY, parts: int | None = None) -> int:
    """A new version that holds the rows of ``df``; returns its number.

    Parts whose rows are those of the last version keep its folders; only the others are written. ``parts`` is fixed by the first
    version (64 by default), and asking for another number, key or set of columns is an error, as is a NULL or repeated key. The
    frame is read three times: store what is costly to compute.
    """
    spark, keys, last = df.sparkSession, key_columns(key), version(df.sparkSession, target)
    if PART in df.columns:
        raise ValueError(f"a column named {PART} cannot be stored")
    parts = (last.parts if last else 64) if parts is None else parts
    if last and (last.parts, last.keys) != (parts, keys):
        raise ValueError(f"{target} has {last.parts} parts by {last.keys}, not {parts} by {keys}")
    assert_key(df, keys)
    if last is None:
        df.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{target}/schema")
        kept = spark.createDataFrame([], MANIFEST)
        return _commit(spark, target, 0, kept, df.withColumn(PART, part_of(keys, parts)), parts, keys)
    df = _as_stored(df, schema_of(spark, target))
    dealt = df.withColumn(PART, part_of(keys, parts))
    now = {r[PART]: r for r in dealt.groupBy(PART).agg(*_checks(df)).collect()}
    before: dict[int, list] = {}
    for r in last.folders.collect():
        before.setdefault(r["part"], []).append(r)
    same = [p for p, r in now.items() if _like(r, before.get(p, []))]
    kept = last.folders.where(F.col(PART).isin(same))
    return _commit(spark, target, last.number + 1, kept, dealt.where(~F.col(PART).isin(same)), parts, keys)


def _like(now, folders: list) -> bool:
    total, xor = sum(r["rows"] for r in folders), 0
    for r in folders:
        xor ^= r["xor"]
    return bool(folders) and (now["rows"], now["xor"], now["sum"]) == (total, xor, sum(r["sum"] for r in folders))


def _as_stored(df: DataFrame, schema: T.StructType) -> DataFrame:
    if sorted(df.columns) != sorted(schema.names):
        raise ValueError(f"columns {sorted(df.columns)}, stored are {sorted(schema.names)}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def fold(spark: SparkSession, target: str) -> int | None:
    """A version with the same rows, in which parts that appends left in several folders have one. None if there are none."""
    last = version(spark, target)
    many = [r[PART] for r in last.folders.groupBy(PART).count().where("count > 1").select(PART).collect()]
    if not many:
        return None
    rows = _read(spark, target, [p for part, p in last.paths() if part in set(many)], schema_of(spark, target))
    return _commit(spark, target, last.number + 1, last.folders.where(~F.col(PART).isin(many)), rows, last.parts, last.keys)


def expire(spark: SparkSession, target: str, keep: int = 2) -> list[int]:
    """Removes all versions but the last ``keep``, and the folders that none of those has; returns the removed numbers.

    Manifests go first, so a run that fails half way leaves no version without its rows; the next run removes the rest. No reader
    may be at work on the removed versions. Stored changes stay.
    """
    found = versions(spark, target)
    gone, kept = found[:-keep], found[-keep:]
    for number in gone:
        remove(spark, f"{target}/manifest/version={number}")
    held = {p for number in kept for _, p in version(spark, target, number).paths()}
    for number in numbered_folders(spark, f"{target}/data", "version", finished=False):
        if number > kept[-1]:
            continue  # a version that is being written
        folder = f"data/version={number}"
        own = {f"{folder}/{PART}={p}" for p in numbered_folders(spark, f"{target}/{folder}", PART, finished=False)}
        if not own & held:
            remove(spark, f"{target}/{folder}")
            remove(spark, f"{target}/filters/version={number}")
        else:
            for path in own - held:
                remove(spark, f"{target}/{path}")
    return gone


def folders_that_may_hold(df: DataFrame, target: str, at: Version) -> DataFrame:
    """(keys, part, path): folders whose filter does not rule a key of ``df`` out. No row of the table is read."""
    spark, keys = df.sparkSession, at.keys
    wanted = df.select(*keys).distinct().withColumn(PART, part_of(keys, at.parts))
    asked = wanted.join(at.folders.select(PART, "path", "bits"), PART)
    asked = asked.withColumn("bit", F.explode(_positions(keys, F.col("bits"))))
    asked = asked.withColumn("bucket", F.floor(F.col("bit") / BITMAP)).withColumn("at", (F.col("bit") % BITMAP).cast("int"))
    stored = spark.read.option("basePath", f"{target}/filters").parquet(f"{target}/filters")
    stored = stored.select(F.concat(F.lit("data/version="), F.col("version"), F.lit(f"/{PART}="), F.col(PART)).alias("path"), "bucket", "bitmap")
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte.cast("bigint"), F.col("at") % 8) == 1
    hit = asked.join(stored, ["path", "bucket"]).where(is_set)
    # Two probes may ask for one bit, and each of them finds it.
    return hit.groupBy(*keys, PART, "path").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == PROBES).select(*keys, PART, "path")


def append_unseen(df: DataFrame, target: str) -> int | None:
    """Adds the rows whose key the table lacks, as a new version; None if there are none. A repeated run adds nothing.

    The filters say which folders may hold which keys of the batch; only those are read, only their key columns, and normally
    that is none. Rows with a NULL or repeated key are refused.
    """
    spark = df.sparkSession
    at = version(spark, target)
    if at is None:
        raise ValueError(f"{target} does not exist; publish its first version")
    assert_key(df, at.keys)
    schema = schema_of(spark, target)
    df = _as_stored(df, schema)
    new = unseen_in(df, target, at)
    if new.isEmpty():
        return None
    return _commit(spark, target, at.number + 1, at.folders, new.withColumn(PART, part_of(at.keys, at.parts)), at.parts, at.keys)


def unseen_in(df: DataFrame, target: str, at: Version) -> DataFrame:
    """The rows of ``df`` whose key the version lacks, read through its filters."""
    spark = df.sparkSession
    paths = sorted(r["path"] for r in folders_that_may_hold(df, target, at).select("path").distinct().collect())
    if not paths:
        return df
    return unseen_rows(df, _read(spark, target, paths, schema_of(spark, target)), at.keys)


def changes_between_versions(spark: SparkSession, target: str, old: int, new: int, columns: Sequence[str]) -> DataFrame:
    """``change_set`` of two versions. Folders that both have are not read."""
    a, b, schema = version(spark, target, old), version(spark, target, new), schema_of(spark, target)
    left, right = {p for _, p in a.paths()}, {p for _, p in b.paths()}
    before = _read(spark, target, sorted(left - right), schema).drop(PART)
    after = _read(spark, target, sorted(right - left), schema).drop(PART)
    return change_set(before, after, columns, a.keys)


def store_changes(spark: SparkSession, target: str, number: int, columns: Sequence[str]) -> None:
    """The change feed of a version, once: keys, new values, ``version`` and ``deleted``. Version 0 is all inserts."""
    at = version(spark, target, number)
    if number == versions(spark, target)[0]:
        rows = read(spark, target, number).select(*at.keys, *columns, F.lit(number).cast("bigint").alias("version"), F.lit(False).alias("deleted"))
    else:
        found = changes_between_versions(spark, target, number - 1, number, columns)
        rows = as_updates(found, columns, F.lit(number).cast("bigint"), at.keys)
    rows.write.mode("overwrite").parquet(f"{target}/changes/version={number}")


def read_changes(spark: SparkSession, target: str) -> DataFrame:
    """The stored feed, as a stream; ``keyed_sync.sync`` takes it in by key and ``version``.

    A feed that a crash made to be written twice delivers rows twice, which that sync does not mind.
    """
    found = spark.read.parquet(f"{target}/changes").schema
    return spark.readStream.schema(found).parquet(f"{target}/changes")


def point_lookup(keys: DataFrame, target: str, features: Sequence[str], number: int | None = None) -> DataFrame:
    """The features of each requested key, NULL for unknown ones; each request gives one row.

    Up to ``MOST_REQUESTS`` different keys, counted first unless the planner knows them to be small, are broadcast and prune the
    table's parts at run time, so only parts that can hold a requested key are read; more than that are joined like any other
    frame. Other columns of ``keys`` stay.
    """
    spark = keys.sparkSession
    at = version(spark, target, number)
    rows = _read(spark, target, [p for _, p in at.paths()], schema_of(spark, target)).select(*at.keys, PART, *features)
    asked = keys.select(*at.keys).distinct().withColumn(PART, part_of(at.keys, at.parts))
    if not fits_broadcast(keys) and asked.limit(MOST_REQUESTS + 1).count() > MOST_REQUESTS:
        return keys.join(rows.drop(PART), at.keys, "left")
    # The comparison tells the planner that the requests select, which a join alone does not.
    found = rows.join(F.broadcast(asked.where(F.col(PART) >= 0)), [*at.keys, PART]).drop(PART)
    return keys.join(found, at.keys, "left").select(*keys.columns, *features)
