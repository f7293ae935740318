"""Catalog tables: scan, append, overwrite, insert-select, keyed feature tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom import names
from loadloom.operators.keys import assert_key, unseen_rows
from loadloom.operators.skew import key_columns
from loadloom.session import remove


def scan(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table, or parquet files when the name is a path."""
    return spark.read.parquet(table) if "/" in table else spark.table(table)


def _writer(df: DataFrame, path: str | None, key: str | Sequence[str] | None = None, buckets: int | None = None):
    if buckets:
        # One task per bucket, so that each bucket is one file.
        keys = key_columns(key)
        writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    else:
        writer = df.write
    return writer.option("path", path) if path else writer


def append(
    df: DataFrame, table: str, path: str | None = None, key: str | Sequence[str] = names.KEY,
    buckets: int | None = None,
) -> None:
    """Adds the rows; makes the table if there is none, with ``buckets`` bucketed by its key.

    Columns are matched by name. Tables bucketed alike are joined by key without a shuffle.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df.select(*spark.table(table).columns).write.insertInto(table)
    else:
        _writer(df, path, key, buckets).saveAsTable(table)


VERSIONS = "_versions"


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").collect()
    begin = next(i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed"))
    return {r["col_name"]: r["data_type"] for r in rows[begin:]} | {
        "partitioned": "yes" if any(r["col_name"] == "# Partition Information" for r in rows) else ""
    }


def location(spark: SparkSession, table: str) -> str:
    """Where the table's files lie now. ``overwrite`` moves it; names stay valid, paths kept elsewhere do not."""
    return _described(spark, table)["Location"]


def _names(text: str) -> list[str]:
    return [c.strip().strip("`") for c in text.strip("[]").split(",") if c.strip()]


def _stage(df: DataFrame, table: str, told: dict[str, str], folder: str) -> None:
    """All rows into a new folder, in the table's columns, types, format and buckets."""
    spark, declared = df.sparkSession, df.sparkSession.table(table).schema
    rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in declared.fields])
    kind, buckets = told.get("Provider", "parquet"), told.get("Num Buckets")
    if not buckets:
        rows.write.format(kind).save(folder)
        return
    keys, sort = _names(told["Bucket Columns"]), _names(told.get("Sort Columns", ""))
    writer = rows.repartition(int(buckets), *keys).write.format(kind).bucketBy(int(buckets), *keys)
    writer = writer.sortBy(*sort) if sort else writer
    # Only a table can be written in buckets: one of its own, which leaves its files when it goes.
    own = f"{table.rsplit('.', 1)[0]}." if "." in table else ""
    own += f"loadloom_{folder.rsplit('-', 1)[1]}"
    writer.option("path", folder).saveAsTable(own)
    spark.sql(f"DROP TABLE {own}")


def overwrite(df: DataFrame, table: str, path: str | None = None, keep: int = 1) -> None:
    """Replaces the rows of the table; buckets, format, comment and properties stay. Makes the table if there is none.

    The new rows are written completely into a folder of their own below the table's first one, and the table's location is
    then switched to it: that switch is the only step that readers can notice, so a run that fails anywhere leaves the old rows,
    and a reader never finds none. The frame may read the table itself. ``keep`` replaced versions stay for readers at work;
    older ones, and what failed runs left, are removed. One writer at a time.

    Columns are matched by name and cast to the table's types. A partitioned table has more than one location and is refused.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        _writer(df, path).saveAsTable(table)
        return
    told = _described(spark, table)
    if told["partitioned"]:
        raise ValueError(f"{table} is partitioned; replace its partitions by INSERT OVERWRITE")
    folder = _new_version(told["Location"])
    _stage(df, table, told, folder)
    _switch(spark, table, folder)
    expire(spark, table, keep)


def _root(place: str) -> str:
    return place.split(f"/{VERSIONS}/")[0].rstrip("/")


def _new_version(place: str) -> str:
    return f"{_root(place)}/{VERSIONS}/{time.time_ns():020d}-{uuid.uuid4().hex}"


def _switch(spark: SparkSession, table: str, folder: str) -> None:
    """The commit."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def versions(spark: SparkSession, table: str) -> list[str]:
    """Folders of the table's versions that are still there, oldest first; the table's first folder counts if it has files."""
    root = _root(location(spark, table))
    return [root] * bool(_data_files(spark, root)) + _folders(spark, f"{root}/{VERSIONS}")


def expire(spark: SparkSession, table: str, keep: int = 1) -> None:
    """Removes all versions but the current one and the ``keep`` before it. Folders newer than the current one were never
    committed and go as well, so no writer may be at work."""
    now, found = location(spark, table), versions(spark, table)
    root = _root(now)
    at = [f.rstrip("/").split("/")[-1] for f in found].index(now.rstrip("/").split("/")[-1]) if now != root else 0
    for folder in found[: max(at - keep, 0)] + found[at + 1 :]:
        if folder == root:
            for file in _data_files(spark, root):
                remove(spark, file)
        else:
            remove(spark, folder)


def drop(spark: SparkSession, table: str) -> None:
    """Drops the table with the files of all its versions."""
    root = _root(location(spark, table))
    spark.sql(f"DROP TABLE {table}")
    remove(spark, root)


def _listed(spark: SparkSession, folder: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(files.listStatus(path)) if files.exists(path) else []


def _folders(spark: SparkSession, folder: str) -> list[str]:
    return sorted(f"{folder}/{s.getPath().getName()}" for s in _listed(spark, folder) if s.isDirectory())


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    return [f"{folder}/{s.getPath().getName()}" for s in _listed(spark, folder) if not s.isDirectory()]


def append_unseen(df: DataFrame, table: str, key: str | Sequence[str] = names.KEY) -> None:
    """S4 with J5: rows whose key the table already has are not added again, so a repeated run adds nothing.

    That holds only for keys, so a batch with a NULL or repeated key is refused before anything is written; ``divide_by_key``
    takes such rows out.
    """
    assert_key(df, key_columns(key))
    append(unseen_rows(df, df.sparkSession.table(table), key), table)


def insert_select(df: DataFrame, table: str, columns: Sequence[str]) -> None:
    """Named columns into a table by position, cast to the table's types."""
    declared = df.sparkSession.table(table).schema
    if len(declared) != len(columns):
        raise ValueError(f"{table} has {len(declared)} columns, {len(columns)} are given")
    casts = [F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(columns, declared.fields, strict=True)]
    df.select(*casts).write.insertInto(table)


def create_empty(spark: SparkSession, table: str, schema: T.StructType, path: str | None = None) -> None:
    """An empty table of a declared schema, in place of any table of that name and of its definition."""
    _writer(spark.createDataFrame([], schema), path).mode("overwrite").saveAsTable(table)


def create_keyed_table(
    df: DataFrame,
    table: str,
    key: str | Sequence[str] = names.KEY,
    description: str = "",
    path: str | None = None,
    buckets: int | None = None,
) -> None:
    """A new table whose key is checked before it is written (S8), with the key kept as a table property.

    For a table that is looked up over and over, ``buckets`` (its size over some 200 MB) saves its shuffle each time.
    """
    keys = key_columns(key)
    assert_key(df, keys)
    _writer(df, path, key, buckets).mode("errorifexists").saveAsTable(table)
    text = description.replace("'", "\\'")
    df.sparkSession.sql(f"COMMENT ON TABLE {table} IS '{text}'")
    df.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('loadloom.key' = '{','.join(keys)}')")


def temp_view(df: DataFrame, name: str) -> None:
    """S10."""
    df.createOrReplaceTempView(name)
