"""Positions of stored rows: which file holds the row at a position, from row counts per file.

The order is that of the files by name and of the rows within them, which for tables stored in time order is time order. An index
has one row per file; slices and draws read only the files that they hit, and within them Spark skips by row number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE, ROW = "_file", "_row"


@dataclass(frozen=True)
class Positions:
    """``index``: file, first (the position of its first row), rows. ``rows``: of the whole table."""

    frame: DataFrame
    index: DataFrame
    rows: int


def _located(df: DataFrame) -> DataFrame:
    return df.withColumns({FILE: F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index")})


def positions_of(df: DataFrame) -> Positions:
    """The index of a frame read from unpartitioned Parquet files, counted without reading a column. A row per file reaches the driver, which
    numbers them."""
    counts = df.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    first, rows = 0, []
    for r in counts.sort("file").collect():
        rows.append((r["file"], first, r["rows"]))
        first += r["rows"]
    return Positions(df, df.sparkSession.createDataFrame(rows, "file string, first bigint, rows bigint"), first)


def _files(at: Positions, hit: DataFrame) -> list[str]:
    return sorted(r[0] for r in hit.select("file").distinct().collect())


def _read(at: Positions, files: list[str]) -> DataFrame:
    """The same columns from some of the files."""
    spark: SparkSession = at.frame.sparkSession
    if not files:
        return _located(at.frame).limit(0)
    return _located(spark.read.schema(at.frame.schema).parquet(*files))


def rows_at(at: Positions, start: int, stop: int) -> DataFrame:
    """Rows at positions ``start`` up to, not including, ``stop``, from the files that hold them."""
    start, stop = max(start, 0), min(stop, at.rows)
    hit = at.index.where((F.col("first") < stop) & (F.col("first") + F.col("rows") > start))
    if stop <= start:
        return at.frame.limit(0)
    rows = _read(at, _files(at, hit)).join(hit.withColumnRenamed("file", FILE), FILE)
    place = F.col("first") + F.col(ROW)
    return rows.where((place >= start) & (place < stop)).select(*at.frame.columns)


def draw(at: Positions, n: int, seed: int = 0) -> DataFrame:
    """``n`` independent uniform draws of rows, in no order and with repetition. Nothing is stored.

    Positions are drawn by a digest of seed and number of the draw, found in the index, and joined to the rows of the files they fall into.
    A row drawn more than once is returned as often; a repeated run with the same seed draws the same rows.
    """
    if n <= 0:
        return at.frame.limit(0)
    if at.rows == 0:
        raise ValueError("cannot draw from an empty frame")
    spark = at.frame.sparkSession
    # 60 bits of a digest over the number of rows: the bias towards any position is below rows / 2^60.
    digest = F.md5(F.concat_ws("/", F.lit(seed).cast("string"), F.col("id").cast("string")))
    drawn = spark.range(n).select((F.conv(F.right(digest, F.lit(15)), 16, 10).cast("bigint") % at.rows).alias("place"))
    drawn = drawn.groupBy("place").agg(F.count(F.lit(1)).alias("_times"))
    # Every file stands under each stretch of positions that it reaches into; there are about twice as many as files.
    size = max(1, at.rows // max(1, at.index.count()))
    stretch = lambda c: F.floor(c / F.lit(size))
    reach = F.sequence(stretch(F.col("first")), stretch(F.col("first") + F.col("rows") - 1))
    files = at.index.where("rows > 0").withColumn("stretch", F.explode(reach))
    held = drawn.withColumn("stretch", stretch(F.col("place"))).join(files, "stretch")
    held = held.where((F.col("place") >= F.col("first")) & (F.col("place") < F.col("first") + F.col("rows")))
    held = held.select(F.col("file").alias(FILE), (F.col("place") - F.col("first")).alias(ROW), "_times")
    files = sorted(r[0] for r in held.select(FILE).distinct().collect())
    rows = _read(at, files).join(held, [FILE, ROW])
    return rows.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))).select(*at.frame.columns)
