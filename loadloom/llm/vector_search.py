"""Exact top-k by inner product with a vector-approximation file.

Every component of a vector is cut into one of 256 cells between the smallest and largest value of its dimension; the file of
cells takes a byte per component. A query's scores with all cells of a block are one matrix product, and since the cells of a
dimension are equally wide, each score is known to within one gap per query: a lower and an upper bound for every vector.
Only vectors whose upper bound reaches the kth best lower bound are candidates. Their exact vectors are read in order of
their bounds: first the most promising few of each query, whose kth exact score then shows which others must be read.

Equal vectors are searched once. A class of them is named by a 64-bit hash and keeps its k + 1 smallest ids, which is all that
any query can return from it. Query blocks meet vector blocks; both are of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadloom.llm.graphs import written

SCALE, CELLS = 1024, 256
#: Vectors and queries of a block.
VECTORS, QUERIES = 8192, 2048
#: Exact vectors that each query reads before it knows its kth score, as a multiple of k.
FIRST = 2
#: Scores lie below this.
LIMIT = float(2**63)


#: Whole numbers below this are exact in a double.
EXACT = float(2**53)


def whole(embedding: Column) -> Column:
    """``floor(1024 * x)`` of each component; NULL if one is null, not finite, or beyond what a double holds exactly."""
    scaled = F.transform(embedding, lambda x: x.cast("double") * SCALE)
    bad = F.exists(scaled, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= EXACT))
    return F.when(~F.coalesce(bad, F.lit(False)), F.transform(scaled, lambda x: F.floor(x).cast("bigint")))


def _vectors(group: pa.Table) -> np.ndarray:
    flat = group.column("v").combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy().reshape(group.num_rows, -1)


def _cells_of(low: np.ndarray, width: np.ndarray):
    def run(group: pa.Table) -> pa.Table:
        cells = ((_vectors(group) - low) // width).astype(np.uint8)
        return pa.table({"block": group.column("block").slice(0, 1), "keys": [group.column("key").to_numpy().tobytes()], "cells": [cells.tobytes()]},
                        schema=pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("cells", pa.binary())]))

    return run


def _query_block(group: pa.Table) -> pa.Table:
    return pa.table({"query_block": group.column("query_block").slice(0, 1), "query_keys": [group.column("key").to_numpy().tobytes()], "queries": [_vectors(group).tobytes()]},
                    schema=pa.schema([("query_block", pa.int64()), ("query_keys", pa.binary()), ("queries", pa.binary())]))


_CANDIDATES = pa.schema([("query", pa.int64()), ("key", pa.int64()), ("lower", pa.float64()), ("upper", pa.float64())])


def _bounded(low: np.ndarray, width: np.ndarray, k: int):
    """Candidates of each query in one block, by the bounds of their cells."""
    most = np.maximum(np.abs(low), np.abs(low + CELLS * width)).astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["keys"], dtype=np.int64)
                cells = np.frombuffer(row["cells"], dtype=np.uint8).reshape(len(keys), -1)
                floor = (low + cells * width).astype(np.float64).T
                query_keys = np.frombuffer(row["query_keys"], dtype=np.int64)
                queries = np.frombuffer(row["queries"], dtype=np.int64).reshape(len(query_keys), -1).astype(np.float64)
                for a in range(0, len(queries), 256):
                    q = queries[a : a + 256]
                    scores = q @ floor
                    slack = 1e-13 * (np.abs(q) @ most)[:, None]
                    lower = scores + (np.minimum(q, 0) @ (width - 1))[:, None] - slack
                    gap = (np.abs(q) @ (width - 1))[:, None] + 2 * slack
                    # A score that may lie beyond 64 bits counts for nothing until it is known; one that must is none.
                    none = (lower >= LIMIT) | (lower + gap < -LIMIT)
                    lower = np.where((lower < -LIMIT) | (lower + gap >= LIMIT), -np.inf, lower)
                    kept = min(k, lower.shape[1])
                    least = np.partition(lower, lower.shape[1] - kept, axis=1)[:, -kept][:, None]
                    i, j = np.nonzero((lower + gap >= least) & ~none | np.isneginf(lower) & ~none)
                    found = lower[i, j]
                    upper = np.where(np.isneginf(found), np.inf, found + gap[i, 0])
                    columns = [query_keys[a + i], keys[j], found, upper]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_CANDIDATES)

    return run


def _first(df: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= k)


def _scored(pairs: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """Exact scores of (query, key) pairs."""
    rows = pairs.join(vectors.select("key", "v"), "key").join(queries.select(F.col("key").alias("query"), F.col("v").alias("q")), "query")
    wide = F.aggregate(F.zip_with("q", "v", lambda a, b: a.cast("decimal(17,0)") * b.cast("decimal(17,0)")), F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x).cast("decimal(38,0)"))
    plain = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda s, x: s + x)
    # Products of components below 2^24 cannot pass 64 bits.
    large = F.exists("q", lambda x: F.abs(x) >= 1 << 24) | F.exists("v", lambda x: F.abs(x) >= 1 << 24)
    score = F.when(large, wide.try_cast("bigint")).otherwise(plain)
    return rows.select("query", "key", score.alias("score")).where("score is not null")


def _search(classes: DataFrame, queries: DataFrame, dims: int, k: int) -> DataFrame:
    """(query, key, score): at least the k best classes of each query class, ties of the kth included."""
    ends = classes.agg(*[f(F.col("v")[d]).alias(f"{name}{d}") for d in range(dims) for name, f in (("a", F.min), ("b", F.max))]).first()
    low = np.array([ends[f"a{d}"] for d in range(dims)], dtype=np.int64)
    width = np.array([(ends[f"b{d}"] - ends[f"a{d}"]) // CELLS + 1 for d in range(dims)], dtype=np.int64)
    blocks, query_blocks = -(-classes.count() // VECTORS), -(-queries.count() // QUERIES)
    dealt = classes.select("key", "v", F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"))
    file = written(dealt.groupBy("block").applyInArrow(_cells_of(low, width), "block bigint, keys binary, cells binary"), "cells")
    asked = queries.select("key", "v", F.pmod(F.xxhash64("key"), F.lit(query_blocks)).alias("query_block"))
    asked = asked.groupBy("query_block").applyInArrow(_query_block, "query_block bigint, query_keys binary, queries binary")
    met = file.withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint")))).join(asked, "query_block")
    bounds = met.select("keys", "cells", "query_keys", "queries").mapInArrow(_bounded(low, width, k), "query bigint, key bigint, lower double, upper double")
    bounds = written(bounds, "bounds")
    certain = _first(bounds, "query", [F.col("lower").desc(), F.col("key")], k).groupBy("query").agg(F.min("lower").alias("least"), F.count("*").alias("n"))
    bounds = bounds.join(certain, "query").where((F.col("upper") >= F.col("least")) | (F.col("n") < k))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("upper").desc(), "key"))
    bounds = written(bounds.select("query", "key", "upper", place.alias("place")), "bounds")
    read = written(_scored(bounds.where(F.col("place") <= FIRST * k), classes, queries), "scores")
    sure = _first(read, "query", [F.col("score").desc(), F.col("key")], k).groupBy("query").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    rest = bounds.where(F.col("place") > FIRST * k).join(sure, "query").where((F.col("upper") >= F.col("least")) | (F.col("n") < k))
    return read.union(_scored(rest.select("query", "key"), classes, queries))


def top_k(embeddings: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by ``every``, the k highest inner products.

    Ties go to the smaller vec_id. Rows with the query's own id are no candidates; with fewer than k others, all are returned.
    Vectors that are null or hold nulls, numbers that are not finite or beyond 2^43, and null ids, take no part; scores beyond 64
    bits count as none; vectors of different lengths never meet, and empty ones none. Rows that agree in id and vector are one. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole(F.col("embedding")).alias("v"))
    rows = rows.where("vec_id is not null and v is not null and size(v) > 0").withColumn("key", F.xxhash64("v"))
    rows = written(rows, "vectors")
    asked = rows.where(F.col("vec_id") % every == 0)
    out = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    for dims in [r[0] for r in rows.select(F.size("v")).distinct().sort("size(v)").collect()]:
        same = rows.where(F.size("v") == dims)
        few = _first(same.select("key", "vec_id").distinct(), "key", [F.col("vec_id")], k + 1)
        ids = written(few.select("key", "vec_id"), "ids")
        classes = written(same.groupBy("key").agg(F.first("v").alias("v")), "classes")
        queries = written(asked.where(F.size("v") == dims).groupBy("key").agg(F.first("v").alias("v")), "queries")
        if queries.isEmpty():
            continue
        best = _search(classes, queries, dims, k + 1).join(ids, "key")
        best = _first(best, "query", [F.col("score").desc(), F.col("vec_id")], k + 1).drop("place")
        own = asked.where(F.size("v") == dims).select(F.col("key").alias("query"), F.col("vec_id").alias("query_id")).distinct()
        answers = best.join(own, "query").where(F.col("vec_id") != F.col("query_id"))
        rank = F.row_number().over(Window.partitionBy("query", "query_id").orderBy(F.col("score").desc(), "vec_id"))
        answers = answers.withColumn("rank", rank).where(F.col("rank") <= k)
        out = out.union(answers.select("query_id", "rank", "vec_id", "score"))
    return out
