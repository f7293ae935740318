"""Connected components of an edge list that may hold hubs, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadloom.session import scratch_path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there and a lost executor costs nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, whatever its columns are called."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), both BIGINT: root is the smallest node reachable.

    Each round joins the larger neighbours of a node to its smallest one, then the smaller ones, until every edge leads
    from a node to its root. A round is two groupings and two joins on the nodes, which the adaptive skew join can split.
    Null ends and loops are ignored; without edges the result is empty.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = written(edges.distinct(), "edges")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        small = written(small.where("a <> b").distinct(), "edges")
        # Every node with one parent, and no parent with a parent: all are stars.
        state = small.agg(F.count("*").alias("n"), F.countDistinct("a").alias("d")).first()
        flat = state["n"] == state["d"] and small.join(small.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()
        edges = small
        if flat:
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())


def empty_components(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "node bigint, root bigint")
