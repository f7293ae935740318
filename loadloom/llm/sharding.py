"""Shards of near-equal bytes by histogram sort.

Rows are ordered by a hash of their text, then by a hash of id and text. Where the splitters lie is found by counting: each
round lays probes into the interval that still holds a splitter and adds up the exact bytes between them in one small
aggregate; the interval shrinks by that factor until a probe is within tolerance. Rows are moved once, at the end. Equal
texts lie side by side and share a shard unless their group is too large for the tolerance, in which case it is split by the
second hash, and copies of one row by their number. Only DataFrame functions run; the driver sees a bounded number of counts per
round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadloom.llm.graphs import written

#: Keys are whole numbers from 0 to this.
SPACE = 1 << 62
#: Intervals between probes in each round, in all and per open splitter.
PROBES, REFINE = 1024, 64
#: Rows that one task numbers at most, on average.
NUMBERED = 100_000
#: Copies of one row that one task unfolds at once.
UNFOLDED = 100_000


@dataclass
class Interval:
    """Where a splitter must lie: text key from lo to hi, or within one text key, row key from lo to hi."""

    target: int
    below: int = 0
    lo: int = 0
    hi: int = SPACE
    text_key: int | None = None
    found: tuple[int, int, int] | None = None


def _key(*columns: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 2)


def _piece(i: Interval, probes: int) -> int:
    return max(1, -(-(i.hi - i.lo) // probes))


def _counted(keys: DataFrame, spans: list[Interval], probes: int) -> dict[int, dict[int, int]]:
    """Bytes in each piece of each span, empty pieces left out."""
    at = None
    for k, s in enumerate(spans):
        key = F.col("text_key") if s.text_key is None else F.col("row_key")
        here = (key >= F.lit(s.lo)) & (key < F.lit(s.hi))
        if s.text_key is not None:
            here &= F.col("text_key") == F.lit(s.text_key)
        name = "text_key" if s.text_key is None else "row_key"
        # Whole-number division; doubles would blur large keys.
        value = F.expr(f"{k * probes}L + ({name} - {s.lo}L) div {_piece(s, probes)}L")
        at = F.when(here, value) if at is None else at.when(here, value)
    rows = keys.select(at.alias("at"), (F.col("size") * F.col("copies")).alias("size")).where("at is not null")
    out: dict[int, dict[int, int]] = {}
    for at_, size in rows.groupBy("at").agg(F.sum("size")).collect():
        out.setdefault(at_ // probes, {})[at_ % probes] = size
    return out


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int, int]]:
    """The first (text key, row key, copy) of each shard but the first. ``tolerance``: share of a shard's bytes."""
    total = keys.agg(F.sum(F.col("size") * F.col("copies"))).first()[0] or 0
    slack = int(tolerance * total / shards)
    open_ = every = [Interval(total * i // shards) for i in range(1, shards)]
    probes = PROBES
    while open_:
        spans = list({(s.text_key, s.lo, s.hi): s for s in open_}.values())
        index = {(s.text_key, s.lo, s.hi): k for k, s in enumerate(spans)}
        counts = _counted(keys, spans, probes)
        for s in open_:
            got, step = counts.get(index[(s.text_key, s.lo, s.hi)], {}), _piece(s, probes)
            below, left, right = s.below, s.lo, s.hi
            for piece in sorted(got):
                if below + got[piece] > s.target:
                    left, right = s.lo + piece * step, min(s.hi, s.lo + (piece + 1) * step)
                    after = below + got[piece]
                    break
                below += got[piece]
                left = min(s.hi, s.lo + (piece + 1) * step)
            else:
                left, after = s.hi, below
            near, error = (left, s.target - below) if s.target - below <= after - s.target else (right, after - s.target)
            if error <= slack or left >= s.hi:
                s.found = (near, 0, 0) if s.text_key is None else (s.text_key, near, 0)
            elif right - left == 1 and s.text_key is not None:
                s.found = (s.text_key, *_between_copies(keys, s, left, below))
            elif right - left == 1:
                s.below, s.text_key, s.lo, s.hi = below, left, 0, SPACE
            else:
                s.below, s.lo, s.hi = below, left, right
        open_ = [s for s in open_ if s.found is None]
        probes = REFINE
    return sorted(s.found for s in every)


def _between_copies(keys: DataFrame, s: Interval, row_key: int, below: int) -> tuple[int, int]:
    """The row key and copy nearest to the target among the copies of the row (of the rows, if their keys are equal) there."""
    one = keys.where((F.col("text_key") == s.text_key) & (F.col("row_key") == row_key)).agg(F.sum("copies"), F.sum(F.col("size") * F.col("copies"))).first()
    copies, size = one
    copy = round((s.target - below) * copies / size)
    return (row_key, copy) if copy < copies else (row_key + 1, 0)


def _in_shards(keys: DataFrame, bounds: list[tuple[int, int, int]]) -> DataFrame:
    """``keys`` with ``shard`` and the copies that lie there; a row whose copies a splitter divides has one row per shard."""
    first, cuts = F.lit(0), []
    for text_key, row_key, copy in bounds:
        here = (F.col("text_key") == text_key) & (F.col("row_key") == row_key)
        past = (F.col("text_key") > text_key) | ((F.col("text_key") == text_key) & (F.col("row_key") > row_key))
        first = first + (past | (here if copy == 0 else F.lit(False))).cast("int")
        if copy:
            cuts.append(F.when(here, F.lit(copy).cast("bigint")))
    if not cuts:
        return keys.withColumn("shard", first)
    # Rows with equal keys (a hash's fault) are divided alike, each at most at its own last copy.
    inner = F.transform(F.array_compact(F.array(*cuts)), lambda c: F.least(c, F.col("copies")))
    ends = F.concat(inner, F.array("copies"))
    pieces = F.transform(ends, lambda e, i: F.struct((first + i).alias("shard"), (e - F.when(i == 0, 0).otherwise(F.get(ends, i - 1))).alias("copies")))
    rows = keys.withColumn("piece", F.explode(pieces)).withColumns({"shard": F.col("piece.shard"), "copies": F.col("piece.copies")})
    return rows.drop("piece").where("copies > 0")


def shard_by_bytes(docs: DataFrame, shards: int = 24, tolerance: float = 0.005) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs`` (doc_id, text); other columns are ignored.

    ``size`` is the UTF-8 length plus 8 (a null text: 8, checksum 0). The bytes of a shard are within ``tolerance`` of the mean
    or as near as whole rows allow, repeated rows included. Slots count from 0 without gaps. A null
    doc_id is a value like any other. Every repeated row has a slot of its own. An empty table gives an empty result.
    """
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 2).alias("text_key"),
    )
    keys = rows.groupBy("doc_id", "size", "text_crc32", "text_key").agg(F.count("*").alias("copies"))
    keys = written(keys.withColumn("row_key", _key("doc_id", "text_key")), "keys")
    bounds = splitters(keys, shards, tolerance)
    parts = max(1, -(-keys.count() // (shards * NUMBERED)))
    placed = _in_shards(keys, bounds).withColumn("part", F.pmod("row_key", F.lit(parts)))
    sizes = placed.groupBy("shard", "part").agg(F.sum("copies").alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "part").orderBy("text_key", "row_key", "doc_id", "size", "text_crc32")
    numbered = placed.withColumn("end", F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    slots = numbered.join(starts, ["shard", "part"]).withColumn("last", F.col("start") + F.col("end") - 1)
    columns = ["doc_id", "size", "text_crc32", "shard"]
    slots = slots.select(*columns, (F.col("last") - F.col("copies") + 1).alias("low"), F.col("last").alias("high"), "copies")
    # Many copies of one row are cut into stretches that are spread over tasks.
    few, many = slots.where(F.col("copies") <= UNFOLDED), slots.where(F.col("copies") > UNFOLDED)
    many = many.withColumn("low", F.explode(F.sequence("low", "high", F.lit(UNFOLDED).cast("bigint"))))
    many = many.withColumn("high", F.least(F.col("low") + UNFOLDED - 1, "high")).repartition("shard", "low")
    return few.unionByName(many).select(*columns, F.explode(F.sequence("low", "high")).alias("slot"))
