"""Hard negatives by angular triangle filtering.

Every vector stores its angles to a few reference directions. For vectors a and v with angles p and t to one direction, the angle
between a and v lies between |p - t| and p + t (or 2 pi less that), so the stored angles and the norms bound the score from both
sides. Vectors of one label lie in blocks, in order of the nearest direction and of the angle to it. A block is passed over if its
ranges of angles and norms rule out every score that is asked for; of the others only the window of angles that can hold such a
score is scored in whole numbers. All bounds are widened by more than rounding can amount to.

A search first scores the few blocks with the highest bounds for each block of anchors. The kth score found there is a floor for
the rest. Directions are vectors far apart in a sample of at most ``SAMPLE`` rows; they decide the speed alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadloom.llm.graphs import written

SCALE = 256
#: Reference directions, and rows that they are chosen from.
DIRECTIONS, SAMPLE = 16, 4096
#: Rows and anchors of a block at most; blocks that are scored first.
ROWS, ANCHORS, FIRST = 4096, 512, 2
#: Widening of angles, far above the rounding of an arc cosine.
SLACK = 1e-6
#: Whole numbers up to here are exact in a double.
EXACT = float(2**53)
#: Rows with larger components are scored apart from the others.
HUGE = 2**22
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def whole(embedding: Column) -> Column:
    """``floor(256 * x)`` of each component; NULL if one is null, not finite, or beyond what a double holds exactly."""
    scaled = F.transform(embedding, lambda x: x.cast("double") * SCALE)
    bad = F.exists(scaled, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= EXACT))
    return F.when(~F.coalesce(bad, F.lit(False)), F.transform(scaled, lambda x: F.floor(x).cast("bigint")))


def directions_of(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per length of vectors, up to ``DIRECTIONS`` unit vectors far apart, from the ``SAMPLE`` rows with the smallest hash."""
    drawn = rows.select("v").orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).collect()
    by_length: dict[int, list] = {}
    for r in drawn:
        by_length.setdefault(len(r["v"]), []).append(r["v"])
    out = {}
    for length, vectors in by_length.items():
        m = np.array(vectors, dtype=np.float64)
        m = m[np.abs(m).max(axis=1) > 0]
        if not len(m):
            continue
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        chosen, nearest = [0], m @ m[0]
        while len(chosen) < min(DIRECTIONS, len(m)):
            at = int(nearest.argmin())
            if nearest[at] > 1 - 1e-9:
                break
            chosen.append(at)
            nearest = np.maximum(nearest, m @ m[at])
        out[length] = m[chosen]
    return out


def _angles(v: np.ndarray, directions: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Norms and angles (one column per direction; a single one of zeros without directions)."""
    v = v.astype(np.float64)
    norms = np.linalg.norm(v, axis=1)
    if directions is None:
        return norms, np.zeros((len(v), 1))
    return norms, np.arccos(np.clip(v @ directions.T / np.where(norms > 0, norms, 1)[:, None], -1, 1))


def _matrix(column: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _filed(directions: dict[int, np.ndarray]):
    """Rows with their nearest direction and the angle to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pa.compute.list_value_length(batch.column("v")).to_numpy()
            for d in np.unique(lengths):
                part = batch.filter(pa.array(lengths == d))
                _, angles = _angles(_matrix(part.column("v"), part.num_rows), directions.get(int(d)))
                cell = angles.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.full(part.num_rows, d, dtype=np.int32)), pa.array(cell.astype(np.int32)), pa.array(angles[np.arange(len(cell)), cell])],
                    names=[*part.schema.names, "dims", "cell", "angle"],
                )

    return run


FILED = "vec_id bigint, label int, v array<bigint>, row bigint, dims int, cell int, angle double"
#: A block: its rows as bytes, the ranges of its angles to every direction, and of its norms.
BLOCK = "dims int, label int, cell int, ids binary, rows binary, vectors binary, low array<double>, high array<double>, least double, most double"


def _blocks(directions: dict[int, np.ndarray], size: int):
    """Cuts sorted rows into blocks of one length, label and cell."""

    def block(part: pa.Table) -> dict:
        v = _matrix(part.column("v"), part.num_rows)
        d, label, cell = (part.column(c)[0].as_py() for c in ("dims", "label", "cell"))
        norms, angles = _angles(v, directions.get(d))
        small = v.astype(np.int32)
        return {
            "dims": d, "label": label, "cell": cell, "ids": part.column("vec_id").to_numpy().tobytes(), "rows": part.column("row").to_numpy().tobytes(),
            "vectors": (small if (small == v).all() else v).tobytes(), "low": angles.min(axis=0).tolist(), "high": angles.max(axis=0).tolist(),
            "least": float(norms.min()), "most": float(norms.max()),
        }

    schema = pa.schema([("dims", pa.int32()), ("label", pa.int32()), ("cell", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary()), ("vectors", pa.binary()),
                        ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("least", pa.float64()), ("most", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kind = [], None

        def flush():
            return pa.RecordBatch.from_pylist([block(pa.Table.from_batches(held))], schema=schema)

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("dims", "label", "cell")], axis=1)
            turns = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(turns[:-1], turns[1:], strict=True):
                if a == b:
                    continue
                if held and tuple(keys[a]) != kind:
                    yield flush()
                    held = []
                kind = tuple(keys[a])
                while a < b:
                    room = size - sum(x.num_rows for x in held)
                    held.append(batch.slice(a, min(room, b - a)))
                    a += held[-1].num_rows
                    if sum(x.num_rows for x in held) == size:
                        yield flush()
                        held = []
        if held:
            yield flush()

    return run


def _in_blocks(filed: DataFrame, directions: dict, size: int, label: str) -> DataFrame:
    """Blocks (columns of ``BLOCK`` and ``block``, their number), written. Rows are dealt by ranges, so no key is too large."""
    order = ["dims", "label", "cell", "angle", "vec_id", "row"]
    n = filed.count()
    rows = filed.repartitionByRange(max(1, -(-n // (8 * size))), *order).sortWithinPartitions(*order)
    return written(rows.mapInArrow(_blocks(directions, size), BLOCK).withColumn("block", F.monotonically_increasing_id()), label)


def _upper(q: dict, v: dict) -> float:
    """No score between two blocks is higher."""
    gap = max([0.0, *(max(a - d, c - b) for a, b, c, d in zip(q["low"], q["high"], v["low"], v["high"], strict=True))]) - SLACK
    cos = float(np.cos(max(gap, 0.0)))
    norms = q["most"] * v["most"] if cos > 0 else q["least"] * v["least"]
    return norms * cos + 1 + 1e-9 * q["most"] * v["most"]


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            q = {k: r[f"q_{k}"] for k in ("low", "high", "least", "most")}
            out.append(_upper(q, r))
        yield pa.RecordBatch.from_arrays([batch.column("q_block"), batch.column("block"), batch.column("q_label"), batch.column("label"), pa.array(out, pa.float64())], names=["q_block", "block", "q_label", "label", "upper"])


def _pairs(anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """(q_block, block, q_label, label, upper): every block of anchors with every block of rows of the same length, written."""
    groups = anchors.count() // 8 + 1
    q = anchors.select(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("number"), F.col("block").alias("q_block"), F.col("dims").alias("q_dims"), F.col("label").alias("q_label"), *[F.col(c).alias(f"q_{c}") for c in ("low", "high", "least", "most")])
    ends = blocks.select("block", "dims", "label", "low", "high", "least", "most")
    ends = ends.withColumn("number", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))
    met = ends.join(q, "number").where("dims = q_dims")
    return written(met.mapInArrow(_bounded, "q_block bigint, block bigint, q_label int, label int, upper double"), "pairs")


def _products(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products, rows by queries; Python's whole numbers where doubles would round. Doubles hold the components."""
    size = np.abs(v).max(initial=0) * np.abs(q).max(initial=0) * v.shape[1]
    if size < EXACT:
        return v @ q.T
    return v.astype(np.int64).astype(object) @ q.astype(np.int64).astype(object).T


def _size_classes(v: np.ndarray) -> list[np.ndarray]:
    """Row numbers with small and with huge components, so that few huge ones do not slow the others down."""
    huge = np.abs(v).max(axis=1, initial=0) >= HUGE
    return [x for x in (np.flatnonzero(~huge), np.flatnonzero(huge)) if len(x)]


def _window(lo: np.ndarray, hi: np.ndarray, norm: np.ndarray, angle: np.ndarray, least: float, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Angles to the block's direction that can give a score from lo to hi."""
    share = lambda bound, big, small: bound / np.maximum(norm * np.where(bound > 0, big, small), 1e-300)
    near = np.arccos(np.clip(share(lo, most, least), -1, 1))
    far = np.arccos(np.clip(share(hi, least, most), -1, 1))
    a = np.maximum(angle - near, far - angle) - SLACK
    b = np.minimum(angle + near, 2 * np.pi - far - angle) + SLACK
    # Beyond a right angle or a norm, no angle does; a product of norms below the floor leaves nothing.
    b = np.where(lo > norm * most * (1 + 1e-9) + 1, -1.0, b)
    return a, b


def _together(slots: np.ndarray, first: np.ndarray, last: np.ndarray, most: int = 128) -> Iterator[np.ndarray]:
    """Slots, in order of their windows' beginnings, in groups whose windows nearly coincide, to be scored by one product."""
    begin = 0
    for end in range(1, len(slots) + 1):
        if end < len(slots) and end - begin < most:
            part = slots[begin : end + 1]
            if (last[part].max() - first[part].min()) * len(part) <= 1.5 * (last[part] - first[part]).sum():
                continue
        yield slots[begin:end]
        begin = end


FOUND = "row bigint, slot bigint, vec_id bigint, score bigint"
_FOUND = pa.schema([("row", pa.int64()), ("slot", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _scored(directions: dict[int, np.ndarray], k: int):
    """Per slot the k best rows of a block whose scores lie within the slot's bounds and that come before its last so far."""

    def pair(r: dict) -> Iterator[tuple]:
        d = r["dims"]
        whole_of = lambda raw, n: np.frombuffer(raw, dtype=np.int32 if len(raw) == 4 * n * d else np.int64).reshape(n, d).astype(np.int64)
        ids = np.frombuffer(r["ids"], dtype=np.int64)
        v = whole_of(r["vectors"], len(ids))
        q_rows, q_ids = (np.frombuffer(r[c], dtype=np.int64) for c in ("q_rows", "q_ids"))
        q = whole_of(r["q_vectors"], len(q_rows))
        s_row, s_slot, s_lo, s_id, s_hi = (np.array(r[c], dtype=np.int64) for c in ("s_row", "s_slot", "s_lo", "s_id", "s_hi"))
        at = np.searchsorted(q_rows, s_row) if (q_rows[1:] >= q_rows[:-1]).all() else np.array([np.flatnonzero(q_rows == x)[0] for x in s_row], dtype=np.int64)
        own = directions.get(d)
        _, angles = _angles(v, None if own is None else own[[r["cell"]]])
        order = np.argsort(angles[:, 0], kind="stable")
        # Components are exact in doubles, and converted once for all products.
        angles, ids, v, q = angles[order, 0], ids[order], v[order].astype(np.float64), q.astype(np.float64)
        huge = bool(len(v)) and np.abs(v).max() >= HUGE
        norm, angle = _angles(q, None if own is None else own[[r["cell"]]])
        a, b = _window(s_lo.astype(np.float64), s_hi.astype(np.float64), norm[at], angle[at, 0], r["least"], r["most"])
        first, last = np.searchsorted(angles, a, side="left"), np.searchsorted(angles, b, side="right")
        alive = np.flatnonzero(first < last)
        alive = alive[np.argsort(first[alive], kind="stable")]
        for part in _size_classes(q[at[alive]]) if len(alive) else []:
            for slots in _together(alive[part], first, last):
                i, j = int(first[slots].min()), int(last[slots].max())
                asked, back = np.unique(at[slots], return_inverse=True)
                for rows in [i + r for r in _size_classes(v[i:j])] if huge else [slice(i, j)]:
                    scores, own_ids = _products(v[rows], q[asked]), ids[rows]
                    for s, c in zip(slots, back, strict=True):
                        got = scores[:, c]
                        fits = np.flatnonzero((got >= int(s_lo[s])) & (got <= int(s_hi[s])) & (own_ids != q_ids[at[s]]))
                        if len(fits) > k:
                            kth = np.sort(got[fits])[-k]
                            fits = fits[got[fits] >= kth]
                        best = sorted((-int(got[x]), int(own_ids[x])) for x in fits)
                        # Ties with the floor count only with a smaller id.
                        best = [(x, y) for x, y in best if -x > int(s_lo[s]) or y <= int(s_id[s])][:k]
                        yield from ((int(s_row[s]), int(s_slot[s]), y, -x) for x, y in best)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                rows = list(pair(batch.slice(n, 1).to_pylist()[0]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=_FOUND)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """(row, slot, rank, vec_id, score): the k best of each slot; a row found twice counts once."""
    place = F.row_number().over(Window.partitionBy("row", "slot").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def _search(anchors: DataFrame, blocks: DataFrame, pairs: DataFrame, slots: DataFrame, directions: dict, k: int) -> DataFrame:
    """(row, slot, rank, vec_id, score): for each slot (q_block, row, slot, lo, hi) the k highest scores within lo and hi.

    ``pairs`` says which blocks may be met. Written.
    """

    def scored(met: DataFrame, asked: DataFrame) -> DataFrame:
        kept = [F.collect_list(F.col(c)).alias(f"s_{c}") for c in ("row", "slot", "lo", "id", "hi")]
        q = anchors.select(F.col("block").alias("q_block"), F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
        q = asked.groupBy("q_block").agg(*kept).join(q, "q_block")
        full = met.join(q, "q_block").join(blocks.select("block", "dims", "cell", "ids", "vectors", "least", "most"), "block")
        return written(full.drop("q_block", "block").mapInArrow(_scored(directions, k), FOUND), "found")

    asked = written(slots.select("q_block", "row", "slot", "lo", F.lit(HIGHEST).alias("id"), "hi"), "slots")
    order = Window.partitionBy("q_block").orderBy(F.col("upper").desc(), "block")
    met = written(pairs.withColumn("place", F.row_number().over(order)).select("q_block", "block", "upper", "place"), "met")
    seeds = scored(met.where(F.col("place") <= FIRST).select("q_block", "block"), asked)
    floors = _best(seeds, k).where(F.col("rank") == k).select("row", "slot", F.col("score").alias("floor"), F.col("vec_id").alias("floor_id"))
    raised = asked.join(floors, ["row", "slot"], "left")
    raised = written(raised.select("q_block", "row", "slot", F.coalesce("floor", "lo").alias("lo"), F.coalesce("floor_id", "id").alias("id"), "hi"), "slots")
    least = raised.groupBy("q_block").agg(F.min("lo").alias("least_lo"))
    rest = met.where(F.col("place") > FIRST).join(least, "q_block").where(F.col("upper") >= F.col("least_lo").cast("double")).select("q_block", "block")
    return written(_best(seeds.unionByName(scored(rest, raised)).distinct(), k), "best")


def mine(embeddings: DataFrame, anchors_every: int = 100, positives: int = 5, negatives: int = 5) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``embeddings``: vec_id, embedding, label. Anchors are rows whose vec_id is divisible by ``anchors_every``; an anchor's
    positives are the rows of its label with the highest scores; for each of them, the negatives are the rows of other labels with
    the highest scores from 80 % of the positive's to all of it, so none for a negative score. Ties go to the smaller vec_id.
    Rows with the anchor's own vec_id are no partners. Rows with a null vec_id, label or vector, an empty vector, or a component
    that is null, not finite or beyond 2^45 take no part; vectors of different lengths never meet. Equal rows count once; scores
    beyond 64 bits count as none. No rows give no rows. Other columns are ignored.
    """
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"), whole(F.col("embedding")).alias("v"))
    rows = rows.where("vec_id is not null and label is not null and v is not null and size(v) > 0").distinct()
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    directions = directions_of(rows)
    filed = written(rows.mapInArrow(_filed(directions), FILED), "filed")
    blocks = _in_blocks(filed, directions, ROWS, "blocks")
    chosen = filed.where(F.col("vec_id") % anchors_every == 0)
    anchors = _in_blocks(chosen, directions, ANCHORS, "anchors")
    pairs = _pairs(anchors, blocks)
    # Which block an anchor is in, and its id.
    owners = written(anchors.select(F.col("block").alias("q_block"), "rows", "ids").mapInArrow(_owners, "q_block bigint, row bigint, anchor_id bigint"), "owners")
    same = pairs.where("q_label = label")
    first = _search(anchors, blocks, same, owners.select("q_block", "row", F.lit(0).cast("bigint").alias("slot"), F.lit(LOWEST).alias("lo"), F.lit(HIGHEST).alias("hi")), directions, positives)
    pos = first.select("row", F.col("rank").cast("bigint").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    asked = pos.where("positive_score >= 0").join(owners, "row")
    asked = asked.select("q_block", "row", "slot", (F.col("positive_score") - F.floor(F.expr("positive_score div 5"))).alias("lo"), F.col("positive_score").alias("hi"))
    found = _search(anchors, blocks, pairs.where("q_label <> label"), asked, directions, negatives)
    out = found.join(pos, ["row", "slot"]).join(owners, "row")
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            rows, ids = (np.frombuffer(r[c], dtype=np.int64) for c in ("rows", "ids"))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), r["q_block"], dtype=np.int64)), pa.array(rows), pa.array(ids)], names=["q_block", "row", "anchor_id"])
