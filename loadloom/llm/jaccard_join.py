"""Exact Jaccard join of word-shingle sets in their metric space.

A document is the set of its distinct shingles. Jaccard distance and the size of the symmetric difference are metrics, and
two sets with ``intersection >= t * union`` satisfy ``difference <= (1-t)/(1+t) * (|x| + |y|)``.

1. *Outer region.* A shingle that no other set has lies outside every other set, so ``u(x)``, the number of those, is a
   distance to the space that sets share, and the triangle inequality gives ``difference(x, y) >= u(x) + u(y)``. A set whose
   u is too large has no partner at all; most texts end here, without any comparison.
2. *Regions.* The first pivots are single shingles. A set lies nearest to the pivots it holds; of those, the one held by
   the fewest sets is its cell. A partner may lack at most ``(1-t)|x|`` of its shingles, so a set at the boundary is
   repeated in that many next cells (its window) and in no more, less those of its own outer region.
3. *Recursion.* In each cell the set with the most room (smallest u for its size) becomes the pivot; cells of one pivot
   form its region. Every member is compared with the pivot exactly. Members connected with it need no comparison with each
   other; loose ones, whose window still reaches other members, are joined with the region again, block by block and inside
   the tasks. Pairs are never listed: a loose member yields one link for each component it meets.

Everything is shuffled by region in blocks; one task holds a block of bounded size. Shingles are 64-bit hashes, of which
48 bits are kept: two sets are compared on those, and the answer can differ from the exact one only if two of their few
hundred shingles collide (1 in 10^9 pairs). Set ids are 64-bit hashes of the whole set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadloom.llm import textarrays as ta
from loadloom.llm.graphs import components, unused, written

#: Text bytes per bucket of shingles: a task then holds about three and a half million of them.
BUCKET_BYTES = 24_000_000
#: Members of a region that one task holds of either side.
BLOCK = 2048

#: Passes over a bucket, each sorting its part.
_PARTS = 4
_LOW = np.uint64((1 << 48) - 1)


def _set_ids(sets: list[np.ndarray]) -> np.ndarray:
    total = np.array([ta.mix(s).sum(dtype=np.uint64) + np.uint64(len(s)) for s in sets], dtype=np.uint64)
    return ta.mix(total).view(np.int64)


def _blob(*arrays: np.ndarray) -> list[bytes]:
    return [a.tobytes() for a in arrays]


_SPREAD = "bucket int, doc_id bigint, key bigint, n int, sid bigint, owners binary, counts binary, low binary, high binary, df binary"
_ARROW = pa.schema(
    [("bucket", pa.int32()), ("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("sid", pa.int64()), ("owners", pa.binary()),
     ("counts", pa.binary()), ("low", pa.binary()), ("high", pa.binary()), ("df", pa.binary())]
)


def _spread(buckets: int, width: int):
    """Per piece of texts: a row for each document, and for each bucket its shingles, ordered by set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = 0
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for first, last, data, at in ta.pieces(batch.column(2)):
                sets = ta.shingle_sets(ta.words(data, at), width)
                sids = _set_ids(sets)
                sizes = np.array([len(s) for s in sets], dtype=np.int32)
                piece += 1
                rows = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows, -1 - (piece + int(sids[0] & 0xFFFF)) % buckets, dtype=np.int32)),
                     ids.slice(first, rows), keys.slice(first, rows), pa.array(sizes), pa.array(sids),
                     *[pa.nulls(rows, pa.binary())] * 5], schema=_ARROW,
                )
                _, once = np.unique(sids, return_index=True)
                once = once[sizes[once] > 0]
                if not len(once):
                    continue
                hashes = np.concatenate([sets[i] for i in once])
                owner = np.repeat(np.arange(len(once), dtype=np.int32), sizes[once])
                bucket = ((hashes >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.uint16 if buckets < 65536 else np.int32)
                order = np.argsort(bucket, kind="stable")
                hashes, owner, bucket = hashes[order], owner[order], bucket[order]
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(bucket)]])
                yield _rows([(int(bucket[a]), *_packed(sids[once], owner[a:b], hashes[a:b] & _LOW), b"") for a, b in zip(starts, ends)])

    return run


def _packed(sids: np.ndarray, owner: np.ndarray, payload: np.ndarray) -> list[bytes]:
    """Set ids in order with the count of their entries, at most 255 each, and the payload as 32 and 16 bits."""
    new = np.ones(len(owner), dtype=bool)
    new[1:] = owner[1:] != owner[:-1]
    starts = np.flatnonzero(new)
    inside = np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))
    cut = np.flatnonzero(inside % 255 == 0)
    counts = np.diff(np.append(cut, len(owner))).astype(np.uint8)
    return _blob(sids[owner[cut]], counts, payload.astype(np.uint32), (payload >> np.uint64(32)).astype(np.uint16))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    n = len(rows)
    columns = list(zip(*rows)) if rows else [[] for _ in range(6)]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
         *[pa.array(c, pa.binary()) for c in columns[1:]]], schema=_ARROW,
    )


def _unpacked(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Set ids, place of each entry's set among them, payload, and share counts (empty if none) of all rows of a group."""
    joined = {}
    for name, kind in (("owners", np.int64), ("counts", np.uint8), ("low", np.uint32), ("high", np.uint16), ("df", np.uint8)):
        parts = [np.frombuffer(x.as_buffer(), dtype=kind) for x in group.column(name) if x.is_valid]
        joined[name] = np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
    owner = np.repeat(np.arange(len(joined["owners"]), dtype=np.int32), joined["counts"])
    payload = joined["low"].astype(np.uint64) | joined["high"].astype(np.uint64) << np.uint64(32)
    return joined["owners"], owner, payload, joined["df"]


def _shared(buckets: int):
    """Of one bucket: the shingles that two different sets hold, again by set. Document rows pass."""

    def run(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        if bucket < 0:
            return group
        owners, owner, payload, _ = _unpacked(group)
        del group
        # The same set may come from several tasks: count it once.
        sids, inverse = np.unique(owners, return_inverse=True)
        owner, found = inverse.astype(np.int32)[owner], []
        for part in range(_PARTS):
            some = payload & np.uint64(_PARTS - 1) == part
            o, p = owner[some], payload[some]
            order = np.lexsort((o, p))
            o, p = o[order], p[order]
            new = np.ones(len(p), dtype=bool)
            new[1:] = (p[1:] != p[:-1]) | (o[1:] != o[:-1])
            o, p = o[new], p[new]
            held = np.diff(np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1], [True]]))) if len(p) else np.zeros(0, dtype=np.int64)
            df = np.repeat(held, held)
            found.append((o[df > 1], p[df > 1], df[df > 1].astype(np.int32)))
        owner, payload, df = (np.concatenate(x) for x in zip(*found))
        # Rarer first; beyond 15, by powers of 2^(1/8).
        df = np.where(df < 16, df, np.minimum(255, np.log2(df) * 8 - 16)).astype(np.uint8)
        target = ((sids.view(np.uint64) >> np.uint64(1)) % np.uint64(buckets)).astype(np.int64)[owner]
        order = np.lexsort((owner, target))
        owner, payload, df, target = owner[order], payload[order], df[order], target[order]
        if not len(owner):
            return _ARROW.empty_table()
        cuts = np.flatnonzero(np.diff(target)) + 1
        out = []
        for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(target)]])):
            # The bucket of the shingles rides in front of the set ids, as one without entries.
            owners, counts, low, top = _packed(sids, owner[a:b], payload[a:b])
            owners = np.array([bucket], dtype=np.int64).tobytes() + owners
            counts = bytes(1) + counts
            out.append((int(target[a]), owners, counts, low, top, df[a:b].tobytes()))
        return pa.Table.from_batches([_rows(out)])

    return run


def least_shared(n: np.ndarray, percent: int) -> np.ndarray:
    """What a set of n must share with any partner."""
    return -(-n * percent // 100)


_SETS = "sid bigint, n int, room bigint, held binary, cells array<bigint>"


def _regions(percent: int):
    """Of one bucket of sets: size, room, all shared shingles, and the cells of its window; nothing for sets without partner.

    Room is ``(100 + percent) * u - (100 - percent) * n``: for a pair to be linked, both rooms must add up to 0 or less.
    """

    kinds = [("sid", pa.int64()), ("n", pa.int32()), ("room", pa.int64()), ("held", pa.binary()), ("cells", pa.list_(pa.int64()))]
    empty = pa.schema(kinds).empty_table()

    def run(group: pa.Table) -> pa.Table:
        known = group.filter(pc.is_null(group.column("owners")))
        known_sids, known_n = known.column("sid").to_numpy(), known.column("n").to_numpy()
        parts = []
        for batch in group.filter(pc.is_valid(group.column("owners"))).to_batches():
            for i in range(batch.num_rows):
                owners, owner, payload, df = _unpacked(pa.Table.from_batches([batch.slice(i, 1)]))
                # The same 48 bits mean other shingles in other buckets.
                parts.append((owners[owner], payload ^ ta.mix(owners[:1].view(np.uint64)), df))
        if not parts:
            return empty
        owners, hashes, df = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((hashes, df, owners))
        owners, hashes = owners[order], hashes[order]
        cut = np.concatenate([[0], np.flatnonzero(np.diff(owners)) + 1, [len(owners)]])
        sids, shared = owners[cut[:-1]], np.diff(cut)
        by_sid = np.argsort(known_sids)
        n = known_n[by_sid][np.searchsorted(known_sids[by_sid], sids)].astype(np.int64)
        room = (100 + percent) * (n - shared) - (100 - percent) * n
        window = n - least_shared(n, percent) + 1 - (n - shared)
        keep = np.flatnonzero((shared >= least_shared(n, percent)) & (window > 0))
        held = [_short(np.sort(hashes[cut[i] : cut[i + 1]] & _LOW)) for i in keep]
        cells = [hashes[cut[i] : cut[i] + window[i]].view(np.int64) for i in keep]
        return pa.table(
            {"sid": pa.array(sids[keep]), "n": pa.array(n[keep].astype(np.int32)), "room": pa.array(room[keep]),
             "held": pa.array(held, pa.binary()), "cells": pa.array(cells, pa.list_(pa.int64()))}
        )

    return run


def _short(hashes: np.ndarray) -> bytes:
    """48 bits of each hash: the low 32 of all, then the next 16."""
    return hashes.astype(np.uint32).tobytes() + (hashes >> np.uint64(32)).astype(np.uint16).tobytes()


def _long(held: bytes) -> np.ndarray:
    n = len(held) // 6
    return np.frombuffer(held, np.uint32, n) | np.frombuffer(held, np.uint16, n, 4 * n).astype(np.uint64) << np.uint64(32)


def _overlaps(one: np.ndarray, every: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Size of the intersection of ``one`` with each of the sets laid in a row in ``every``."""
    at = np.minimum(np.searchsorted(one, every), len(one) - 1)
    hit = np.concatenate([[0], np.cumsum(one[at] == every)])
    ends = np.cumsum(lengths)
    return hit[ends] - hit[ends - lengths]


def _columns(group: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    held = [_long(x) for x in group.column("held").to_pylist()]
    return group.column("sid").to_numpy(), group.column("n").to_numpy().astype(np.int64), held


def _with_pivot(percent: int):
    """Links of the members of one block of a region with its pivot."""

    def run(group: pa.Table) -> pa.Table:
        pivot = group.column("region")[0].as_py()
        sid, n, held = _columns(group)
        own = int(np.flatnonzero(sid == pivot)[0])
        both = _overlaps(held[own], np.concatenate(held), np.array([len(h) for h in held]))
        good = (100 * both >= percent * (n + n[own] - both)) & (sid != pivot)
        return pa.table({"a": pa.array(sid[good]), "b": pa.array(np.full(good.sum(), pivot, dtype=np.int64))})

    return run


def _between_blocks(percent: int):
    """Links between a block of loose members and a block of all members: for each loose one, one per component it meets."""

    def run(group: pa.Table) -> pa.Table:
        loose = group.column("loose").to_numpy(zero_copy_only=False)
        sid, n, held = _columns(group)
        label = group.column("label").to_numpy()
        rows, ones = np.flatnonzero(~loose), np.flatnonzero(loose)
        if not len(rows) or not len(ones):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        every, codes = np.unique(np.concatenate([held[r] for r in rows]), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum([len(held[r]) for r in rows])[:-1]])
        mark = np.zeros(len(every), dtype=np.uint8)
        a, b = [], []
        for i in ones:
            at = np.minimum(np.searchsorted(every, held[i]), len(every) - 1)
            at = at[every[at] == held[i]]
            mark[at] = 1
            both = np.add.reduceat(mark[codes], starts, dtype=np.int64)
            mark[at] = 0
            good = rows[(100 * both >= percent * (n[i] + n[rows] - both)) & (label[rows] != label[i])]
            _, firsts = np.unique(label[good], return_index=True)
            a += [sid[i]] * len(firsts)
            b += sid[good[firsts]].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    labels = written(components(links), "labels").withColumnRenamed("node", "sid")
    return rows.join(labels, "sid", "left").withColumn("label", F.coalesce("root", "sid")).drop("root")


def _join_regions(sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) of all linked sets."""
    cells = sets.select("sid", "n", "room", F.explode("cells").alias("cell"))
    # The pivot of a cell has the most room; whom even it cannot reach is alone there.
    pivots = cells.groupBy("cell").agg(F.min(F.struct("room", "sid")).alias("p"), F.count("*").alias("c")).where("c > 1")
    members = cells.join(pivots, "cell").where("room + p.room <= 0 or sid = p.sid")
    members = written(members.select(F.col("p.sid").alias("region"), "sid", "n", "room").distinct(), "regions")

    size = members.groupBy("region").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.max(F.when(F.col("sid") == F.col("region"), F.col("n"))).alias("pn"))
    near = members.join(size.where("pn is not null"), "region").where(
        (100 * F.least("n", "pn") >= percent * F.greatest("n", "pn")) & (F.col("sid") != F.col("region"))
    )
    near = near.select("region", F.pmod(F.xxhash64("sid"), F.col("blocks")).alias("block"), "sid")
    pivot_rows = near.select("region", "block", F.col("region").alias("sid")).distinct()
    rows = near.union(pivot_rows).join(sets.select("sid", "n", "held"), "sid").select("region", "block", "sid", "n", "held")
    links = rows.groupBy("region", "block").applyInArrow(_with_pivot(percent), "a bigint, b bigint")
    links = written(links, "links")

    # Members not connected with their pivot are loose: they still have to meet the others that their window reaches.
    known = _labelled(members, links)
    mains = known.where("sid = region").select("region", F.col("label").alias("main"))
    others = written(known.where("sid <> region").join(mains, "region").withColumn("loose", F.col("label") != F.col("main")), "members")
    span = others.groupBy("region").agg(F.min("room").alias("least"), F.min(F.when(F.col("loose"), F.col("room"))).alias("least_loose"))
    others = others.join(span, "region").where("(loose and room + least <= 0) or room + least_loose <= 0")
    counts = others.groupBy("region").agg(
        F.ceil(F.count(F.when(F.col("loose") & (F.col("room") + F.col("least") <= 0), 1)) / BLOCK).alias("a"),
        F.ceil(F.count("*") / BLOCK).alias("b"), F.count("*").alias("c"),
    ).where("a > 0 and c > 1")
    others = others.join(counts, "region").join(sets.select("sid", "held"), "sid")
    own = lambda blocks: F.pmod(F.xxhash64("sid"), F.col(blocks))
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    loose = others.where("loose and room + least <= 0").select("region", own("a").alias("x"), every("b").alias("y"), "sid", "n", "held", "label", F.lit(True).alias("loose"))
    rest = others.where("room + least_loose <= 0").select("region", every("a").alias("x"), own("b").alias("y"), "sid", "n", "held", "label", F.lit(False).alias("loose"))
    more = loose.union(rest).groupBy("region", "x", "y").applyInArrow(_between_blocks(percent), "a bigint, b bigint")
    return written(components(links.union(written(more, "links"))), "labels")


def _rooted(docs: DataFrame, width: int, percent: int, bucket_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n, sid) of every document, and (sid, root) of every set; ``key`` is a hash of the text."""
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(max(8, size // bucket_bytes), 1 << 24)
    spread = docs.mapInArrow(_spread(buckets, width), _SPREAD)
    shared = written(spread.groupBy("bucket").applyInArrow(_shared(buckets), _SPREAD), "shingles")
    place = F.pmod(F.shiftrightunsigned("sid", 1), F.lit(buckets)).cast("int").alias("bucket")
    sizes = shared.where("bucket < 0 and n > 0").groupBy("sid", "n").agg(F.count("*").alias("rows")).select(place, "n", "sid")
    entries = shared.where("bucket >= 0").select("bucket", "owners", "counts", "low", "high", "df")
    sets = entries.unionByName(sizes, allowMissingColumns=True).groupBy("bucket").applyInArrow(_regions(percent), _SETS)
    labels = _join_regions(written(sets, "sets"), percent)
    rows = shared.where("bucket < 0").select("doc_id", "key", "n", "sid")
    sids = rows.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("first"))
    roots = sids.join(labels.withColumnRenamed("node", "sid"), "sid", "left")
    return rows, roots.select("sid", "first", F.coalesce("root", "sid").alias("root"))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text); other columns are ignored.

    Words are maximal runs of anything but blank and 0x09-0x0D with A-Z lowered. Rows are linked when
    ``100 * intersection >= percent * union`` (both sides whole numbers, so ties count as links). A component is named by its
    smallest doc_id. Null and empty texts have an empty set and are linked with nothing. Repeated rows and equal sets are one
    set, each row with its own result row. Rows with a null doc_id take part; they get a null component_id if all rows of
    their component lack an id. An empty table gives an empty result.
    """
    rows, roots = _rooted(docs, width, percent, bucket_bytes)
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.join(least, "root").select("sid", "component_id")
    return rows.join(named, "sid", "left").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs``, all columns, with one row of each component: that of the smallest doc_id (nulls last), then of the smallest
    hash of its text. Rows without any word are no component's and all stay."""
    rows, roots = _rooted(docs, width, percent, bucket_bytes)
    own = unused(docs, "own_null", "own_id", "own_key")
    own_key = F.struct(F.col("doc_id").isNull().alias(own[0]), F.coalesce("doc_id", F.lit(0)).alias(own[1]), F.col("key").alias(own[2]))
    # Copies are brought to one row per set, combined before the shuffle, before sets are brought to components.
    first = rows.where("n > 0").groupBy("sid").agg(F.min(own_key).alias("b"))
    kept = first.join(roots, "sid").groupBy("root").agg(F.min("b").alias("b")).select("b.*")
    text = F.col("text").cast("string")
    marked = docs.withColumns(
        {own[0]: F.col("doc_id").isNull(), own[1]: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), own[2]: F.xxhash64(text)}
    )
    wordless = text.isNull() | ~text.rlike(r"[^\x20\x09-\x0D]")
    one = marked.join(kept, own, "left_semi").dropDuplicates(own).drop(*own)
    return one.union(docs.where(wordless))
