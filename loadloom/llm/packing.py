"""Best-fit packing of texts into training sequences of several permitted lengths.

A text of n words needs n + 1 places, one for the separator behind it; one that is longer than the longest sequence is cut
into pieces of that length and a rest. Pieces are dealt at random over groups of bounded size, since a sequence holds only a
few of them and a group of thousands packs as tightly as the whole corpus. In a group, pieces are placed from the longest to
the shortest into the open bin that they fill best. When none has room, a bin is opened: of the permitted lengths up to a
limit, the one that costs least per place. Every permitted length is tried as that limit, each bin is cut down to the
shortest length that holds its contents, and the packing of least total cost is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Permitted lengths, and what a sequence costs besides its places.
LENGTHS, OVERHEAD = (512, 1024, 2048, 4096), 16
#: Pieces that one task packs, on average.
GROUP = 20_000


def sequence_cost(length: int) -> float:
    return length + OVERHEAD


def best_fit(sizes: np.ndarray, opened: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, and how full each bin is. ``sizes`` fall; ``opened[size]``: length of a bin opened for it."""
    rooms: list[list[int]] = [[] for _ in range(max(opened) + 1)]
    some = 0  # bit r is set while a bin has room r
    bins, offsets, full, room_of = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), [], []
    for i, size in enumerate(sizes.tolist()):
        fit = some >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                some ^= 1 << room
        else:
            room, b = opened[size], len(full)
            full.append(0)
        bins[i], offsets[i] = b, full[b]
        full[b] += size
        room -= size
        if room:
            if not rooms[room]:
                some |= 1 << room
            rooms[room].append(b)
    return bins, offsets, np.array(full, dtype=np.int64)


def pack(sizes: np.ndarray, lengths: Sequence[int] = LENGTHS, cost: Callable[[int], float] = sequence_cost):
    """(bin, offset, length of the bin) of each piece, for the limit on opened bins that costs least in all.

    ``sizes`` are whole numbers from 1 to the longest length, in falling order.
    """
    lengths = sorted(lengths)
    holding = np.array(lengths)[np.searchsorted(lengths, np.arange(lengths[-1] + 1))]
    prices, best = np.array([cost(c) for c in lengths]), None
    for limit in lengths:
        opened = []
        for size in range(lengths[-1] + 1):
            fitting = [c for c in lengths if size <= c <= limit] or [int(holding[size])]
            opened.append(min(fitting, key=lambda c: (cost(c) / c, -c)))
        bins, offsets, full = best_fit(sizes, opened)
        kept = holding[full]
        total = prices[np.searchsorted(lengths, kept)].sum()
        if best is None or total < best[0]:
            best = total, bins, offsets, kept[bins]
    return best[1:]


_PACKED = "doc_id bigint, text_key bigint, copy bigint, piece int, first_word bigint, n_places int, sequence bigint, place int, length int"


def _pack_group(lengths: Sequence[int], cost: Callable[[int], float]):
    def run(group: pa.Table) -> pa.Table:
        order = np.lexsort([group.column(c).fill_null(0).to_numpy() for c in ("piece", "copy", "text_key", "doc_id")] + [-group.column("n_places").to_numpy()])
        group = group.take(pa.array(order))
        bins, offsets, kept = pack(group.column("n_places").to_numpy(), lengths, cost)
        number = group.column("group")[0].as_py()
        for name, values, kind in (("sequence", bins + (number << 32), pa.int64()), ("place", offsets, pa.int32()), ("length", kept, pa.int32())):
            group = group.append_column(name, pa.array(values, kind))
        return group.drop_columns(["group"])

    return run


def pack_documents(docs: DataFrame, lengths: Sequence[int] = LENGTHS, cost: Callable[[int], float] = sequence_cost, group: int = GROUP) -> DataFrame:
    """Where each piece of every row of ``docs`` (doc_id, text) goes; other columns are ignored.

    (doc_id, text_key, copy, piece, first_word, n_places, sequence, place, length): ``n_places`` from ``first_word`` of the text
    lie in ``sequence`` from ``place`` on, and the sequence has ``length``. Rows that agree in id and text are told apart by
    ``copy``, from 0. Null and empty texts take one place, the separator's. A null doc_id is kept. An empty table gives no rows.
    """
    longest = max(lengths)
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        (F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)) + 1).cast("bigint").alias("n"),
    )
    rows = rows.groupBy("doc_id", "text_key", "n").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / longest).cast("int"))))
    first = F.col("piece").cast("bigint") * longest
    pieces = pieces.select(
        "doc_id", "text_key", "copy", "piece", first.alias("first_word"),
        F.least(F.lit(longest).cast("bigint"), F.col("n") - first).cast("int").alias("n_places"),
    )
    total = rows.agg(F.sum(F.ceil(F.col("n") / longest))).first()[0] or 0
    groups = max(1, -(-int(total) // group))
    pieces = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "text_key", "copy", "piece"), F.lit(groups)))
    return pieces.groupBy("group").applyInArrow(_pack_group(tuple(lengths), cost), _PACKED)


#: Stands in the place behind the last word of a text.
SEPARATOR = "<|endoftext|>"


def sequence_texts(docs: DataFrame, packed: DataFrame, separator: str = SEPARATOR) -> DataFrame:
    """(sequence, length, n_places, words): what each sequence of ``pack_documents`` holds, one word per place, in order.

    ``docs`` are the packed rows; a piece's words are cut from its whole text, and the piece that ends a text has the separator in its
    last place. Places beyond ``n_places`` up to ``length`` are to be padded. A sequence is of bounded size by its length, so its
    pieces meet in one task; equal texts are read once however many copies were packed.
    """
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    texts = texts.groupBy("doc_id", "text_key").agg(F.first("text").alias("text"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"\S+"), F.lit(0))
    texts = texts.select(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), F.concat(words, F.array(F.lit(separator))).alias("all"))
    # A text's pieces are cut once, before its copies multiply them.
    cuts = packed.groupBy("doc_id", "text_key", "first_word", "n_places").agg(F.count("*").alias("copies"))
    pieces = cuts.join(texts, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key")))
    pieces = pieces.select("doc_id", "text_key", "first_word", F.slice("all", (F.col("first_word") + 1).cast("int"), F.col("n_places")).alias("part"))
    same = [packed[c].eqNullSafe(pieces[c]) for c in ("doc_id", "text_key", "first_word")]
    placed = packed.join(pieces, same[0] & same[1] & same[2]).select("sequence", "length", "place", "n_places", "part")
    whole = placed.groupBy("sequence").agg(
        F.first("length").alias("length"), F.sum("n_places").alias("n_places"), F.array_sort(F.collect_list(F.struct("place", "part"))).alias("parts")
    )
    return whole.select("sequence", "length", "n_places", F.flatten(F.transform("parts", lambda p: p["part"])).alias("words"))
