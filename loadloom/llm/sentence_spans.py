"""Removal of passages that repeat across documents, by sliding sentence spans.

From every sentence on, and back from every sentence, the shortest run of at least ``MIN_SENTENCES`` sentences and
``MIN_WORDS`` words is hashed over its words (A-Z lowered). Runs meet by hash all over the corpus; the first occurrence, by
doc_id and place, stays, and every sentence that any other one covers is removed. Sentences end with a full stop, a question
or exclamation mark (also before closing punctuation) or a line. One of more than ``LONG`` words, so any, counts as several: it
is cut before every word whose hash is smaller than those of the two words on either side. Such cuts follow from the words
around them alone, so a passage is cut alike wherever it stands, also where its ends are glued to the words of its host. So
two sentences, or one, of ``MIN_WORDS`` words are a run as well if they hold ``MIN_SENTENCES`` cuts.

Runs travel in blocks by bucket of their hash, found places in blocks by document. A run in a third of all documents puts
one entry for each of them into its bucket, no more. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadloom.llm import textarrays as ta

MIN_SENTENCES, MIN_WORDS, LONG = 3, 15, 0
#: Text bytes per bucket of runs.
BUCKET_BYTES = 16_000_000

U64 = np.uint64
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".!?"]] = True
_LAST_ID = np.iinfo(np.int64).max


def _sentence_starts(w: ta.Words, data: np.ndarray) -> np.ndarray:
    """Whether each word begins a sentence."""
    n = len(w.hashes)
    ended = np.zeros(n, dtype=bool)
    tail = np.ones(n, dtype=bool)
    for back in range(1, 5):  # closing quotes, brackets and marks may follow the stop
        at = w.end - back
        tail &= at >= w.start
        byte = data[np.maximum(at, 0)]
        ended |= tail & _ENDS[byte]
        tail &= ~ta.ALNUM[byte]
    lines = np.concatenate([[0], np.cumsum(data == 0x0A)])
    starts = np.ones(n, dtype=bool)
    starts[1:] = ended[:-1] | (lines[w.start[1:]] > lines[w.end[:-1]]) | (w.owner[1:] != w.owner[:-1])
    sentence = np.cumsum(starts)
    low = np.bincount(sentence)[sentence] > LONG
    for d in (1, 2):
        apart = (sentence[d:] != sentence[:-d])
        low[d:] &= apart | (w.hashes[d:] < w.hashes[:-d])
        low[:-d] &= apart | (w.hashes[:-d] < w.hashes[d:])
    return starts | low


def runs(w: ta.Words, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, first byte, last byte + 1 within the text) of every run; a run ends where the next word starts."""
    n = len(w.hashes)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(U64), none, none
    first = np.flatnonzero(_sentence_starts(w, data))
    bounds = np.append(first, n)  # sentence s holds words bounds[s] to bounds[s + 1]
    owner = w.owner[first]
    low = np.searchsorted(owner, owner, "left")
    high = np.searchsorted(owner, owner, "right")
    s = np.arange(len(first))
    ahead = np.maximum(np.searchsorted(bounds, bounds[s] + MIN_WORDS, "left"), s + MIN_SENTENCES)
    good = ahead <= high
    back = np.minimum(np.searchsorted(bounds, bounds[s + 1] - MIN_WORDS, "right") - 1, s + 1 - MIN_SENTENCES)
    fine = back >= low
    both = np.unique(np.concatenate([s[good] << 32 | ahead[good], back[fine] << 32 | (s + 1)[fine]]))
    a, b = bounds[both >> 32], bounds[both & 0xFFFFFFFF]
    up, down = ta.power_tables(n + 1)
    total = np.concatenate([[U64(0)], np.cumsum(w.hashes * up[:n])])
    hashes = ta.mix((total[b] - total[a]) * down[a] + (b - a).astype(U64))
    text = w.owner[a]
    end = np.where(b < n, w.start[np.minimum(b, n - 1)], len(data))
    end = np.minimum(end, at[text + 1])
    return text, hashes, w.start[a] - at[text], end - at[text]


_BLOCKS = "bucket int, owners binary, counts binary, hashes binary, starts binary, ends binary"
_KINDS = (("owners", np.int64), ("counts", np.uint8), ("hashes", U64), ("starts", np.uint32), ("ends", np.uint32))
_SCHEMA = pa.schema([("bucket", pa.int32()), *[(name, pa.binary()) for name, _ in _KINDS]])


def _blocks(bucket: np.ndarray, table: np.ndarray, owner: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """One row per bucket; owners, (doc_id, text key) each, once per run of up to 255 entries."""
    order = np.lexsort((owner, bucket))
    bucket, owner, columns = bucket[order], owner[order], [c[order] for c in columns]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else np.zeros(1, dtype=int)
    rows: list[list] = [[] for _ in _SCHEMA]
    for a, b in zip(cuts, cuts[1:]):
        own = owner[a:b]
        new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        inside = np.arange(b - a) - np.repeat(new, np.diff(np.append(new, b - a)))
        cut = np.flatnonzero(inside % 255 == 0)
        counts = np.diff(np.append(cut, b - a)).astype(np.uint8)
        values = (table[own[cut]], counts, *[c[a:b].astype(k) for c, (_, k) in zip(columns, _KINDS[2:])])
        rows[0].append(int(bucket[a]))
        for to, v in zip(rows[1:], values):
            to.append(v.tobytes())
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _SCHEMA)], schema=_SCHEMA)


def _opened(group: pa.Table) -> list[np.ndarray]:
    """Owner table, owner of each entry, hashes, starts and ends of a group of blocks; each document once in the table."""
    got = {}
    for name, kind in _KINDS:
        got[name] = np.frombuffer(b"".join(x.as_py() for x in group.column(name)), dtype=kind)
    table, inverse = np.unique(got["owners"].reshape(-1, 2), axis=0, return_inverse=True)
    return [table, np.repeat(inverse.ravel(), got["counts"]), got["hashes"], got["starts"], got["ends"]]


def _spread(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(_LAST_ID).to_numpy()
            keys = batch.column(1).to_numpy()
            for first, last, data, at in ta.pieces(batch.column(2)):
                text, hashes, start, end = runs(ta.words(data, at), data, at)
                table = np.stack([ids[first:last], keys[first:last]], axis=1)
                bucket = ((hashes >> U64(40)) * U64(buckets) >> U64(24)).astype(np.int64)
                yield _blocks(bucket, table, text, hashes, start, end)

    return run


def _repeated(buckets: int):
    """Of one bucket: every entry but the first of its hash, by bucket of its document."""

    def run(group: pa.Table) -> pa.Table:
        table, owner, hashes, start, end = _opened(group)  # the table is in order of document
        order = np.lexsort((start, owner, hashes))
        owner, hashes, start, end = owner[order], hashes[order], start[order], end[order]
        same = np.zeros(len(hashes), dtype=bool)
        same[1:] = hashes[1:] == hashes[:-1]
        # Rows that agree in id and text are one document, so their first entries all stay.
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(hashes))))
        keep = (owner != owner[head]) | (start != start[head])
        owner, hashes, start, end = owner[keep], hashes[keep], start[keep], end[keep]
        # By document, not by its text alone: a text may be that of any share of the documents.
        both = ta.mix(np.ascontiguousarray(table[:, 0]).view(U64)) ^ np.ascontiguousarray(table[:, 1]).view(U64)
        target = (ta.mix(both) % U64(buckets)).astype(np.int64)[owner]
        return pa.Table.from_batches([_blocks(target, table, owner, hashes, start, end)])

    return run


_CUTS = "cut_id bigint, cut_key bigint, cuts binary, n_spans bigint"


def _merged(group: pa.Table) -> pa.Table:
    """For each document: its ranges to cut, in order and disjoint."""
    table, owner, _, start, end = _opened(group)
    order = np.lexsort((end, start, owner))
    owner, start, end = owner[order], start[order].astype(np.int64), end[order].astype(np.int64)
    bounds = np.searchsorted(owner, np.arange(len(table) + 1))
    cuts = []
    for a, b in zip(bounds, bounds[1:]):
        far = np.maximum.accumulate(end[a:b])
        new = np.flatnonzero(np.concatenate([[True], start[a + 1 : b] > far[:-1]]))
        cuts.append(np.stack([start[a:b][new], far[np.append(new[1:] - 1, b - a - 1)]], axis=1).astype(np.uint32).tobytes())
    return pa.table(
        {"cut_id": pa.array(table[:, 0], pa.int64()), "cut_key": pa.array(table[:, 1], pa.int64()),
         "cuts": pa.array(cuts, pa.binary()), "n_spans": pa.array(np.diff(bounds), pa.int64())}
    )


def _without(text: str | None, cuts: bytes | None) -> str | None:
    if text is None or not cuts:
        return text
    data, kept, at = text.encode(), [], 0
    for a, b in np.frombuffer(cuts, dtype=np.uint32).reshape(-1, 2).tolist():
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return b"".join(kept).decode()


def _cut(schema: pa.Schema, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            cuts = columns.pop()
            if cuts.null_count < len(cuts):
                texts = [_without(t.as_py(), c.as_py()) for t, c in zip(columns[column], cuts)]
                columns[column] = pa.array(texts, schema.field(column).type)
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_spans, n_removed) of every row of ``docs`` (doc_id, text); other columns are ignored.

    ``n_spans``: repeated runs found in the text; ``n_removed``: characters removed. Documents without a repeated run come back
    unchanged. Null texts stay null, and empty ones empty. The order of documents is that of doc_id, nulls last, then of a
    hash of the text. Rows that agree in id and text are one document, each row changed alike. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(max(8, size // BUCKET_BYTES), 1 << 24)
    found = rows.select("doc_id", "key", "text").mapInArrow(_spread(buckets), _BLOCKS)
    again = found.groupBy("bucket").applyInArrow(_repeated(buckets), _BLOCKS)
    cuts = again.groupBy("bucket").applyInArrow(_merged, _CUTS)
    same = (F.coalesce("doc_id", F.lit(_LAST_ID)) == F.col("cut_id")) & (F.col("key") == F.col("cut_key"))
    joined = rows.join(cuts, same, "left").select("doc_id", F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.length("text").alias("was"), "text", "cuts")
    schema = pa.schema([("doc_id", pa.int64()), ("n_spans", pa.int64()), ("was", pa.int32()), ("text", pa.string())])
    out = joined.mapInArrow(_cut(schema, 3), "doc_id bigint, n_spans bigint, was int, text string")
    removed = F.coalesce(F.col("was") - F.length("text"), F.lit(0)).cast("bigint")
    return out.select("doc_id", "text", "n_spans", removed.alias("n_removed"))
