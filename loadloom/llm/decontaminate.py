"""Benchmark passages in documents, exact or edited, by CGK embedding and bit-sampling LSH.

Texts are sequences of words (runs of ASCII letters, digits and other characters' bytes, capitals of ASCII and Latin-1 lowered). A passage is a window
of a document within ``percent`` word edits of an item; items of fewer than six words must match exactly, and items of fewer
than ``MIN_WORDS`` words are not searched for.

1. *Windows.* k edits leave at least n - 2 - 3k of an item's n - 2 word triples intact, so a window that holds fewer triples
   of the items of its size cannot be one of them. This drops nothing and leaves few windows.
2. *CGK.* A walk over a window repeats or advances at each step by a random bit of the word it stands on. Walks that read
   the same word fall into step again after an edit, so sequences at small edit distance have walks at small Hamming distance.
3. *Bit sampling.* Each of many keys joins the words that a walk read at a few random steps; a window meets an item if any
   key agrees. Their number is set per size class, by trial on edited copies of its items, to reach ``recall``. Walks drift
   apart with length; a class that misses ``recall`` with all keys has none, and all its dense windows are verified.
4. *Verification.* Word edit distance between the item and the best end of the window, exactly; without keys, between each
   item and the best window of each dense stretch of a text.

Items travel in broadcast blocks of a bounded number of words; more items mean more passes. Each text is read once per
block, with no shuffle, and whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom.llm import textarrays as ta

U64 = np.uint64
MIN_WORDS = 3
#: Words of the items of one broadcast block (about 30 MB of index).
BLOCK_WORDS = 400_000
#: Words read at, walks, and step sets of each walk for every key.
SAMPLED, WALKS, STEP_SETS = 3, 12, 8
#: Edited copies at least in a trial.
TRIALS = 60
#: Windows embedded at once.
EMBEDDED = 4_000
_BITMAP_BITS = 24


def edits(n: int, percent: int) -> int:
    return n * percent // 100 if n >= 6 else 0


@dataclass
class SizeClass:
    """Items of similar length and the keys of their walks."""

    items: np.ndarray
    words: list[np.ndarray]
    allowed: np.ndarray
    needed: int
    window: int
    steps: np.ndarray = field(default=None)
    salts: np.ndarray = field(default=None)
    keys: np.ndarray = field(default=None)
    owner: np.ndarray = field(default=None)
    #: The word triples of each item, if the class has no keys.
    held: list[np.ndarray] | None = None

    def embed(self, stream: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Keys of the windows at ``starts``, one column each."""
        walks, length = len(self.salts), int(self.steps.max()) + 1
        at = np.repeat(starts[None, :], walks, axis=0)
        read = np.empty((length, walks, len(starts)), dtype=U64)
        for j in range(length):
            read[j] = stream[at]
            if j % 64 == 0:
                salt = ta.mix(self.salts + U64(j))[:, None]
            at += (ta.mix(read[j] ^ salt) >> U64(j % 64) & U64(1)).astype(at.dtype)
        out = []
        for q, steps in enumerate(self.steps):
            key = np.full((walks, len(starts)), U64(q + 1))
            for j in steps:
                key = ta.mix(key ^ read[j]) + U64(1)
            out.append(ta.mix(key ^ self.salts[:, None]))
        return np.concatenate(out)

    def fit(self, seed: int, recall: float) -> None:
        rng = np.random.default_rng(seed)
        shortest = min(len(w) for w in self.words)
        length = max(1, shortest * 3 // 2)
        sampled = min(SAMPLED, length)
        self.salts = rng.integers(1, 1 << 63, WALKS, dtype=np.int64).astype(U64)
        self.steps = np.stack([np.sort(rng.choice(length, sampled, replace=False)) for _ in range(STEP_SETS)])
        keys = self.embed(*_laid(self.words, length))
        # Trial: copies edited as much as is allowed, in random places.
        found = np.concatenate([self.embed(*_laid([_edited(w, k, rng) for w, k in zip(self.words, self.allowed)], length)) == keys
                                for _ in range(max(1, TRIALS // len(self.words)))], axis=1)
        for used in range(1, STEP_SETS + 1):
            if found[: used * WALKS].any(axis=0).mean() >= recall:
                break
        else:
            self.held = [np.unique(_triples(w)) for w in self.words]
            return
        self.steps, keys = self.steps[:used], keys[: used * WALKS]
        order = np.argsort(keys, axis=None, kind="stable")
        self.keys, self.owner = keys.ravel()[order], np.broadcast_to(np.arange(len(self.words)), keys.shape).ravel()[order]

    def matches(self, stream: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, item of the class) pairs with an equal key."""
        keys = self.embed(stream, starts)
        left, right = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        count = (right - left).ravel()
        if not count.any():
            none = np.zeros(0, dtype=np.int64)
            return none, none
        where = np.repeat(np.broadcast_to(starts, keys.shape).ravel(), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(left.ravel(), count)
        both = np.unique(where * len(self.words) + self.owner[place])
        return both // len(self.words), both % len(self.words)


def _laid(words: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequences in a row with room behind each, and where each starts."""
    gap = np.zeros(pad + 1, dtype=U64)
    starts = np.cumsum([0, *[len(w) + len(gap) for w in words[:-1]]])
    return np.concatenate([x for w in words for x in (w, gap)]), starts


def _edited(words: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    out = list(words)
    for _ in range(k):
        kind, at = rng.integers(3), int(rng.integers(len(out)))
        if kind == 0:
            out[at] = U64(rng.integers(1, 1 << 63))
        elif kind == 1:
            out.insert(at, U64(rng.integers(1, 1 << 63)))
        elif len(out) > 1:
            del out[at]
    return np.array(out, dtype=U64)


def _triples(words: np.ndarray) -> np.ndarray:
    return ta.grams(words, np.zeros(len(words), dtype=np.int8), (0, 1, 2))[1]


@dataclass
class Index:
    """All of a block of items: which size classes hold each word triple, and the classes."""

    triples: np.ndarray
    classes_of: np.ndarray
    bitmap: np.ndarray
    classes: list[SizeClass]

    @classmethod
    def build(cls, ids: list[int], words: list[np.ndarray], percent: int, recall: float, seed: int) -> Index:
        order = sorted((i for i in range(len(ids)) if len(words[i]) >= MIN_WORDS), key=lambda i: (len(words[i]), ids[i]))
        groups: list[list[int]] = []
        for i in order:
            if not groups or len(words[i]) > len(words[groups[-1][0]]) * 5 // 4 + 1 or len(words[i]) >= 6 > len(words[groups[-1][0]]):
                groups.append([])
            groups[-1].append(i)
        classes = []
        for g in groups:
            allowed = np.array([edits(len(words[i]), percent) for i in g])
            needed = min(len(words[i]) - 2 - 3 * k for i, k in zip(g, allowed))
            window = max(len(words[i]) + k for i, k in zip(g, allowed))
            c = SizeClass(np.array([ids[i] for i in g]), [words[i] for i in g], allowed, max(1, int(needed)), int(window))
            c.fit(seed, recall)
            classes.append(c)
        pairs = [(t, np.full(len(t), k)) for k, c in enumerate(classes) for w in c.words for t in [_triples(w)]]
        triples = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, dtype=U64)
        kinds = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, dtype=np.int64)
        every, at = np.unique(triples, return_inverse=True)
        held = np.zeros(len(every), dtype=U64)
        np.bitwise_or.at(held, at, U64(1) << kinds.astype(U64))
        bitmap = np.zeros(1 << _BITMAP_BITS, dtype=bool)
        bitmap[every >> U64(64 - _BITMAP_BITS)] = True
        return cls(every, held, bitmap, classes)

    def search(self, w: ta.Words) -> list[tuple[int, int, int, int, int]]:
        """(text, item_id, edits, first word, last word + 1) of the best window of every item in every text."""
        at, triples = ta.grams(w.hashes, w.owner, (0, 1, 2))
        some = np.flatnonzero(self.bitmap[triples >> U64(64 - _BITMAP_BITS)])
        if not len(some) or not len(self.triples):
            return []
        place = np.minimum(np.searchsorted(self.triples, triples[some]), len(self.triples) - 1)
        some, place = (x[self.triples[place] == triples[some]] for x in (some, place))
        at, held = at[some], self.classes_of[place]
        firsts = np.concatenate([[0], np.cumsum(w.counts)])
        stream = np.concatenate([w.hashes, np.zeros(1 + max(2 * c.window for c in self.classes), dtype=U64)])
        out: dict[tuple[int, int], tuple[int, int, int]] = {}
        for k, c in enumerate(self.classes):
            starts = _dense(at[held >> U64(k) & U64(1) == 1], w.owner, firsts, c.needed, c.window)
            for start, item, dist, end in _matched(c, stream, w.owner, firsts, starts) if c.held is None else _all_verified(c, stream, w.owner, firsts, starts):
                text = int(w.owner[start])
                key, own = (text, int(c.items[item])), start - int(firsts[text])
                found = (dist, own, own + end)
                out[key] = min(out.get(key, found), found)
        return [(text, item, *rest) for (text, item), rest in sorted(out.items())]


def _dense(hits: np.ndarray, owner: np.ndarray, firsts: np.ndarray, needed: int, window: int) -> np.ndarray:
    """All starts of windows with at least ``needed`` hits."""
    if len(hits) < needed:
        return np.zeros(0, dtype=np.int64)
    a, b = hits[: len(hits) - needed + 1], hits[needed - 1 :]
    good = (owner[a] == owner[b]) & (b - a <= window - 3)
    a, b = a[good], b[good]
    low = np.maximum(firsts[owner[a]], b + 3 - window)
    # Union of the ranges low..a.
    marks = np.zeros(len(owner) + 1, dtype=np.int32)
    np.add.at(marks, low, 1)
    np.add.at(marks, a + 1, -1)
    return np.flatnonzero(np.cumsum(marks[:-1]) > 0)


def _matched(c: SizeClass, stream, owner, firsts, starts) -> Iterator[tuple[int, int, int, int]]:
    for a in range(0, len(starts), EMBEDDED):
        yield from _verified(c, stream, owner, firsts, *c.matches(stream, starts[a : a + EMBEDDED]))


def _all_verified(c: SizeClass, stream, owner, firsts, starts) -> Iterator[tuple[int, int, int, int]]:
    """(start, item, edits, words of the window) of the best window of every item in every run of starts, by Sellers' algorithm:
    one row of the distance table for each word of the text, each cell with the first of the best starts."""
    cuts = np.flatnonzero((np.diff(starts) > 1) | (np.diff(owner[starts]) != 0)) + 1
    for run in np.split(starts, cuts) if len(starts) else ():
        low, high = int(run[0]), int(min(run[-1] + c.window, firsts[owner[run[0]] + 1]))
        text = stream[low:high]
        triples = _triples(text)
        for i, (words, k) in enumerate(zip(c.words, c.allowed)):
            n = len(words)
            if np.isin(triples, c.held[i]).sum() < n - 2 - 3 * k:
                continue
            unit = np.int64(1 << 32)
            steps = np.arange(n + 1, dtype=np.int64) * unit
            row, best, end = steps.copy(), steps[n], 0  # edits above, start below
            for e, word in enumerate(text, 1):
                new = np.empty_like(row)
                new[0] = e
                np.minimum(row[1:] + unit, row[:-1] + np.where(words != word, unit, 0), out=new[1:])
                row = np.minimum.accumulate(new - steps) + steps
                if row[n] < best:
                    best, end = row[n], e
            dist, start = divmod(int(best), 1 << 32)
            if dist <= k and end > start:
                yield low + start, i, dist, end - start


def _verified(c: SizeClass, stream, owner, firsts, starts, items) -> Iterator[tuple[int, int, int, int]]:
    """(start, item, edits, words of the window) of the pairs within the allowed edits."""
    for a in range(0, len(starts), 1024):
        s, it = starts[a : a + 1024], items[a : a + 1024]
        n = np.array([len(c.words[i]) for i in it])
        wide = int(n.max())
        text = np.zeros((len(s), wide), dtype=U64)
        for r, i in enumerate(it):
            text[r, : n[r]] = c.words[i]
        room = firsts[owner[s] + 1] - s
        steps = np.arange(wide + 1)
        row = np.broadcast_to(steps, (len(s), wide + 1)).astype(np.int32)
        ends = np.arange(len(s))
        best, where = row[ends, n].copy(), np.zeros(len(s), dtype=np.int64)
        for e in range(1, c.window + 1):
            word = stream[s + e - 1][:, None]
            new = np.empty_like(row)
            new[:, 0] = e
            new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (text != word))
            row = np.minimum.accumulate(new - steps, axis=1) + steps
            now = np.where(e <= room, row[ends, n], np.iinfo(np.int32).max)
            better = now < best
            best[better], where[better] = now[better], e
        for r in np.flatnonzero(best <= c.allowed[it]):
            yield int(s[r]), int(it[r]), int(best[r]), int(where[r])


def item_words(data: np.ndarray, at: np.ndarray) -> ta.Words:
    """Words with the capitals of Latin-1 lowered as well: in UTF-8, 0xC3 and 0x80-0x9E but for the multiplication sign."""
    high = np.flatnonzero(data[:-1] == 0xC3) + 1
    high = high[(data[high] >= 0x80) & (data[high] <= 0x9E) & (data[high] != 0x97)]
    if len(high):
        data = data.copy()
        data[high] += 0x20
    return ta.words(data, at, ta.ALNUM)


def _item_words(texts: list[str | None]) -> list[np.ndarray]:
    out = []
    for _, _, data, at in ta.pieces(pa.array(texts, pa.string())):
        w = item_words(data, at)
        cut = np.concatenate([[0], np.cumsum(w.counts)])
        out += [w.hashes[a:b] for a, b in zip(cut, cut[1:])]
    return out


def indexes(benchmark: DataFrame, percent: int = 20, recall: float = 0.98, seed: int = 11) -> Iterator[Index]:
    """Indexes of blocks of at most ``BLOCK_WORDS`` words, read one block at a time."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("item_id is not null and text is not null").distinct()
    ids, words, total = [], [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        (own,) = _item_words([row["text"]])
        ids.append(row["item_id"])
        words.append(own)
        total += len(own)
        if total >= BLOCK_WORDS:
            yield Index.build(ids, words, percent, recall, seed)
            ids, words, total = [], [], 0
    if ids:
        yield Index.build(ids, words, percent, recall, seed)


FOUND = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("n_edits", T.IntegerType()),
     T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType())]
)


def _in_batch(index: Index, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
    for first, _, data, at in ta.pieces(texts):
        for text, *rest in index.search(item_words(data, at)):
            yield (first + text, *rest)


def contaminations(docs: DataFrame, benchmark: DataFrame, percent: int = 20, recall: float = 0.98) -> DataFrame:
    """(doc_id, item_id, n_edits, first_word, end_word): for each row of ``docs`` (doc_id, text) and each item of ``benchmark``
    (item_id, text) in it, the best window; ties go to the first. Clean documents give no row.

    Repeated documents each give their rows, and null ids stay null. Items with a null id or text, and null or empty
    documents, give none. Other columns are ignored. Without items or documents the result is empty.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], FOUND)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_edits", pa.int32()), ("first_word", pa.int64()), ("end_word", pa.int64())])
    for index in indexes(benchmark, percent, recall):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                got = [(ids[row], *rest) for row, *rest in _in_batch(sent.value, batch.column(1))]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got), schema)], schema=schema)

        out = out.union(rows.mapInArrow(run, FOUND))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = 20, recall: float = 0.98) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item of ``benchmark`` is found."""
    for index in indexes(benchmark, percent, recall):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = np.ones(batch.num_rows, dtype=bool)
                good[[row for row, *_ in _in_batch(sent.value, batch.column(batch.schema.get_field_index("text")))]] = False
                yield batch.filter(pa.array(good))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
