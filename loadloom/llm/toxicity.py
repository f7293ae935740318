"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its distinct words, word pairs and pairs with one or two words between, each hashed into ``dims``
coordinates and worth 1. Every coordinate has its own learning rate, which falls with the gradients it has seen, and L1
keeps at zero whatever has not earned a weight. What scoring needs is a small table of weights.

Training uses at most ``max_rows`` labelled rows, those with the smallest hash of id and text, dealt over shards of about
``shard_rows``. Each shard learns from its own rows, ``rounds`` times over; the states are then averaged coordinate by
coordinate in Spark, and only coordinates with a weight leave it. The bound covers training only: every row of the corpus is
scored, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadloom.llm import textarrays as ta
from loadloom.llm.graphs import written

#: (salt, distances of the words) of each kind of feature.
KINDS = ((1, (0,)), (2, (0, 1)), (3, (0, 2)), (4, (0, 3)))


@dataclass
class Settings:
    """Rate ``alpha / (beta + sqrt(sum of squared gradients))``; penalties; hashing and training sizes."""

    alpha: float = 1.5
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 1.0
    bits: int = 20
    rounds: int = 3
    max_rows: int = 40_000
    shard_rows: int = 8_000
    seed: int = 7

    @property
    def dims(self) -> int:
        return 1 << self.bits


def features(w: ta.Words, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, coordinate) of each feature occurrence, one kind after the other; coordinate 0 is left to the bias."""
    for salt, offsets in KINDS:
        at, hashes = ta.grams(w.hashes, w.owner, offsets)
        index = ta.mix(hashes ^ np.uint64(salt)) >> np.uint64(64 - bits)
        yield w.owner[at], np.maximum(index.astype(np.int64), 1)


def rows_of_features(data: np.ndarray, at: np.ndarray, bits: int) -> list[np.ndarray]:
    """Distinct coordinates of each text."""
    w = ta.words(data, at)
    texts, index = (np.concatenate(x) for x in zip(*features(w, bits)))
    both = np.unique(texts.astype(np.int64) << bits | index)
    bounds = np.searchsorted(both, np.arange(len(w.counts) + 1, dtype=np.int64) << bits)
    both &= (1 << bits) - 1
    both = both.astype(np.int32)
    return [both[a:b] for a, b in zip(bounds, bounds[1:])]


@dataclass
class State:
    """Per coordinate: the adjusted sum of gradients and the sum of their squares. Coordinate 0 is the bias, free of L1."""

    z: np.ndarray
    n: np.ndarray

    def weights(self, s: Settings, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        small = np.abs(z) <= s.l1
        w = -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)
        w[small] = 0.0
        return w

    def bias(self, s: Settings) -> float:
        return float(-self.z[0] / ((s.beta + np.sqrt(self.n[0])) / s.alpha))

    def learn(self, s: Settings, index: np.ndarray, label: float) -> None:
        at = np.concatenate([[0], index])
        w = self.weights(s, at)
        w[0] = self.bias(s)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / s.alpha * w
        self.n[at] = n + g * g


@dataclass
class Weights:
    """Non-zero weights: at most ``2**bits`` of them, so their broadcast is bounded whatever the corpus."""

    bits: int
    bias: float
    index: np.ndarray = field(repr=False)
    value: np.ndarray = field(repr=False)

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits)
        out[self.index] = self.value
        return out


def _shard_learns(s: Settings):
    def run(group: pa.Table) -> pa.Table:
        labels, rows = group.column("label").to_numpy(), []
        for _, _, data, at in ta.pieces(group.column("text")):
            rows += rows_of_features(data, at, s.bits)
        own = State(np.zeros(s.dims), np.zeros(s.dims))
        order = np.argsort(group.column("order").to_numpy(), kind="stable")
        for turn in range(s.rounds):
            for i in np.random.default_rng(s.seed + turn).permutation(order):
                own.learn(s, rows[i], labels[i])
        seen = np.flatnonzero(own.n)
        return pa.table({"at": seen, "z": own.z[seen], "n": own.n[seen]})

    return run


def train(docs: DataFrame, labels: DataFrame, s: Settings | None = None) -> Weights:
    """Weights learned from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); other columns are ignored.

    Rows with a null id or label are passed over; of repeated ids the label 1 wins. Rows that agree in id and text count once. At
    most ``max_rows`` labelled documents are learned from, those with the smallest hash; labels without a document use up none
    of them. Without any labelled row all weights are 0 and every score is 0.5.
    """
    s = s or Settings()
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("key", F.xxhash64("text"))
    # Labelled documents first, as ids and hashes; the bound is on those, and only then are their texts fetched.
    pairs = texts.select("doc_id", "key").join(known, "doc_id").groupBy("doc_id", "key").agg(F.max("label").alias("label"))
    pairs = written(pairs.withColumn("order", F.xxhash64("doc_id", "key", F.lit(s.seed))), "labelled")
    total = pairs.count()
    if total > s.max_rows:
        share = min(1.0, (s.max_rows + 10 * s.max_rows**0.5 + 100) / total)
        near = pairs.where(F.col("order") <= F.lit(min(2**63 - 1, int(-(2**63) + share * 2**64))))
        pairs = written(near.orderBy("order", "doc_id", "key").limit(s.max_rows), "labelled")
        total = pairs.count()
    shards = max(1, -(-total // s.shard_rows))
    chosen = texts.join(F.broadcast(pairs), ["doc_id", "key"]).groupBy("doc_id", "key").agg(F.first("text").alias("text"), F.max("label").alias("label"), F.max("order").alias("order"))
    chosen = chosen.withColumn("label", F.col("label").cast("double")).withColumn("shard", F.pmod(F.xxhash64("order"), F.lit(shards)))
    state = State(np.zeros(s.dims), np.zeros(s.dims))
    if total:
        seen = chosen.groupBy("shard").applyInArrow(_shard_learns(s), "at bigint, z double, n double")
        # Sums of doubles depend on the order of arrival in their last bits; cut them off.
        mean = lambda c: F.round(F.sum(c) / shards, 9).alias(c)
        heavy = seen.groupBy("at").agg(mean("z"), mean("n")).where((F.abs("z") > s.l1) | (F.col("at") == 0))
        for row in heavy.toLocalIterator():
            state.z[row["at"]], state.n[row["at"]] = row["z"], row["n"]
    w = state.weights(s)
    w[0] = 0
    index = np.flatnonzero(w)
    return Weights(s.bits, state.bias(s), index, w[index])


def scores(model: Weights, texts: pd.Series | pa.Array) -> np.ndarray:
    """Probability of label 1 for each whole text; that of the bias alone for an empty or null one."""
    dense = model.dense()
    out = []
    for first, last, data, at in ta.pieces(pa.array(texts, pa.string()) if isinstance(texts, pd.Series) else texts):
        w = ta.words(data, at)
        keys = []
        for text, index in features(w, model.bits):
            live = np.flatnonzero(dense[index])
            keys.append(text[live].astype(np.int64) << model.bits | index[live])
        both = np.unique(np.concatenate(keys))  # a feature counts once per text
        total = np.bincount(both >> model.bits, weights=dense[both & ((1 << model.bits) - 1)], minlength=last - first)
        out.append(1 / (1 + np.exp(-np.clip(total + model.bias, -35, 35))))
    return np.concatenate(out) if out else np.zeros(0)


def _scored(sent, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = pa.array(scores(sent.value, batch.column(batch.num_columns - 1)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], got], schema=schema)

    return run


def held_out() -> Column:
    """Rows that training must not see."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def train_on_rest(docs: DataFrame, labels: DataFrame, s: Settings | None = None) -> Weights:
    """``train`` on the labelled rows that are not held out."""
    return train(docs, labels.where(~F.coalesce(held_out(), F.lit(False))), s)


def score_documents(docs: DataFrame, model: Weights, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs`` (doc_id, text), one row for each, repeated ones included.

    Null and empty texts get the score of the bias; a null doc_id stays null. Other columns are ignored. Equal texts have
    equal scores. ``predicted`` is 1 from the threshold on.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    got = rows.mapInArrow(_scored(sent, schema), "doc_id bigint, score double")
    return got.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, model: Weights, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = scores(sent.value, batch.column(batch.schema.get_field_index("text")))
            yield batch.filter(pa.array(got < threshold))

    return docs.mapInArrow(keep, docs.schema)
