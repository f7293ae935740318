import random
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import EDGES, doc_frame, prose

from loadloom.llm import sharding
from loadloom.llm.sharding import shard_by_bytes


def _check(rows, got, shards):
    size = lambda t: len((t or "").encode()) + 8
    crc = lambda t: zlib.crc32((t or "").encode())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((d, size(t), crc(t)) for d, t in rows)
    slots, load = defaultdict(list), Counter()
    for r in got:
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load


@pytest.mark.parametrize("hot", [0, 1500])
def test_shards_are_near_equal_and_whole(spark, hot):
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.randrange(5, 60))) for i in range(3000)] + [(5000 + i, "the same text " * 10) for i in range(hot)]
    load = _check(rows, shard_by_bytes(doc_frame(spark, rows), 8).collect(), 8)
    mean = sum(load.values()) / 8
    assert len(load) == 8 and max(load.values()) - min(load.values()) < 0.02 * mean + 1000


def test_small_groups_of_copies_stay_together(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 30)) for i in range(3000)] + [(9000 + i, f"copy number {i % 40}") for i in range(120)]
    got = shard_by_bytes(doc_frame(spark, rows), 4).collect()
    where = defaultdict(set)
    for r in got:
        where[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_edges(spark):
    _check(EDGES, shard_by_bytes(doc_frame(spark, EDGES), 24).collect(), 24)
    assert shard_by_bytes(doc_frame(spark, []), 24).count() == 0
    one = [(1, "a")] * 50
    assert sorted(_check(one, shard_by_bytes(doc_frame(spark, one), 3).collect(), 3).values()) == [144, 153, 153]


@pytest.mark.parametrize("unfolded", [100_000, 7])
def test_copies_of_one_row_are_divided(spark, monkeypatch, unfolded):
    monkeypatch.setattr(sharding, "UNFOLDED", unfolded)
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(5, 60))) for i in range(600)] + [(7000, "one row " * 20)] * 300
    load = _check(rows, shard_by_bytes(doc_frame(spark, rows), 24).collect(), 24)
    mean = sum(load.values()) / 24
    assert len(load) == 24 and max(load.values()) - min(load.values()) < 0.02 * mean + 1000


def test_two_rows_of_many_copies_and_one_shard(spark):
    rows = [(1, "a" * 92)] * 400 + [(2, "b" * 192)] * 200 + [(3, None)] * 10
    load = _check(rows, shard_by_bytes(doc_frame(spark, rows), 8).collect(), 8)
    assert max(load.values()) - min(load.values()) <= 400
    assert len(_check(rows, shard_by_bytes(doc_frame(spark, rows), 1).collect(), 1)) == 1
