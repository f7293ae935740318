import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loadloom.llm import trie

DDL = "conv_id bigint, turn bigint, role string, text string, name string, parent string, id string, depth string, total string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], DDL)


def rebuilt(rows, every=20, lengths=4):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % lengths
        base = c - (abs(c) % every) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + v[h:]
    return out


def brute(convs):
    members, kids, leaves, saved = defaultdict(list), defaultdict(list), {}, {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = []
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids[p])
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def built(spark, rows):
    return collected(trie.prefix_trie(*trie.with_shared_heads(trie.ordered_turns(frame(spark, rows)))))


def rows_of(rng, convs, most, texts):
    return [(c, t, rng.choice(["user", "assistant"]), f"t{rng.randrange(texts)} w" + " x" * rng.randrange(3)) for c in range(convs) for t in range(rng.randint(1, most))]


@pytest.mark.parametrize("chunk, stretch", [(64, 256), (3, 2)])
def test_equals_brute_force(spark, monkeypatch, chunk, stretch):
    monkeypatch.setattr(trie, "CHUNK", chunk)
    monkeypatch.setattr(trie, "STRETCH", stretch)
    monkeypatch.setattr(trie, "IDS", 3)
    rng = random.Random(chunk)
    rows = rows_of(rng, 70, 5, 2)
    rows += [(200, t, "user", f"deep {t}") for t in range(40)] + [(201, t, "user", f"deep {t}") for t in range(25)]
    # Nulls, ties in turn, repeated rows, texts that need their lengths, negative ids, no id.
    rows += [(300, None, None, None), (300, None, "a", "b"), (300, 1, "a", "z"), (300, 1, "a", "b"), (300, 1, "a", "b"), (301, 0, "ab", "c"), (302, 0, "a", "bc")]
    rows += [(303, 0, "a", "b/c"), (304, 0, "a/b", "c"), (-7, 0, "user", "neg"), (-7, 5, "user", "é 漢 \t x"), (None, 0, "user", "lost"), (305, 0, "", ""), (306, 3, "x", " \n ")]
    assert built(spark, rows) == brute(rebuilt(rows))


def test_conversations_that_lose_all_their_turns_end_at_the_root(spark):
    short = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 1]
    rows = [(c, 0, "user", "gone") for c in short]
    got = built(spark, rows)
    ids = ",".join(map(str, short))
    assert got == [(short[0], 0, None, len(short), 0, 1, 0, hashlib.sha256(ids.encode()).hexdigest())]


def test_chains_stars_and_brooms_take_few_rounds(spark, monkeypatch):
    """One long conversation, one whose nodes each lose a member, many of one turn, and combs with long teeth."""
    rounds = []
    rake = trie._rake
    monkeypatch.setattr(trie, "_rake", lambda tree: (rounds.append(1), rake(tree))[1])
    monkeypatch.setattr(trie, "STRETCH", 16)
    convs = {1: [("u", f"a{i}") for i in range(300)]}
    convs |= {1000 + n: [("u", f"n{i}") for i in range(n)] for n in range(1, 40)}
    convs |= {2000 + n: [("u", f"s{n}")] for n in range(200)}
    # A comb: the teeth are longer than what is left of the back, so labels along the back all differ.
    convs |= {3000 + n: [("u", f"b{i}") for i in range(n)] + [("u", f"t{n} {i}") for i in range(2 * (30 - n))] for n in range(1, 30)}
    rows = [(c, i, r, x) for c, v in convs.items() for i, (r, x) in enumerate(v)]
    turns = trie.ordered_turns(frame(spark, rows))
    totals = turns.groupBy("conv_id").agg(F.count("*").alias("total"))
    assert collected(trie.prefix_trie(turns, totals)) == brute(convs)
    assert len(rounds) <= 16  # 300 deep


def test_one_conversation_of_a_third_of_all_rows_is_dealt_over_tasks(spark):
    rows = [(5, t, "user", "same") for t in range(4000)] + [(c, 0, "user", str(c)) for c in range(100, 4100, 2)]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        turns = trie.ordered_turns(frame(spark, rows).repartition(7))
        sizes = [r["n"] for r in turns.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert turns.where("conv_id = 5").agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first() == (0, 3999, 4000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 6000


def test_empty_table(spark):
    assert built(spark, []) == []
    assert built(spark, [(None, 1, "user", "x")]) == []
