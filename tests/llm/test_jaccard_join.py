import random

import pytest
from pyspark.sql import functions as F
from helpers import EDGES, doc_frame, edited, prose, words

from loadloom.llm.graphs import components
from loadloom.llm.jaccard_join import jaccard_components, one_of_each


def _set(text):
    own = words(text)
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4)) if len(own) >= 5 else frozenset([tuple(own)] if own else [])


def _brute(rows):
    sets = [_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def _got(df):
    return sorted(map(tuple, jaccard_components(df).select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_components_equal_brute_force(spark):
    rng = random.Random(1)
    rows = list(EDGES)
    common = prose(rng, 30)
    for g in range(12):
        base = prose(rng, rng.choice((6, 12, 40, 150, 300)))
        rows += [(100 + 40 * g + k, edited(rng, base, rng.choice((0, 0.01, 0.02, 0.03, 0.05)))) for k in range(20)]
        rows += [(1000 + g, common + " " + prose(rng, 60))]
    rows += [(9000 + k, " ".join(f"s{i}" for i in range(k % 7, 30))) for k in range(20)]  # subsets, some exactly at 80 percent
    rng.shuffle(rows)
    assert _got(doc_frame(spark, rows).repartition(5)) == _brute(rows)


def test_exact_threshold(spark):
    # 8 of 10 shingles shared: linked; 7 of 9: not.
    a = [f"w{i}" for i in range(13)]
    rows = [(1, " ".join(a)), (2, " ".join(a + ["x"])), (3, " ".join(a[:12] + ["y", "z"])), (4, " ".join(a[:11]))]
    assert _got(doc_frame(spark, rows)) == _brute(rows)


def test_empty_table(spark):
    assert _got(doc_frame(spark, [])) == []


def test_one_of_each_group_stays(spark):
    rng = random.Random(2)
    base = prose(rng, 200)
    rows = [*EDGES, (50, base), (40, edited(rng, base, 0.01)), (60, base), (5, prose(rng, 80)), (None, base)]
    df = doc_frame(spark, rows)
    kept = one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    # Texts without words stay; of the copies of "one" the first; of the group around base, 40.
    want = [r for r in rows if not words(r[1])] + [(4, "one"), (None, "no id here"), rows[8], rows[9], rows[11], rows[13]]
    assert got == sorted(want, key=repr)


def test_one_of_each_with_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (3, None, "z")], "doc_id bigint, text string, __key string")
    for c in ("__id", "__null", "own_id", "own_key", "own_null", "sid", "root", "b"):
        docs = docs.withColumn(c, F.lit("kept"))
    got = one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"], r["__key"], r["own_key"], r["sid"]) for r in got.collect()) == [(1, "x", "kept", "kept"), (3, "z", "kept", "kept")]


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (5, 4), (7, 7)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)] + [(100, 99), (99, 0)]])
def test_graph_components(spark, edges):
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {}
    for a, b in edges:
        if a != b:
            parent.setdefault(a, {a}).add(b), parent.setdefault(b, {b}).add(a)
    want = {}
    for n in parent:
        seen, todo = {n}, [n]
        while todo:
            for m in parent[todo.pop()]:
                if m not in seen:
                    seen.add(m), todo.append(m)
        want[n] = min(seen)
    assert got == want
