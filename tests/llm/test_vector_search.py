import math
import random

import pytest

from loadloom.llm import vector_search


def _brute(rows, k, every):
    ints = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, v in ints:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ints if i != q and len(w) == len(v))[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(8192, 2048), (40, 7)])
def test_equals_brute_force_with_ties_and_odd_rows(spark, monkeypatch, blocks):
    monkeypatch.setattr(vector_search, "VECTORS", blocks[0])
    monkeypatch.setattr(vector_search, "QUERIES", blocks[1])
    rng = random.Random(12)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(300)]
    same = [0.5] * 8
    rows += [(1000 + i, same) for i in range(40)]
    rows += [(2000 + i, [0.25, 0.25]) for i in range(5)] + [(2010, [1.0, -3.0])]
    rows += [(None, same), (3000, None), (3010, []), (3020, [None, *same[1:]]), (3030, [math.nan, *same[1:]]), (3040, [math.inf, *same[1:]]), (1000, same), (1010, [1e4] * 8)]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id bigint, embedding array<double>, label int, score int")
    got = vector_search.top_k(df, 10, 10).collect()
    want = _brute(rows, 10, 10)
    # Two vectors share id 1010; each has its own answers.
    assert sorted(map(tuple, got)) == want


def test_few_and_no_vectors(spark):
    kind = "vec_id bigint, embedding array<float>"
    assert vector_search.top_k(spark.createDataFrame([], kind)).count() == 0
    assert vector_search.top_k(spark.createDataFrame([(0, [1.0])], kind)).count() == 0
    got = vector_search.top_k(spark.createDataFrame([(0, [1.0]), (7, [0.5]), (8, [0.5])], kind)).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 7, 1024 * 512), (0, 2, 8, 1024 * 512)]


@pytest.mark.parametrize("blocks", [(8192, 2048), (16, 5)])
def test_huge_components_end_no_query(spark, monkeypatch, blocks):
    monkeypatch.setattr(vector_search, "VECTORS", blocks[0])
    monkeypatch.setattr(vector_search, "QUERIES", blocks[1])
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(4)]) for i in range(80)]
    rows += [(1000, [1e200, 0.0, 0.0, 0.0]), (1010, [3e6, -2e6, 5e5, 1.0]), (1020, [4e9, 4e9, 0.0, 0.0]), (1021, [8e9, 1.0, 1.0, 1.0]), (1022, [-8e9, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    fits = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows if all(abs(1024 * x) < 2**53 for x in v)}
    want = []
    for q, v in fits:
        if q % 10 == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in fits if i != q]
            best = sorted(x for x in scores if -(2**63) <= -x[0] < 2**63)[:10]
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, vector_search.top_k(df, 10, 10).collect())) == sorted(want)
