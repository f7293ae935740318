import math
import random

import numpy as np
import pytest

from loadloom.llm import hard_negatives

KIND = "vec_id bigint, embedding array<double>, label int, score bigint, row string, block string, angle string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, 1, "x", "x", "x") for i, v, l in rows], KIND)


def brute(rows, every=100, k=5, m=5):
    fits = {(i, l, tuple(math.floor(256 * x) for x in v)) for i, v, l in rows if i is not None and l is not None and v and all(x is not None and math.isfinite(x) and abs(256 * x) < 2**53 for x in v)}
    out = []
    for i, l, v in fits:
        if i % every:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), j, lj) for j, lj, w in fits if j != i and len(w) == len(v)]
        scores = sorted(x for x in scores if -(2**63) <= -x[0] < 2**63)
        for s, j, _ in [x for x in scores if x[2] == l][:k]:
            found = [x for x in scores if x[2] != l and 80 * -s <= 100 * -x[0] <= 100 * -s][:m]
            out += [(i, j, r, x[1], -s, -x[0]) for r, x in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, every=10):
    return sorted(map(tuple, hard_negatives.mine(frame(spark, rows), every).collect()))


def clustered(rng, n, dims, labels, spread, norms=(0.5, 1.5)):
    """Vectors around centres, labels that partly cross them."""
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    out = []
    for i in range(n):
        c, size = rng.choice(centres), rng.uniform(*norms)
        out.append((i, [rng.gauss(x, spread) * size for x in c], rng.randrange(labels)))
    return out


@pytest.mark.parametrize("rows, anchors, first, spread", [(4096, 512, 2, 0.3), (16, 4, 1, 0.05), (16, 4, 2, 1.0), (7, 3, 1, 0.01)])
def test_equals_brute_force(spark, monkeypatch, rows, anchors, first, spread):
    monkeypatch.setattr(hard_negatives, "ROWS", rows)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "FIRST", first)
    rng = random.Random(rows)
    data = clustered(rng, 300, 8, 3, spread)
    assert mined(spark, data) == brute(data, 10) != []


def test_ties_copies_odd_rows_and_huge_numbers(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 8)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 2)
    rng = random.Random(3)
    data = clustered(rng, 60, 4, 2, 0.2)
    same = [0.5, -0.25, 0.75, 0.1]
    data += [(1000 + i, same, i % 2) for i in range(50)] + [(1010, same, 0), (1020, [0.4, 0.1, 0.2, 0.2], 1), (1020, same, 1)]
    data += [(2000 + i, [0.0] * 4, i % 2) for i in range(12)]
    data += [(3000, [0.5, 0.5], 0), (3001, [0.25, 0.5], 0), (3002, [0.25, 0.49], 1), (3010, [1.0], 7)]
    data += [(None, same, 1), (4000, None, 1), (4010, same, None), (4020, [], 1), (4030, [None, 1.0, 1.0, 1.0], 1), (4040, [math.nan] * 4, 1), (4050, [math.inf] * 4, 0)]
    data += [(5000, [1e200] * 4, 0), (5010, [1e9, 1.0, 2.0, 3.0], 0), (5011, [9e8, 1.0, 1.0, 1.0], 0), (5012, [8.5e8, 3.0, 1.0, 1.0], 1), (5020, [3e12, 3e12, 0.0, 0.0], 1), (5021, [3e12, 0.0, 0.0, 0.0], 1)]
    assert mined(spark, data) == brute(data, 10)


def test_windows_leave_out_blocks_of_clustered_vectors_and_nothing_that_fits(spark, monkeypatch):
    """On tight clusters most rows are never scored."""
    scored = []
    products = hard_negatives._products
    monkeypatch.setattr(hard_negatives, "_products", lambda v, q: (scored.append(len(v) * len(q)), products(v, q))[1])
    rng = random.Random(8)
    v = np.array([x for _, x, _ in clustered(rng, 4000, 16, 1, 0.02, (0.95, 1.05))])
    v = np.floor(256 * v).astype(np.int64)
    directions = {16: v[:6] / np.linalg.norm(v[:6], axis=1, keepdims=True)}
    _, angles = hard_negatives._angles(v, directions[16])
    cell = angles.argmin(axis=1)
    found = 0
    run = hard_negatives._scored(directions, 5)
    q = v[:20]
    floors = np.sort(q @ v.T, axis=1)[:, -6]
    import pyarrow as pa

    for c in np.unique(cell):
        rows = np.flatnonzero(cell == c)
        norms = np.linalg.norm(v[rows].astype(float), axis=1)
        record = {
            "dims": 16, "cell": int(c), "ids": rows.astype(np.int64).tobytes(), "vectors": v[rows].tobytes(), "least": norms.min(), "most": norms.max(),
            "q_rows": np.arange(20, dtype=np.int64).tobytes(), "q_ids": np.arange(20, dtype=np.int64).tobytes(), "q_vectors": q.tobytes(),
            "s_row": list(range(20)), "s_slot": [0] * 20, "s_lo": floors.tolist(), "s_id": [2**62] * 20, "s_hi": [2**62] * 20,
        }
        found += sum(b.num_rows for b in run(iter([pa.RecordBatch.from_pylist([record])])))
    want = sum(min(5, int(((q[i] @ v.T >= floors[i]) & (np.arange(len(v)) != i)).sum())) for i in range(20))
    assert found >= want
    assert sum(scored) < 0.5 * 20 * len(v)


def test_few_and_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2), (3, [-1.0], 2)]) == [(0, 1, 1, 2, 65536, 256 * 230)]
