import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillcast.llm import hard_negatives as hn
from rillcast.llm.segment_bounds import FINEST, candidates, levels, summaries

END = 2**63 - 1


def plain(rows, is_anchor, positives=5, negatives=5):
    """All results by scoring every pair with Python's whole numbers."""
    used = []
    for v, x, label in rows:
        if v is not None and label is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            row = (v, label, tuple(max(-(2**62), min(2**62, math.floor(256 * c))) if abs(256 * c) < 1e300 else int(math.copysign(2**62, c)) for c in x))
            if row not in used:
                used.append(row)
    out = []
    for a in used:
        if not is_anchor(a[0]):
            continue
        score = lambda r: max(-END - 1, min(END, sum(p * q for p, q in zip(a[2], r[2]))))
        best = sorted(((-score(r), r[0]) for r in used if r is not a and r[1] == a[1]))[:positives]
        for s, p in best:
            fit = sorted((-score(r), r[0]) for r in used if r[1] != a[1] and 80 * -s <= 100 * score(r) <= 100 * -s)
            out += [(a[0], p, k + 1, n, -s, -t) for k, (t, n) in enumerate(fit[:negatives])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def rows_of(seed, n=160, d=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(3, d))
    rows = [(i, (centres[i % 3] * 0.6 + rng.normal(size=d) * 0.5).tolist(), i % 3) for i in range(n)]
    # Ties, copies under other ids and labels, one hot vector.
    rows += [(n + i, rows[5][1], i % 3) for i in range(40)]
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("unit", [(8192, 4096), (17, 3)])
def test_against_all_pairs(spark, monkeypatch, unit):
    monkeypatch.setattr(hn, "UNIT_VECTORS", unit[0])
    monkeypatch.setattr(hn, "UNIT_ANCHORS", unit[1])
    monkeypatch.setattr(hn, "ANCHORS", 4)
    rows = rows_of(1)
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = plain(rows, lambda v: v % 10 == 0)
    assert got(hn.hard_negatives(docs, F.col("vec_id") % 10 == 0)) == want and len(want) > 200


def test_odd_rows(spark):
    big = [1e300, -1e300, 3.0]
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [1.0], 1), (1, [2.0, 1.0, 5.0], 1), (2, [1.0, 1.0], 2), (3, [], 1), (4, [], 2), (None, [1.0], 1), (5, None, 1),
        (6, [1.0, None], 1), (7, [float("nan")], 1), (8, [float("inf")], 2), (9, [1.0, 1.0], None), (10, [0.9, 1.9], 2), (11, [0.99, 2.0], 3), (20, big, 4), (21, big, 4), (22, big, 5),
        (23, [1e5, 2e5, -1e5], 4), (24, [1.1e5, 1.9e5, -1e5], 5),
    ]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", rank int, q string")
    want = plain(rows, lambda v: True)
    assert got(hn.hard_negatives(docs, F.lit(True))) == want and len(want) > 10
    assert got(hn.hard_negatives(docs.where("false"), F.lit(True))) == []
    assert got(hn.hard_negatives(docs, F.lit(False))) == []
    floats = docs.withColumn("embedding", F.col("embedding").cast("array<float>")).where("vec_id < 20")
    assert got(hn.hard_negatives(floats, F.lit(True))) == plain([(r[0], r[1] and [None if c is None else float(np.float32(c)) for c in r[1]], r[2]) for r in rows if r[0] is not None and r[0] < 20], lambda v: True)


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(3)
    x, y = np.floor(rng.normal(size=(30, 4 * FINEST)) * 256), np.floor(rng.normal(size=(40, 4 * FINEST)) * 256 + 50)
    lx, ly = (levels(*summaries(z), 4) for z in (x, y))
    assert len(lx) == 5 and lx[0][1].shape[1] == 1
    exact, before, seen = x @ y.T, None, []

    def keep(a, b, low, high):
        assert (low <= exact[a, b]).all() and (exact[a, b] <= high).all()
        seen.append((high - low).mean())
        return np.ones(len(a), bool)

    candidates(lx, ly, np.ones((30, 40), bool), keep)
    assert len(seen) == 5 and seen == sorted(seen, reverse=True)
    for (w, m, d), x2 in zip(lx, [x] * 5):
        parts = x2.reshape(30, m.shape[1], w)
        assert np.allclose(parts.mean(axis=2), m) and np.allclose(parts.std(axis=2) * np.sqrt(w), d)
