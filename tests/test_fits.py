"""Forecasters of the whole design against plain numpy and plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillcast.config import Clip
from rillcast.operators import boosting, ridge


def samples(seed=1, n=90, p=7, h=3, sites=2):
    """(site, number, features, deltas) with a signal in two features."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        x = rng.normal(size=p)
        y = np.stack([(k + 1) * x[1] + np.sin(2 * x[3]) + 0.1 * rng.normal() for k in range(h)])
        out.append((i % sites, i, x.tolist(), y.tolist()))
    return out


SCHEMA = "site_id int, forecast_start_time int, features array<double>, scaled_deltas array<double>"


@pytest.mark.parametrize("alpha", [0.0, 3.0])
@pytest.mark.parametrize("held", [0, 64])
def test_ridge_against_numpy(spark, monkeypatch, alpha, held):
    monkeypatch.setattr(ridge, "HELD_GROUPS", held)
    rows = samples()
    bad = [(0, 900, [None] + [1.0] * 6, [1.0] * 3), (0, 901, [float("nan")] * 7, [1.0] * 3), (0, 902, None, [1.0] * 3), (0, 903, [1.0] * 7, [1.0, None, 2.0]), (5, 904, None, None)]
    train = spark.createDataFrame([*rows, *bad], SCHEMA).repartition(6)
    got = {r["site_id"]: r for r in ridge.fit_ridge(train, keys=["site_id"], alpha=alpha).collect()}
    assert set(got) == {0, 1}
    for site, r in got.items():
        x = np.array([[1.0, *f] for s, _, f, _ in rows if s == site])
        y = np.array([d for s, _, _, d in rows if s == site])
        shrink = alpha * np.diag([0.0] + [1.0] * 7)
        assert r["n"] == len(x) and np.allclose(np.array(r["coefficients"]), np.linalg.solve(x.T @ x + shrink, x.T @ y).T)


def test_ridge_of_dependent_features_and_of_nothing(spark):
    rows = [(0, i, [float(i), 2.0 * i], [3.0 * i + 1]) for i in range(5)]
    train = spark.createDataFrame(rows, SCHEMA)
    (r,) = ridge.fit_ridge(train, keys=["site_id"], alpha=0.0).collect()
    c = np.array(r["coefficients"][0])
    assert all(abs(c[0] + c[1] * i + c[2] * 2 * i - (3 * i + 1)) < 1e-6 for i in range(5))
    assert ridge.fit_ridge(train.where("false"), keys=["site_id"]).count() == 0
    mixed = spark.createDataFrame([*rows, (0, 9, [1.0], [1.0])], SCHEMA)
    with pytest.raises(Exception, match="differ in length"):
        ridge.fit_ridge(mixed, keys=["site_id"]).collect()


def scorable(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({
        "lags": F.array(F.lit(0.0), F.lit(10.0)), "targets": F.transform("scaled_deltas", lambda d: d * 2 + 1 + 10), "delta_scale": F.lit(2.0), "delta_mean": F.lit(1.0)})


def test_ridge_scores(spark):
    rows = samples()
    df = scorable(spark, rows)
    fitted = ridge.fit_ridge(df, keys=["site_id"])
    coefficients = {r["site_id"]: np.array(r["coefficients"]) for r in fitted.collect()}
    scored = ridge.score_ridge(df, fitted, 3, Clip(enabled=False), keys=["site_id"]).collect()
    assert len(scored) == len(rows)
    by_id = {i: (s, x) for s, i, x, _ in rows}
    for r in scored:
        site, x = by_id[r["forecast_start_time"]]
        assert np.allclose(r["y_pred"], 10 + 1 + 2 * (coefficients[site] @ [1.0, *x]))


def plain_trees(rows, edges, trees, depth, rate, shrink, least):
    """Predictions of boosted trees of one group and horizon by loops."""
    bins = [[sum(v <= x for v in e) for x, e in zip(f, edges)] for f, _ in rows]
    residual = [y for _, y in rows]
    out = [0.0] * len(rows)
    for _ in range(trees):
        nodes = {1: list(range(len(rows)))}
        for level in range(depth):
            for node in [k for k in nodes if k >= 2**level]:
                own, best = nodes[node], None
                g = sum(residual[i] for i in own)
                for f in range(len(edges)):
                    for cut in sorted({bins[i][f] for i in own}):
                        left = [i for i in own if bins[i][f] <= cut]
                        if min(len(left), len(own) - len(left)) < least:
                            continue
                        gl = sum(residual[i] for i in left)
                        gain = round(gl**2 / (len(left) + shrink) + (g - gl) ** 2 / (len(own) - len(left) + shrink) - g**2 / (len(own) + shrink), 6)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, f, cut)
                if best:
                    del nodes[node]
                    _, f, cut = best
                    nodes[2 * node] = [i for i in own if bins[i][f] <= cut]
                    nodes[2 * node + 1] = [i for i in own if bins[i][f] > cut]
        for own in nodes.values():
            value = rate * sum(residual[i] for i in own) / (len(own) + shrink)
            for i in own:
                out[i] += value
                residual[i] -= value
    return out


@pytest.mark.parametrize("by", ["width", "count"])
def test_boosted_groups_against_loops(spark, by):
    rows = samples(2, n=60, p=4, h=2)
    df = scorable(spark, rows).repartition(5)
    edges = boosting.bin_edges(df, ["site_id"], "features", 6, by)
    grown = boosting.fit_boosted_groups(df, edges, 2, trees=3, depth=3, rate=0.3, subsample=1.0, shrink=1.0, least_rows=2)
    assert {r["tree"] for r in grown.select("tree").distinct().collect()} == {0, 1, 2}
    scored = boosting.score_boosted_groups(df, edges, grown, 2, 3, 0.3, Clip(enabled=False)).collect()
    got = {r["forecast_start_time"]: r["y_pred"] for r in scored}
    bounds = {r["site_id"]: r["edges"] for r in edges.collect()}
    assert len(got) == len(rows)
    for site in (0, 1):
        own = [(i, x, y) for s, i, x, y in rows if s == site]
        for h in range(2):
            want = plain_trees([(x, y[h]) for _, x, y in own], bounds[site], 3, 3, 0.3, 1.0, 2)
            assert np.allclose([got[i][h] for i, _, _ in own], [10 + 1 + 2 * w for w in want])


def test_boosting_learns_with_samples_left_out(spark):
    rows = samples(3, n=200, p=4, h=1, sites=1)
    df = scorable(spark, [*rows, (0, 999, [None] * 4, [1.0])])
    edges = boosting.bin_edges(df, ["site_id"], "features", 16)
    grown = boosting.fit_boosted_groups(df, edges, 1, trees=4, depth=3, rate=0.5, subsample=0.7)
    sizes = [r["n"] for r in grown.where("node = 1").collect()]
    assert len(sizes) == 4 and len(set(sizes)) > 1 and all(110 < n < 170 for n in sizes)
    scored = boosting.score_boosted_groups(df.where("forecast_start_time < 999"), edges, grown, 1, 3, 0.5, Clip(enabled=False))
    error, before = np.array([(r["y_pred"][0] - r["y_true"][0], 10 - r["y_true"][0]) for r in scored.collect()]).T
    assert (error**2).mean() < 0.35 * (before**2).mean()
    assert boosting.fit_boosted_groups(df.where("false"), edges, 1, trees=1, depth=1).count() == 0
