"""Fused restarts of K-Means against plain Lloyd steps and plain silhouettes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrid.operators import cluster as clu, lloyd


def frame(spark, x, parts=5):
    return spark.createDataFrame([(i, None if v is None else v.tolist()) for i, v in enumerate(x)], "k int, v array<double>").repartition(parts)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    return np.concatenate([rng.normal(m, 1.0, size=(80, 4)) for m in (0, 4, 9)]) + 1000


def plain_lloyd(x, centers, max_iter, tol):
    still = tol * x.var(axis=0).mean()
    for _ in range(max_iter):
        own = ((x[:, None] - centers) ** 2).sum(-1).argmin(1)
        moved = np.array([x[own == j].mean(0) if (own == j).any() else centers[j] for j in range(len(centers))])
        gap, centers = ((moved - centers) ** 2).sum(), moved
        if gap <= still:
            break
    return centers, ((x[:, None] - centers) ** 2).sum(-1).min(1).sum()


def test_every_run_equals_plain_lloyd(spark, points, monkeypatch):
    starts = {}
    plain = lloyd._spread_out

    def remember(sample, k, rng):
        starts[len(starts)] = plain(sample, k, rng)
        return starts[len(starts) - 1]

    monkeypatch.setattr(lloyd, "_spread_out", remember)
    runs = lloyd.fit_many(frame(spark, points), "v", [2, 3, 5], restarts=4)
    assert [(r.k, r.restart) for r in runs] == [(k, r) for r in range(4) for k in (2, 3, 5)]
    for run in runs:
        centers, cost = plain_lloyd(points, starts[run.restart][:run.k].copy(), 300, 1e-4)
        np.testing.assert_allclose(run.centers, centers, rtol=1e-9)
        assert abs(run.cost - cost) < 1e-6 * cost and run.sizes.sum() == len(points)


def test_sweep_equals_plain_silhouettes(spark, points):
    df = frame(spark, points)
    rows = {r["k"]: r for r in clu.k_sweep(df, "k", "v", ks=(2, 3, 4), restarts=3).collect()}
    runs = lloyd.fit_many(df, "v", (2, 3, 4), 3)
    for k, row in rows.items():
        best = lloyd.best_of(runs, k)
        own = ((points[:, None] - best.centers) ** 2).sum(-1).argmin(1)
        gaps = ((points[:, None] - points) ** 2).sum(-1)
        s = []
        for i in range(len(points)):
            mean = [gaps[i][(own == j)].sum() / max((own == j).sum() - (own[i] == j), 1) for j in range(k)]
            a, b = mean[own[i]], min(m for j, m in enumerate(mean) if j != own[i])
            s.append((b - a) / max(a, b))
        assert abs(row["silhouette"] - np.mean(s)) < 1e-8 and abs(row["inertia"] - best.cost) < 1e-6 * best.cost
    assert rows[3]["inertia_change"] < 0 and rows[4]["never_rises"]


def test_result_does_not_depend_on_partitions(spark, points):
    costs = [sorted(round(r.cost, 6) for r in lloyd.fit_many(frame(spark, points, n), "v", [3], restarts=2, sample_rows=10_000)) for n in (1, 9)]
    assert abs(min(costs[0]) - min(costs[1])) < 1e-3


def test_edges(spark):
    few = np.array([[1.0, 1.0]] * 3 + [[2.0, 2.0]])
    df = frame(spark, [*few, None])
    run = lloyd.best_of(lloyd.fit_many(df, "v", [3], restarts=2), 3)
    assert run.cost == 0 and run.sizes.sum() == 4
    labels = {r["k"]: r["c"] for r in df.select("k", run.predict(F.col("v")).alias("c")).collect()}
    assert labels[4] is None and labels[0] == labels[1] == labels[2] != labels[3]
    with pytest.raises(ValueError):
        lloyd.fit_many(df.where("false"), "v", [2])
