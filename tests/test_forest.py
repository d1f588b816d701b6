"""Forests grown from cells."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallygrid.operators import forest as fo, growing as gro, models as mod
from tallygrid.plans import modelling as M


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.uniform(0, 10, (1500, 2)), 1)
    y = x[:, 0] ** 2 + x[:, 1] + rng.normal(0, 4, 1500)
    data = [(i, [float(v) for v in x[i]], float(y[i])) for i in range(1500)]
    return spark.createDataFrame(data + data[:100], "id int, v array<double>, y double").select(
        "id", array_to_vector("v").alias("features"), "y").localCheckpoint()


def _found(df):
    return sorted(tuple(r) for r in df.select("id", "split", "actual", F.round("predicted", 6)).collect())


def test_registered_forest_runs_all_trees_to_their_end(spark, rows, monkeypatch):
    seen = {}
    monkeypatch.setattr(M, "prepared", lambda *a, **k: (rows.withColumnRenamed("id", M.KEY).withColumnRenamed("y", M.TARGET),) * 2 + ([],))
    monkeypatch.setattr(fo, "fit", lambda *a: seen.update(trees=a[3], depth=a[4]) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        M.QUERIES["forest_regression"](spark, "")
    assert seen == {"trees": 300, "depth": mod.MAX_DEPTH}


def test_bags_are_poisson_draws_of_rows():
    h = np.random.default_rng(1).integers(-2 ** 62, 2 ** 62, 20000)
    one, many = fo.drawn(h, np.ones(20000, int), 3, 42), fo.drawn(h, np.full(20000, 5), 3, 42)
    assert abs((one == 0).mean() - np.exp(-1)) < 0.015 and abs(one.mean() - 1) < 0.03 and abs(one.var() - 1) < 0.05
    assert abs(many.mean() - 5) < 0.07 and abs(many.var() - 5) < 0.25
    assert abs(fo.drawn(h[:300], np.full(300, 2000), 3, 42).mean() - 2000) < 15
    assert abs(np.corrcoef(one, fo.drawn(h, np.ones(20000, int), 4, 42))[0, 1]) < 0.03


def test_forest_smooths_and_does_not_depend_on_the_layout(rows):
    test = rows.where("id % 5 = 0")
    train = rows.where("id % 5 > 0")
    pred = mod.forest_regression(train, test, "features", "y", "id", trees=30)
    single = mod.tree_regression(train, test, "features", "y", "id")
    error = [p.where("split = 'test'").agg(F.avg(F.pow(F.col("actual") - F.col("predicted"), 2))).first()[0] for p in (pred, single)]
    assert error[0] < 0.85 * error[1] and pred.count() == rows.count()
    assert _found(mod.forest_regression(train.repartition(7), test, "features", "y", "id", trees=30)) == _found(pred)


def test_trees_of_many_cells_are_grown_by_all_tasks(rows, monkeypatch):
    want = _found(mod.forest_regression(rows, rows.limit(20), "features", "y", "id", trees=2, max_depth=6))
    monkeypatch.setattr(fo, "HELD_CELLS", 10)
    assert _found(mod.forest_regression(rows, rows.limit(20), "features", "y", "id", trees=2, max_depth=6)) == want
