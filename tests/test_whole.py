"""Registered fits run with the operators' full settings."""

import pytest
from pyspark.ml.linalg import Vectors

from tallygrid.operators import models as mod, neural as net
from tallygrid.plans import modelling as M


class Reached(Exception):
    pass


@pytest.fixture
def rows(spark, monkeypatch):
    table = spark.createDataFrame([(str(i), Vectors.dense([i % 7, i % 3]), float(i % 7), M.LABELS[i % 3]) for i in range(60)],
                                  [M.KEY, "features", M.TARGET, "band"])
    monkeypatch.setattr(M, "prepared", lambda *a, **k: (table, table, [("a", "a"), ("b", "b")]))
    return table


def _settings(monkeypatch, module, name, run):
    """What ``run`` hands to a class or function of a module."""
    seen = {}

    def caught(*args, **kwargs):
        seen.update(kwargs)
        raise Reached
    monkeypatch.setattr(module, name, caught)
    with pytest.raises(Reached):
        run()
    return seen


def test_boosted_multiclass_runs_all_rounds(spark, rows, monkeypatch):
    seen = _settings(monkeypatch, mod, "GBTClassifier", lambda: M.QUERIES["boosted_multiclass"](spark, ""))
    assert (seen["maxIter"], seen["stepSize"], seen["maxDepth"]) == (300, 0.05, 3)


def test_classes_are_boosted_at_the_same_time(spark, rows, monkeypatch):
    seen = _settings(monkeypatch, mod, "OneVsRest", lambda: M.QUERIES["boosted_multiclass"](spark, ""))
    assert seen["parallelism"] == 3


def test_mlp_history_runs_until_patience_ends_it(spark, rows, monkeypatch):
    seen = _settings(monkeypatch, net, "mlp_fit", lambda: M.QUERIES["mlp_history"](spark, ""))
    assert seen.get("epochs", 500) == 500


def test_validation_shares_the_next_epochs_pass(rows, monkeypatch):
    single, mean_loss = [], net._mean_loss
    monkeypatch.setattr(net, "_mean_loss", lambda *a: single.append(1) or mean_loss(*a))
    fit = net.mlp_fit(rows, "features", M.TARGET, M.KEY, layers=(2, 1), epochs=3)
    assert [e for e, *_ in fit.history] == [1, 2, 3] and len(single) == 1
    held = net.mlp_fit(rows, "features", M.TARGET, M.KEY, layers=(2, 1), epochs=2).history
    assert [h[:3] for h in held] == [pytest.approx(h[:3], rel=1e-9) for h in fit.history[:2]]
