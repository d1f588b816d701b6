"""Queries that fit models on the line table, and anomaly reports.

Models have no SQL form, so these carry no oracle; the tests check their
invariants. Anomaly reports are checked on a rule-based score.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..functions.scale import forget, release, settle, spread
from ..operators import anomaly as ano, features as feat, models as mod, neural as net, pruning as pru
from ..operators import splits as spl
from . import fixtures as fx
from .fixtures import BANDS, with_views
from .preparing import CATEGORICAL, NUMERIC

KEY, TARGET, LABELS = "line_id", "charge", list(BANDS)
# Settings that keep a registered run short; the operators default to the full ones.
TREES, ROUNDS, EPOCHS, FOURIER = 20, 20, 12, 200
FOREST_DEPTH, SVM_STEPS = 10, 100


def prepared(spark, sf, scale=False):
    """(train, test, names): feature vectors fitted on train rows, price columns kept out of the leak."""
    inputs = fx.lines(spark, sf).select(KEY, *NUMERIC, *CATEGORICAL)
    rows = spread(inputs.join(fx.split(spark, sf), KEY), KEY)
    release(spark)
    train = rows.where("split = 'train'")
    model = feat.feature_pipeline(train, NUMERIC, CATEGORICAL, scale=scale)
    # the rows lie in even hash partitions already
    table = settle(feat.feature_vectors(model, rows, [KEY, "split", TARGET, "band"]))
    # the vectors are all that is read from here on
    forget(rows)
    release(spark)
    names = feat.feature_names(model, NUMERIC, CATEGORICAL)
    return (table.where("split = 'train'").drop("split"), table.where("split = 'test'").drop("split"), names)


def _regression(fit, scale=False, **params):
    def run(spark, sf):
        train, test, _ = prepared(spark, sf, scale)
        return rounded(fit(train, test, "features", TARGET, KEY, **params))
    return run


def _classification(fit, scale=False, **params):
    def run(spark, sf):
        train, test, _ = prepared(spark, sf, scale)
        return fit(train, test, "features", "band", LABELS, KEY, **params)
    return run


def _tree(spark, sf):
    train, test, names = prepared(spark, sf)
    return mod.fit_tree_regression(train, "features", TARGET), train, test, names


def _inner(spark, sf):
    """Tree fitted on inner-train rows, with the inner-train, validation and test tables."""
    train, test, _ = prepared(spark, sf)
    cut = spl.mark_first_by_hash(train, KEY, -(-train.count() // 5), seed=43)
    inner, held = cut.where(~F.col("chosen")).drop("chosen"), cut.where("chosen").drop("chosen")
    model = mod.fit_tree_regression(inner, "features", TARGET)
    return model, inner, held, train, test


def _prune_search(spark, sf):
    model, inner, held, _, _ = _inner(spark, sf)
    return pru.prune_search(model, inner, held, "features", TARGET)


def _pruned_tree(spark, sf):
    model, inner, held, train, test = _inner(spark, sf)
    alpha = pru.chosen_alpha(pru.prune_search(model, inner, held, "features", TARGET))
    full = mod.fit_tree_regression(train, "features", TARGET)
    return rounded(pru.pruned_tree(full, alpha, train, test, "features", TARGET, KEY))


def _history(spark, sf):
    train, _, _ = prepared(spark, sf, scale=True)
    return net.mlp_history(spark, net.mlp_fit(train, "features", TARGET, KEY))


def _importance(function):
    def run(spark, sf):
        model, _, _, names = _tree(spark, sf)
        return rounded(function(model, names))
    return run


def _sweep(spark, sf):
    """Six settings compared on validation rows cut from the train set."""
    train, _, _ = prepared(spark, sf, scale=True)
    cut = spl.mark_first_by_hash(train, KEY, -(-train.count() // 5), seed=43)
    return mod.svm_sweep(cut.where(~F.col("chosen")).drop("chosen"), cut.where("chosen").drop("chosen"),
                         "features", "band", LABELS, KEY, n_components=FOURIER, max_iter=SVM_STEPS)


ANOMALY_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice",
                "o_totalprice", "charge"]


def _points(spark, sf):
    lines = fx.lines(spark, sf)
    return spread(lines.select(KEY, F.array(*[F.col(c).cast("double") for c in ANOMALY_COLS])
                               .alias("features")), KEY)


def _iforest(spark, sf):
    points = _points(spark, sf)
    return rounded(ano.iforest_score(points, KEY, "features", ano.iforest_fit(points, KEY, "features")))


def _flagged(spark, sf):
    """Rule-based score: standard units of ``charge`` above its mean."""
    lines = fx.lines(spark, sf)
    stats = lines.agg(F.struct(F.avg("charge").alias("m"), F.stddev_pop("charge").alias("s")).alias("k"))
    scored = lines.withColumn("k", stats.scalar())
    return scored.withColumn("anomaly_score", (F.col("charge") - F.col("k.m")) / F.col("k.s")) \
        .withColumn("is_anomaly", F.col("anomaly_score") > 2).drop("k")


QUERIES = {
    "tree_regression": _regression(mod.tree_regression),
    "tree_nodes": lambda s, d: rounded(mod.tree_nodes(_tree(s, d)[0])),
    "tree_complexity": lambda s, d: mod.tree_complexity(_tree(s, d)[0]),
    "prune_path": lambda s, d: pru.prune_path(_inner(s, d)[0]),
    "prune_search": _prune_search,
    "pruned_tree": _pruned_tree,
    "forest_regression": _regression(mod.forest_regression),
    "boosted_regression": _regression(mod.boosted_regression, rounds=ROUNDS, rate=0.1),
    "mlp_regression": _regression(net.mlp_regression, scale=True, epochs=EPOCHS),
    "mlp_history": _history,
    "feature_importance": _importance(mod.feature_importance),
    "importance_by_column": _importance(mod.importance_by_column),
    "tree_classification": _classification(mod.tree_classification),
    "forest_classification": _classification(mod.forest_classification, trees=TREES, max_depth=FOREST_DEPTH),
    "boosted_multiclass": _classification(mod.boosted_multiclass),
    "svm_linear": _classification(mod.svm_linear, scale=True, max_iter=SVM_STEPS),
    "svm_rbf": _classification(mod.svm_rbf, scale=True, n_components=FOURIER, max_iter=SVM_STEPS),
    "svm_sweep": _sweep,
    "iforest_fit": lambda s, d: ano.iforest_fit(_points(s, d), KEY, "features"),
    "iforest_score": _iforest,
    "anomaly_rate": lambda s, d: rounded(ano.anomaly_rate(_flagged(s, d))),
    "anomaly_drivers": lambda s, d: rounded(ano.anomaly_drivers(_flagged(s, d), "is_anomaly", ANOMALY_COLS, 5)),
    "top_anomalies": lambda s, d: rounded(ano.top_anomalies(
        _flagged(s, d), fx.lines(s, d), KEY, ["charge", "l_extendedprice", "l_quantity"])),
}

_FLAG = """z AS (SELECT *, (charge - (SELECT avg(charge) FROM fx_lines))/(SELECT stddev_pop(charge) FROM fx_lines) AS score FROM fx_lines)"""
_DRIVERS = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, avg({c}) FILTER (WHERE score <= 2) AS a, avg({c}) FILTER (WHERE score > 2) AS b, "
    f"stddev_samp({c}) AS s FROM z" for c in ANOMALY_COLS)

ORACLES = {
    "anomaly_rate": with_views("fx_lines", f"""WITH {_FLAG} SELECT count(*) AS rows, count(*) FILTER (WHERE score <= 2) AS normal,
 count(*) FILTER (WHERE score > 2) AS anomalous, round(100.0*count(*) FILTER (WHERE score > 2)/count(*), 6) AS pct FROM z"""),
    "anomaly_drivers": with_views("fx_lines", f"""WITH {_FLAG}, d AS ({_DRIVERS})
SELECT row_number() OVER (ORDER BY coalesce(abs(b-a)/nullif(s, 0), 0) DESC, variable) AS rank, variable,
 round(coalesce(a, 0), 6) AS normal_mean, round(coalesce(b, 0), 6) AS anomaly_mean, round(coalesce(b-a, 0), 6) AS difference, round(coalesce((b-a)/nullif(a, 0), 0), 6) AS rel_difference,
 round(coalesce(abs(b-a)/nullif(s, 0), 0), 6) AS std_difference FROM d QUALIFY rank <= 5"""),
    "top_anomalies": with_views("fx_lines", f"""WITH {_FLAG} SELECT row_number() OVER (ORDER BY score DESC, line_id) AS rank, line_id,
 round(score, 6) AS anomaly_score, round(charge, 6) AS charge, l_extendedprice, l_quantity FROM z QUALIFY rank <= 20"""),
}
