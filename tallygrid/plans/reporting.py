"""Queries for sources and sinks, evaluation, logged sequences and consolidation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..functions.scale import checkpoint_dir
from ..operators import consolidate as con, evaluate as ev, sequences as seq
from ..sources import csv, identity
from . import fixtures as fx
from .fixtures import BANDS, table, with_views
from .preparing import _imputed

LABELS = list(BANDS)


def scratch(spark, name):
    """A fresh folder next to the checkpoints, which every executor can reach."""
    return f"{checkpoint_dir(spark)}/tallygrid-{name}-{uuid.uuid4().hex}"


def _scan_csv(spark, sf):
    path = scratch(spark, "part")
    part = table(spark, sf, "part")
    part.withColumn("p_type", F.when(F.col("p_size") % 5 == 0, "NA").otherwise(F.col("p_type"))) \
        .write.option("header", True).csv(path)
    return csv.scan_csv(spark, path)


def _scan_csv_literal(spark, sf):
    path = scratch(spark, "literal")
    df = fx.missing(spark, sf).select("line_id", "l_quantity", "discount_code", "returnflag")
    df.withColumn("returnflag", F.coalesce("returnflag", F.lit("None"))) \
        .write.option("header", True).csv(path)
    return csv.scan_csv_literal(spark, path)


def _write_verified(format):
    def run(spark, sf):
        df = _imputed(spark, sf).drop("discount")
        return csv.write_verified(df, scratch(spark, "verified"), format)
    return run


def _texts(spark, sf):
    """Texts with quotes, commas and line breaks."""
    return table(spark, sf, "documents").select("doc_id", "text")


def _scan_csv_text(spark, sf):
    path = scratch(spark, "text")
    csv.write_verified(_texts(spark, sf), path, "csv")
    return csv.scan_csv_literal(spark, path, _texts(spark, sf).schema)


def _file_fingerprint(spark, sf):
    files = identity.file_fingerprint(spark, f"{sf}/*.parquet")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("path"), "length", "sha256")


def _coverage(function):
    def run(spark, sf):
        customers = table(spark, sf, "customer").select(
            F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"))
        orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"))
        return function(customers, orders, "key", "nation")
    return run


def _mean_model(spark, sf):
    """The train mean as prediction for every row."""
    s = fx.split(spark, sf)
    mean = s.where("split = 'train'").agg(F.avg("charge").alias("m")).scalar()
    return s.select("line_id", "split", F.col("charge").alias("actual"), mean.alias("predicted"))


def _majority_model(spark, sf):
    return fx.split(spark, sf).select("line_id", "split", F.col("band").alias("actual"),
                                      F.lit("mid").alias("predicted"))


def _regressors(spark, sf):
    return {"binned": fx.pred_reg(spark, sf), "mean": _mean_model(spark, sf)}


def _reg_test(spark, sf):
    return ev.model_table(_regressors(spark, sf)).where("split = 'test'").drop("split")


def _classifiers(spark, sf):
    return {"price_band": fx.pred_cls(spark, sf), "majority": _majority_model(spark, sf)}


def _cls_test(spark, sf):
    return ev.model_table(_classifiers(spark, sf), LABELS).where("split = 'test'").drop("split")


def _per_class_by_model(spark, sf):
    test = ev.stack_models(_classifiers(spark, sf)).where("split = 'test'")
    return ev.per_class_metrics(test, LABELS, ["model"])


def _test(df):
    return df.where("split = 'test'")


def _collect(spark, sf):
    t = _reg_test(spark, sf)
    first = t.where("model = 'binned'").select(F.col("model").alias("name"), F.col("rmse").alias("rmse_test"),
                                               F.col("mae").alias("mae_test"), F.col("r2").alias("r2_test"))
    second = t.where("model = 'mean'")
    return con.collect_metrics(
        [first, second],
        [{"model": "name", "rmse": "rmse_test", "mae": "mae_test", "r2": "r2_test"},
         {"model": "model", "rmse": "rmse", "mae": "mae", "r2": "r2"}],
        {"binned": "Mean per price bin"})


def _gate(spark, sf):
    measured = ev.metrics_long(_cls_test(spark, sf), ["accuracy", "macro_f1"]).select(
        F.concat("model", F.lit("."), "metric").alias("metric"), F.col("value").alias("measured"))
    expected = spark.createDataFrame(
        [("price_band.accuracy", 0.97), ("price_band.macro_f1", 0.95),
         ("majority.accuracy", 0.50), ("absent.accuracy", 1.0)], "metric string, expected double")
    criteria = _coverage(identity.coverage_check)(spark, sf).select(
        F.lit("every nation covered").alias("rule"), (F.col("status") == "PASS").alias("ok"))
    return con.quality_gate(measured, expected, 0.05, criteria)


GAMMA, SWEEPS = 0.95, 20


def _q(spark, sf):
    return seq.q_iteration(seq.transition_table(fx.steps(spark, sf)), GAMMA, SWEEPS)


QUERIES = {
    "scan_csv": _scan_csv,
    "scan_csv_literal": _scan_csv_literal,
    "normalize_na": lambda s, d: csv.normalize_na(
        table(s, d, "documents").select("doc_id", "source", "lang"), ["source", "lang"], ["web", "en", "NA"]),
    "write_verified": _write_verified("parquet"),
    "write_verified_csv": _write_verified("csv"),
    "scan_csv_text": _scan_csv_text,
    "write_verified_text": lambda s, d: csv.write_verified(_texts(s, d), scratch(s, "text"), "csv"),
    "file_fingerprint": _file_fingerprint,
    "table_fingerprint": lambda s, d: identity.table_fingerprint(table(s, d, "part")),
    "coverage_check": _coverage(identity.coverage_check),
    "coverage_missing": _coverage(identity.coverage_missing),
    "prediction_table": lambda s, d: rounded(ev.prediction_table(fx.pred_reg(s, d), "line_id")),
    "regression_metrics": lambda s, d: rounded(ev.regression_metrics(fx.pred_reg(s, d))),
    "train_test_gap": lambda s, d: rounded(ev.train_test_gap(ev.model_table(_regressors(s, d)))),
    "model_table": lambda s, d: rounded(ev.model_table(_regressors(s, d))),
    "model_delta": lambda s, d: rounded(ev.model_delta(
        _reg_test(s, d), "rmse", [("binned", "mean"), ("mean", "binned")])),
    "model_ranking": lambda s, d: rounded(ev.model_ranking(_reg_test(s, d), "rmse")),
    "model_ranking_classes": lambda s, d: rounded(ev.model_ranking(_cls_test(s, d), "macro_f1", ascending=False)),
    "rmse_pct_range": lambda s, d: rounded(ev.rmse_pct_range(_test(fx.pred_reg(s, d)))),
    "metrics_long": lambda s, d: rounded(ev.metrics_long(_reg_test(s, d), ["mae", "rmse", "r2"])),
    "best_models": lambda s, d: rounded(ev.best_models(
        _cls_test(s, d), {"accuracy": False, "balanced_accuracy": False, "macro_f1": False})),
    "confusion_matrix": lambda s, d: ev.confusion_matrix(_test(fx.pred_cls(s, d)), LABELS),
    "per_class_metrics": lambda s, d: rounded(ev.per_class_metrics(_test(fx.pred_cls(s, d)), LABELS)),
    "classification_metrics": lambda s, d: rounded(ev.classification_metrics(fx.pred_cls(s, d), LABELS)),
    "classification_gap": lambda s, d: rounded(ev.classification_gap(
        ev.classification_metrics(fx.pred_cls(s, d), LABELS))),
    "classification_report": lambda s, d: rounded(ev.classification_report(_test(fx.pred_cls(s, d)), LABELS)),
    "best_model_per_class": lambda s, d: rounded(ev.best_model_per_class(
        _per_class_by_model(s, d), ["majority", "price_band"])),
    "best_config": lambda s, d: rounded(ev.best_config(
        _cls_test(s, d), [("balanced_accuracy", "desc"), ("macro_f1", "desc"), ("model", "asc")])),
    "episode_rollup": lambda s, d: rounded(seq.episode_rollup(fx.steps(s, d))),
    "rolling_mean": lambda s, d: rounded(seq.rolling_mean(
        table(s, d, "events"), "user_id", ["ts", "event_id"], "value"), 9),
    "episode_evaluation": lambda s, d: rounded(seq.episode_evaluation(seq.episode_rollup(fx.steps(s, d)))),
    "transition_table": lambda s, d: rounded(seq.transition_table(fx.steps(s, d)), 9),
    "q_iteration": lambda s, d: rounded(_q(s, d)),
    "greedy_policy": lambda s, d: rounded(seq.greedy_policy(_q(s, d))),
    "collect_metrics": lambda s, d: rounded(_collect(s, d)),
    "quality_gate": _gate,
}

_REG = """WITH p AS (SELECT 'binned' AS model, split, actual, predicted FROM fx_pred_reg
UNION ALL SELECT 'mean', split, charge, (SELECT avg(charge) FROM fx_split WHERE split = 'train') FROM fx_split),
m AS (SELECT model, split, count(*) AS n, avg(abs(actual-predicted)) AS mae, sqrt(avg((actual-predicted)^2)) AS rmse,
 1 - sum((actual-predicted)^2)/sum((actual-mu)^2) AS r2
 FROM (SELECT *, avg(actual) OVER (PARTITION BY model, split) AS mu FROM p) x GROUP BY model, split),
t AS (SELECT * FROM m WHERE split = 'test')"""
_L = "(VALUES ('low'), ('mid'), ('high')) l(label)"
_CLS = f"""WITH p AS (SELECT 'price_band' AS model, split, actual, predicted FROM fx_pred_cls
UNION ALL SELECT 'majority', split, band, 'mid' FROM fx_split),
k AS (SELECT model, split, label, count(*) FILTER (WHERE actual = label) AS support,
 count(*) FILTER (WHERE actual = label AND predicted = label) AS hits, count(*) FILTER (WHERE predicted = label) AS guessed
 FROM p, {_L} GROUP BY model, split, label),
c AS (SELECT *, support-hits AS errors, coalesce(hits/nullif(guessed, 0)::DOUBLE, 0) AS precision,
 coalesce(hits/nullif(support, 0)::DOUBLE, 0) AS recall FROM k),
f AS (SELECT *, coalesce(2*precision*recall/nullif(precision+recall, 0), 0) AS f1 FROM c),
m AS (SELECT model, split, sum(hits)/sum(support)::DOUBLE AS accuracy, avg(recall) FILTER (WHERE support > 0) AS balanced_accuracy,
 avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1, sum(f1*support)/sum(support) AS weighted_f1,
 sum(precision*support)/sum(support) AS wp, sum(recall*support)/sum(support) AS wr, CAST(sum(support) AS BIGINT) AS n
 FROM f GROUP BY model, split)"""
_CM = ("accuracy", "balanced_accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1")
_CMR = ", ".join(f"round({c}, 6) AS {c}" for c in _CM)
_STEPS = "fx_steps"


def _reg(body):
    return with_views("fx_pred_reg", _REG + "\n" + body)


def _cls(body):
    return with_views("fx_pred_cls", _CLS + "\n" + body)


_TRANS = """tr AS (SELECT state, action, next_state, count(*) AS n, avg(reward) AS mr,
 count(*) FILTER (WHERE is_goal)/count(*)::DOUBLE AS ts
 FROM (SELECT *, coalesce(lead(state) OVER (PARTITION BY episode ORDER BY step), 'end') AS next_state FROM fx_steps) x
 GROUP BY 1, 2, 3)"""


def _q_sql(body):
    parts = [_TRANS, "q0 AS (SELECT DISTINCT state, action, 0.0::DOUBLE AS q FROM tr)"]
    for i in range(1, SWEEPS + 1):
        parts.append(f"""q{i} AS MATERIALIZED (SELECT tr.state, tr.action,
 sum(n*(mr + {GAMMA}::DOUBLE*(1-ts)*coalesce(v, 0)))/sum(n) AS q
 FROM tr LEFT JOIN (SELECT state, max(q) AS v FROM q{i-1} GROUP BY state) w ON w.state = tr.next_state
 GROUP BY tr.state, tr.action)""")
    return with_views("fx_steps", "WITH " + ",\n".join(parts) + "\n" + body.format(q=f"q{SWEEPS}"))


_CELLS = ", ".join(f"coalesce(concat(length(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)), 'n')"
                   for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"))

ORACLES = {
    "scan_csv": """SELECT p_partkey, p_name, p_brand, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_type END AS p_type,
 CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part""",
    "scan_csv_literal": with_views("fx_missing", """SELECT line_id, l_quantity, coalesce(discount_code, '') AS discount_code,
 coalesce(returnflag, 'None') AS returnflag FROM fx_missing"""),
    "normalize_na": """SELECT doc_id, CASE WHEN source NOT IN ('web', 'en', 'NA') THEN source END AS source,
 CASE WHEN lang NOT IN ('web', 'en', 'NA') THEN lang END AS lang FROM documents""",
    "write_verified": """SELECT count(*) AS rows_in, count(*) AS rows_out, CAST(6 AS INT) AS cols_in, CAST(6 AS INT) AS cols_out,
 CAST(0 AS BIGINT) AS nulls_out, true AS ok FROM lineitem""",
    "write_verified_csv": """SELECT count(*) AS rows_in, count(*) AS rows_out, CAST(6 AS INT) AS cols_in, CAST(6 AS INT) AS cols_out,
 CAST(0 AS BIGINT) AS nulls_out, true AS ok FROM lineitem""",
    "table_fingerprint": f"""SELECT count(*) AS rows, concat_ws('-', CAST(sum(CAST(concat('0x', substr(d, 1, 14)) AS BIGINT)) AS VARCHAR),
 CAST(sum(CAST(concat('0x', substr(d, 15, 14)) AS BIGINT)) AS VARCHAR)) AS fingerprint
FROM (SELECT sha256(concat_ws(',', {_CELLS})) AS d FROM part) p""",
    "scan_csv_text": "SELECT doc_id, text FROM documents",
    "write_verified_text": """SELECT count(*) AS rows_in, count(*) AS rows_out, CAST(2 AS INT) AS cols_in, CAST(2 AS INT) AS cols_out,
 CAST(0 AS BIGINT) AS nulls_out, true AS ok FROM documents""",
    "coverage_check": """SELECT c_nationkey AS criterion, CASE WHEN count(*) FILTER (WHERE o IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
 count(*) AS required, count(*) FILTER (WHERE o IS NULL) AS missing
FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS o FROM orders) d ON o = c_custkey GROUP BY c_nationkey""",
    "coverage_missing": """SELECT c_nationkey AS criterion, c_custkey AS key FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""",
    "prediction_table": with_views("fx_pred_reg", """SELECT line_id, round(actual, 6) AS actual, round(predicted, 6) AS predicted,
 round(predicted-actual, 6) AS error, round(abs(predicted-actual), 6) AS abs_error FROM fx_pred_reg"""),
    "regression_metrics": _reg("SELECT split, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2 FROM m WHERE model = 'binned'"),
    "train_test_gap": _reg("""SELECT a.model, round(a.rmse, 6) AS rmse_train, round(b.rmse, 6) AS rmse_test, round(b.rmse-a.rmse, 6) AS gap,
 round(b.rmse/a.rmse, 6) AS ratio FROM m a JOIN m b ON a.model = b.model AND a.split = 'train' AND b.split = 'test'"""),
    "model_table": _reg("SELECT model, split, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) + 0 AS r2 FROM m"),
    "model_delta": _reg("""SELECT concat(a.model, '_vs_', b.model) AS comparison, round(a.rmse-b.rmse, 6) AS delta,
 round(100*(a.rmse-b.rmse)/b.rmse, 6) AS delta_pct FROM t a JOIN t b ON a.model <> b.model"""),
    "model_ranking": _reg("SELECT row_number() OVER (ORDER BY rmse, model) AS rank, model, round(rmse, 6) AS rmse FROM t"),
    "model_ranking_classes": _cls("""SELECT row_number() OVER (ORDER BY macro_f1 DESC, model) AS rank, model,
 round(macro_f1, 6) AS macro_f1 FROM m WHERE split = 'test'"""),
    "rmse_pct_range": with_views("fx_pred_reg", """SELECT round(sqrt(avg((actual-predicted)^2)), 6) AS rmse,
 round(max(actual)-min(actual), 6) AS target_range,
 round(100*sqrt(avg((actual-predicted)^2))/(max(actual)-min(actual)), 6) AS rmse_pct_range FROM fx_pred_reg WHERE split = 'test'"""),
    "metrics_long": _reg("""SELECT model, 'mae' AS metric, round(mae, 6) AS value FROM t UNION ALL
SELECT model, 'rmse', round(rmse, 6) FROM t UNION ALL SELECT model, 'r2', round(r2, 6) FROM t"""),
    "best_models": _cls("""SELECT metric, a AS winner, round(va, 6) AS winner_value, b AS runner_up, round(vb, 6) AS runner_up_value,
 round(va-vb, 6) AS delta, round(100*(va-vb)/vb, 6) AS delta_pct
FROM (SELECT metric, max(model) FILTER (WHERE k = 1) AS a, max(v) FILTER (WHERE k = 1) AS va,
 max(model) FILTER (WHERE k = 2) AS b, max(v) FILTER (WHERE k = 2) AS vb
 FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY v DESC, model) AS k FROM (
  SELECT 'accuracy' AS metric, model, accuracy AS v FROM m WHERE split = 'test' UNION ALL
  SELECT 'balanced_accuracy', model, balanced_accuracy FROM m WHERE split = 'test' UNION ALL
  SELECT 'macro_f1', model, macro_f1 FROM m WHERE split = 'test') u) r GROUP BY metric) z"""),
    "confusion_matrix": with_views("fx_pred_cls", """SELECT actual, count(*) FILTER (WHERE predicted = 'low') AS low,
 count(*) FILTER (WHERE predicted = 'mid') AS mid, count(*) FILTER (WHERE predicted = 'high') AS high
FROM fx_pred_cls WHERE split = 'test' GROUP BY actual"""),
    "per_class_metrics": _cls("""SELECT label, support, hits, errors, round(precision, 6) AS precision, round(recall, 6) AS recall,
 round(f1, 6) AS f1 FROM f WHERE model = 'price_band' AND split = 'test'"""),
    "classification_metrics": _cls(f"SELECT split, {_CMR} FROM m WHERE model = 'price_band'"),
    "classification_gap": _cls("""SELECT round(a.accuracy-b.accuracy, 6) AS gap_accuracy,
 round(a.balanced_accuracy-b.balanced_accuracy, 6) AS gap_balanced_accuracy, round(a.macro_f1-b.macro_f1, 6) AS gap_macro_f1
FROM m a JOIN m b ON a.model = 'price_band' AND b.model = 'price_band' AND a.split = 'train' AND b.split = 'test'"""),
    "classification_report": _cls("""SELECT label AS row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
FROM f WHERE model = 'price_band' AND split = 'test'
UNION ALL SELECT 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), n FROM m WHERE model = 'price_band' AND split = 'test'
UNION ALL SELECT 'macro avg', round(macro_precision, 6), round(macro_recall, 6), round(macro_f1, 6), n FROM m WHERE model = 'price_band' AND split = 'test'
UNION ALL SELECT 'weighted avg', round(wp, 6), round(wr, 6), round(weighted_f1, 6), n FROM m WHERE model = 'price_band' AND split = 'test'"""),
    "best_model_per_class": _cls("""SELECT label, model, round(recall, 6) AS recall FROM f WHERE split = 'test'
QUALIFY row_number() OVER (PARTITION BY label ORDER BY recall DESC, CASE model WHEN 'majority' THEN 1 ELSE 2 END) = 1"""),
    "best_config": _cls(f"SELECT model, {_CMR} FROM m WHERE split = 'test' ORDER BY m.balanced_accuracy DESC, m.macro_f1 DESC, model LIMIT 1"),
    "episode_rollup": with_views(_STEPS, """SELECT episode, round(sum(reward), 6) AS total_reward, count(*) AS steps,
 bool_or(is_goal) AS reached_goal FROM fx_steps GROUP BY episode"""),
    "rolling_mean": """SELECT event_id, round(value, 9) AS value, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
 ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 9) AS rolling_mean FROM events""",
    "episode_evaluation": with_views(_STEPS, """WITH e AS (SELECT sum(reward) AS r, count(*) AS n, bool_or(is_goal) AS g FROM fx_steps GROUP BY episode)
SELECT count(*) AS episodes, round(count(*) FILTER (WHERE g)/count(*)::DOUBLE, 6) AS success_rate,
 round(avg(n) FILTER (WHERE g), 6) AS mean_steps_success, round(avg(r), 6) AS mean_reward FROM e"""),
    "transition_table": with_views(_STEPS, f"""WITH {_TRANS} SELECT state, action, next_state, n AS count,
 round(mr, 9) AS mean_reward, round(ts, 9) AS terminal_share FROM tr"""),
    "q_iteration": _q_sql("SELECT state, action, round(q, 6) AS q FROM {q}"),
    "greedy_policy": _q_sql("""SELECT state, action, round(q, 6) AS q FROM {q}
QUALIFY row_number() OVER (PARTITION BY state ORDER BY q DESC, action) = 1"""),
    "collect_metrics": _reg("""SELECT row_number() OVER (ORDER BY rmse, name) AS rank, name AS model, round(rmse, 6) AS rmse,
 round(mae, 6) AS mae, round(r2, 6) AS r2 FROM (SELECT *, CASE model WHEN 'binned' THEN 'Mean per price bin' ELSE model END AS name FROM t) x"""),
    "quality_gate": _cls("""SELECT rule, CASE WHEN bool_and(ok) THEN 'PASS' ELSE 'FAIL' END AS status FROM (
SELECT 'price_band.accuracy' AS rule, abs(accuracy-0.97) <= 0.05 AS ok FROM m WHERE model = 'price_band' AND split = 'test'
UNION ALL SELECT 'price_band.macro_f1', abs(macro_f1-0.95) <= 0.05 FROM m WHERE model = 'price_band' AND split = 'test'
UNION ALL SELECT 'majority.accuracy', abs(accuracy-0.5) <= 0.05 FROM m WHERE model = 'majority' AND split = 'test'
UNION ALL SELECT 'absent.accuracy', false
UNION ALL SELECT 'every nation covered', c_custkey IN (SELECT o_custkey FROM orders) FROM customer) x GROUP BY rule"""),
}
