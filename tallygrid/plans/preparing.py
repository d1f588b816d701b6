"""Queries for missing values, feature preparation, splits and class balance."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..functions.scale import settle
from ..operators import features as feat, missing as mis, splits as spl
from ..operators.missing import FillRule
from ..operators.profile import missing_summary
from . import fixtures as fx
from .fixtures import BANDS, table, with_views
from .profiling import MISSING_TYPES

RULES = [
    FillRule("price", "median", "missing at random"),
    FillRule("returnflag", "mode", "missing at random"),
    FillRule("tax", "zero", "structural"),
    FillRule("discount_code", "evidence", "structural", evidence="discount"),
]


def _imputed(spark, sf):
    df = fx.missing(spark, sf)
    return mis.impute_apply(df, mis.impute_plan(df, RULES))


def _imputed_integer(spark, sf):
    """Whole numbers with nulls, filled by a median that can be a half."""
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 7 != 0, F.col("l_suppkey")).alias("supplier"))
    return rounded(mis.impute_apply(df, mis.impute_plan(df, [mis.FillRule("supplier", "median", "missing at random")])))


def _consistency(spark, sf):
    df = fx.missing(spark, sf)
    amounts = F.coalesce("discount", F.lit(0.0)) + F.coalesce("tax", F.lit(0.0))
    return mis.consistency_rules(df, [
        ("code absent implies discount 0", F.col("discount_code").isNull(), F.col("discount") == 0),
        ("code absent implies amounts 0", F.col("discount_code").isNull(), amounts == 0),
        ("tax present implies price present", F.col("tax").isNotNull(), F.col("price").isNotNull()),
    ])


def _before_after(spark, sf):
    df = fx.missing(spark, sf)
    plan = mis.impute_plan(df, RULES)
    after = mis.impute_apply(df, plan)
    return missing_summary(df), missing_summary(after, only_missing=False), plan


def _train(spark, sf, source):
    """Rows of a fixture with their set from ``fx_split``."""
    return spl.split_apply(source, fx.split(spark, sf), "line_id")


def _median_on_split(spark, sf):
    rows = settle(_train(spark, sf, fx.missing(spark, sf).select("line_id", "price", "discount")))
    done = feat.fit_median_impute(rows.where("split = 'train'"), rows, ["price", "discount"])
    return done.where("split = 'test'").select("line_id", "price", "discount")


def _scaled(spark, sf):
    rows = _train(spark, sf, fx.lines(spark, sf).select("line_id", "l_quantity", "o_totalprice"))
    return rows.where("split = 'train'"), rows.where("split = 'test'").drop("split")


def _standard_scale(spark, sf):
    train, test = _scaled(spark, sf)
    return feat.standard_scale(train, test, ["l_quantity", "o_totalprice"])


def _inverse_scale(spark, sf):
    train, test = _scaled(spark, sf)
    cols = ["l_quantity", "o_totalprice"]
    return feat.inverse_scale(feat.standard_scale(train, test, cols), train, cols)


def _target_scale(spark, sf):
    rows = fx.split(spark, sf)
    return feat.target_scale(rows.where("split = 'train'"), rows.where("split = 'test'"), "charge", "line_id")


def _one_hot(spark, sf):
    o = table(spark, sf, "orders")
    train = o.where("o_orderpriority <> '5-LOW'")
    return feat.one_hot(train, o, ["o_orderpriority", "o_orderstatus"], "o_orderkey")


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice", "o_totalprice"]
CATEGORICAL = ["l_returnflag", "o_orderpriority", "fee_kind"]


def _feature_vectors(spark, sf):
    """Vector size and sum per row of the fitted preparation."""
    rows = settle(_train(spark, sf, fx.lines(spark, sf).select("line_id", *NUMERIC, *CATEGORICAL)))
    model = feat.feature_pipeline(rows.where("split = 'train'"), NUMERIC, CATEGORICAL, scale=True)
    values = vector_to_array("features")
    return feat.feature_vectors(model, rows, ["line_id"]).select(
        "line_id", F.size(values).alias("n_features"),
        F.aggregate(F.slice(values, len(NUMERIC) + 1, F.size(values)), F.lit(0.0), lambda a, v: a + v)
        .alias("active_categories"))


def _split_nested(spark, sf):
    first = spl.split_random(table(spark, sf, "orders"), "o_orderkey")
    return spl.split_nested(first, "o_orderkey", seed=43)


def _split_persist(spark, sf):
    s = fx.split(spark, sf)
    return spl.split_persist(s.where("split = 'train'"), s.where("split = 'test'"), "line_id", "band")


def _split_apply(spark, sf):
    rows = spl.split_apply(fx.lines(spark, sf), fx.split(spark, sf), "line_id")
    return rows.select("line_id", "split", "p_type", "l_quantity")


def _label_encode(spark, sf):
    return feat.label_encode(fx.split(spark, sf).select("line_id", "band"), "band", list(BANDS))


QUERIES = {
    "co_missing": lambda s, d: rounded(mis.co_missing(fx.missing(s, d), "discount_code", "discount")),
    "evidence_fill": lambda s, d: rounded(mis.evidence_fill(fx.missing(s, d), "discount_code", "discount")),
    "impute_plan": lambda s, d: rounded(mis.impute_plan(fx.missing(s, d), RULES)),
    "impute_median": lambda s, d: rounded(mis.impute_median(fx.missing(s, d), ["price", "discount"])),
    "impute_mode": lambda s, d: mis.impute_mode(fx.missing(s, d), ["returnflag", "discount_code"]),
    "impute_constant": lambda s, d: mis.impute_constant(
        fx.missing(s, d), {"tax": 0.0, "discount_code": "None", "returnflag": "Unknown"}),
    "impute_apply": lambda s, d: rounded(_imputed(s, d)),
    "impute_apply_integer": _imputed_integer,
    "consistency_rules": _consistency,
    "missing_before_after": lambda s, d: mis.missing_before_after(*_before_after(s, d)),
    "imputation_tally": lambda s, d: mis.imputation_tally(*_before_after(s, d)),
    "no_missing_gate": lambda s, d: mis.no_missing_gate(_imputed(s, d)),
    "finite_gate": lambda s, d: mis.finite_gate(
        fx.lines(s, d), ["l_quantity", "l_extendedprice", "disc_price", "rebate", "charge"]),
    "finite_gate_missing": lambda s, d: mis.finite_gate(fx.missing(s, d), ["price", "discount", "tax"]),
    "band_target": lambda s, d: feat.band_target(
        fx.lines(s, d).select("line_id", "charge"), "charge", [10000, 100000], list(BANDS), "band")
        .select("line_id", "band"),
    "feature_catalog": lambda s, d: feat.feature_catalog(
        fx.lines(s, d), ["line_id"], "charge", ["disc_price"]),
    "fit_median_impute": lambda s, d: rounded(_median_on_split(s, d)),
    "fit_constant_impute": lambda s, d: feat.fit_constant_impute(
        fx.missing(s, d).select("line_id", "discount_code", "returnflag"), ["discount_code", "returnflag"]),
    "one_hot": _one_hot,
    "standard_scale": lambda s, d: rounded(_standard_scale(s, d)),
    "inverse_scale": lambda s, d: rounded(_inverse_scale(s, d)),
    "target_scale": lambda s, d: rounded(_target_scale(s, d)),
    "label_encode": _label_encode,
    "feature_vectors": _feature_vectors,
    "feature_pipeline": _feature_vectors,
    "split_random": lambda s, d: spl.split_random(table(s, d, "orders"), "o_orderkey"),
    "split_nested": _split_nested,
    "split_tail": lambda s, d: spl.split_tail(table(s, d, "orders"), "o_orderkey"),
    "split_stratified": lambda s, d: spl.split_stratified(fx.split(s, d), "line_id", "band"),
    "split_persist": _split_persist,
    "split_apply": _split_apply,
    "split_integrity": lambda s, d: spl.split_integrity(
        fx.split(s, d), "line_id", {"train": 48000, "test": 12000}),
    "split_distribution": lambda s, d: rounded(spl.split_distribution(fx.split(s, d), "band")),
    "stratification_check": lambda s, d: rounded(spl.stratification_check(fx.split(s, d), "band")),
    "class_balance": lambda s, d: rounded(spl.class_balance(fx.split(s, d), "band", ["low", "mid"])),
    "imbalance_ratio": lambda s, d: rounded(spl.imbalance_ratio(fx.split(s, d), "band")),
}

_ZERO_RATIO = """(SELECT coalesce(CAST(count(*) FILTER (WHERE discount_code IS NULL AND discount = 0) AS DOUBLE)
 / nullif(count(*) FILTER (WHERE discount_code IS NULL AND discount >= 0), 0), 0) FROM fx_missing)"""
_MISSING_UNION = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, '{'categorical' if t == 'string' else 'numeric'}' AS kind, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
    f"round(100.0*count(*) FILTER (WHERE {c} IS NULL)/count(*), 6) AS missing_pct FROM fx_missing"
    for c, t in MISSING_TYPES.items())
_PLAN = f"""SELECT variable, kind, missing_count, missing_pct,
 CASE variable WHEN 'price' THEN 'missing at random' WHEN 'returnflag' THEN 'missing at random'
  WHEN 'tax' THEN 'structural' WHEN 'discount_code' THEN 'structural' ELSE 'to review' END AS missing_type,
 CASE variable WHEN 'price' THEN 'median' WHEN 'returnflag' THEN 'mode' WHEN 'tax' THEN 'zero'
  WHEN 'discount_code' THEN CASE WHEN {_ZERO_RATIO} >= 0.9 THEN 'none' ELSE 'unknown' END
  ELSE 'review' END AS strategy,
 CASE variable WHEN 'price' THEN (SELECT CAST(quantile_cont(price, 0.5) AS VARCHAR) FROM fx_missing)
  WHEN 'returnflag' THEN (SELECT returnflag FROM fx_missing WHERE returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
  WHEN 'tax' THEN '0'
  WHEN 'discount_code' THEN CASE WHEN {_ZERO_RATIO} >= 0.9 THEN 'None' ELSE 'Unknown' END END AS fill_value
FROM ({_MISSING_UNION}) m WHERE missing_count > 0"""
_AFTER = "CASE WHEN fill_value IS NULL THEN missing_count ELSE 0 END"


def _mode(col):
    return (f"(SELECT {col} FROM fx_missing WHERE {col} IS NOT NULL GROUP BY 1 "
            f"ORDER BY count(*) DESC, 1 LIMIT 1)")


def _scaled_sql(view, cols, formula):
    parts = ", ".join(f"round({formula.format(c=c)}, 6) AS {c}" for c in cols)
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    return f"""WITH r AS (SELECT f.line_id, s.split, {', '.join('f.' + c for c in cols)}
 FROM {view} f JOIN fx_split s ON f.line_id = s.line_id),
k AS (SELECT {stats} FROM r WHERE split = 'train')
SELECT line_id, {parts} FROM r, k WHERE split = 'test'"""


def _order_split(n_expr="0.2*count(*) OVER ()", seed=42, source="orders", where=""):
    return f"""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5(concat('{seed}|', CAST(o_orderkey AS VARCHAR))),
 CAST(o_orderkey AS VARCHAR)) <= ceil({n_expr}) THEN 'test' ELSE 'train' END AS split FROM {source} {where}"""


_STRATIFIED = """WITH c AS (SELECT band, count(*) AS n, sum(count(*)) OVER () AS total FROM fx_split GROUP BY band),
q AS (SELECT band, CAST(floor(t*n/total) AS BIGINT) AS base, (t*n) % total AS rest, t
 FROM (SELECT *, CAST(ceil(0.2*total) AS BIGINT) AS t FROM c) x),
quota AS (SELECT band, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, band)
 <= any_value(t) OVER () - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM q)
SELECT s.line_id, s.band, CASE WHEN row_number() OVER (PARTITION BY s.band
 ORDER BY md5(concat('42|', s.line_id)), s.line_id) <= quota THEN 'test' ELSE 'train' END AS split
FROM fx_split s JOIN quota USING (band)"""

ORACLES = {
    "co_missing": with_views("fx_missing", """SELECT count(*) FILTER (WHERE discount_code IS NULL) AS missing_a,
 round(100.0*count(*) FILTER (WHERE discount_code IS NULL)/count(*), 6) AS missing_a_pct,
 count(*) FILTER (WHERE discount IS NULL) AS missing_b,
 count(*) FILTER (WHERE discount_code IS NULL AND discount = 0) AS a_missing_b_zero,
 count(*) FILTER (WHERE discount_code IS NULL AND discount > 0) AS a_missing_b_positive FROM fx_missing"""),
    "evidence_fill": with_views("fx_missing", f"""SELECT round({_ZERO_RATIO}, 6) AS zero_ratio,
 CASE WHEN {_ZERO_RATIO} >= 0.9 THEN 'None' ELSE 'Unknown' END AS fill_value"""),
    "impute_plan": with_views("fx_missing", _PLAN),
    "impute_median": with_views("fx_missing", """SELECT line_id, l_quantity,
 round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM fx_missing)), 6) AS price,
 round(coalesce(discount, (SELECT quantile_cont(discount, 0.5) FROM fx_missing)), 6) AS discount,
 discount_code, returnflag, tax FROM fx_missing"""),
    "impute_mode": with_views("fx_missing", f"""SELECT line_id, l_quantity, price, discount, tax,
 coalesce(discount_code, {_mode('discount_code')}) AS discount_code,
 coalesce(returnflag, {_mode('returnflag')}) AS returnflag FROM fx_missing"""),
    "impute_constant": with_views("fx_missing", """SELECT line_id, l_quantity, price, discount, coalesce(tax, 0) AS tax,
 coalesce(discount_code, 'None') AS discount_code, coalesce(returnflag, 'Unknown') AS returnflag FROM fx_missing"""),
    "impute_apply": with_views("fx_missing", f"""SELECT line_id, l_quantity,
 round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM fx_missing)), 6) AS price,
 round(discount, 6) AS discount,
 coalesce(discount_code, CASE WHEN {_ZERO_RATIO} >= 0.9 THEN 'None' ELSE 'Unknown' END) AS discount_code,
 coalesce(returnflag, {_mode('returnflag')}) AS returnflag, coalesce(tax, 0) AS tax FROM fx_missing"""),
    "impute_apply_integer": """WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 <> 0 THEN l_suppkey END AS supplier FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(coalesce(supplier, (SELECT quantile_cont(supplier, 0.5) FROM r)) AS DOUBLE) AS supplier FROM r""",
    "consistency_rules": with_views("fx_missing", """WITH r AS (
SELECT 'code absent implies discount 0' AS rule, discount_code IS NULL AS p, coalesce(discount = 0, false) AS q FROM fx_missing
UNION ALL SELECT 'code absent implies amounts 0', discount_code IS NULL, coalesce(discount, 0) + coalesce(tax, 0) = 0 FROM fx_missing
UNION ALL SELECT 'tax present implies price present', tax IS NOT NULL, price IS NOT NULL FROM fx_missing)
SELECT rule, count(*) FILTER (WHERE p) AS cases, count(*) FILTER (WHERE p AND q) AS consistent,
 count(*) FILTER (WHERE p AND NOT q) AS inconsistent FROM r GROUP BY rule"""),
    "missing_before_after": with_views("fx_missing", f"""SELECT variable, missing_count AS missing_before,
 {_AFTER} AS missing_after, strategy, fill_value FROM ({_PLAN}) p"""),
    "imputation_tally": with_views("fx_missing", f"""WITH p AS ({_PLAN})
SELECT strategy, CAST(sum(missing_count - {_AFTER}) AS BIGINT) AS cells FROM p GROUP BY strategy
UNION ALL SELECT 'total before', CAST(sum(missing_count) AS BIGINT) FROM p
UNION ALL SELECT 'total after', CAST(sum({_AFTER}) AS BIGINT) FROM p"""),
    "no_missing_gate": with_views("fx_missing", f"""SELECT variable, {_AFTER} AS missing_count FROM ({_PLAN}) p
WHERE {_AFTER} > 0"""),
    "finite_gate": with_views("fx_lines", " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
        f"count(*) FILTER (WHERE isnan({c})) AS nans, count(*) FILTER (WHERE isinf({c})) AS infs FROM fx_lines"
        for c in ("l_quantity", "l_extendedprice", "disc_price", "rebate", "charge"))),
    "finite_gate_missing": with_views("fx_missing", " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
        f"count(*) FILTER (WHERE isnan({c})) AS nans, count(*) FILTER (WHERE isinf({c})) AS infs FROM fx_missing"
        for c in ("price", "discount", "tax"))),
    "band_target": with_views("fx_split", "SELECT line_id, band FROM fx_split"),
    "feature_catalog": with_views("fx_lines", " UNION ALL ".join(
        f"SELECT '{c}' AS feature, '{t}' AS dtype, '{'categorical' if t == 'string' else 'numeric'}' AS kind, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
        f"'{'constant + one-hot' if t == 'string' else 'median'}' AS preparation, "
        f"{str(c in ('line_id', 'charge', 'disc_price')).lower()} AS forbidden FROM fx_lines"
        for c, t in {"line_id": "string", "l_quantity": "double", "l_extendedprice": "double",
                     "l_discount": "double", "l_tax": "double", "p_size": "int", "p_retailprice": "double",
                     "o_totalprice": "double", "l_returnflag": "string", "p_type": "string",
                     "o_orderpriority": "string", "disc_price": "double", "rebate": "double",
                     "fee_kind": "string", "charge": "double"}.items())),
    "fit_median_impute": with_views("fx_missing fx_split", """WITH r AS (SELECT m.line_id, m.price, m.discount, s.split
 FROM fx_missing m JOIN fx_split s ON m.line_id = s.line_id),
k AS (SELECT quantile_cont(price, 0.5) AS p, quantile_cont(discount, 0.5) AS d FROM r WHERE split = 'train')
SELECT line_id, round(coalesce(price, p), 6) AS price, round(coalesce(discount, d), 6) AS discount
FROM r, k WHERE split = 'test'"""),
    "fit_constant_impute": with_views("fx_missing", """SELECT line_id, coalesce(discount_code, 'None') AS discount_code,
 coalesce(returnflag, 'None') AS returnflag FROM fx_missing"""),
    "one_hot": """WITH c AS (SELECT DISTINCT 'o_orderpriority' AS col, o_orderpriority AS v FROM orders WHERE o_orderpriority <> '5-LOW'
UNION ALL SELECT DISTINCT 'o_orderstatus', o_orderstatus FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT o_orderkey, concat(col, '_', v) AS feature, 1 AS value FROM orders, c
WHERE CASE col WHEN 'o_orderpriority' THEN o_orderpriority = v ELSE o_orderstatus = v END""",
    "standard_scale": with_views("fx_split", _scaled_sql("fx_lines", ["l_quantity", "o_totalprice"], "({c} - m_{c})/s_{c}")),
    "inverse_scale": with_views("fx_split", _scaled_sql("fx_lines", ["l_quantity", "o_totalprice"], "{c}")),
    "target_scale": with_views("fx_split", """WITH k AS (SELECT avg(charge) AS m, stddev_pop(charge) AS s FROM fx_split WHERE split = 'train')
SELECT line_id, round((charge - m)/s, 6) AS scaled, round(charge, 6) AS restored FROM fx_split, k WHERE split = 'test'"""),
    "label_encode": with_views("fx_split", """SELECT line_id, band,
 CASE band WHEN 'low' THEN 0 WHEN 'mid' THEN 1 ELSE 2 END AS label_id FROM fx_split"""),
    "feature_vectors": with_views("fx_split", f"""WITH r AS (SELECT f.*, s.split FROM fx_lines f JOIN fx_split s ON f.line_id = s.line_id),
k AS (SELECT count(DISTINCT l_returnflag) + count(DISTINCT o_orderpriority) + count(DISTINCT fee_kind) + {len(NUMERIC)} AS n
 FROM r WHERE split = 'train')
SELECT line_id, CAST(n AS INT) AS n_features, 3.0::DOUBLE AS active_categories FROM r, k"""),
    "split_random": _order_split(),
    "split_nested": f"""WITH a AS ({_order_split()}), t AS (SELECT o_orderkey FROM a WHERE split = 'train'),
b AS ({_order_split(seed=43, source='t')})
SELECT o_orderkey, CASE split WHEN 'test' THEN 'validation' ELSE 'train' END AS split FROM b
UNION ALL SELECT o_orderkey, split FROM a WHERE split = 'test'""",
    "split_tail": """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey)
 > floor(count(*) OVER ()*(1-0.15::DOUBLE)) THEN 'validation' ELSE 'train' END AS split FROM orders""",
    "split_stratified": with_views("fx_split", _STRATIFIED),
    "split_persist": with_views("fx_split", "SELECT line_id, split, band FROM fx_split"),
    "split_apply": with_views("fx_split", """SELECT f.line_id, s.split, f.p_type, f.l_quantity
FROM fx_lines f JOIN fx_split s ON f.line_id = s.line_id"""),
    "split_integrity": with_views("fx_split", """WITH k AS (SELECT line_id, count(*) AS n, min(split) <> max(split) AS both_sets FROM fx_split GROUP BY 1)
SELECT 'duplicate_keys' AS "check", count(*) FILTER (WHERE n > 1) AS value, count(*) FILTER (WHERE n > 1) = 0 AS ok FROM k
UNION ALL SELECT 'shared_keys', count(*) FILTER (WHERE both_sets), count(*) FILTER (WHERE both_sets) = 0 FROM k
UNION ALL SELECT 'train_rows', count(*) FILTER (WHERE split = 'train'), count(*) FILTER (WHERE split = 'train') = 48000 FROM fx_split
UNION ALL SELECT 'test_rows', count(*) FILTER (WHERE split = 'test'), count(*) FILTER (WHERE split = 'test') = 12000 FROM fx_split"""),
    "split_distribution": with_views("fx_split", """SELECT g.split, g.band, count(s.line_id) AS count,
 round(100.0*count(s.line_id)/sum(count(s.line_id)) OVER (PARTITION BY g.split), 6) AS pct
FROM (SELECT * FROM (VALUES ('train'), ('test')) a(split), (SELECT DISTINCT band FROM fx_split) b) g
LEFT JOIN fx_split s ON s.split = g.split AND s.band = g.band GROUP BY g.split, g.band"""),
    "stratification_check": with_views("fx_split", """WITH p AS (SELECT band, 100.0*count(*)/(SELECT count(*) FROM fx_split) AS t,
 100.0*count(*) FILTER (WHERE split = 'train')/(SELECT count(*) FROM fx_split WHERE split = 'train') AS a,
 100.0*count(*) FILTER (WHERE split = 'test')/(SELECT count(*) FROM fx_split WHERE split = 'test') AS b FROM fx_split GROUP BY band)
SELECT band, round(t, 6) AS pct_total, round(a, 6) AS pct_train, round(b, 6) AS pct_test,
 round(a-t, 6) AS diff_train, round(b-t, 6) AS diff_test FROM p"""),
    "class_balance": with_views("fx_split", """SELECT l.label, count(*) FILTER (WHERE band = l.label) AS count,
 round(100.0*count(*) FILTER (WHERE band = l.label)/count(*), 6) AS pct, count(*) FILTER (WHERE band IS NULL) AS missing,
 count(*) FILTER (WHERE band NOT IN ('low', 'mid')) AS invalid
FROM fx_split, (VALUES ('low'), ('mid')) l(label) GROUP BY l.label"""),
    "imbalance_ratio": with_views("fx_split", """WITH c AS (SELECT band, count(*) AS n FROM fx_split GROUP BY band)
SELECT a.band AS majority, a.n AS majority_count, b.band AS minority, b.n AS minority_count, round(a.n/b.n::DOUBLE, 6) AS ratio
FROM (SELECT * FROM c ORDER BY n DESC, band LIMIT 1) a, (SELECT * FROM c ORDER BY n, band LIMIT 1) b"""),
}
ORACLES["feature_pipeline"] = ORACLES["feature_vectors"]
