"""Queries for structural, numeric and categorical profiling and correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import categorical as cat, correlation as cor, profile as prof
from . import fixtures as fx
from .fixtures import table, with_views

LINEITEM_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax"]
LINES_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice",
             "o_totalprice", "disc_price", "rebate", "charge"]
LINES_CAT = ["l_returnflag", "p_type", "o_orderpriority", "fee_kind"]
SKEW_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "rebate", "charge"]


# Means of two-decimal amounts over 3 * 2^a * 5^b rows can end exactly on half of
# the sixth digit; seven digits keep both engines away from such ties.
MEAN_DIGITS = 7


def long_sql(view: str, cols: list[str], type_: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST({c} AS {type_}) AS value FROM {view}" for c in cols)


def profile_sql(view: str, cols: list[str]) -> str:
    return f"""
SELECT variable, count(value) AS count, count(*)-count(value) AS missing_count,
       100.0*(count(*)-count(value))/count(*) AS missing_pct, min(value) AS min,
       quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, avg(value) AS mean,
       quantile_cont(value, 0.75) AS q3, max(value) AS max, stddev_samp(value) AS std,
       quantile_cont(value, 0.75)-quantile_cont(value, 0.25) AS iqr, skewness(value) AS skewness,
       count(*) FILTER (WHERE value = 0) AS zero_count,
       100.0*count(*) FILTER (WHERE value = 0)/count(*) AS zero_pct
FROM ({long_sql(view, cols, 'DOUBLE')}) u GROUP BY variable"""


def counts_sql(view: str, cols: list[str], type_: str = "VARCHAR") -> str:
    return f"""SELECT variable, value, count(*) AS n FROM ({long_sql(view, cols, type_)}) u
GROUP BY variable, value"""


def summary_sql(view: str, cols: list[str]) -> str:
    return f"""
SELECT c.variable, count(value) AS n_categories, count(*) AS n_categories_with_missing,
       CAST(coalesce(sum(n) FILTER (WHERE value IS NULL), 0) AS BIGINT) AS missing_count,
       100.0*coalesce(sum(n) FILTER (WHERE value IS NULL), 0)/sum(n) AS missing_pct,
       max(value) FILTER (WHERE top = 1) AS top_value, max(n) FILTER (WHERE top = 1) AS top_count,
       100.0*max(n) FILTER (WHERE top = 1)/sum(n) AS top_pct,
       max(value) FILTER (WHERE bottom = 1) AS bottom_value,
       max(n) FILTER (WHERE bottom = 1) AS bottom_count,
       100.0*max(n) FILTER (WHERE bottom = 1)/sum(n) AS bottom_pct
FROM (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY (value IS NULL), n DESC, value) AS top,
             row_number() OVER (PARTITION BY variable ORDER BY (value IS NULL), n, value) AS bottom
      FROM ({counts_sql(view, cols)}) k) c GROUP BY c.variable"""


def freq_sql(view: str, cols: list[str]) -> str:
    return f"""
SELECT variable, coalesce(value, '<NA>') AS category, n AS count,
       100.0*n/sum(n) OVER (PARTITION BY variable) AS pct, value IS NULL AS is_missing
FROM ({counts_sql(view, cols)}) k"""


def pairs_sql(view: str, pairs: list[tuple[str, str]]) -> str:
    def one(a, b):
        return (f"SELECT '{a}' AS v1, '{b}' AS v2, (SELECT CASE WHEN isnan(r) THEN NULL ELSE r END "
                f"FROM (SELECT corr({a}, {b}) AS r FROM {view}) x) AS r")
    return " UNION ALL ".join(one(a, b) for a, b in pairs)


MISSING_NUM = ["l_quantity", "price", "discount", "tax"]
MISSING_ALL = ["line_id", "l_quantity", "price", "discount", "discount_code", "returnflag", "tax"]
CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice",
             "o_totalprice", "disc_price", "rebate"]


def _profile(spark, sf):
    return prof.numeric_profile(fx.lines(spark, sf), LINES_NUM)


def _reference(spark, sf):
    s = prof.target_summary(table(spark, sf, "orders"), "o_totalprice")
    measured = s.select("count", "mean", "median", "std").select(
        F.col("count").cast("double").alias("count"), "mean", "median", "std").unpivot(
        [], ["count", "mean", "median", "std"], "metric", "measured")
    expected = spark.createDataFrame(
        [("count", 15000.0), ("mean", 250000.0), ("median", 251000.0), ("std", 144000.0)],
        "metric string, expected double")
    return prof.reference_compare(measured, expected, 2000.0)


QUERIES = {
    "shape_summary": lambda s, d: prof.shape_summary(table(s, d, "lineitem"), "l_extendedprice", 60000),
    "column_overview": lambda s, d: prof.column_overview(table(s, d, "lineitem")),
    "duplicate_rows": lambda s, d: prof.duplicate_rows(table(s, d, "documents"), ["text"]),
    "duplicate_rows_orders": lambda s, d: prof.duplicate_rows(
        table(s, d, "orders"), ["o_orderstatus", "o_orderpriority"]),
    "preview_rows": lambda s, d: prof.preview_rows(table(s, d, "orders"), "o_orderkey"),
    "missing_summary": lambda s, d: rounded(prof.missing_summary(fx.missing(s, d))),
    "cardinality_summary": lambda s, d: prof.cardinality_summary(
        table(s, d, "orders"), ["o_orderstatus", "o_orderpriority"]),
    "cardinality_summary_part": lambda s, d: prof.cardinality_summary(
        table(s, d, "part"), ["p_name", "p_brand", "p_type"]),
    "numeric_profile": lambda s, d: rounded(prof.numeric_profile(table(s, d, "lineitem"), LINEITEM_NUM), MEAN_DIGITS),
    "numeric_profile_missing": lambda s, d: rounded(
        prof.numeric_profile(fx.missing(s, d), MISSING_NUM)),
    "target_summary": lambda s, d: rounded(prof.target_summary(table(s, d, "orders"), "o_totalprice")),
    "median_zero_columns": lambda s, d: rounded(prof.median_zero_columns(_profile(s, d)), MEAN_DIGITS),
    "low_variability": lambda s, d: rounded(prof.low_variability(fx.lines(s, d), LINES_NUM)),
    "skew_ranking": lambda s, d: rounded(
        prof.skew_ranking(prof.numeric_profile(fx.lines(s, d), SKEW_COLS), n=4), MEAN_DIGITS),
    "skew_ranking_events": lambda s, d: rounded(
        prof.skew_ranking(prof.numeric_profile(table(s, d, "events"), ["value", "user_id"])), MEAN_DIGITS),
    "profile_topk": lambda s, d: rounded(prof.profile_topk(_profile(s, d), "zero_pct", 5)),
    "histogram": lambda s, d: rounded(prof.histogram(table(s, d, "orders"), "o_totalprice"), 4),
    "box_stats": lambda s, d: rounded(prof.box_stats(table(s, d, "orders"), "o_totalprice", "o_orderstatus")),
    "reference_compare": lambda s, d: rounded(_reference(s, d)),
    "categorical_summary": lambda s, d: rounded(cat.categorical_summary(table(s, d, "part"), ["p_brand", "p_type"])),
    "categorical_summary_orders": lambda s, d: rounded(cat.categorical_summary(table(s, d, "orders"))),
    "categorical_summary_customer": lambda s, d: rounded(
        cat.categorical_summary(table(s, d, "customer"), ["c_mktsegment", "c_name"])),
    "categorical_summary_missing": lambda s, d: rounded(
        cat.categorical_summary(fx.missing(s, d), ["discount_code", "returnflag", "line_id"], only_missing=True)),
    "frequency_long": lambda s, d: rounded(cat.frequency_long(fx.missing(s, d), ["discount_code", "returnflag"])),
    "high_cardinality": lambda s, d: rounded(cat.high_cardinality(cat.categorical_summary(table(s, d, "part")))),
    "dominant_categories": lambda s, d: rounded(
        cat.dominant_categories(cat.categorical_summary(fx.lines(s, d), LINES_CAT))),
    "rare_categories": lambda s, d: rounded(cat.rare_categories(cat.frequency_long(fx.lines(s, d), LINES_CAT))),
    "rare_categories_users": lambda s, d: rounded(
        cat.rare_categories(cat.frequency_long(table(s, d, "events"), ["user_id"]))),
    "top_categories": lambda s, d: cat.top_categories(table(s, d, "part"), "p_brand"),
    "top_categories_limit": lambda s, d: cat.top_categories(table(s, d, "part"), "p_type", 3),
    "corr_matrix": lambda s, d: rounded(cor.corr_matrix(table(s, d, "lineitem"), LINEITEM_NUM)),
    "corr_matrix_missing": lambda s, d: rounded(cor.corr_matrix(fx.missing(s, d), MISSING_NUM)),
    "corr_to_target": lambda s, d: rounded(cor.corr_to_target(fx.lines(s, d), CORR_COLS, "charge", top=5)),
    "corr_to_target_missing": lambda s, d: rounded(cor.corr_to_target(fx.missing(s, d), MISSING_NUM, "price", top=2)),
    "corr_high_pairs": lambda s, d: rounded(cor.corr_high_pairs(fx.lines(s, d), CORR_COLS)),
    "corr_reference_pairs": lambda s, d: rounded(cor.corr_reference_pairs(
        cor.corr_matrix(fx.lines(s, d), ["l_extendedprice", "disc_price", "rebate", "l_discount"]),
        [("l_extendedprice", "disc_price"), ("rebate", "l_discount")])),
    "corr_headline": lambda s, d: rounded(cor.corr_headline(fx.lines(s, d), CORR_COLS, "charge")),
}

_STAT = ["min", "q1", "median", "mean", "q3", "max", "std", "iqr", "skewness", "missing_pct", "zero_pct"]


def _rounded_profile(view: str, cols: list[str], digits: int = MEAN_DIGITS) -> str:
    return (f"SELECT variable, count, missing_count, zero_count, "
            f"{', '.join(f'round({c}, {digits}) AS {c}' for c in _STAT)} FROM ({profile_sql(view, cols)}) p")


def _rounded_summary(view: str, cols: list[str], where: str = "") -> str:
    return (f"SELECT * REPLACE (round(missing_pct, 6) AS missing_pct, round(top_pct, 6) AS top_pct, "
            f"round(bottom_pct, 6) AS bottom_pct) FROM ({summary_sql(view, cols)}) s {where}")


_LABEL = """CASE WHEN skewness > 1 THEN 'strong positive' WHEN skewness > 0.5 THEN 'moderate positive'
 WHEN skewness >= -0.5 THEN 'about symmetric' WHEN skewness >= -1 THEN 'moderate negative'
 ELSE 'strong negative' END"""


def _skew(view: str, cols: list[str], n: int) -> str:
    return f"""SELECT row_number() OVER (ORDER BY abs(skewness) DESC, variable) AS rank, variable,
 round(skewness, {MEAN_DIGITS}) AS skewness, round(mean, {MEAN_DIGITS}) AS mean, round(median, {MEAN_DIGITS}) AS median, round(min, {MEAN_DIGITS}) AS min,
 round(max, {MEAN_DIGITS}) AS max, {_LABEL} AS label
FROM ({profile_sql(view, cols)}) p QUALIFY rank <= {n}"""


def _overview(view: str, cols: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, '{t}' AS dtype, '{k}' AS kind, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS missing_count, count(DISTINCT {c}) AS n_distinct FROM {view}"
        for c, (t, k) in cols.items())


def _missing_rows(view: str, cols: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, '{t}' AS dtype, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
        f"100.0*count(*) FILTER (WHERE {c} IS NULL)/count(*) AS missing_pct FROM {view}"
        for c, t in cols.items())


MISSING_TYPES = {"line_id": "string", "l_quantity": "double", "price": "double", "discount": "double",
                 "discount_code": "string", "returnflag": "string", "tax": "double"}


def _cardinality(view: str, cols: list[str]) -> str:
    return f"""SELECT variable, n_categories AS n_distinct, top_value, top_count, missing_count
FROM ({summary_sql(view, cols)}) s"""


def _to_target(view: str, cols: list[str], target: str, top: int) -> str:
    return f"""SELECT row_number() OVER (ORDER BY abs(r) DESC, v1) AS rank, v1 AS variable, round(r, 6) AS r,
 round(abs(r), 6) AS abs_r, CASE WHEN abs(r) >= 0.7 THEN 'strong' WHEN abs(r) >= 0.5 THEN 'upper moderate'
 WHEN abs(r) >= 0.3 THEN 'moderate' ELSE 'low' END AS label,
 row_number() OVER (ORDER BY abs(r) DESC, v1) <= {top} AS in_top
FROM ({pairs_sql(view, [(c, target) for c in cols if c != target])}) p WHERE r IS NOT NULL"""


_ALL_PAIRS = [(a, b) for a in LINEITEM_NUM for b in LINEITEM_NUM]
_HALF = [(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]

ORACLES = {
    "shape_summary": """SELECT count(*) AS rows, CAST(11 AS BIGINT) AS columns, CAST(8 AS BIGINT) AS n_numeric,
 CAST(2 AS BIGINT) AS n_categorical, true AS target_present, count(*) - 60000 AS difference FROM lineitem""",
    "column_overview": _overview("lineitem", {
        "l_orderkey": ("bigint", "numeric"), "l_partkey": ("bigint", "numeric"),
        "l_suppkey": ("bigint", "numeric"), "l_linenumber": ("int", "numeric"),
        "l_quantity": ("double", "numeric"), "l_extendedprice": ("double", "numeric"),
        "l_discount": ("double", "numeric"), "l_tax": ("double", "numeric"),
        "l_returnflag": ("string", "categorical"), "l_linestatus": ("string", "categorical"),
        "l_shipdate": ("timestamp_ntz", "other")}),
    "duplicate_rows": """SELECT count(*) AS rows, count(DISTINCT text) AS distinct_rows,
 count(*) - count(DISTINCT text) AS duplicates FROM documents""",
    "duplicate_rows_orders": """SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows,
 CAST(sum(n - 1) AS BIGINT) AS duplicates
FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) t""",
    "preview_rows": """(SELECT 'first' AS position, * FROM orders ORDER BY o_orderkey LIMIT 5)
UNION ALL (SELECT 'last' AS position, * FROM orders ORDER BY o_orderkey DESC LIMIT 5)""",
    "missing_summary": with_views("fx_missing", f"""SELECT variable, dtype, missing_count,
 round(missing_pct, 6) AS missing_pct FROM ({_missing_rows('fx_missing', MISSING_TYPES)}) t WHERE missing_count > 0"""),
    "cardinality_summary": _cardinality("orders", ["o_orderstatus", "o_orderpriority"]),
    "cardinality_summary_part": _cardinality("part", ["p_name", "p_brand", "p_type"]),
    "numeric_profile": _rounded_profile("lineitem", LINEITEM_NUM),
    "numeric_profile_missing": with_views("fx_missing", _rounded_profile("fx_missing", MISSING_NUM, 6)),
    "target_summary": """SELECT count(x) AS count, round(min(x), 6) AS min, round(max(x), 6) AS max,
 round(avg(x), 6) AS mean, round(quantile_cont(x, 0.5), 6) AS median, round(stddev_samp(x), 6) AS std,
 round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.75), 6) AS q3,
 round(avg(x) - quantile_cont(x, 0.5), 6) AS mean_minus_median, round(skewness(x), 6) AS skewness
FROM (SELECT o_totalprice AS x FROM orders) t""",
    "median_zero_columns": with_views("fx_lines", f"""SELECT variable, round(median, {MEAN_DIGITS}) AS median,
 round(mean, {MEAN_DIGITS}) AS mean, round(max, {MEAN_DIGITS}) AS max, zero_count, round(zero_pct, {MEAN_DIGITS}) AS zero_pct
FROM ({profile_sql('fx_lines', LINES_NUM)}) p WHERE median = 0"""),
    "low_variability": with_views("fx_lines", f"""SELECT variable, round(value, 6) AS dominant_value,
 n AS dominant_count, round(100.0*n/total, 6) AS dominant_pct
FROM (SELECT *, sum(n) OVER (PARTITION BY variable) AS total,
 coalesce(sum(n) FILTER (WHERE value = 0) OVER (PARTITION BY variable), 0) AS zeros,
 row_number() OVER (PARTITION BY variable ORDER BY n DESC, (value IS NULL), value) AS k
 FROM ({counts_sql('fx_lines', LINES_NUM, 'DOUBLE')}) c) t
WHERE k = 1 AND (100.0*zeros/total >= 95 OR 100.0*n/total > 95)"""),
    "skew_ranking": with_views("fx_lines", _skew("fx_lines", SKEW_COLS, 4)),
    "skew_ranking_events": _skew("events", ["value", "user_id"], 15),
    "profile_topk": with_views("fx_lines", f"""SELECT row_number() OVER (ORDER BY zero_pct DESC, variable) AS rank,
 variable, round(zero_pct, 6) AS value FROM ({profile_sql('fx_lines', LINES_NUM)}) p QUALIFY rank <= 5"""),
    "histogram": """WITH s AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice)-min(o_totalprice))/30 AS w FROM orders),
c AS (SELECT least(CAST(floor((o_totalprice - lo)/w) AS BIGINT), 29) AS bin, count(*) AS n FROM orders, s GROUP BY 1)
SELECT b.bin, round(lo + b.bin*w, 4) AS lower, round(lo + (b.bin+1)*w, 4) AS upper, coalesce(n, 0) AS count
FROM (SELECT range AS bin FROM range(30)) b CROSS JOIN s LEFT JOIN c ON c.bin = b.bin""",
    "box_stats": """WITH q AS (SELECT o_orderstatus AS g, quantile_cont(o_totalprice, 0.25) AS q1,
 quantile_cont(o_totalprice, 0.5) AS median, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1)
SELECT g AS "group", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
 round(min(x) FILTER (WHERE inside), 6) AS whisker_low, round(max(x) FILTER (WHERE inside), 6) AS whisker_high,
 count(*) FILTER (WHERE NOT inside) AS outliers
FROM (SELECT q.*, o_totalprice AS x,
 o_totalprice BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1) AS inside FROM orders JOIN q ON g = o_orderstatus) t
GROUP BY g, q1, median, q3""",
    "reference_compare": """WITH m AS (SELECT 'count' AS metric, CAST(count(*) AS DOUBLE) AS measured, 15000.0::DOUBLE AS expected FROM orders
UNION ALL SELECT 'mean', avg(o_totalprice), 250000.0 FROM orders
UNION ALL SELECT 'median', quantile_cont(o_totalprice, 0.5), 251000.0 FROM orders
UNION ALL SELECT 'std', stddev_samp(o_totalprice), 144000.0 FROM orders)
SELECT metric, round(measured, 6) AS measured, expected, round(measured-expected, 6) AS difference,
 round(abs(measured-expected), 6) AS abs_difference,
 round(100*abs(measured-expected)/abs(expected), 6) AS pct_difference, abs(measured-expected) <= 2000 AS matches FROM m""",
    "categorical_summary": _rounded_summary("part", ["p_brand", "p_type"]),
    "categorical_summary_orders": _rounded_summary("orders", ["o_orderstatus", "o_orderpriority"]),
    "categorical_summary_customer": _rounded_summary("customer", ["c_mktsegment", "c_name"]),
    "categorical_summary_missing": with_views("fx_missing", _rounded_summary(
        "fx_missing", ["discount_code", "returnflag", "line_id"], "WHERE missing_count > 0")),
    "frequency_long": with_views("fx_missing", f"""SELECT variable, category, count, round(pct, 6) AS pct, is_missing
FROM ({freq_sql('fx_missing', ['discount_code', 'returnflag'])}) f"""),
    "high_cardinality": f"""SELECT variable, n_categories, missing_count, round(missing_pct, 6) AS missing_pct
FROM ({summary_sql('part', ['p_name', 'p_brand', 'p_type'])}) s WHERE n_categories >= 10""",
    "dominant_categories": with_views("fx_lines", f"""SELECT variable, top_value AS category, top_count AS count,
 round(top_pct, 6) AS pct FROM ({summary_sql('fx_lines', LINES_CAT)}) s WHERE top_pct >= 90"""),
    "rare_categories": with_views("fx_lines", f"""SELECT variable, category, count, round(pct, 6) AS pct
FROM ({freq_sql('fx_lines', LINES_CAT)}) f WHERE NOT is_missing AND (count < 10 OR pct < 1)"""),
    "rare_categories_users": f"""SELECT variable, category, count, round(pct, 6) AS pct
FROM ({freq_sql('events', ['user_id'])}) f WHERE NOT is_missing AND (count < 10 OR pct < 1)""",
    "top_categories": """SELECT row_number() OVER (ORDER BY count(*) DESC, p_brand) AS rank, p_brand AS category,
 count(*) AS count FROM part GROUP BY p_brand""",
    "top_categories_limit": """SELECT row_number() OVER (ORDER BY count(*) DESC, p_type) AS rank, p_type AS category,
 count(*) AS count FROM part GROUP BY p_type QUALIFY rank <= 3""",
    "corr_matrix": f"SELECT v1, v2, round(r, 6) AS r FROM ({pairs_sql('lineitem', _ALL_PAIRS)}) p",
    "corr_matrix_missing": with_views("fx_missing", "SELECT v1, v2, round(r, 6) AS r FROM (" + pairs_sql(
        "fx_missing", [(a, b) for a in MISSING_NUM for b in MISSING_NUM]) + ") p"),
    "corr_to_target": with_views("fx_lines", _to_target("fx_lines", CORR_COLS, "charge", 5)),
    "corr_to_target_missing": with_views("fx_missing", _to_target("fx_missing", MISSING_NUM, "price", 2)),
    "corr_high_pairs": with_views("fx_lines", f"""SELECT v1, v2, round(r, 6) AS r, round(abs(r), 6) AS abs_r
FROM ({pairs_sql('fx_lines', _HALF)}) p WHERE abs(r) >= 0.7"""),
    "corr_reference_pairs": with_views("fx_lines", f"""SELECT v1, v2, round(r, 6) AS r, coalesce(abs(r) >= 0.5, false) AS relevant
FROM ({pairs_sql('fx_lines', [('l_extendedprice', 'disc_price'), ('rebate', 'l_discount')])}) p"""),
    "corr_headline": with_views("fx_lines", f"""WITH t AS ({pairs_sql('fx_lines', [(c, 'charge') for c in CORR_COLS])}),
h AS (SELECT * FROM ({pairs_sql('fx_lines', _HALF)}) x WHERE abs(r) >= 0.7)
SELECT CAST({len(CORR_COLS) + 1} AS BIGINT) AS n_variables, (SELECT count(*) FROM h) AS n_strong_pairs,
 (SELECT v1 FROM t ORDER BY abs(r) DESC, v1 LIMIT 1) AS best_variable,
 round((SELECT r FROM t ORDER BY abs(r) DESC, v1 LIMIT 1), 6) AS best_r,
 (SELECT v1 FROM h ORDER BY abs(r) DESC, v1, v2 LIMIT 1) AS pair_v1,
 (SELECT v2 FROM h ORDER BY abs(r) DESC, v1, v2 LIMIT 1) AS pair_v2,
 round((SELECT r FROM h ORDER BY abs(r) DESC, v1, v2 LIMIT 1), 6) AS pair_r"""),
}
