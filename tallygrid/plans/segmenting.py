"""Queries for clustering, cluster quality and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import cluster as clu, features as feat
from . import fixtures as fx
from .fixtures import table, with_views

VARS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice",
        "o_totalprice", "charge"]
FEES = ["exempt", "regular"]


def _means(spark, sf):
    return clu.cluster_means(fx.vectors(spark, sf), "embedding", "label")


def _two(spark, sf):
    """Two groupings of the vectors: by half and by parity of the label."""
    v = fx.vectors(spark, sf)
    half = v.select("vec_id", F.when(F.col("label") < 5, 0).otherwise(1).alias("cluster"))
    parity = v.select("vec_id", (F.col("label") % 2).alias("cluster"))
    return half, parity


def _assign(spark, sf):
    half, parity = _two(spark, sf)
    return half.select(F.lit("half").alias("method"), "vec_id", "cluster").unionByName(
        parity.select(F.lit("parity").alias("method"), "vec_id", "cluster"))


def _best_kmeans(spark, sf, k=2, restarts=20):
    return clu.kmeans_fit(fx.vectors(spark, sf), "embedding", k, restarts=restarts)


def _assignments(spark, sf):
    model, _ = _best_kmeans(spark, sf)
    return clu.cluster_assignments(model, fx.vectors(spark, sf), "vec_id", "label", "embedding")


def _centroids(spark, sf):
    """Scaled group means of the line table, brought back to original units."""
    lines = fx.lines(spark, sf).select("fee_kind", *VARS)
    scaled = feat.standard_scale(lines, lines, VARS)
    centers = scaled.groupBy(F.col("fee_kind").alias("cluster")).agg(*[F.avg(c).alias(c) for c in VARS])
    return clu.centroids_original(centers, lines, VARS)


def _labelled(spark, sf):
    """Line rows with two groupings: the price band and the fee kind."""
    return fx.split(spark, sf).join(
        fx.lines(spark, sf).select("line_id", "fee_kind", "p_size"), "line_id")


def _align(spark, sf):
    assign = fx.lines(spark, sf).select(F.col("fee_kind").alias("cluster"), "charge")
    return clu.align_clusters(assign, "charge", ["low", "high"])


def _concentration(spark, sf):
    return clu.class_concentration(_labelled(spark, sf), "fee_kind", "band",
                                   {"low": "regular", "high": "exempt"})


def _delta(spark, sf):
    rows = _labelled(spark, sf)
    stats = None
    for method, group in (("fee", F.col("fee_kind") == "exempt"), ("size", F.col("p_size") > 25)):
        per = clu.group_target_stats(
            rows.withColumn("g", F.when(group, "high").otherwise("low")), "g", "charge")
        part = per.select(F.lit(method).alias("method"), F.col("group").alias("profile"), "mean", "median")
        stats = part if stats is None else stats.unionByName(part)
    return clu.profile_delta(stats)


def _common(spark, sf):
    lines = fx.lines(spark, sf)
    by_fee = clu.discriminant_variables(lines, "fee_kind", VARS, FEES)
    by_size = clu.discriminant_variables(
        lines.withColumn("big", F.when(F.col("p_size") > 25, "y").otherwise("n")), "big", VARS, ["n", "y"])
    return clu.common_variables(by_fee, by_size, 5)


def _methods(spark, sf):
    half, parity = _two(spark, sf)
    return clu.method_comparison({"half": half, "parity": parity}, fx.vectors(spark, sf),
                                 "vec_id", "embedding", "label")


QUERIES = {
    "kmeans_fit": lambda s, d: rounded(_best_kmeans(s, d)[1]),
    "nearest_centroid": lambda s, d: rounded(clu.nearest_centroid(
        fx.vectors(s, d), "vec_id", "embedding",
        _means(s, d))),
    "inertia": lambda s, d: rounded(clu.inertia(fx.vectors(s, d), "embedding", "label")),
    "silhouette": lambda s, d: rounded(clu.silhouette(fx.vectors(s, d), "vec_id", "embedding", "label")),
    "silhouette_squared": lambda s, d: rounded(clu.silhouette(
        fx.vectors(s, d), "vec_id", "embedding", "label")),
    "k_sweep": lambda s, d: rounded(clu.k_sweep(fx.vectors(s, d), "vec_id", "embedding")),
    "cluster_sizes": lambda s, d: rounded(clu.cluster_sizes(_assign(s, d))),
    "cluster_quality": lambda s, d: rounded(clu.cluster_quality(clu.cluster_sizes(_assign(s, d)))),
    "cluster_assignments": _assignments,
    "group_profile": lambda s, d: rounded(clu.group_profile(fx.lines(s, d), "fee_kind", VARS, FEES)),
    "group_profile_median": lambda s, d: rounded(clu.group_profile(
        fx.lines(s, d), "fee_kind", VARS, FEES, stat="median")),
    "discriminant_variables": lambda s, d: rounded(clu.discriminant_variables(
        fx.lines(s, d), "fee_kind", VARS, FEES, 5)),
    "centroids_original": lambda s, d: rounded(_centroids(s, d)),
    "group_target_stats": lambda s, d: rounded(clu.group_target_stats(fx.split(s, d), "band", "charge")),
    "crosstab_long": lambda s, d: rounded(clu.crosstab_long(
        table(s, d, "orders"), "o_orderstatus", "o_orderpriority")),
    "pca_project": lambda s, d: rounded(clu.pca_project(fx.vectors(s, d), "vec_id", "embedding")),
    "pca_variance": lambda s, d: rounded(clu.pca_variance(fx.vectors(s, d), "embedding")),
    "ward_cluster": lambda s, d: clu.ward_cluster(fx.vectors(s, d), "vec_id", "embedding"),
    "merge_heights": lambda s, d: rounded(clu.merge_heights(
        s, clu.ward_fit(fx.vectors(s, d), "vec_id", "embedding"))),
    "contingency": lambda s, d: clu.contingency(*_two(s, d), "vec_id"),
    "adjusted_rand": lambda s, d: rounded(clu.adjusted_rand(*_two(s, d), "vec_id")),
    "align_clusters": lambda s, d: rounded(_align(s, d)),
    "class_concentration": lambda s, d: rounded(_concentration(s, d)),
    "profile_delta": lambda s, d: rounded(_delta(s, d)),
    "common_variables": _common,
    "method_comparison": lambda s, d: rounded(_methods(s, d)),
}

_CENTERS = """c AS (SELECT label, list(m ORDER BY i) AS center FROM (
 SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM (
  SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM fx_vec) u GROUP BY label, i) a GROUP BY label)"""
_EMB = "CAST(embedding AS DOUBLE[])"
_HALF = "CASE WHEN label < 5 THEN 0 ELSE 1 END"


def _sil(groups: str, power: int = 1, rows: str = "fx_vec") -> str:
    """Silhouette scores per row as CTE chain ``<groups>_s`` for a labelling expression."""
    distance = "list_distance(a.e, b.e)" + (f"^{power}" if power > 1 else "")
    return f"""v AS MATERIALIZED (SELECT vec_id, {groups} AS cluster, {_EMB} AS e FROM {rows}),
n AS (SELECT cluster, count(*) AS n FROM v GROUP BY cluster),
d AS (SELECT a.vec_id, a.cluster, b.cluster AS other, sum({distance}) AS total FROM v a, v b GROUP BY 1, 2, 3),
s AS (SELECT d.vec_id, d.cluster,
 max(total/nullif(n.n-1, 0)) FILTER (WHERE d.other = d.cluster) AS a, min(total/n.n) FILTER (WHERE d.other <> d.cluster) AS b
 FROM d JOIN n ON n.cluster = d.other GROUP BY 1, 2),
k AS (SELECT cluster, CASE WHEN a IS NULL THEN 0 ELSE (b-a)/greatest(a, b) END AS s FROM s)"""


_SIL_OUT = """SELECT CAST(cluster AS VARCHAR) AS cluster, count(*) AS n, round(avg(s), 6) AS silhouette FROM k GROUP BY cluster
UNION ALL SELECT 'overall', count(*), round(avg(s), 6) FROM k"""


def _stats(view, group, target):
    return f"""SELECT {group} AS g, count({target}) AS n, min({target}) AS mn, quantile_cont({target}, 0.25) AS q1,
 quantile_cont({target}, 0.5) AS md, avg({target}) AS mu, quantile_cont({target}, 0.75) AS q3, max({target}) AS mx FROM {view} GROUP BY 1"""


def _profile_sql(stat):
    f = "avg({c})" if stat == "mean" else "quantile_cont({c}, 0.5)"
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {f.format(c=c)} FILTER (WHERE fee_kind = 'exempt') AS a, "
        f"{f.format(c=c)} FILTER (WHERE fee_kind = 'regular') AS b FROM fx_lines" for c in VARS)
    return with_views("fx_lines", f"""SELECT variable, round(a, 6) AS exempt, round(b, 6) AS regular,
 round(abs(a-b), 6) AS abs_difference, round(coalesce(abs(a-b)/nullif(abs(a), 0), 0), 6) AS rel_difference FROM ({parts}) p""")


def _disc(group, first, second):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, (avg({c}) FILTER (WHERE {group} = '{first}') - avg({c}))/stddev_pop({c}) AS a, "
        f"(avg({c}) FILTER (WHERE {group} = '{second}') - avg({c}))/stddev_pop({c}) AS b FROM fx_lines" for c in VARS)


def _rank(group, first, second):
    return f"""SELECT *, row_number() OVER (ORDER BY abs(a-b) DESC, variable) AS rank
FROM ({_disc(group, first, second)}) p"""


_BIG = "CASE WHEN p_size > 25 THEN 'y' ELSE 'n' END"
_METHOD = """SELECT 'half' AS method, vec_id, CASE WHEN label < 5 THEN 0 ELSE 1 END AS cluster FROM fx_vec
UNION ALL SELECT 'parity', vec_id, label % 2 FROM fx_vec"""
_ARI = f"""x AS (SELECT {_HALF} AS x, label % 2 AS y, count(*) AS n FROM fx_vec GROUP BY 1, 2),
t AS (SELECT (SELECT sum(n*(n-1)/2.0) FROM x) AS cell, (SELECT sum(n*(n-1)/2.0) FROM (SELECT sum(n) AS n FROM x GROUP BY x) q) AS r,
 (SELECT sum(n*(n-1)/2.0) FROM (SELECT sum(n) AS n FROM x GROUP BY y) q) AS c, (SELECT CAST(sum(n) AS BIGINT) FROM x) AS n),
ari AS (SELECT n, (cell - r*c/(n*(n-1)/2.0))/((r+c)/2 - r*c/(n*(n-1)/2.0)) AS ari FROM t)"""


def _method_row(name, groups):
    return f"""(WITH {_sil(groups, 2)},
g AS (SELECT {groups} AS cluster, count(*) AS n, avg(label) AS mu FROM fx_vec GROUP BY 1)
SELECT '{name}' AS method, round((SELECT avg(s) FROM k), 6) AS silhouette, round((SELECT ari FROM ari), 6) AS ari,
 min(n) AS small_size, max(n) AS large_size, round(min(mu), 6) AS low_mean, round(max(mu), 6) AS high_mean FROM g)"""


ORACLES = {
    "nearest_centroid": with_views("fx_vec", f"""WITH {_CENTERS}
SELECT vec_id, CAST(c.label AS BIGINT) AS cluster, round(list_distance({_EMB}, center), 6) AS distance FROM fx_vec v, c
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_distance({_EMB}, center), c.label) = 1"""),
    "inertia": with_views("fx_vec", f"""WITH {_CENTERS}, d AS (SELECT c.label, list_distance({_EMB}, center)^2 AS d FROM fx_vec v JOIN c ON v.label = c.label)
SELECT CAST(label AS VARCHAR) AS cluster, round(sum(d), 6) AS sum_sq FROM d GROUP BY label UNION ALL SELECT 'total', round(sum(d), 6) FROM d"""),
    "silhouette": with_views("fx_vec", f"WITH {_sil('label', 2)}\n{_SIL_OUT}"),
    "silhouette_squared": with_views("fx_vec", f"WITH {_sil('label', 2)}\n{_SIL_OUT}"),
    "cluster_sizes": with_views("fx_vec", f"""SELECT method, cluster, count(*) AS count,
 round(100.0*count(*)/sum(count(*)) OVER (PARTITION BY method), 6) AS pct FROM ({_METHOD}) m GROUP BY method, cluster"""),
    "cluster_quality": with_views("fx_vec", f"""SELECT method, min(n) AS min_size, max(n) AS max_size, round(max(n)/min(n)::DOUBLE, 6) AS ratio,
 min(n) < 0.05*sum(n) AS has_tiny_cluster FROM (SELECT method, cluster, count(*) AS n FROM ({_METHOD}) m GROUP BY 1, 2) c GROUP BY method"""),
    "group_profile": _profile_sql("mean"),
    "group_profile_median": _profile_sql("median"),
    "discriminant_variables": with_views("fx_lines", f"""SELECT rank, variable, round(a, 6) AS exempt, round(b, 6) AS regular,
 round(abs(a-b), 6) AS abs_difference FROM ({_rank('fee_kind', 'exempt', 'regular')}) r WHERE rank <= 5"""),
    "centroids_original": with_views("fx_lines", f"""SELECT fee_kind AS cluster, {', '.join(f'round(avg({c}), 6) AS {c}' for c in VARS)}
FROM fx_lines GROUP BY fee_kind"""),
    "group_target_stats": with_views("fx_split", f"""SELECT g AS "group", n AS count, round(100.0*n/sum(n) OVER (), 6) AS pct, round(mn, 6) AS min,
 round(q1, 6) AS q1, round(md, 6) AS median, round(mu, 6) AS mean, round(q3, 6) AS q3, round(mx, 6) AS max
FROM ({_stats('fx_split', 'band', 'charge')}) s"""),
    "crosstab_long": """SELECT g.s AS "group", g.p AS label, count(o_orderkey) AS count,
 round(100.0*count(o_orderkey)/sum(count(o_orderkey)) OVER (PARTITION BY g.s), 6) AS pct
FROM (SELECT * FROM (SELECT DISTINCT o_orderstatus AS s FROM orders) a, (SELECT DISTINCT o_orderpriority AS p FROM orders) b) g
LEFT JOIN orders ON o_orderstatus = g.s AND o_orderpriority = g.p GROUP BY g.s, g.p""",
    "contingency": with_views("fx_vec", f"""SELECT {_HALF} AS label_a, count(*) FILTER (WHERE label % 2 = 0) AS "0",
 count(*) FILTER (WHERE label % 2 = 1) AS "1" FROM fx_vec GROUP BY 1"""),
    "adjusted_rand": with_views("fx_vec", f"WITH {_ARI} SELECT n, round(ari, 6) AS ari FROM ari"),
    "align_clusters": with_views("fx_lines", """SELECT fee_kind AS cluster, round(avg(charge), 6) AS mean_target,
 CASE row_number() OVER (ORDER BY avg(charge), fee_kind) WHEN 1 THEN 'low' ELSE 'high' END AS profile FROM fx_lines GROUP BY fee_kind"""),
    "class_concentration": with_views("fx_split", """SELECT band AS label, fee_kind AS profile, count(*) AS count,
 round(100.0*count(*)/sum(count(*)) OVER (PARTITION BY band), 6) AS pct_of_label,
 (band = 'low' AND fee_kind = 'regular') OR (band = 'high' AND fee_kind = 'exempt') AS is_expected
FROM fx_split s JOIN fx_lines f ON s.line_id = f.line_id GROUP BY band, fee_kind"""),
    "profile_delta": with_views("fx_lines", """SELECT 'fee' AS method,
 round(avg(charge) FILTER (WHERE fee_kind = 'exempt') - avg(charge) FILTER (WHERE fee_kind <> 'exempt'), 6) AS delta_mean,
 round(quantile_cont(charge, 0.5) FILTER (WHERE fee_kind = 'exempt') - quantile_cont(charge, 0.5) FILTER (WHERE fee_kind <> 'exempt'), 6) AS delta_median FROM fx_lines
UNION ALL SELECT 'size', round(avg(charge) FILTER (WHERE p_size > 25) - avg(charge) FILTER (WHERE p_size <= 25), 6),
 round(quantile_cont(charge, 0.5) FILTER (WHERE p_size > 25) - quantile_cont(charge, 0.5) FILTER (WHERE p_size <= 25), 6) FROM fx_lines"""),
    "common_variables": with_views("fx_lines", f"""SELECT a.variable, a.rank AS rank_a, b.rank AS rank_b
FROM ({_rank('fee_kind', 'exempt', 'regular')}) a JOIN ({_rank(_BIG, 'n', 'y')}) b ON a.variable = b.variable AND a.rank <= 5 AND b.rank <= 5"""),
    "method_comparison": with_views("fx_vec", f"""WITH {_ARI}
SELECT * FROM {_method_row('half', _HALF)} h UNION ALL SELECT * FROM {_method_row('parity', 'label % 2')} p"""),
}
