"""Segmentation: K-Means, Ward, quality measures and cluster profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import count_if, percent, ratio, unpivot_values
from ..functions.radix import quantiles
from ..functions.vectors import as_array, as_vector, lists, matrix
from . import lloyd
from .features import inverse_scale
from .profile import ranked

# ---------------------------------------------------------------- fitting

def kmeans_fit(df: DataFrame, features: str, k: int, restarts: int = 20, seed: int = 42,
               max_iter: int = 300) -> tuple[lloyd.Run, DataFrame]:
    """Best of ``restarts`` runs by within-cluster sum of squares, with the cost of each run; all runs share their passes."""
    runs = lloyd.fit_many(df, features, [k], restarts, seed, max_iter)
    best = lloyd.best_of(runs, k)
    table = [(r.restart, r.cost, r is best) for r in runs]
    return best, df.sparkSession.createDataFrame(table, "restart int, cost double, chosen boolean")


def cluster_assignments(model: lloyd.Run, df: DataFrame, key: str, target: str,
                        features: str = "features") -> DataFrame:
    return df.select(key, model.predict(as_array(df, features)).alias("cluster"), target)


def nearest_centroid(df: DataFrame, key: str, vector: str, centroids: DataFrame) -> DataFrame:
    """Closest centroid per row; ties go to the smaller cluster id.

    ``centroids`` is (cluster, center), a model that every task receives.
    """
    rows = sorted(centroids.select("cluster", "center").collect())
    ids = np.array([r[0] for r in rows])
    centers = np.array([list(r[1]) for r in rows], dtype="float64")
    key_type = df.schema[key].dataType.simpleString()

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            best = np.full(len(x), np.inf)
            winner = np.zeros(len(x), dtype="int64")
            for j, center in enumerate(centers):
                d = np.sqrt(((x - center) ** 2).sum(axis=1))
                closer = d < best
                best[closer], winner[closer] = d[closer], j
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids[winner].astype("int64")), pa.array(best)],
                names=[key, "cluster", "distance"])

    return df.select(key, as_array(df, vector).alias("v")).mapInArrow(
        assign, f"`{key}` {key_type}, cluster bigint, distance double")


def cluster_means(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """(cluster, n, center) with partial aggregation of vector sums."""
    from pyspark.ml.functions import vector_to_array

    rows = df.select(F.col(cluster).alias("cluster"), as_vector(df, vector).alias("v"))
    return rows.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.mean(F.col("v"))).alias("center"))


def inertia(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """Within-cluster sum of squares per cluster and in total, for any number of clusters."""
    rows = df.select(F.col(cluster).alias("cluster"), as_array(df, vector).alias("v")).where(F.col("cluster").isNotNull())
    gap = F.zip_with("v", "center", lambda a, b: (a - b) * (a - b))
    per = rows.join(cluster_means(df, vector, cluster).select("cluster", "center"), "cluster") \
        .groupBy(F.col("cluster").cast("string").alias("cluster")) \
        .agg(F.sum(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x)).alias("sum_sq"))
    return per.unionByName(per.agg(F.sum("sum_sq").alias("sum_sq")).select(F.lit("total").alias("cluster"), "sum_sq"))


# ---------------------------------------------------------------- silhouette

def silhouette(df: DataFrame, key: str, vector: str, cluster: str) -> DataFrame:
    """Mean silhouette of squared Euclidean distances, per cluster and overall.

    Exact over all rows in two linear passes: a row's mean squared distance to a
    cluster follows from that cluster's size, mean and variance.
    """
    rows = df.select(F.col(key).alias("key"), F.col(cluster).alias("cluster"),
                     as_array(df, vector).alias("v")).where(F.col("cluster").isNotNull())
    scored = _silhouette_squared(rows)
    per = scored.groupBy(F.col("cluster").cast("string").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("s").alias("silhouette"))
    return per.unionByName(scored.agg(
        F.count(F.lit(1)).alias("n"), F.avg("s").alias("silhouette")).select(
        F.lit("overall").alias("cluster"), "n", "silhouette"))


def _silhouette_squared(rows: DataFrame) -> DataFrame:
    """Mean squared distance to a cluster follows from its size, mean and sum of squares."""
    from pyspark.ml.functions import vector_to_array

    vec = rows.select("cluster", as_vector(rows, "v").alias("x"))
    stats = sorted(vec.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.mean(F.col("x"))).alias("m"),
        vector_to_array(Summarizer.variance(F.col("x"))).alias("s")).collect())
    slot = {r["cluster"]: i for i, r in enumerate(stats)}
    sizes = np.array([r["n"] for r in stats], dtype="float64")
    means = np.array([list(r["m"]) for r in stats])
    spread = np.array([sum(r["s"]) for r in stats]) * (sizes - 1)
    kind = rows.schema["cluster"].dataType.simpleString()

    def score(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            own = np.array([slot[c] for c in batch.column(0).to_pylist()])
            sums = np.stack([sizes[j] * ((x - means[j]) ** 2).sum(axis=1) + spread[j]
                             for j in range(len(sizes))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lloyd.score(sums, own, sizes))], names=["cluster", "s"])

    return rows.select("cluster", "v").mapInArrow(score, f"cluster {kind}, s double")


def overall_silhouette(scores: DataFrame) -> float | None:
    return scores.where("cluster = 'overall'").first()["silhouette"]


def k_sweep(df: DataFrame, key: str, features: str, ks: Sequence[int] = tuple(range(2, 11)),
            restarts: int = 20, seed: int = 42) -> DataFrame:
    """Inertia, its change and silhouette per k, and whether inertia ever rises."""
    runs = lloyd.fit_many(df, features, ks, restarts, seed)
    best = [lloyd.best_of(runs, k) for k in ks]
    scores = lloyd.silhouettes(df, features, best)
    out = [(int(k), run.cost, score) for k, run, score in zip(ks, best, scores)]
    table = df.sparkSession.createDataFrame(out, "k int, inertia double, silhouette double")
    whole = Window.partitionBy(F.lit(0))
    change = F.col("inertia") - F.lag("inertia").over(whole.orderBy("k"))
    return (table.withColumn("inertia_change", change)
            .withColumn("never_rises", F.coalesce(F.max("inertia_change").over(whole) <= 1e-8, F.lit(True)))
            .select("k", "inertia", "inertia_change", "silhouette", "never_rises"))


# ---------------------------------------------------------------- sizes and profiles

def cluster_sizes(assign: DataFrame, by: str = "method") -> DataFrame:
    counts = assign.groupBy(by, "cluster").count()
    return counts.select(by, "cluster", "count",
                         percent(F.col("count"), F.sum("count").over(Window.partitionBy(by))).alias("pct"))


def cluster_quality(sizes: DataFrame, by: str = "method", min_share: float = 0.05) -> DataFrame:
    return sizes.groupBy(by).agg(
        F.min("count").alias("min_size"), F.max("count").alias("max_size"),
        ratio(F.max("count"), F.min("count")).alias("ratio"),
        (F.min("count") < min_share * F.sum("count")).alias("has_tiny_cluster"))


def group_profile(df: DataFrame, group: str, cols: Sequence[str], values: Sequence,
                  stat: str = "mean") -> DataFrame:
    """Mean or median per variable for two groups, with absolute and relative difference."""
    first, second = [str(v) for v in values]
    g = F.col(group).cast("string")
    long = unpivot_values(df.select(g.alias("_g"), *cols), cols, "double", keep=["_g"])
    if stat == "mean":
        wide = long.groupBy("variable").agg(*[
            F.avg(F.when(F.col("_g") == v, F.col("value"))).alias(v) for v in (first, second)])
    else:
        q = quantiles(long.where(F.col("_g").isin(first, second)), ["variable", "_g"], "value", [0.5])
        wide = q.groupBy("variable").agg(*[
            F.max(F.when(F.col("_g") == v, F.col("q")[0])).alias(v) for v in (first, second)])
    diff = F.abs(F.col(f"`{first}`") - F.col(f"`{second}`"))
    return wide.withColumn("abs_difference", diff).withColumn(
        "rel_difference", ratio(diff, F.abs(F.col(f"`{first}`")))).na.fill(0.0)


def discriminant_variables(df: DataFrame, group: str, cols: Sequence[str], values: Sequence,
                           n: int = 15) -> DataFrame:
    """Absolute difference of the standardised group means, largest first."""
    first, second = [str(v) for v in values]
    long = unpivot_values(df.select(F.col(group).cast("string").alias("_g"), *cols), cols, "double",
                          keep=["_g"])
    x = F.col("value")
    std = F.stddev_pop(x)
    wide = long.groupBy("variable").agg(
        F.avg(x).alias("_mean"), F.when(std == 0, 1.0).otherwise(std).alias("_std"),
        *[F.avg(F.when(F.col("_g") == v, x)).alias(v) for v in (first, second)])
    scaled = wide.select("variable", *[
        ((F.col(f"`{v}`") - F.col("_mean")) / F.col("_std")).alias(v) for v in (first, second)])
    scaled = scaled.withColumn("abs_difference", F.abs(F.col(f"`{first}`") - F.col(f"`{second}`")))
    top = scaled.orderBy(F.desc("abs_difference"), "variable").limit(n)
    return ranked(top, F.desc("abs_difference"), F.col("variable")).select(
        "rank", "variable", F.col(f"`{first}`"), F.col(f"`{second}`"), "abs_difference")


def centroids_original(centroids: DataFrame, train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scaled centroids (cluster, one column per variable) in original units."""
    return inverse_scale(centroids.select("cluster", *cols), train, cols)


def group_target_stats(df: DataFrame, group: str, target: str) -> DataFrame:
    x = F.col(target).cast("double")
    # two columns, read by every counting pass; the result needs them no more
    rows = df.select(group, target).persist()
    try:
        q = quantiles(rows, [group], target, [0.25, 0.5, 0.75], extra=[
            F.min(x).alias("min"), F.avg(x).alias("mean"), F.max(x).alias("max")])
    finally:
        rows.unpersist()
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return q.select(F.col(group).alias("group"), F.col("n").alias("count"),
                    percent(F.col("n"), total).alias("pct"), "min", F.col("q")[0].alias("q1"),
                    F.col("q")[1].alias("median"), "mean", F.col("q")[2].alias("q3"), "max")


def crosstab_long(df: DataFrame, group: str, label: str) -> DataFrame:
    """Counts of every group x label cell and their share of the group.

    The pivot lists the labels and refuses more than spark.sql.pivotMaxValues.
    """
    wide = df.groupBy(F.col(group).alias("group")).pivot(label).count()
    cells = [c for c in wide.columns if c != "group"]
    long = wide.na.fill(0, cells).unpivot(["group"], [F.col(f"`{c}`") for c in cells], "label", "count")
    return long.select("group", "label", "count", percent(
        F.col("count"), F.sum("count").over(Window.partitionBy("group"))).alias("pct"))


# ---------------------------------------------------------------- principal components

def _pca(df: DataFrame, features: str, k: int):
    rows = df.select(as_vector(df, features).alias("x"))
    model = PCA(k=k, inputCol="x", outputCol="y").fit(rows)
    mean = np.array(rows.select(Summarizer.mean(F.col("x"))).first()[0].toArray())
    axes = np.array(model.pc.toArray())
    # the sign of an axis is arbitrary: make its largest loading positive
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(k)])
    return axes, mean, model.explainedVariance.toArray()


def pca_project(df: DataFrame, key: str, features: str, k: int = 2) -> DataFrame:
    axes, mean, _ = _pca(df, features, k)
    key_type = df.schema[key].dataType.simpleString()
    names = [f"pc{i + 1}" for i in range(k)]

    def project(batches):
        for batch in batches:
            if batch.num_rows:
                y = (matrix(batch.column(1)) - mean) @ axes
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(y[:, i]) for i in range(k)]], names=[key, *names])

    return df.select(key, as_array(df, features).alias("v")).mapInArrow(
        project, f"`{key}` {key_type}, " + ", ".join(f"{n} double" for n in names))


def pca_variance(df: DataFrame, features: str, k: int = 2) -> DataFrame:
    _, _, explained = _pca(df, features, k)
    rows = [(f"pc{i + 1}", float(v), float(explained[:i + 1].sum())) for i, v in enumerate(explained)]
    return df.sparkSession.createDataFrame(rows, "component string, explained double, cumulative double")


# ---------------------------------------------------------------- Ward

@dataclass
class WardFit:
    """Merge list over the micro-clusters and each micro-cluster's final label."""

    merges: list[tuple[int, int, int, float, int]]
    labels: list[int]
    assign: DataFrame
    key: str


def ward_merges(centers: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int, float, int]]:
    """(step, left, right, height, size) of size-weighted Ward merges.

    Merging clusters a and b costs 2 * |a||b| / (|a|+|b|) * ||ca - cb||^2; the height
    is its root. New clusters are numbered m, m+1, ...
    """
    m = len(centers)
    c, w = centers.astype("float64").copy(), sizes.astype("float64").copy()
    ids = np.arange(m)
    sq = (c ** 2).sum(1)
    cost = 2 * np.outer(w, w) / (w[:, None] + w[None, :]) * np.maximum(
        sq[:, None] + sq[None, :] - 2 * c @ c.T, 0)
    np.fill_diagonal(cost, np.inf)
    merges = []
    for step in range(m - 1):
        i, j = sorted(np.unravel_index(np.argmin(cost), cost.shape))
        merges.append((step, int(min(ids[i], ids[j])), int(max(ids[i], ids[j])),
                       float(np.sqrt(cost[i, j])), int(w[i] + w[j])))
        c[i] = (w[i] * c[i] + w[j] * c[j]) / (w[i] + w[j])
        w[i] += w[j]
        ids[i] = m + step
        cost[j, :] = cost[:, j] = np.inf
        alive = np.isfinite(cost[i]) & (np.arange(m) != i)
        update = 2 * w[i] * w / (w[i] + w) * ((c - c[i]) ** 2).sum(1)
        cost[i, alive] = cost[alive, i] = update[alive]
    return merges


def cut_merges(m: int, merges: Sequence[tuple], k: int) -> list[int]:
    """Label 0..k-1 per leaf after undoing the last k-1 merges, numbered by first leaf."""
    parent = {}
    for step, left, right, _, _ in merges[:max(m - k, 0)]:
        parent[left] = parent[right] = m + step

    def root(x):
        while x in parent:
            x = parent[x]
        return x
    seen: dict[int, int] = {}
    return [seen.setdefault(root(leaf), len(seen)) for leaf in range(m)]


def ward_fit(df: DataFrame, key: str, features: str, k: int = 2, micro: int = 500,
             seed: int = 42) -> WardFit:
    """Ward on at most ``micro`` centroids.

    A distributed K-Means first condenses the rows, so the driver sees ``micro``
    centroids and never the rows.
    """
    rows = df.select(key, as_array(df, features).alias("v"))
    model, _ = kmeans_fit(rows, "v", micro, restarts=1, seed=seed, max_iter=20)
    places = rows.select(key, model.predict(F.col("v")).alias("micro"))
    centers, sizes = model.centers, model.sizes
    keep = np.flatnonzero(sizes > 0)
    centers, sizes = centers[keep], sizes[keep]
    slot = F.array(*[F.lit(int(np.searchsorted(keep, i))) for i in range(int(keep.max()) + 1)])
    places = places.select(key, slot[F.col("micro")].alias("micro"))
    merges = ward_merges(centers, sizes)
    return WardFit(merges, cut_merges(len(centers), merges, k), places, key)


def ward_cluster(df: DataFrame, key: str, features: str, k: int = 2, micro: int = 500,
                 fit: WardFit | None = None) -> DataFrame:
    fit = fit or ward_fit(df, key, features, k, micro)
    label = F.array(*[F.lit(v) for v in fit.labels])
    return fit.assign.select(fit.key, label[F.col("micro")].alias("cluster"))


def merge_heights(spark, fit: WardFit, last: int = 30) -> DataFrame:
    return spark.createDataFrame(fit.merges[-last:],
                                 "step int, left int, right int, height double, size int")


# ---------------------------------------------------------------- agreement and comparison

def contingency(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Counts of label_a x label_b, one column per label of b."""
    both = a.select(key, F.col("cluster").alias("label_a")).join(
        b.select(key, F.col("cluster").alias("label_b")), key)
    wide = both.groupBy("label_a").pivot("label_b").count()
    return wide.na.fill(0, [c for c in wide.columns if c != "label_a"])


def adjusted_rand(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Adjusted Rand index from the cell, row and column counts; 1 when both are trivial."""
    both = a.select(key, F.col("cluster").alias("x")).join(b.select(key, F.col("cluster").alias("y")), key)
    cells = both.groupBy("x", "y").count()

    def pairs(counts):
        n = F.col("count").cast("double")
        return counts.agg(F.sum(n * (n - 1) / 2)).scalar()
    cell = pairs(cells)
    row = pairs(cells.groupBy("x").agg(F.sum("count").alias("count")))
    column = pairs(cells.groupBy("y").agg(F.sum("count").alias("count")))
    n = F.col("n").cast("double")
    expected = ratio(F.col("row") * F.col("column"), n * (n - 1) / 2)
    top = (F.col("row") + F.col("column")) / 2
    return cells.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).select(
        "n", cell.alias("cell"), row.alias("row"), column.alias("column")).select(
        "n", F.coalesce(ratio(F.col("cell") - expected, top - expected), F.lit(1.0)).alias("ari"))


def align_clusters(assign: DataFrame, target: str, names: Sequence[str]) -> DataFrame:
    """Name clusters by their mean target, lowest first."""
    means = assign.groupBy("cluster").agg(F.avg(target).alias("mean_target"))
    placed = ranked(means, F.col("mean_target"), F.col("cluster"), out="_r")
    return placed.select("cluster", "mean_target", F.try_element_at(
        F.array(*[F.lit(n) for n in names]), F.col("_r").cast("int")).alias("profile"))


def class_concentration(df: DataFrame, profile: str, label: str,
                        expected: Mapping[str, str]) -> DataFrame:
    """Share of each class per profile, with a flag where the class is expected."""
    counts = df.groupBy(F.col(label).alias("label"), F.col(profile).alias("profile")).count()
    want = F.lit(False)
    for name, place in expected.items():
        want = want | ((F.col("label") == name) & (F.col("profile") == place))
    return counts.select("label", "profile", "count", percent(
        F.col("count"), F.sum("count").over(Window.partitionBy("label"))).alias("pct_of_label"),
        want.alias("is_expected"))


def profile_delta(stats: DataFrame, low: str = "low", high: str = "high") -> DataFrame:
    """High minus low profile per method; ``stats`` has method, profile, mean, median."""
    def at(p, c):
        return F.max(F.when(F.col("profile") == p, F.col(c)))
    return stats.groupBy("method").agg(
        (at(high, "mean") - at(low, "mean")).alias("delta_mean"),
        (at(high, "median") - at(low, "median")).alias("delta_median"))


def common_variables(rank_a: DataFrame, rank_b: DataFrame, n: int = 10) -> DataFrame:
    a = rank_a.where(F.col("rank") <= n).select("variable", F.col("rank").alias("rank_a"))
    b = rank_b.where(F.col("rank") <= n).select("variable", F.col("rank").alias("rank_b"))
    return a.join(b, "variable").orderBy(F.col("rank_a") + F.col("rank_b"), "rank_a")


def method_comparison(assigns: Mapping[str, DataFrame], data: DataFrame, key: str, vector: str,
                      target: str) -> DataFrame:
    """Silhouette, agreement, sizes and profile means of two methods; one row per method."""
    (name_a, a), (name_b, b) = assigns.items()
    ari = adjusted_rand(a, b, key).select("ari").scalar()
    out = None
    for name, assign in ((name_a, a), (name_b, b)):
        rows = data.select(key, vector, target).join(assign.select(key, "cluster"), key)
        score = silhouette(rows, key, vector, "cluster") \
            .where("cluster = 'overall'").select("silhouette").scalar()
        per = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("mean"))
        part = per.agg(F.min("n").alias("small_size"), F.max("n").alias("large_size"),
                       F.min("mean").alias("low_mean"), F.max("mean").alias("high_mean")).select(
            F.lit(name).alias("method"), score.alias("silhouette"), ari.alias("ari"),
            "small_size", "large_size", "low_mean", "high_mean")
        out = part if out is None else out.unionByName(part)
    return out
