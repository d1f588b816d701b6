"""Isolation Forest and anomaly reports."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import count_if, percent, ratio, unpivot_values
from ..functions.scale import settle
from ..functions.vectors import as_array, matrix
from .profile import ranked

# Fixed value of the average path length of an unsuccessful search.
EULER_GAMMA = 0.5772156649015329
FOREST_SCHEMA = ("tree_id int, node_id int, feature int, threshold double, left int, right int, "
                 "size int, depth int")
_SPACE = float(2 ** 63)


def average_path(n) -> np.ndarray:
    """Expected path length of a search among n points."""
    n = np.asarray(n, dtype="float64")
    big = np.maximum(n, 3)
    return np.where(n > 2, 2 * (np.log(big - 1) + EULER_GAMMA) - 2 * (big - 1) / big,
                    np.where(n == 2, 1.0, 0.0))


def _unit_hash(*parts) -> F.Column:
    """Deterministic uniform number in [-1, 1) from the hash of the parts."""
    return F.xxhash64(*parts) / F.lit(_SPACE)


def tree_samples(df: DataFrame, key: str, features: str, trees: int, sample: int,
                 seed: int) -> DataFrame:
    """(tree_id, v): about 1.5 * sample candidate rows per tree, cut to the first ``sample`` by hash.

    A hash threshold first keeps a pool whose size does not grow with the table, and
    each pool row names its trees by its own hashes, so the work past the scan is constant.
    """
    n = df.count()
    rows = df.select(F.col(key).cast("string").alias("k"), as_array(df, features).alias("v"))
    pool = min(1.0, 1.25 * trees * sample / max(n, 1))
    rows = settle(rows.where(_unit_hash(F.lit(seed), F.lit("pool"), "k") <= 2 * pool - 1))
    n = rows.count()
    share = min(1.0, 1.5 * sample / max(n, 1) + 16 * math.sqrt(sample) / max(n, 1))
    own = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: _unit_hash(F.lit(seed), t, "k") <= 2 * share - 1)
    drawn = rows.withColumn("tree_id", F.explode(own)).withColumn("h", F.xxhash64(F.lit(seed), "tree_id", "k"))
    place = F.row_number().over(Window.partitionBy("tree_id").orderBy("h", "k"))
    return drawn.withColumn("place", place).where(F.col("place") <= sample)


def grow_tree(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (id, feature, threshold, left, right, size, depth) of one random tree."""
    nodes: list[list] = [[0, -1, 0.0, -1, -1, len(x), 0]]
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        depth = nodes[at][6]
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        useful = np.flatnonzero(high > low)
        if depth >= limit or len(rows) < 2 or not len(useful):
            continue
        f = int(rng.choice(useful))
        cut = float(rng.uniform(low[f], high[f]))
        go_left = x[rows, f] <= cut
        left, right = len(nodes), len(nodes) + 1
        nodes[at][1:5] = [f, cut, left, right]
        for child, part in ((left, rows[go_left]), (right, rows[~go_left])):
            nodes.append([child, -1, 0.0, -1, -1, len(part), depth + 1])
            todo.append((child, part))
    return [tuple(n) for n in nodes]


def iforest_fit(df: DataFrame, key: str, features: str, trees: int = 300, sample: int = 256,
                seed: int = 42) -> DataFrame:
    """Node table of an Isolation Forest; each tree sees at most ``sample`` rows."""
    limit = math.ceil(math.log2(max(sample, 2)))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        tree = int(pdf["tree_id"].iloc[0])
        x = np.stack([np.asarray(v, dtype="float64") for v in pdf["v"]])
        found = grow_tree(x, np.random.default_rng([seed, tree]), limit)
        out = pd.DataFrame(found, columns=["node_id", "feature", "threshold", "left", "right", "size", "depth"])
        out.insert(0, "tree_id", tree)
        return out

    picked = tree_samples(df, key, features, trees, sample, seed)
    return picked.select("tree_id", "place", "v").groupBy("tree_id").applyInPandas(build, FOREST_SCHEMA)


def forest_arrays(forest: DataFrame) -> tuple[np.ndarray, ...]:
    """The node table as flat arrays: bounded by trees x 2 * sample.

    Leaves point at themselves, so every row can take the same number of steps.
    """
    pdf = forest.orderBy("tree_id", "node_id").toPandas()
    sizes = pdf.groupby("tree_id")["node_id"].size().to_numpy()
    roots = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype("int32")
    base = np.repeat(roots, sizes)
    leaf = (pdf["feature"] < 0).to_numpy()
    own = np.arange(len(pdf))
    child = np.stack([np.where(leaf, own, base + pdf["left"]), np.where(leaf, own, base + pdf["right"])], axis=1)
    return (roots, np.where(leaf, 0, pdf["feature"]).astype("int32"),
            np.where(leaf, np.inf, pdf["threshold"]), child.ravel().astype("int32"),
            (pdf["depth"] + average_path(pdf["size"])).to_numpy(), int(pdf["depth"].max()))


def mean_path(x: np.ndarray, arrays: tuple, block: int = 2048) -> np.ndarray:
    """Average path length of each row over all trees, in cache-sized row blocks."""
    roots, feature, threshold, child, path, depth = arrays
    out = np.zeros(len(x))
    for start in range(0, len(x), block):
        part = x[start:start + block]
        n = len(part)
        flat = np.ascontiguousarray(part.T).ravel()
        rows = np.arange(n)
        total = np.zeros(n)
        for root in roots:
            at = np.full(n, root)
            for _ in range(depth):
                right = flat[feature[at] * n + rows] > threshold[at]
                at = child[2 * at + right]
            total += path[at]
        out[start:start + block] = total / len(roots)
    return out


def iforest_score(df: DataFrame, key: str, features: str, forest: DataFrame) -> DataFrame:
    """Score 2^(-E[path]/c), decision 0.5 - score, flag where the decision is negative."""
    forest = settle(forest)
    arrays = forest_arrays(forest)
    shared = df.sparkSession.sparkContext.broadcast(arrays)
    sample = forest.where(F.col("node_id") == 0).agg(F.max("size")).first()[0]
    norm = float(average_path(sample)) or 1.0
    key_type = df.schema[key].dataType.simpleString()

    def score(batches):
        model = shared.value
        for batch in batches:
            if batch.num_rows:
                s = np.exp2(-mean_path(matrix(batch.column(1)), model) / norm)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)],
                                                 names=[key, "anomaly_score"])

    scored = df.select(key, as_array(df, features).alias("v")).mapInArrow(
        score, f"`{key}` {key_type}, anomaly_score double")
    return scored.withColumn("decision", 0.5 - F.col("anomaly_score")).withColumn(
        "is_anomaly", F.col("decision") < 0)


def anomaly_rate(scored: DataFrame) -> DataFrame:
    flag = F.col("is_anomaly")
    return scored.agg(F.count(F.lit(1)).alias("rows"), count_if(~flag).alias("normal"),
                      count_if(flag).alias("anomalous"),
                      percent(count_if(flag), F.count(F.lit(1))).alias("pct"))


def anomaly_drivers(df: DataFrame, flag: str, cols: Sequence[str], n: int = 15) -> DataFrame:
    """Mean difference of anomalous and normal rows per variable, largest standardised first."""
    long = unpivot_values(df.select(F.col(flag).alias("_f"), *cols), cols, "double", keep=["_f"])
    x = F.col("value")
    wide = long.groupBy("variable").agg(
        F.avg(F.when(~F.col("_f"), x)).alias("normal_mean"),
        F.avg(F.when(F.col("_f"), x)).alias("anomaly_mean"), F.stddev_samp(x).alias("_std"))
    diff = F.col("anomaly_mean") - F.col("normal_mean")
    table = wide.select(
        "variable", "normal_mean", "anomaly_mean", diff.alias("difference"),
        ratio(diff, F.col("normal_mean")).alias("rel_difference"),
        ratio(F.abs(diff), F.col("_std")).alias("std_difference")).na.fill(0.0)
    top = table.orderBy(F.desc("std_difference"), "variable").limit(n)
    return ranked(top, F.desc("std_difference"), F.col("variable")).select("rank", *table.columns)


def top_anomalies(scored: DataFrame, df: DataFrame, key: str, drivers: Sequence[str],
                  n: int = 20) -> DataFrame:
    """The ``n`` highest scores with their driver columns."""
    top = scored.orderBy(F.desc("anomaly_score"), key).limit(n).select(key, "anomaly_score")
    placed = ranked(top, F.desc("anomaly_score"), F.col(key))
    return df.select(key, *drivers).join(placed, key).select(
        "rank", key, "anomaly_score", *drivers)
