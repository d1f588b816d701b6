"""Pearson correlation and redundancy review."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .profile import ranked

# Lower limits of |r| per band.
STRONG, UPPER_MODERATE, MODERATE = 0.70, 0.50, 0.30


def corr_label(abs_r: F.Column) -> F.Column:
    return (F.when(abs_r >= STRONG, "strong").when(abs_r >= UPPER_MODERATE, "upper moderate")
            .when(abs_r >= MODERATE, "moderate").when(abs_r.isNotNull(), "low"))


def _sums(df: DataFrame, cols: Sequence[str], means: Sequence[float]) -> dict[tuple[int, int], tuple]:
    """{(i, j): (n, sum x, sum x*x, sum x*y)} of centred columns over the rows where both are known.

    A batch gives all pairs by matrix products with the marks of known cells; a task
    sends one row per pair, whatever its number of rows.
    """
    k, names = len(cols), ["i", "j", "n", "s", "q", "p"]

    def products(batches):
        total = np.zeros((4, k, k))
        for batch in batches:
            if batch.num_rows:
                known = np.array([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], dtype="float64").T
                x = np.array([c.fill_null(0.0).to_numpy() for c in batch.columns]).T - means
                x[known == 0] = 0.0
                total += (known.T @ known, x.T @ known, (x * x).T @ known, x.T @ x)
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype("int32")), pa.array(j.astype("int32")),
                                          *[pa.array(t.ravel()) for t in total]], names=names)

    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(
        products, "i int, j int, n double, s double, q double, p double")
    return {(r["i"], r["j"]): (r["n"], r["s"], r["q"], r["p"])
            for r in rows.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names[2:]]).collect()}


def _pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(v1, v2, r) for the listed pairs, pairwise complete, null for a constant column.

    A first pass takes one mean per column; the second sums products of the centred columns.
    """
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    first = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    sums = _sums(df, cols, [m or 0.0 for m in first])
    slot = {c: i for i, c in enumerate(cols)}
    parts = []
    for a, b in pairs:
        n, sx, qx, xy = sums.get((slot[a], slot[b]), (0, 0, 0, 0))
        _, sy, qy, _ = sums.get((slot[b], slot[a]), (0, 0, 0, 0))
        parts.append((a, b, n, sx, sy, qx, qy, xy))

    # a few numbers per column pair: finish the arithmetic here
    found = []
    for a, b, n, sx, sy, qx, qy, xy in parts:
        if not n:
            found.append((a, b, None))
            continue
        cov, var_x, var_y = xy - sx * sy / n, qx - sx ** 2 / n, qy - sy ** 2 / n
        # sums of a constant column leave rounding dust instead of an exact zero
        if var_x <= 1e-14 * qx or var_y <= 1e-14 * qy:
            found.append((a, b, None))
        else:
            found.append((a, b, cov / (math.sqrt(var_x) * math.sqrt(var_y))))
    return df.sparkSession.createDataFrame(found, "v1 string, v2 string, r double")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Full symmetric matrix in long form; only pairs i <= j are computed."""
    cols = list(cols)
    half = _pairs(df, [(a, b) for i, a in enumerate(cols) for b in cols[i:]])
    both = F.when(F.col("v1") == F.col("v2"), F.array(F.struct("v1", "v2"))).otherwise(
        F.array(F.struct("v1", "v2"), F.struct(F.col("v2").alias("v1"), F.col("v1").alias("v2"))))
    return half.select(F.explode(both).alias("p"), "r").select(
        "p.v1", "p.v2",
        F.when(F.col("p.v1") == F.col("p.v2"), F.when(F.col("r").isNotNull(), 1.0))
        .otherwise(F.col("r")).alias("r"))


def corr_to_target(df: DataFrame, cols: Sequence[str], target: str, top: int = 10) -> DataFrame:
    found = _pairs(df, [(c, target) for c in cols if c != target]).where(F.col("r").isNotNull())
    found = found.select(F.col("v1").alias("variable"), "r", F.abs("r").alias("abs_r"))
    return ranked(found, F.desc("abs_r"), F.col("variable")).select(
        "rank", "variable", "r", "abs_r", corr_label(F.col("abs_r")).alias("label"),
        (F.col("rank") <= top).alias("in_top"))


def corr_high_pairs(df: DataFrame, cols: Sequence[str], threshold: float = STRONG) -> DataFrame:
    return (_pairs(df, list(combinations(cols, 2)))
            .withColumn("abs_r", F.abs("r")).where(F.col("abs_r") >= threshold))


def corr_reference_pairs(matrix: DataFrame, pairs: Sequence[tuple[str, str]],
                         threshold: float = UPPER_MODERATE) -> DataFrame:
    wanted = matrix.sparkSession.createDataFrame(list(pairs), "v1 string, v2 string")
    return F.broadcast(wanted).join(matrix, ["v1", "v2"]).select(
        "v1", "v2", "r", F.coalesce(F.abs("r") >= threshold, F.lit(False)).alias("relevant"))


def corr_headline(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Number of variables and strong pairs, best target variable, strongest predictor pair."""
    predictors = [c for c in cols if c != target]
    table = _pairs(df, [(c, target) for c in predictors] + list(combinations(predictors, 2)))
    strength = F.abs("r")
    on_target = F.col("v2") == target
    strong = ~on_target & (strength >= STRONG)
    pick = F.struct((-strength).alias("s"), "v1", "v2", "r")
    return table.agg(
        F.count(F.when(strong, 1)).alias("n_strong_pairs"),
        F.min(F.when(on_target & F.col("r").isNotNull(), pick)).alias("b"),
        F.min(F.when(strong, pick)).alias("p")
    ).select(F.lit(len(predictors) + 1).cast("long").alias("n_variables"), "n_strong_pairs",
             F.col("b.v1").alias("best_variable"), F.col("b.r").alias("best_r"),
             F.col("p.v1").alias("pair_v1"), F.col("p.v2").alias("pair_v2"),
             F.col("p.r").alias("pair_r"))
