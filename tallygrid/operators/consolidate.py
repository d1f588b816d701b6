"""Collecting metric tables and the final gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from .profile import ranked, reference_compare


def collect_metrics(sources: Sequence[DataFrame], mapping: Sequence[Mapping[str, str]],
                    labels: Mapping[str, str]) -> DataFrame:
    """Metric tables with their own column names -> one ranked table with display labels.

    ``mapping[i]`` gives, for source i, its column for each of model, rmse, mae, r2.
    """
    rows = None
    for source, names in zip(sources, mapping):
        part = source.select(*[F.col(names[c]).alias(c) for c in ("model", "rmse", "mae", "r2")])
        rows = part if rows is None else rows.unionByName(part)
    shown = rows.sparkSession.createDataFrame(list(labels.items()), "model string, label string")
    named = rows.join(F.broadcast(shown), "model", "left").select(
        F.coalesce("label", "model").alias("model"), "rmse", "mae", "r2")
    return ranked(named, F.col("rmse"), F.col("model")).select("rank", "model", "rmse", "mae", "r2")


def quality_gate(measured: DataFrame, expected: DataFrame, tol: float,
                 criteria: DataFrame | None = None) -> DataFrame:
    """PASS/FAIL per metric (within tolerance) and per criterion (all its rows true)."""
    checks = expected.select("metric").join(
        reference_compare(measured, expected, tol), "metric", "left").select(
        F.col("metric").alias("rule"), F.coalesce("matches", F.lit(False)).alias("ok"))
    if criteria is not None:
        checks = checks.unionByName(criteria.select("rule", F.coalesce("ok", F.lit(False)).alias("ok")))
    return checks.groupBy("rule").agg(
        F.when(F.bool_and("ok"), "PASS").otherwise("FAIL").alias("status"))
