"""Categorical profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import percent, text_columns
from ..functions.scale import number_rows
from .profile import ranked, value_counts

# Fixed value: how a missing category is shown in frequency tables.
MISSING = "<NA>"


def categorical_summary(df: DataFrame, cols: Sequence[str] | None = None,
                        only_missing: bool = False) -> DataFrame:
    """Cardinality, nulls, most and least frequent category per column.

    Extremes are ordinary min aggregates over (count, value), so no task sorts
    all categories of a column; ties go to the smaller value.
    """
    counts = value_counts(df, list(cols or text_columns(df)))
    present = F.col("value").isNotNull()
    c = F.col("count")
    found = counts.groupBy("variable").agg(
        F.sum("count").alias("_rows"),
        F.count("value").alias("n_categories"),
        F.count(F.lit(1)).alias("n_categories_with_missing"),
        F.coalesce(F.sum(F.when(~present, c)), F.lit(0)).alias("missing_count"),
        F.min(F.when(present, F.struct((-c).alias("c"), "value"))).alias("_top"),
        F.min(F.when(present, F.struct(c.alias("c"), "value"))).alias("_bottom"))
    out = found.select(
        "variable", "n_categories", "n_categories_with_missing", "missing_count",
        percent(F.col("missing_count"), F.col("_rows")).alias("missing_pct"),
        F.col("_top.value").alias("top_value"), (-F.col("_top.c")).alias("top_count"),
        percent(-F.col("_top.c"), F.col("_rows")).alias("top_pct"),
        F.col("_bottom.value").alias("bottom_value"), F.col("_bottom.c").alias("bottom_count"),
        percent(F.col("_bottom.c"), F.col("_rows")).alias("bottom_pct"))
    return out.where(F.col("missing_count") > 0) if only_missing else out


def frequency_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, category, count, pct, is_missing); every column has all rows as its total."""
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return value_counts(df, cols).select(
        "variable", F.coalesce("value", F.lit(MISSING)).alias("category"), "count",
        percent(F.col("count"), rows).alias("pct"), F.col("value").isNull().alias("is_missing"))


def high_cardinality(summary: DataFrame, min_categories: int = 10) -> DataFrame:
    return summary.where(F.col("n_categories") >= min_categories).select(
        "variable", "n_categories", "missing_count", "missing_pct")


def dominant_categories(summary: DataFrame, min_pct: float = 90.0) -> DataFrame:
    return summary.where(F.col("top_pct") >= min_pct).select(
        "variable", F.col("top_value").alias("category"), F.col("top_count").alias("count"),
        F.col("top_pct").alias("pct"))


def rare_categories(freq: DataFrame, max_count: int = 10, max_pct: float = 1.0) -> DataFrame:
    rare = (F.col("count") < max_count) | (F.col("pct") < max_pct)
    return freq.where(~F.col("is_missing") & rare).select("variable", "category", "count", "pct")


def top_categories(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Value counts in descending order with their rank.

    With ``n`` a top-k keeps the ranking small; without it the rows are numbered
    over a range-partitioned sort.
    """
    counts = df.groupBy(F.col(col).alias("category")).count().where(F.col("category").isNotNull())
    order = [F.desc("count"), F.col("category").asc()]
    if n is not None:
        out = ranked(counts.orderBy(*order).limit(n), *order)
    else:
        out = number_rows(counts, order, out="rank")
    return out.select("rank", "category", "count")
