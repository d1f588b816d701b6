"""Missing-value diagnosis, rule-based imputation and consistency checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import count_if, kind_of, percent, ratio, unpivot_values
from ..functions.radix import quantiles
from .features import medians
from .profile import cardinality_summary, missing_summary


@dataclass(frozen=True)
class FillRule:
    """How one column is filled.

    ``strategy``: median, mode, zero, none, unknown, or evidence (none/unknown,
    decided by how often ``evidence`` is zero where the column is null).
    """

    variable: str
    strategy: str
    missing_type: str
    evidence: str | None = None


# Constant fills per strategy.
CONSTANTS = {"zero": "0", "none": "None", "unknown": "Unknown"}


def co_missing(df: DataFrame, a: str, b: str) -> DataFrame:
    gone, y = F.col(a).isNull(), F.col(b)
    return df.agg(
        count_if(gone).alias("missing_a"),
        percent(count_if(gone), F.count(F.lit(1))).alias("missing_a_pct"),
        count_if(y.isNull()).alias("missing_b"),
        count_if(gone & (y == 0)).alias("a_missing_b_zero"),
        count_if(gone & (y > 0)).alias("a_missing_b_positive"))


def evidence_fill(df: DataFrame, a: str, b: str, min_ratio: float = 0.90) -> DataFrame:
    """Share of zeros in ``b`` among the known cases where ``a`` is null, and the fill it implies."""
    zero, known = F.col("a_missing_b_zero"), F.col("a_missing_b_zero") + F.col("a_missing_b_positive")
    share = F.coalesce(ratio(zero, known), F.lit(0.0))
    return co_missing(df, a, b).select(
        share.alias("zero_ratio"),
        F.when(share >= min_ratio, CONSTANTS["none"]).otherwise(CONSTANTS["unknown"]).alias("fill_value"))


def impute_plan(df: DataFrame, rules: Sequence[FillRule]) -> DataFrame:
    """One row per column with nulls; columns without a rule are marked for review."""
    spark = df.sparkSession
    by_kind: dict[str, list[FillRule]] = {}
    for rule in rules:
        by_kind.setdefault(rule.strategy, []).append(rule)
    fixed = [(r.variable, r.strategy, r.missing_type, CONSTANTS[r.strategy])
             for r in rules if r.strategy in CONSTANTS]
    schema = "variable string, strategy string, missing_type string, fill_value string"
    parts = [spark.createDataFrame(fixed, schema)]
    for name, found in (
        ("median", lambda cols: quantiles(unpivot_values(df, cols, "double"), ["variable"], "value", [0.5])
            .select("variable", F.col("q")[0].cast("string").alias("fill_value"))),
        ("mode", lambda cols: cardinality_summary(df, cols)
            .select("variable", F.col("top_value").alias("fill_value"))),
    ):
        wanted = by_kind.get(name)
        if wanted:
            types = F.create_map(*[F.lit(v) for r in wanted for v in (r.variable, r.missing_type)])
            parts.append(found([r.variable for r in wanted]).select(
                "variable", F.lit(name).alias("strategy"),
                types[F.col("variable")].alias("missing_type"), "fill_value"))
    for rule in by_kind.get("evidence", []):
        parts.append(evidence_fill(df, rule.variable, rule.evidence).select(
            F.lit(rule.variable).alias("variable"), F.lower("fill_value").alias("strategy"),
            F.lit(rule.missing_type).alias("missing_type"), "fill_value"))
    fills = parts[0]
    for part in parts[1:]:
        fills = fills.unionByName(part)
    kinds = F.create_map(*[F.lit(v) for f in df.schema.fields for v in (f.name, kind_of(f.dataType))])
    return missing_summary(df).join(fills, "variable", "left").select(
        "variable", kinds[F.col("variable")].alias("kind"), "missing_count", "missing_pct",
        F.coalesce("missing_type", F.lit("to review")).alias("missing_type"),
        F.coalesce("strategy", F.lit("review")).alias("strategy"), "fill_value")


def impute_apply(df: DataFrame, plan: DataFrame) -> DataFrame:
    """Apply a plan in one projection; the plan has at most one row per column.

    A column filled by its median becomes double, since a median of whole numbers can be a half.
    """
    rows = plan.select("variable", "strategy", "fill_value").collect()
    fills = {r["variable"]: r["fill_value"] for r in rows}
    halves = {r["variable"] for r in rows if r["strategy"] == "median"}
    types = {f.name: T.DoubleType() if f.name in halves else f.dataType for f in df.schema.fields}
    return df.select(*[
        F.coalesce(F.col(c).cast(types[c]), F.lit(fills[c]).cast(types[c])).alias(c)
        if fills.get(c) is not None else F.col(c) for c in df.columns])


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    fills = medians(df, cols)
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(fills.get(c))).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    tops = {r["variable"]: r["top_value"] for r in cardinality_summary(df, cols).collect()}
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[F.coalesce(F.col(c), F.lit(tops.get(c)).cast(types[c])).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def impute_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def consistency_rules(df: DataFrame, rules: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Rules "P implies Q": cases of P, those where Q holds, the rest."""
    wide = df.agg(*[e for i, (_, p, q) in enumerate(rules)
                    for e in (count_if(p).alias(f"p{i}"), count_if(p & q).alias(f"q{i}"))])
    cells = [F.struct(F.lit(name).alias("rule"), F.col(f"p{i}").alias("cases"),
                      F.col(f"q{i}").alias("consistent"),
                      (F.col(f"p{i}") - F.col(f"q{i}")).alias("inconsistent"))
             for i, (name, _, _) in enumerate(rules)]
    return wide.select(F.inline(F.array(*cells)))


def missing_before_after(before: DataFrame, after: DataFrame, plan: DataFrame) -> DataFrame:
    """Join two missing summaries and the plan: one row per planned column."""
    b = before.select("variable", F.col("missing_count").alias("missing_before"))
    a = after.select("variable", F.col("missing_count").alias("missing_after"))
    both = b.join(a, "variable", "full")
    return plan.select("variable", "strategy", "fill_value").join(both, "variable", "left").select(
        "variable", F.coalesce("missing_before", F.lit(0)).alias("missing_before"),
        F.coalesce("missing_after", F.lit(0)).alias("missing_after"), "strategy", "fill_value")


def imputation_tally(before: DataFrame, after: DataFrame, plan: DataFrame) -> DataFrame:
    """Filled cells per strategy, then the total of missing cells before and after."""
    joined = missing_before_after(before, after, plan)
    per = joined.groupBy("strategy").agg(
        F.sum(F.col("missing_before") - F.col("missing_after")).alias("cells"))

    def total(summary, name):
        return summary.agg(F.coalesce(F.sum("missing_count"), F.lit(0)).alias("cells")).select(
            F.lit(name).alias("strategy"), "cells")
    return per.unionByName(total(before, "total before")).unionByName(total(after, "total after"))


def no_missing_gate(df: DataFrame, strict: bool = False) -> DataFrame:
    """Columns that still hold nulls; in strict mode reading a non-empty result fails."""
    left = missing_summary(df).select("variable", "missing_count")
    if strict:
        left = left.withColumn("missing_count", F.raise_error(
            F.concat(F.lit("nulls left in "), F.col("variable"))).cast("long"))
    return left


def finite_gate(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    aggs, cells = [], []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [count_if(x.isNull()).alias(f"u{i}"), count_if(F.isnan(x)).alias(f"n{i}"),
                 count_if(F.abs(x) == float("inf")).alias(f"f{i}")]
        cells.append(F.struct(F.lit(c).alias("variable"), F.col(f"u{i}").alias("nulls"),
                              F.col(f"n{i}").alias("nans"), F.col(f"f{i}").alias("infs")))
    return df.agg(*aggs).select(F.inline(F.array(*cells)))
