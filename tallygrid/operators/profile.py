"""Structural and numeric profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.columns import (count_if, kind_of, numeric_columns, percent, ratio,
                                 stack_columns, unpivot_values)
from ..functions.radix import quantiles
from ..functions.scale import attach, settle


def shape_summary(df: DataFrame, target: str, expected_rows: int | None = None) -> DataFrame:
    kinds = [kind_of(f.dataType) for f in df.schema.fields]
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(len(kinds)).cast("long").alias("columns"),
        F.lit(kinds.count("numeric")).cast("long").alias("n_numeric"),
        F.lit(kinds.count("categorical")).cast("long").alias("n_categorical"),
        F.lit(target in df.columns).alias("target_present"),
        (F.col("rows") - F.lit(expected_rows).cast("long")).alias("difference"))


#: Values up to this size are compared as they are, longer ones by their SHA-256.
SHORT_BYTES = 31


def column_overview(df: DataFrame, cols: Sequence[str] | None = None,
                    approx: bool = False) -> DataFrame:
    """Dtype, kind, nulls and distinct values per column.

    Exact counts go through (variable, value) pairs, so a frequent value is
    collapsed before the shuffle, which carries at most 32 bytes of a value;
    ``approx`` needs one pass and no pair shuffle.
    """
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    facts = F.create_map(*[F.lit(v) for c in cols for v in (c, types[c].simpleString())])
    kinds = F.create_map(*[F.lit(v) for c in cols for v in (c, kind_of(types[c]))])
    if approx:
        wide = df.agg(
            *[count_if(F.col(c).isNull()).alias(f"missing_count__{i}") for i, c in enumerate(cols)],
            *[F.approx_count_distinct(c).alias(f"n_distinct__{i}") for i, c in enumerate(cols)])
        found = stack_columns(wide, cols, ["missing_count", "n_distinct"])
    else:
        # long values travel as digests; a digest is longer than any value that travels as it is
        short = F.when(F.octet_length("value") <= SHORT_BYTES, F.col("value").cast("binary")) \
            .otherwise(F.unhex(F.sha2("value", 256)))
        pairs = unpivot_values(df, cols, "string").withColumn("value", short).groupBy("variable", "value").count()
        found = pairs.groupBy("variable").agg(
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("count"))), F.lit(0))
            .alias("missing_count"),
            F.count("value").alias("n_distinct"))
        names = df.sparkSession.createDataFrame([(c,) for c in cols], "variable string")
        found = names.join(found, "variable", "left").na.fill(0)
    return found.select("variable", facts[F.col("variable")].alias("dtype"),
                        kinds[F.col("variable")].alias("kind"), "missing_count", "n_distinct")


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and surplus copies.

    Rows are compared by the SHA-256 of their typed JSON form, so the shuffle
    carries digests, not the rows, and copies collapse before it.
    """
    row = F.struct(*(cols or df.columns))
    digest = F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)
    counts = df.select(digest.alias("d")).groupBy("d").count()
    return counts.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows")
    ).withColumn("duplicates", F.col("rows") - F.col("distinct_rows"))


def preview_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First and last ``n`` rows in key order."""
    def edge(order, name):
        return df.orderBy(order).limit(n).select(F.lit(name).alias("position"), "*")
    return edge(F.col(key).asc(), "first").unionByName(edge(F.col(key).desc(), "last"))


def missing_summary(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Null count and percentage per column, most missing first."""
    cols = df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    entries = [F.struct(F.lit(c).alias("variable"), F.lit(types[c]).alias("dtype"),
                        F.col(f"m{i}").alias("missing_count"),
                        percent(F.col(f"m{i}"), F.col("_rows")).alias("missing_pct"))
               for i, c in enumerate(cols)]
    out = wide.select(F.inline(F.array(*entries)))
    if only_missing:
        out = out.where(F.col("missing_count") > 0)
    return out.orderBy(F.desc("missing_count"), "variable")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, value, count), nulls included."""
    return unpivot_values(df, cols, "string").groupBy("variable", "value").count()


def cardinality_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values, most frequent value and nulls per column; ties go to the smaller value."""
    present = F.col("value").isNotNull()
    return value_counts(df, cols).groupBy("variable").agg(
        F.count("value").alias("n_distinct"),
        F.min(F.when(present, F.struct(-F.col("count"), "value"))).alias("_top"),
        F.coalesce(F.sum(F.when(~present, F.col("count"))), F.lit(0)).alias("missing_count")
    ).select("variable", "n_distinct", F.col("_top.value").alias("top_value"),
             (-F.col("_top")["col1"]).alias("top_count"), "missing_count")


def sample_skewness(column: F.Column | str, n: F.Column) -> F.Column:
    """Bias-corrected skewness: population skewness times sqrt(n(n-1))/(n-2), null below 3 rows."""
    m = n.cast("double")
    return F.when(m > 2, F.skewness(column) * F.sqrt(m * (m - 1)) / F.nullif(m - 2, F.lit(0.0)))


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Fifteen statistics per numeric column: one scan, and two to four counting scans for the quartiles, whatever the column count."""
    cols = list(cols or numeric_columns(df))
    long = unpivot_values(df, cols, "double")
    x = F.col("value")
    base = quantiles(
        long, ["variable"], "value", [0.25, 0.5, 0.75], extra=[
            F.count(F.lit(1)).alias("_rows"),
            F.min(x).alias("min"), F.avg(x).alias("mean"), F.max(x).alias("max"),
            F.stddev_samp(x).alias("std"),
            sample_skewness(x, F.count(x)).alias("skewness"),
            count_if(x == 0).alias("zero_count")])
    q = F.col("q")
    return base.select(
        "variable", F.col("n").alias("count"),
        (F.col("_rows") - F.col("n")).alias("missing_count"),
        percent(F.col("_rows") - F.col("n"), F.col("_rows")).alias("missing_pct"),
        "min", q[0].alias("q1"), q[1].alias("median"), "mean", q[2].alias("q3"), "max", "std",
        (q[2] - q[0]).alias("iqr"), "skewness", "zero_count",
        percent(F.col("zero_count"), F.col("_rows")).alias("zero_pct"))


def target_summary(df: DataFrame, target: str) -> DataFrame:
    x = F.col(target).cast("double")
    base = quantiles(df, [], target, [0.25, 0.5, 0.75], extra=[
        F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"), sample_skewness(x, F.count(x)).alias("skewness")])
    q = F.col("q")
    return base.select(F.col("n").alias("count"), "min", "max", "mean", q[1].alias("median"),
                       "std", q[0].alias("q1"), q[2].alias("q3"),
                       (F.col("mean") - q[1]).alias("mean_minus_median"), "skewness")


def median_zero_columns(profile: DataFrame) -> DataFrame:
    return profile.where(F.col("median") == 0).select(
        "variable", "median", "mean", "max", "zero_count", "zero_pct")


def low_variability(df: DataFrame, cols: Sequence[str], threshold: float = 95.0) -> DataFrame:
    """Columns with too many zeros or one dominant value (nulls are a value here)."""
    counts = unpivot_values(df, cols, "double").groupBy("variable", "value").count()
    best = counts.groupBy("variable").agg(
        F.sum("count").alias("_rows"),
        F.min(F.struct((-F.col("count")).alias("c"), F.col("value").isNull().alias("null"),
                       "value")).alias("_top"),
        F.coalesce(F.sum(F.when(F.col("value") == 0, F.col("count"))), F.lit(0)).alias("_zeros"))
    return (best.select(
        "variable", F.col("_top.value").alias("dominant_value"),
        (-F.col("_top.c")).alias("dominant_count"),
        percent(-F.col("_top.c"), F.col("_rows")).alias("dominant_pct"),
        percent(F.col("_zeros"), F.col("_rows")).alias("_zero_pct"))
        .where((F.col("_zero_pct") >= threshold) | (F.col("dominant_pct") > threshold))
        .drop("_zero_pct"))


# Lower limits of the skewness bands and their names.
SKEW_BANDS = ("strong positive", "moderate positive", "about symmetric",
              "moderate negative", "strong negative")


def skew_label(value: F.Column) -> F.Column:
    return (F.when(value > 1, SKEW_BANDS[0]).when(value > 0.5, SKEW_BANDS[1])
            .when(value >= -0.5, SKEW_BANDS[2]).when(value >= -1, SKEW_BANDS[3])
            .when(value.isNotNull(), SKEW_BANDS[4]))


def ranked(df: DataFrame, *order: F.Column, out: str = "rank") -> DataFrame:
    """Rank a table of bounded size (one row per column, model, class...)."""
    return df.withColumn(out, F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long"))


def skew_ranking(profile: DataFrame, n: int = 15) -> DataFrame:
    top = (profile.where(F.col("skewness").isNotNull())
           .orderBy(F.desc(F.abs("skewness")), "variable").limit(n))
    return ranked(top, F.desc(F.abs("skewness")), F.col("variable")).select(
        "rank", "variable", "skewness", "mean", "median", "min", "max",
        skew_label(F.col("skewness")).alias("label"))


def profile_topk(profile: DataFrame, by: str, n: int = 10) -> DataFrame:
    top = profile.orderBy(F.desc(by), "variable").limit(n)
    return ranked(top, F.desc(by), F.col("variable")).select(
        "rank", "variable", F.col(by).cast("double").alias("value"))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins, the last one closed; empty bins are kept."""
    x = F.col(col).cast("double")
    span = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    span = span.select(F.struct(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.lit(1.0) / bins).otherwise((F.col("hi") - F.col("lo")) / bins).alias("w")
    ).alias("s"))
    placed = (df.where(x.isNotNull()).select(x.alias("x"))
              .withColumn("s", span.scalar())
              .select(F.least(F.floor((F.col("x") - F.col("s.lo")) / F.col("s.w")),
                              F.lit(bins - 1)).cast("long").alias("bin")))
    counts = placed.groupBy("bin").count()
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin").withColumn("s", span.scalar())
    return grid.join(counts, "bin", "left").select(
        "bin", (F.col("s.lo") + F.col("bin") * F.col("s.w")).alias("lower"),
        (F.col("s.lo") + (F.col("bin") + 1) * F.col("s.w")).alias("upper"),
        F.coalesce("count", F.lit(0)).alias("count"))


def box_stats(df: DataFrame, col: str, group: str) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier count per group."""
    q = quantiles(df, [group], col, [0.25, 0.5, 0.75])
    box = settle(q.select(group, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                                     F.col("q")[2].alias("q3")))
    x = F.col(col).cast("double")
    rows = attach(df.select(group, x.alias("_x")), box, [group])
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col("_x") >= F.col("q1") - 1.5 * iqr) & (F.col("_x") <= F.col("q3") + 1.5 * iqr)
    return rows.groupBy(F.col(group).alias("group"), "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        count_if(~inside).alias("outliers"))


def reference_compare(measured: DataFrame, expected: DataFrame, tol: float) -> DataFrame:
    """Join (metric, measured) with (metric, expected) and report the differences."""
    diff = F.col("measured") - F.col("expected")
    return measured.join(expected, "metric").select(
        "metric", "measured", "expected", diff.alias("difference"),
        F.abs(diff).alias("abs_difference"),
        (ratio(F.abs(diff), F.abs(F.col("expected"))) * 100).alias("pct_difference"),
        (F.abs(diff) <= tol).alias("matches"))
