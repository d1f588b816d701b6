"""Deterministic splits and class balance.

Rows are ordered by ``md5(seed|key)``, a value any engine reproduces. The first
rows of that order form the test set. The cut is found by counting hash prefixes,
so no task ever ranks a whole class.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import count_if, percent, ratio
from ..functions.scale import attach, number_rows, sent, settle

PREFIX = 4


def hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))


def mark_first_by_hash(df: DataFrame, key: str,
                       quota: int | Callable[[int], int] | Callable[[DataFrame], DataFrame],
                       groups: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """Add ``chosen``: true for the first ``quota`` rows of each group in hash order.

    1. count rows per (group, hash prefix): at most 16^4 rows per group, from
       which group sizes and, through ``quota``, the quotas follow;
    2. find the prefix that holds the quota and rank only its rows;
    3. compare every row with that threshold: no shuffle of the input.

    Without groups ``quota`` is a number or a function of the row count; with
    groups it maps a table (groups..., n) to (groups..., quota).
    """
    groups = list(groups)
    slim = df.select(*groups, F.col(key).cast("string").alias("_k"), hash_order(key, seed).alias("_h"))
    slim = slim.withColumn("_p", F.substring("_h", 1, PREFIX))
    counts = settle(slim.groupBy(*groups, "_p").count())
    w = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))) \
        .orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("_upto", F.sum("count").over(w))
    if groups:
        quotas = quota(counts.groupBy(*groups).agg(F.sum("count").alias("n")))
        running = attach(running, quotas, groups)
    else:
        if callable(quota):
            quota = quota(counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0])
        running = running.withColumn("quota", F.lit(quota))
    before = F.col("_upto") - F.col("count")
    cut = running.where((before < F.col("quota")) & (F.col("_upto") >= F.col("quota"))).select(
        *groups, F.col("_p").alias("_cut"), (F.col("quota") - before).alias("_rest"))
    if not groups and isinstance(quota, int) and quota > 0:
        # a quota beyond the table takes every row
        total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
        if quota >= total:
            return df.withColumn("chosen", F.lit(True))
    cut = sent(settle(cut))
    if groups:
        near = attach(slim, cut, groups).where(F.col("_p") == F.col("_cut"))
    else:
        near = slim.join(cut, slim["_p"] == cut["_cut"])
    rank = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_h", "_k")
    limit = (near.withColumn("_n", F.row_number().over(rank))
             .where(F.col("_n") == F.col("_rest"))
             .select(*groups, F.struct("_h", "_k").alias("_limit")))
    limit = sent(settle(limit))
    marked = df.withColumn("_o", F.struct(hash_order(key, seed).alias("_h"),
                                          F.col(key).cast("string").alias("_k")))
    if groups:
        marked = attach(marked, limit, groups, "left")
    else:
        marked = marked.withColumn("_limit", limit.select("_limit").scalar())
    return marked.withColumn("chosen", F.coalesce(F.col("_o") <= F.col("_limit"), F.lit(False))) \
        .drop("_o", "_limit")


def _labelled(df: DataFrame, yes: str, no: str) -> Column:
    return F.when(F.col("chosen"), yes).otherwise(no).alias("split")


def split_random(df: DataFrame, key: str, test_size: float = 0.20, seed: int = 42) -> DataFrame:
    """Exactly ceil(test_size * n) test rows."""
    marked = mark_first_by_hash(df.select(key), key, lambda n: math.ceil(test_size * n), seed=seed)
    return marked.select(key, _labelled(marked, "test", "train"))


def split_nested(split: DataFrame, key: str, test_size: float = 0.20, seed: int = 42) -> DataFrame:
    """Cut a validation set out of the train rows; test rows stay."""
    train = split.where(F.col("split") == "train")
    marked = mark_first_by_hash(train.select(key), key, lambda n: math.ceil(test_size * n), seed=seed)
    rest = split.where(F.col("split") != "train").select(key, "split")
    return marked.select(key, _labelled(marked, "validation", "train")).unionByName(rest)


def split_tail(df: DataFrame, order: str, fraction: float = 0.15) -> DataFrame:
    """The last rows in key order become validation."""
    keep = math.floor(df.count() * (1 - fraction))
    numbered = number_rows(df.select(order), [F.col(order)])
    return numbered.select(order, F.when(F.col("position") > keep, "validation")
                           .otherwise("train").alias("split"))


def stratified_quotas(sizes: DataFrame, label: str, test_size: float = 0.20) -> DataFrame:
    """Test rows per class by largest remainder: the total is exactly ceil(test_size * n).

    ``sizes`` has one row per class: (label, n).
    """
    whole = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(whole)
    n_test = F.ceil(F.lit(test_size) * total).cast("long")
    based = sizes.select(label, n_test.alias("_t"), "n", total.alias("_all")) \
        .select(label, "_t", F.expr("_t * n div _all").alias("_base"),
                (F.col("_t") * F.col("n") % F.col("_all")).alias("_rest"))
    short = F.col("_t") - F.sum("_base").over(whole)
    order = F.row_number().over(whole.orderBy(F.desc("_rest"), label))
    return based.select(label, (F.col("_base") + (order <= short).cast("long")).alias("quota"))


def split_stratified(df: DataFrame, key: str, label: str, test_size: float = 0.20,
                     seed: int = 42) -> DataFrame:
    marked = mark_first_by_hash(df.select(key, label), key,
                                lambda sizes: stratified_quotas(sizes, label, test_size), [label], seed)
    return marked.select(key, label, _labelled(marked, "test", "train"))


def split_persist(train: DataFrame, test: DataFrame, key: str, label: str) -> DataFrame:
    """(key, split, label) table of both sets, ordered by key."""
    def side(df, name):
        return df.select(key, F.lit(name).alias("split"), label)
    return side(train, "train").unionByName(side(test, "test")).orderBy(key)


def split_apply(df: DataFrame, split: DataFrame, key: str) -> DataFrame:
    """Reuse a stored split: only rows listed in it, with their set."""
    return df.join(split.select(key, "split"), key)


def split_integrity(split: DataFrame, key: str, expected: Mapping[str, int] | None = None) -> DataFrame:
    """Duplicate keys, keys in more than one set and set sizes, from one group-by on the key."""
    expected = dict(expected or {})
    s = F.col("split")
    per_key = split.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), (F.min(s) != F.max(s)).alias("both"),
        count_if(s == "train").alias("train"), count_if(s == "test").alias("test"))
    sums = per_key.agg(
        count_if(F.col("n") > 1).alias("duplicate_keys"), count_if(F.col("both")).alias("shared_keys"),
        F.coalesce(F.sum("train"), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum("test"), F.lit(0)).alias("test_rows"))
    wanted = {"duplicate_keys": 0, "shared_keys": 0,
              "train_rows": expected.get("train"), "test_rows": expected.get("test")}
    cells = [F.struct(F.lit(c).alias("check"), F.col(c).alias("value"),
                      (F.col(c) > 0 if v is None else F.col(c) == v).alias("ok"))
             for c, v in wanted.items()]
    return sums.select(F.inline(F.array(*cells)))


def split_distribution(split: DataFrame, label: str,
                       sets: Sequence[str] = ("train", "test")) -> DataFrame:
    """Rows per set and class with empty cells kept; pct is within the set."""
    wide = split.groupBy(label).agg(*[count_if(F.col("split") == s).alias(s) for s in sets])
    total = Window.partitionBy("split")
    return wide.unpivot([label], list(sets), "split", "count").select(
        "split", label, "count", percent(F.col("count"), F.sum("count").over(total)).alias("pct"))


def stratification_check(split: DataFrame, label: str) -> DataFrame:
    """Class percentages overall, in train and in test, with their differences."""
    s = F.col("split")
    wide = split.groupBy(label).agg(F.count(F.lit(1)).alias("all"), count_if(s == "train").alias("train"),
                                    count_if(s == "test").alias("test"))
    whole = Window.partitionBy(F.lit(0))

    def pct(c):
        return percent(F.col(c), F.sum(c).over(whole))
    return wide.select(label, pct("all").alias("pct_total"), pct("train").alias("pct_train"),
                       pct("test").alias("pct_test")).select(
        "*", (F.col("pct_train") - F.col("pct_total")).alias("diff_train"),
        (F.col("pct_test") - F.col("pct_total")).alias("diff_test"))


def class_balance(df: DataFrame, label: str, labels: Sequence[str]) -> DataFrame:
    y = F.col(label)
    wide = df.agg(F.count(F.lit(1)).alias("rows"), count_if(y.isNull()).alias("missing"),
                  count_if(~y.isin(list(labels))).alias("invalid"),
                  *[count_if(y == v).alias(f"c{i}") for i, v in enumerate(labels)])
    cells = [F.struct(F.lit(v).alias("label"), F.col(f"c{i}").alias("count"),
                      percent(F.col(f"c{i}"), F.col("rows")).alias("pct"), "missing", "invalid")
             for i, v in enumerate(labels)]
    return wide.select(F.inline(F.array(*cells)))


def imbalance_ratio(df: DataFrame, label: str) -> DataFrame:
    """Majority and minority class and their ratio; ties go to the smaller label."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("v")).count()
    return counts.agg(
        F.min(F.struct((-F.col("count")).alias("c"), "v")).alias("big"),
        F.min(F.struct(F.col("count").alias("c"), "v")).alias("small")
    ).select(F.col("big.v").alias("majority"), (-F.col("big.c")).alias("majority_count"),
             F.col("small.v").alias("minority"), F.col("small.c").alias("minority_count"),
             ratio(-F.col("big.c"), F.col("small.c")).alias("ratio"))
