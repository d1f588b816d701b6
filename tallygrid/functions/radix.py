"""Exact interpolated quantiles by radix selection.

A double becomes a 64-bit key of the same order. A pass counts the leading digit of the keys of every group; the
digit that holds a wanted rank is kept, and the next pass counts the next digit inside it only. A bracket whose smallest
and largest value agree is done. The digits of ``DIGITS`` bits bound what a pass keeps of a group (at most 2**20
counts, whatever the input) and the number of passes (four). No pass sorts values or keeps a sketch of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .scale import attach, settle

#: Bits per pass: sign, exponent and the first of the fraction; then the rest of the fraction.
DIGITS = (20, 18, 13, 13)
#: Open brackets that a pass sends to all tasks; more of them are joined by an exchange.
SENT_BRACKETS = 10_000


def ordered_bits(df: DataFrame, value: str, out: str) -> DataFrame:
    """Add a bigint that sorts like the double: its sign times the bits of its size. Zeros are 0, null stays null, NaN must not occur.

    Built in steps, so that a row needs one logarithm and one power.
    """
    x, size, power, unit = F.col(value), F.col("_size"), F.col("_power"), F.col("_unit")
    steps = df.withColumn("_size", F.abs(x)).withColumn("_power", F.least(F.floor(F.log2("_size")), F.lit(1023)))
    steps = steps.withColumn("_unit", F.pow(F.lit(2.0), power.cast("double")))
    # a logarithm may round across a power of two
    low, high = size < unit, size >= unit * 2
    steps = steps.withColumns({"_power": power - low.cast("int") + high.cast("int"), "_unit": F.when(low, unit / 2).when(high, unit * 2).otherwise(unit)})
    normal = (power + 1023) * F.lit(2 ** 52) + ((size / unit - 1) * float(2 ** 52)).cast("bigint")
    bits = (F.when(size == float("inf"), F.lit(2047 * 2 ** 52)).when(size >= 2.0 ** -1022, normal)
            .otherwise((size * 2.0 ** 1000 * 2.0 ** 74).cast("bigint")))
    return steps.withColumn("_bits_of_size", bits).withColumn(
        out, F.when(x < 0, -F.col("_bits_of_size")).otherwise(F.col("_bits_of_size"))).drop("_size", "_power", "_unit", "_bits_of_size")


def _holding(counts: DataFrame, within: Sequence[str], want: Column, before: Column) -> DataFrame:
    """Digits of ``counts`` that hold wanted ranks, with those ranks and the number of values before the digit."""
    part = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    running = F.sum("_n").over(part.orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("_all", want).withColumn("_upto", before + running)
    ranks = F.filter("_all", lambda r: (r >= F.col("_upto") - F.col("_n")) & (r < F.col("_upto")))
    return placed.withColumn("_want", ranks).withColumn("_before", F.col("_upto") - F.col("_n")).where(F.size("_want") > 0)


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
              extra: Sequence[Column] = (), digits: Sequence[int] = DIGITS) -> DataFrame:
    """(keys..., n, q array<double>, extra...) with linear interpolation, nulls and NaN ignored.

    ``extra`` aggregates take one more pass over all rows. Groups without a value get a null array, and a table
    without rows gives no group. ``digits`` are the bits of each pass, 64 in all.
    """
    keys, probs = list(keys), sorted(probs)
    x = F.col(value).cast("double")
    x = F.when(~F.isnan(x), x)
    rows = df.select(*keys, x.alias("_x"))
    facts = [F.count("_x").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")]
    state = ["_at", "_lo", "_hi", "_want", "_before"]

    used = digits[0]
    first = settle(ordered_bits(rows, "_x", "_bits").groupBy(*keys, F.shiftright("_bits", 64 - used).alias("_at")).agg(*facts))
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    last = F.sum("_n").over(whole) - 1
    wanted = F.array_distinct(F.array(*[r for p in probs for r in (F.floor(last * F.lit(float(p))), F.ceil(last * F.lit(float(p))))]))
    held = settle(_holding(first.where(F.col("_at").isNotNull()), keys, wanted, F.lit(0).cast("bigint")).select(*keys, *state))
    done = []
    for width in [*digits[1:], 0]:
        single = F.lit(not width) | (F.col("_lo") == F.col("_hi"))
        done.append(held.where(single).select(*keys, F.explode("_want").alias("_rank"), F.col("_lo").alias("_value")))
        opened = held.where(~single)
        brackets = opened.count() if width else 0
        if not brackets:
            break
        # the values between the smallest and the largest one of a bracket are those in it
        inside = opened.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col("_at").alias("_in"), F.col("_lo").alias("_from"), F.col("_hi").alias("_to"))
        match = F.col("_x").between(F.col("_from"), F.col("_to"))
        for k in keys:
            match &= F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        kept = rows.where(F.col("_x").isNotNull()).join(F.broadcast(inside) if brackets <= SENT_BRACKETS else inside, match)
        used += width
        counts = ordered_bits(kept.select(*keys, "_in", "_x"), "_x", "_bits").groupBy(*keys, "_in", F.shiftright("_bits", 64 - used).alias("_at")).agg(*facts)
        known = opened.select(*keys, F.col("_at").alias("_in"), F.col("_want").alias("_parent"), F.col("_before").alias("_start"))
        held = settle(_holding(attach(counts, known, [*keys, "_in"]), [*keys, "_in"], F.col("_parent"), F.col("_start")).select(*keys, *state))

    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    found = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_values"))
    if extra:
        kept = settle(df.groupBy(*keys).agg(F.count(x).alias("n"), *extra))
    else:
        kept = first.groupBy(*keys).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
    last = F.col("n") - 1

    def at(p: float) -> Column:
        h = last * F.lit(float(p))
        low, high = F.try_element_at("_values", F.floor(h)), F.try_element_at("_values", F.ceil(h))
        return low + F.when(low == high, 0.0).otherwise((high - low) * (h - F.floor(h)))

    both = attach(kept, found, keys, "left") if keys else kept.withColumn("_values", found.select("_values").scalar())
    return both.withColumn("q", F.when(F.col("n") > 0, F.array(*[at(p) for p in probs]))).drop("_values")
