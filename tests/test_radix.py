"""Radix selection: keys sort like doubles, and quantiles equal sorted values whatever the digits."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrid.functions.radix import ordered_bits, quantiles

SPECIAL = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, -math.inf,
           1.0, math.nextafter(1, 0), math.nextafter(1, 2), 0.1, -0.1, 1e22, 3.0, 2.0 ** 60, math.nextafter(2.0 ** 60, 0), 8.0, math.nextafter(8, 0)]


def doubles():
    rng = random.Random(3)
    powers = [s * 2.0 ** e for e in range(-1074, 1024, 7) for s in (1, -1)]
    close = [math.nextafter(p, d) for p in powers[::3] for d in (0, math.inf)]
    bits = [struct.unpack("d", rng.randbytes(8))[0] for _ in range(3000)]
    return SPECIAL + powers + close + [b for b in bits if not math.isnan(b)]


def test_keys_equal_the_bits(spark):
    df = spark.createDataFrame([(v,) for v in [*doubles(), None]], "x double")
    for r in ordered_bits(df, "x", "k").collect():
        if r["x"] is None:
            assert r["k"] is None
            continue
        size = struct.unpack("q", struct.pack("d", abs(r["x"])))[0]
        assert r["k"] == (-size if r["x"] < 0 else size), r


@pytest.mark.parametrize("digits", [(20, 18, 13, 13), (12, 12, 12, 12, 12, 4), (4,) * 16, (64,)])
def test_quantiles_equal_sorted_values(spark, digits):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([rng.gauss(0, 1), rng.lognormvariate(0, 9), 2.5, round(rng.random(), 2), -7.0])) for _ in range(4000)]
    rows += [("one", 4.0), ("none", None), ("none", float("nan")), ("zeros", 0.0), ("zeros", -0.0), ("far", math.inf), ("far", 1.0), ("same", 3.5)] + [("same", 3.5)] * 50
    probs = [0.0, 0.013, 0.25, 0.5, 0.75, 0.999, 1.0]
    df = spark.createDataFrame(rows, "k string, x double").repartition(7)
    got = {r["k"]: r for r in quantiles(df, ["k"], "x", probs, extra=[F.max("x").alias("top")], digits=digits).collect()}
    groups = {k: [x for g, x in rows if g == k and x is not None and not math.isnan(x)] for k in {g for g, _ in rows}}
    assert set(got) == set(groups)
    for k, values in groups.items():
        assert got[k]["n"] == len(values)
        if not values:
            assert got[k]["q"] is None
        elif k == "far":
            assert got[k]["q"][0] == 1.0 and got[k]["q"][-1] == math.inf
        else:
            np.testing.assert_allclose(got[k]["q"], np.quantile(values, probs), rtol=1e-12, atol=1e-300)


def test_without_keys_and_without_rows(spark):
    df = spark.createDataFrame([(float(v),) for v in (5, 1, 4, 1, 3)], "x double")
    assert quantiles(df, [], "x", [0.5, 0.25]).first()["q"] == [1.0, 3.0]
    empty = df.where("false")
    assert quantiles(empty, [], "x", [0.5]).first().asDict() == {"n": 0, "q": None}
    assert quantiles(empty.withColumn("k", F.lit(1)), ["k"], "x", [0.5]).collect() == []


def test_exchange_of_brackets_equals_sent_brackets(spark, monkeypatch):
    import tallygrid.functions.radix as radix
    df = spark.range(3000).select((F.col("id") % 40).alias("k"), (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 7).alias("x"))
    sent = sorted(map(str, quantiles(df, ["k"], "x", [0.1, 0.5], digits=(12, 12, 40)).collect()))
    monkeypatch.setattr(radix, "SENT_BRACKETS", 5)
    assert sorted(map(str, quantiles(df, ["k"], "x", [0.1, 0.5], digits=(12, 12, 40)).collect())) == sent
