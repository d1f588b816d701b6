"""The scale-safe helpers give the same rows as their single-task forms."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from tallygrid.functions.radix import quantiles
from tallygrid.functions.scale import number_rows, windowed


@pytest.fixture(scope="module")
def skewed(spark):
    # key 0 holds about a third of the rows; many ties and a heavy single value
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"),
        F.col("id").alias("seq"),
        F.when(F.col("id") % 5 == 0, 2.5)
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).cast("double").alias("x"))
    return df.cache()


@pytest.mark.parametrize("digits", [(20, 18, 13, 13), (8,) * 8])
def test_quantiles_match_percentile(skewed, digits):
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 1.0]
    got = {r["k"]: r for r in quantiles(skewed, ["k"], "x", probs, digits=digits).collect()}
    want = skewed.groupBy("k").agg(F.percentile("x", F.array(*map(F.lit, probs))).alias("q"),
                                   F.count("x").alias("n")).collect()
    assert len(got) == len(want)
    for row in want:
        assert got[row["k"]]["n"] == row["n"]
        np.testing.assert_allclose(got[row["k"]]["q"], row["q"], rtol=1e-12)


@pytest.mark.parametrize("digits", [(20, 18, 13, 13), (8,) * 8])
def test_quantiles_global(skewed, digits):
    got = quantiles(skewed, [], "x", [0.25, 0.5], digits=digits).first()
    want = skewed.agg(F.percentile("x", F.array(F.lit(.25), F.lit(.5))).alias("q")).first()
    np.testing.assert_allclose(got["q"], want["q"])


def test_quantiles_empty_null_and_single(spark):
    df = spark.createDataFrame([("a", None), ("b", 3.0), ("b", None)], "k string, x double")
    got = {r["k"]: r["q"] for r in quantiles(df, ["k"], "x", [0.25, 0.5]).collect()}
    assert got == {"a": None, "b": [3.0, 3.0]}
    assert quantiles(df.where("false"), ["k"], "x", [0.5]).count() == 0
    assert quantiles(df.where("false"), [], "x", [0.5]).first()["q"] is None


def test_number_rows(skewed):
    got = number_rows(skewed, [F.col("x"), F.col("seq")], ["k"])
    w = Window.partitionBy("k").orderBy("x", "seq")
    want = skewed.withColumn("position", F.row_number().over(w))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("hot_rows", [100, 1_000_000])
def test_windowed_chunks_equal_one_window(skewed, hot_rows):
    def build(frame, w):
        return (frame.withColumn("mean5", F.round(F.avg("x").over(w.rowsBetween(-4, 0)), 9))
                .withColumn("back", F.lag("x").over(w))
                .withColumn("ahead", F.lead("x", 2).over(w)))

    got = windowed(skewed, ["k"], ["seq"], build, lookback=4, lookahead=2,
                   position="step", hot_rows=hot_rows)
    w = Window.partitionBy("k").orderBy("seq")
    want = build(skewed, w).withColumn("step", F.row_number().over(w))
    cols = ["k", "seq", "x", "mean5", "back", "ahead", "step"]
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == \
        sorted(map(tuple, want.select(*cols).collect()), key=key)


def test_forgotten_tables_leave_no_files(spark):
    import glob

    from tallygrid.functions import scale

    folder = scale.checkpoint_dir(spark).replace("file:", "")
    before = set(glob.glob(f"{folder}/**/part-*", recursive=True))
    kept, gone = scale.settle(spark.range(10)), scale.settle(spark.range(1000))
    assert len(set(glob.glob(f"{folder}/**/part-*", recursive=True)) - before) > kept.rdd.getNumPartitions()
    scale.forget(gone)
    assert len(set(glob.glob(f"{folder}/**/part-*", recursive=True)) - before) == kept.rdd.getNumPartitions() and kept.count() == 10
