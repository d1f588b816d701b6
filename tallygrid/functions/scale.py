"""Building blocks that keep every task bounded, whatever the key distribution.

* ``settle``             - cut lineage with a reliable checkpoint.
* ``forget``             - delete a settled table that was read for the last time.
* ``release``            - let go of shuffle files of finished steps.
* ``sent``               - send a counted small table to all tasks instead of dealing the large one by its keys.
* ``number_rows``        - consecutive numbers without a single-task window.
* ``windowed``           - window functions that split oversized groups.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

HOT_ROWS = 2_000_000
#: Rows of a table that ``sent`` sends to all tasks.
SENT_ROWS = 10_000


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one inside the warehouse, which executors share too."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"
    sc.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so later stages neither recompute nor re-plan it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def forget(settled: DataFrame) -> None:
    """Delete the files of a settled table that nothing will read again."""
    file = settled._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        sc = settled.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let go of shuffle files of finished steps now.

    Spark deletes them once the driver's collector finds their plans unreachable,
    which a roomy driver may not look for until long after the disks are full. Plans,
    stages and dependencies are found one after another, hence the rounds.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def sent(settled: DataFrame) -> DataFrame:
    """A settled table to join with: sent to all tasks if it has at most ``SENT_ROWS`` rows.

    A join with one row per group deals the other side by group otherwise, and a few groups make a few tasks.
    """
    return F.broadcast(settled) if settled.limit(SENT_ROWS + 1).count() <= SENT_ROWS else settled


def attach(df: DataFrame, small: DataFrame, keys: Sequence[str],
           how: str = "inner") -> DataFrame:
    """Null-safe equi-join that keeps the left copy of the keys."""
    renamed = small.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k)
                             for k in small.columns])
    condition = None
    for k in keys:
        part = df[k].eqNullSafe(renamed[f"_r_{k}"])
        condition = part if condition is None else condition & part
    return df.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def number_rows(df: DataFrame, order: Sequence[Column], partition: Sequence[str] = (),
                out: str = "position") -> DataFrame:
    """Number rows 1..n per partition value in the given order.

    A range-partitioned sort spreads one group over many tasks; each task numbers
    its own rows and a small table of run lengths supplies the offsets.
    """
    tagged = settle(
        df.orderBy(*[F.col(p) for p in partition], *order)
        .withColumn("_slot", F.monotonically_increasing_id()))
    tagged = tagged.withColumn("_task", F.shiftright("_slot", 33))
    runs = (tagged.groupBy("_task", *partition)
            .agg(F.min("_slot").alias("_first"), F.count(F.lit(1)).alias("_n")))
    earlier = (Window.partitionBy(*partition) if partition else Window.partitionBy(F.lit(0))) \
        .orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_task", *partition, "_first",
                       F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    joined = attach(tagged, runs, ["_task", *partition])
    return (joined.withColumn(out, F.col("_slot") - F.col("_first") + F.col("_offset") + 1)
            .drop("_slot", "_task", "_first", "_offset"))


def windowed(df: DataFrame, partition: Sequence[str], order: Sequence[str],
             build: Callable[[DataFrame, WindowSpec], DataFrame], *,
             lookback: int = 0, lookahead: int = 0, position: str | None = None,
             hot_rows: int = HOT_ROWS) -> DataFrame:
    """Apply ``build(frame, window)`` per group; groups above ``hot_rows`` are cut into chunks.

    ``build`` may look at most ``lookback`` rows back and ``lookahead`` rows ahead.
    A chunk receives copies of that many neighbour rows, so results equal those of
    one undivided window. ``position`` adds the row number inside the group.
    """
    partition, order = list(partition), list(order)
    hot = (df.groupBy(*partition).count().where(F.col("count") > hot_rows)
           .select(*partition))
    some = hot.limit(1).collect()
    plain = Window.partitionBy(*partition).orderBy(*order)

    def cold_path(frame: DataFrame) -> DataFrame:
        if position:
            frame = frame.withColumn(position, F.row_number().over(plain).cast("long"))
        return build(frame, plain)

    if not some:
        return cold_path(df)

    hot = settle(hot)
    flagged = attach(df, hot.withColumn("_hot", F.lit(True)), partition, "left")
    cold = flagged.where(F.col("_hot").isNull()).drop("_hot")
    large = flagged.where(F.col("_hot")).drop("_hot")
    rn = "_rn"
    numbered = number_rows(large, [F.col(c) for c in order], partition, rn)
    size = max(hot_rows, lookback + 1, lookahead + 1)
    home = F.floor((F.col(rn) - 1) / size)
    place = (F.col(rn) - 1) % size
    copies = F.array_compact(F.array(
        home,
        F.when(place >= size - lookback, home + 1),
        F.when((place < lookahead) & (home > 0), home - 1)))
    spread = (numbered.withColumn("_home", home)
              .withColumn("_chunk", F.explode(copies)))
    if position:
        spread = spread.withColumn(position, F.col(rn).cast("long"))
    chunked = build(spread, Window.partitionBy(*partition, "_chunk").orderBy(*order))
    chunked = (chunked.where(F.col("_chunk") == F.col("_home"))
               .drop("_chunk", "_home", rn))
    return cold_path(cold).unionByName(chunked)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Materialise a training table in even hash partitions.

    Iterative fits read it many times; one shuffle now keeps every pass balanced.
    The number of partitions is left to AQE, which merges small ones.
    """
    return settle(df.repartition(F.col(key)))
