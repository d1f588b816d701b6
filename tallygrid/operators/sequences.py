"""Summaries of logged episodes and batch value iteration over their transitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import count_if, ratio
from ..functions.scale import HOT_ROWS, settle, windowed

# Fixed value: the state after the last logged step of an episode.
END = "end"
# Transition tables up to this many rows are swept inside one partition.


def episode_rollup(steps: DataFrame) -> DataFrame:
    return steps.groupBy("episode").agg(
        F.sum("reward").alias("total_reward"), F.count(F.lit(1)).alias("steps"),
        F.bool_or("is_goal").alias("reached_goal"))


def rolling_mean(df: DataFrame, partition: str, order: Sequence[str], col: str, window: int = 50,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Mean of the last ``window`` rows per partition value, shorter at the start."""
    key = order[-1]

    def build(frame, w):
        return frame.withColumn("rolling_mean", F.avg(col).over(w.rowsBetween(1 - window, 0)))

    slim = df.select(partition, *order, col)
    out = windowed(slim, [partition], order, build, lookback=window - 1, hot_rows=hot_rows)
    return out.select(key, F.col(col).alias("value"), "rolling_mean")


def episode_evaluation(episodes: DataFrame) -> DataFrame:
    won = F.col("reached_goal")
    return episodes.agg(
        F.count(F.lit(1)).alias("episodes"),
        ratio(count_if(won), F.count(F.lit(1))).alias("success_rate"),
        F.avg(F.when(won, F.col("steps"))).alias("mean_steps_success"),
        F.avg("total_reward").alias("mean_reward"))


def transition_table(steps: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Counts, mean reward and terminal share per (state, action, next state)."""
    def build(frame, w):
        return frame.withColumn("next_state", F.coalesce(F.lead("state").over(w), F.lit(END)))

    slim = steps.select("episode", "step", "state", "action", "reward", "is_goal")
    moved = windowed(slim, ["episode"], ["step"], build, lookahead=1, hot_rows=hot_rows)
    return moved.groupBy("state", "action", "next_state").agg(
        F.count(F.lit(1)).alias("count"), F.avg("reward").alias("mean_reward"),
        ratio(count_if(F.col("is_goal")), F.count(F.lit(1))).alias("terminal_share"))


def q_iteration(transitions: DataFrame, gamma: float = 0.95, sweeps: int = 20,
                settle_every: int = 5) -> DataFrame:
    """Batch Q update: expected reward plus gamma times the best value of the next state.

    Terminal moves take the reward alone. Each sweep is one group-by and one
    join over the transition table; a checkpoint keeps the plan short.
    """
    moves = settle(transitions)
    q = moves.select("state", "action").distinct().withColumn("q", F.lit(0.0))
    for sweep in range(1, sweeps + 1):
        value = q.groupBy(F.col("state").alias("next_state")).agg(F.max("q").alias("v"))
        target = F.col("mean_reward") + gamma * (1 - F.col("terminal_share")) * F.coalesce("v", F.lit(0.0))
        q = moves.join(value, "next_state", "left").groupBy("state", "action").agg(
            (F.sum(F.col("count") * target) / F.sum("count")).alias("q"))
        if sweep % settle_every == 0:
            q = settle(q)
    return q


def greedy_policy(q: DataFrame) -> DataFrame:
    """Best action per state; ties go to the smaller action."""
    best = q.groupBy("state").agg(F.min(F.struct((-F.col("q")).alias("n"), "action")).alias("b"))
    return best.select("state", F.col("b.action").alias("action"), (-F.col("b.n")).alias("q"))
