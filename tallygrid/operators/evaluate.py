"""Evaluation, comparison and ranking of predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import count_if, ratio
from .profile import ranked


def prediction_table(pred: DataFrame, key: str) -> DataFrame:
    error = F.col("predicted") - F.col("actual")
    return pred.select(key, "actual", "predicted", error.alias("error"), F.abs(error).alias("abs_error"))


def _regression_aggs() -> list[Column]:
    e = F.col("actual") - F.col("predicted")
    return [F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
            F.sqrt(F.avg(e * e)).alias("rmse"),
            (1 - ratio(F.avg(e * e), F.var_pop("actual"))).alias("r2")]


def regression_metrics(pred: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    return pred.groupBy(*by).agg(*_regression_aggs())


def train_test_gap(metrics: DataFrame) -> DataFrame:
    """RMSE gap and ratio between the sets, per model when there is a model column."""
    by = [c for c in ("model",) if c in metrics.columns]
    wide = metrics.groupBy(*by).agg(
        F.max(F.when(F.col("split") == "train", F.col("rmse"))).alias("rmse_train"),
        F.max(F.when(F.col("split") == "test", F.col("rmse"))).alias("rmse_test"))
    return wide.select(*by, "rmse_train", "rmse_test",
                       (F.col("rmse_test") - F.col("rmse_train")).alias("gap"),
                       ratio(F.col("rmse_test"), F.col("rmse_train")).alias("ratio"))


def stack_models(preds: Mapping[str, DataFrame]) -> DataFrame:
    stacked = None
    for model, pred in preds.items():
        part = pred.select(F.lit(model).alias("model"), "split", "actual", "predicted")
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


def model_table(preds: Mapping[str, DataFrame], labels: Sequence[str] | None = None) -> DataFrame:
    """One row per model and set: regression metrics, or class metrics when labels are given."""
    stacked = stack_models(preds)
    if labels is None:
        return regression_metrics(stacked, ["model", "split"])
    return classification_metrics(stacked, labels, ["model", "split"])


def model_delta(table: DataFrame, metric: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """metric(first) - metric(second), absolute and in percent of the second."""
    spark = table.sparkSession
    values = table.select("model", F.col(metric).alias("v"))
    wanted = F.broadcast(spark.createDataFrame(list(pairs), "a string, b string"))
    joined = (wanted.join(values.select(F.col("model").alias("a"), F.col("v").alias("va")), "a")
              .join(values.select(F.col("model").alias("b"), F.col("v").alias("vb")), "b"))
    delta = F.col("va") - F.col("vb")
    return joined.select(F.concat("a", F.lit("_vs_"), "b").alias("comparison"), delta.alias("delta"),
                         (ratio(delta, F.col("vb")) * 100).alias("delta_pct"))


def model_ranking(table: DataFrame, metric: str, ascending: bool = True) -> DataFrame:
    order = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    return ranked(table.select("model", metric), order, F.col("model")).select("rank", "model", metric)


def rmse_pct_range(pred: DataFrame) -> DataFrame:
    e = F.col("actual") - F.col("predicted")
    return pred.agg(F.sqrt(F.avg(e * e)).alias("rmse"),
                    (F.max("actual") - F.min("actual")).alias("target_range")).withColumn(
        "rmse_pct_range", ratio(F.col("rmse"), F.col("target_range")) * 100)


def metrics_long(table: DataFrame, cols: Sequence[str]) -> DataFrame:
    return table.unpivot(["model"], list(cols), "metric", "value")


def best_models(table: DataFrame, metrics: Mapping[str, bool]) -> DataFrame:
    """Winner and runner-up per metric; ``metrics`` maps a name to "smaller is better"."""
    long = metrics_long(table, list(metrics)).where(F.col("value").isNotNull())
    rising = [m for m, up in metrics.items() if up]
    score = F.when(F.col("metric").isin(rising), F.col("value")).otherwise(-F.col("value"))
    w = Window.partitionBy("metric").orderBy(score, "model")
    top = long.withColumn("place", F.row_number().over(w)).where(F.col("place") <= 2)

    def at(place, column):
        return F.max(F.when(F.col("place") == place, F.col(column)))
    delta = F.col("winner_value") - F.col("runner_up_value")
    return top.groupBy("metric").agg(
        at(1, "model").alias("winner"), at(1, "value").alias("winner_value"),
        at(2, "model").alias("runner_up"), at(2, "value").alias("runner_up_value")
    ).withColumn("delta", delta).withColumn(
        "delta_pct", ratio(delta, F.col("runner_up_value")) * 100)


def confusion_matrix(pred: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per actual label, one column per predicted label, zeros kept."""
    counts = pred.groupBy("actual").agg(
        *[count_if(F.col("predicted") == v).alias(v) for v in labels])
    rows = pred.sparkSession.createDataFrame([(v,) for v in labels], "actual string")
    return F.broadcast(rows).join(counts, "actual", "left").na.fill(0)


def per_class_metrics(pred: DataFrame, labels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Support, hits, errors, precision, recall, F1; undefined ratios are 0.

    The rows collapse to actual x predicted counts first; the rest works on that.
    """
    counts = pred.groupBy(*by, "actual", "predicted").count()
    wide = counts.groupBy(*by).agg(*[e for i, v in enumerate(labels) for e in (
        F.sum(F.when(F.col("actual") == v, F.col("count")).otherwise(0)).alias(f"s{i}"),
        F.sum(F.when(F.col("predicted") == v, F.col("count")).otherwise(0)).alias(f"p{i}"),
        F.sum(F.when((F.col("actual") == v) & (F.col("predicted") == v), F.col("count"))
              .otherwise(0)).alias(f"h{i}"))])
    cells = []
    for i, v in enumerate(labels):
        s, p, h = F.col(f"s{i}"), F.col(f"p{i}"), F.col(f"h{i}")
        cells.append(F.struct(F.lit(v).alias("label"), s.alias("support"), h.alias("hits"),
                              (s - h).alias("errors"),
                              F.coalesce(ratio(h, p), F.lit(0.0)).alias("precision"),
                              F.coalesce(ratio(h, s), F.lit(0.0)).alias("recall"),
                              F.coalesce(ratio(2 * h, s + p), F.lit(0.0)).alias("f1")))
    return wide.select(*by, F.inline(F.array(*cells)))


def _rollup() -> list[Column]:
    support = F.col("support")
    return [
        ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.avg(F.when(support > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        ratio(F.sum(F.col("f1") * support), F.sum("support")).alias("weighted_f1"),
        ratio(F.sum(F.col("precision") * support), F.sum("support")).alias("_wp"),
        ratio(F.sum(F.col("recall") * support), F.sum("support")).alias("_wr"),
        F.sum("support").alias("_n")]


def classification_metrics(pred: DataFrame, labels: Sequence[str],
                           by: Sequence[str] = ("split",)) -> DataFrame:
    return per_class_metrics(pred, labels, by).groupBy(*by).agg(*_rollup()).drop("_wp", "_wr", "_n")


def classification_gap(metrics: DataFrame) -> DataFrame:
    """Train minus test for accuracy, balanced accuracy and macro F1."""
    names = ("accuracy", "balanced_accuracy", "macro_f1")

    def at(split, m):
        return F.max(F.when(F.col("split") == split, F.col(m)))
    return metrics.agg(*[(at("train", m) - at("test", m)).alias(f"gap_{m}") for m in names])


def classification_report(pred: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Class rows, then accuracy, macro and weighted averages."""
    classes = per_class_metrics(pred, labels)
    roll = classes.agg(*_rollup())
    rows = [F.struct(F.lit(name).alias("row"), *[F.col(c).alias(n) for c, n in
                                                  zip(cols, ("precision", "recall", "f1"))],
                     F.col("_n").alias("support"))
            for name, cols in (("accuracy", ("accuracy",) * 3),
                               ("macro avg", ("macro_precision", "macro_recall", "macro_f1")),
                               ("weighted avg", ("_wp", "_wr", "weighted_f1")))]
    return classes.select(F.col("label").alias("row"), "precision", "recall", "f1", "support") \
        .unionByName(roll.select(F.inline(F.array(*rows))))


def best_model_per_class(class_metrics: DataFrame, models: Sequence[str]) -> DataFrame:
    """Highest recall per class; the model listed first wins ties."""
    place = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    best = class_metrics.groupBy("label").agg(
        F.min(F.struct((-F.col("recall")).alias("r"), place.alias("o"), "model")).alias("b"))
    return best.select("label", F.col("b.model").alias("model"), (-F.col("b.r")).alias("recall"))


def best_config(metrics: DataFrame, order_by: Sequence[tuple[str, str]]) -> DataFrame:
    """First row under an ordered list of (column, "asc" | "desc") criteria."""
    order = [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last()
             for c, d in order_by]
    return metrics.orderBy(*order).limit(1)
