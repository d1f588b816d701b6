"""Tree, forest, boosted and support-vector models on Spark ML.

Training tables hold a key, a vector column and the target. Every fit runs on
the executors; a model on the driver is bounded by tree depth, tree count or
weight count, never by rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scale import checkpoint_dir
from ..functions.vectors import as_array, lists, matrix
from . import forest, hinge
from .evaluate import classification_metrics
from .features import label_encode
from .growing import GrownTree, grow, scored
from .profile import ranked

# Spark's depth limit stands for "unrestricted".
MAX_DEPTH = 30
#: Rows whose kernel features are made at once, few enough for a core's cache.
LIFT_ROWS = 256


def _plain(df: DataFrame, features: str) -> DataFrame:
    """Drop attribute metadata, so one-hot slots split on a threshold like any number."""
    return df.withColumn(features, F.col(features).alias(features, metadata={}))


def _sets(train: DataFrame, test: DataFrame, key: str, features: str, target: str) -> DataFrame:
    """(key, split, actual, features) of both sets."""
    def side(df, name):
        return df.select(key, F.lit(name).alias("split"), F.col(target).alias("actual"), features)
    return side(train, "train").unionByName(side(test, "test"))


def predictions(model, train: DataFrame, test: DataFrame, key: str, target: str,
                features: str) -> DataFrame:
    """(key, split, actual, predicted) for both sets."""
    if isinstance(model, (GrownTree, forest.Forest)):
        apply = scored if isinstance(model, GrownTree) else forest.scored
        return apply(model, _sets(train, test, key, features, target), features, [key, "split", "actual"]) \
            .withColumnRenamed("prediction", "predicted")

    def side(df, name):
        scored = model.transform(_plain(df.select(key, features, target), features))
        return scored.select(key, F.lit(name).alias("split"), F.col(target).alias("actual"),
                             F.col("prediction").alias("predicted"))
    return side(train, "train").unionByName(side(test, "test"))


# ---------------------------------------------------------------- regression

def _known(target: str) -> Column:
    """The target as a number; null and NaN are errors."""
    y = F.col(target).cast("double")
    return F.when(y.isNotNull() & ~F.isnan(y), y).otherwise(F.raise_error(F.lit("labels must not be null or NaN")).cast("double"))


def fit_tree_regression(train: DataFrame, features: str, target: str, max_depth: int = MAX_DEPTH,
                        max_bins: int = 64, min_leaf: int = 1, seed: int = 42) -> GrownTree:
    return grow(train, features, [_known(target)], max_depth, max_bins, min_leaf, seed)


def tree_regression(train: DataFrame, test: DataFrame, features: str, target: str, key: str,
                    **params) -> DataFrame:
    model = fit_tree_regression(train, features, target, **params)
    return predictions(model, train, test, key, target, features)


def fit_forest_regression(train: DataFrame, features: str, target: str, trees: int = 300,
                          max_depth: int = MAX_DEPTH, max_bins: int = 64, min_leaf: int = 1, seed: int = 42) -> forest.Forest:
    return forest.fit(train, features, _known(target), trees, max_depth, max_bins, min_leaf, seed)


def forest_regression(train: DataFrame, test: DataFrame, features: str, target: str, key: str,
                      trees: int = 300, **params) -> DataFrame:
    model = fit_forest_regression(train, features, target, trees, **params)
    return predictions(model, train, test, key, target, features)


def fit_boosted_regression(train: DataFrame, features: str, target: str, rounds: int = 500,
                           max_depth: int = 3, rate: float = 0.03, rows: float = 0.8,
                           columns: float = 0.8, seed: int = 42):
    checkpoint_dir(train.sparkSession)
    return GBTRegressor(
        featuresCol=features, labelCol=target, maxIter=rounds, maxDepth=max_depth, stepSize=rate,
        subsamplingRate=rows, featureSubsetStrategy=str(columns), cacheNodeIds=True,
        checkpointInterval=10, seed=seed).fit(_plain(train, features))


def boosted_regression(train: DataFrame, test: DataFrame, features: str, target: str, key: str,
                       **params) -> DataFrame:
    model = fit_boosted_regression(train, features, target, **params)
    return predictions(model, train, test, key, target, features)


# ---------------------------------------------------------------- fitted trees as tables

def tree_nodes(model) -> DataFrame:
    """Nodes of a fitted tree; those of a Spark tree are read back from its saved form."""
    if isinstance(model, GrownTree):
        return model.nodes
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    path = f"{checkpoint_dir(spark)}/tallygrid-tree-{uuid.uuid4().hex}"
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    split = F.col("split")
    leaf = F.col("leftChild") < 0
    return data.select(
        "id", leaf.alias("is_leaf"), "prediction", "impurity", F.col("rawCount").alias("count"), "gain",
        F.when(~leaf, F.col("leftChild")).alias("left"), F.when(~leaf, F.col("rightChild")).alias("right"),
        F.when(~leaf, split["featureIndex"]).alias("feature"),
        F.when(~leaf, F.element_at(split["leftCategoriesOrThreshold"], 1)).alias("threshold"))


def tree_complexity(model) -> DataFrame:
    nodes = model.numNodes
    return tree_nodes(model).agg(F.sum(F.col("is_leaf").cast("int")).alias("leaves")).select(
        F.lit(nodes).alias("nodes"), F.lit(model.depth).alias("depth"), "leaves")


def feature_importance(model, names: Sequence[tuple[str, str]]) -> DataFrame:
    """(rank, feature, importance); ``names`` lists (feature, column) in vector order."""
    values = model.importances() if isinstance(model, GrownTree) else model.featureImportances.toArray()
    if len(values) != len(names):
        raise ValueError(f"{len(values)} importances for {len(names)} features")
    rows = [(f, float(v)) for (f, _), v in zip(names, values)]
    from pyspark.sql import SparkSession
    table = SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")
    return ranked(table, F.desc("importance"), F.col("feature")).select("rank", "feature", "importance")


def importance_by_column(model, names: Sequence[tuple[str, str]]) -> DataFrame:
    """Importance summed over the features that came from one column."""
    per = feature_importance(model, names)
    origin = per.sparkSession.createDataFrame(list(names), "feature string, variable string")
    return per.join(F.broadcast(origin), "feature").groupBy("variable").agg(
        F.sum("importance").alias("importance"))


# ---------------------------------------------------------------- classification

def _coded(df: DataFrame, key: str, features: str, label: str, labels: Sequence[str]) -> DataFrame:
    rows = label_encode(df.select(key, features, label), label, labels)
    return _plain(rows.withColumn("label_id", F.col("label_id").cast("double")), features)


def _class_predictions(model, train, test, key, features, label, labels) -> DataFrame:
    names = F.array(*[F.lit(v) for v in labels])

    def side(df, name):
        scored = model.transform(_coded(df, key, features, label, labels))
        return scored.select(key, F.lit(name).alias("split"), F.col(label).alias("actual"),
                             names[F.col("prediction").cast("int")].alias("predicted"))
    return side(train, "train").unionByName(side(test, "test"))


def tree_classification(train: DataFrame, test: DataFrame, features: str, label: str,
                        labels: Sequence[str], key: str, max_depth: int = MAX_DEPTH,
                        max_bins: int = 64, min_leaf: int = 1, seed: int = 42) -> DataFrame:
    model = grow(_coded(train, key, features, label, labels), features, [F.col("label_id") == i for i in range(len(labels))],
                 max_depth, max_bins, min_leaf, seed)
    rows = label_encode(_sets(train, test, key, features, label), "actual", labels)
    names = F.array(*[F.lit(v) for v in labels])
    return scored(model, rows, features, [key, "split", "actual", "label_id"]).where(F.col("label_id").isNotNull()).select(
        key, "split", "actual", names[F.col("prediction").cast("int")].alias("predicted"))


def forest_classification(train: DataFrame, test: DataFrame, features: str, label: str,
                          labels: Sequence[str], key: str, trees: int = 300,
                          max_depth: int = MAX_DEPTH, max_bins: int = 64, min_leaf: int = 1, seed: int = 42) -> DataFrame:
    model = RandomForestClassifier(
        featuresCol=features, labelCol="label_id", numTrees=trees, maxDepth=max_depth,
        maxBins=max_bins, minInstancesPerNode=min_leaf, cacheNodeIds=True,
        maxMemoryInMB=1024, seed=seed).fit(_coded(train, key, features, label, labels))
    return _class_predictions(model, train, test, key, features, label, labels)


def boosted_multiclass(train: DataFrame, test: DataFrame, features: str, label: str,
                       labels: Sequence[str], key: str, rounds: int = 300, max_depth: int = 3,
                       rate: float = 0.05, rows: float = 0.8, columns: float = 0.8,
                       seed: int = 42) -> DataFrame:
    """One boosted binary model per class; the class with the highest score wins."""
    checkpoint_dir(train.sparkSession)
    binary = GBTClassifier(
        featuresCol=features, labelCol="label_id", maxIter=rounds, maxDepth=max_depth, stepSize=rate,
        subsamplingRate=rows, featureSubsetStrategy=str(columns), cacheNodeIds=True, seed=seed)
    # the classes' models are fitted at the same time: a round of one is too small to keep all cores busy
    model = OneVsRest(classifier=binary, featuresCol=features, labelCol="label_id", parallelism=max(len(labels), 1)).fit(
        _coded(train, key, features, label, labels))
    return _class_predictions(model, train, test, key, features, label, labels)


# ---------------------------------------------------------------- support vectors

@dataclass
class PairwiseSVM:
    """One linear separator per class pair: weights (pairs, d) and intercepts."""

    labels: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray
    intercepts: np.ndarray


def fit_pairwise_svms(train: DataFrame, features: str, label: str, labels: Sequence[str],
                      cs: Sequence[float], max_iter: int = 100,
                      lift: Callable | None = None) -> dict[float, tuple[PairwiseSVM, float]]:
    """Hinge-loss separators with penalty 1/(C*n) for every C and every pair of classes that occur.

    All of them share the passes over the rows; ``lift`` turns inputs into kernel features
    within a pass. Returns the machine and its summed fit seconds per C.
    """
    sizes = {r[0]: r[1] for r in train.groupBy(label).count().collect()}
    present = [i for i, v in enumerate(labels) if sizes.get(v)]
    pairs = list(combinations(present, 2))
    done = hinge.fit(train, features, label, labels, [(i, j, c) for c in cs for i, j in pairs], max_iter, lift=lift)
    out = {}
    for at, c in enumerate(cs):
        fits = done[at * len(pairs):(at + 1) * len(pairs)]
        out[c] = (PairwiseSVM(list(labels), pairs, np.array([f.weights for f in fits]),
                              np.array([f.intercept for f in fits])), sum(f.seconds for f in fits))
    return out


def fit_pairwise_svm(train: DataFrame, features: str, label: str, labels: Sequence[str],
                     c: float = 1.0, max_iter: int = 100, lift: Callable | None = None) -> PairwiseSVM:
    return fit_pairwise_svms(train, features, label, labels, [c], max_iter, lift)[c][0]


def vote(x: np.ndarray, svm: PairwiseSVM) -> np.ndarray:
    """Class index with the most pairwise wins; ties go to the first class."""
    votes = np.zeros((len(x), len(svm.labels)))
    scores = x @ svm.weights.T + svm.intercepts
    for p, (i, j) in enumerate(svm.pairs):
        votes[:, j] += scores[:, p] > 0
        votes[:, i] += scores[:, p] <= 0
    return votes.argmax(axis=1)


def svm_predictions(svm: PairwiseSVM, train: DataFrame, test: DataFrame, features: str, label: str,
                    key: str, lift: Callable | None = None) -> DataFrame:
    """(key, split, actual, predicted); ``lift`` turns inputs into kernel features where they are scored."""
    key_type = train.schema[key].dataType.simpleString()
    names = np.array(svm.labels)

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(3))
                won = names[vote(lift(x) if lift else x, svm)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array(won.tolist())],
                    names=[key, "split", "actual", "predicted"])

    def side(df, name):
        return df.select(key, F.lit(name).alias("split"), F.col(label).alias("actual"),
                         as_array(df, features).alias("v"))
    return side(train, "train").unionByName(side(test, "test")).mapInArrow(
        score, f"`{key}` {key_type}, split string, actual string, predicted string")


def svm_linear(train: DataFrame, test: DataFrame, features: str, label: str, labels: Sequence[str],
               key: str, c: float = 1.0, max_iter: int = 100) -> DataFrame:
    svm = fit_pairwise_svm(train, features, label, labels, c, max_iter)
    return svm_predictions(svm, train, test, features, label, key)


def fourier_lift(train: DataFrame, features: str, n_components: int, seed: int):
    """Random Fourier features of the RBF kernel with gamma = 1 / (d * var(X)).

    Returns a function of a matrix and a number type; it only needs the mean and
    variance of the train vectors.
    """
    stats = train.select(
        Summarizer.mean(F.col(features)).alias("m"), Summarizer.variance(F.col(features)).alias("v"),
        Summarizer.count(F.col(features)).alias("n")).first()
    mean, n = stats["m"].toArray(), stats["n"]
    d = len(mean)
    pooled = (stats["v"].toArray() * (n - 1) / n).mean() + mean.var()
    gamma = 1.0 / (d * pooled) if pooled > 0 else 1.0
    rng = np.random.default_rng(seed)
    directions = rng.normal(0.0, math.sqrt(2 * gamma), (d, n_components))
    phases = rng.uniform(0, 2 * math.pi, n_components)
    scale = math.sqrt(2.0 / n_components)

    def lift(x: np.ndarray, dtype: str = "float64") -> np.ndarray:
        out = np.empty((len(x), n_components), dtype)
        for start in range(0, len(x), LIFT_ROWS):
            angles = x[start:start + LIFT_ROWS] @ directions
            angles += phases
            np.cos(angles.astype(dtype, copy=False), out=out[start:start + LIFT_ROWS])
        out *= np.dtype(dtype).type(scale)
        return out

    return lift, gamma


def fourier_map(train: DataFrame, features: str, n_components: int, seed: int):
    """A function that replaces the vector column of any table by its random Fourier features, and gamma."""
    lift, gamma = fourier_lift(train, features, n_components, seed)
    return lambda df: lifted(df, features, lift), gamma


def lifted(df: DataFrame, features: str, lift: Callable) -> DataFrame:
    others = [c for c in df.columns if c != features]
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in others)

    def project(batches):
        for batch in batches:
            if batch.num_rows:
                z = lift(matrix(batch.column(len(others))))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(others)], lists(z)], names=[*others, features])

    mapped = df.select(*others, as_array(df, features).alias(features)).mapInArrow(
        project, f"{schema}, `{features}` array<double>")
    return mapped.select(*others, array_to_vector(features).alias(features))


def svm_rbf(train: DataFrame, test: DataFrame, features: str, label: str, labels: Sequence[str],
            key: str, c: float = 1.0, n_components: int = 200, seed: int = 42,
            max_iter: int = 100) -> DataFrame:
    """RBF-kernel machine through random features: linear in the number of rows."""
    lift, _ = fourier_lift(train, features, n_components, seed)
    svm = fit_pairwise_svm(train, features, label, labels, c, max_iter, lift)
    return svm_predictions(svm, train, test, features, label, key, lift)


def svm_sweep(train: DataFrame, test: DataFrame, features: str, label: str, labels: Sequence[str],
              key: str, kernels: Sequence[str] = ("linear", "rbf"), cs: Sequence[float] = (0.1, 1.0, 10.0),
              n_components: int = 200, seed: int = 42, max_iter: int = 100) -> DataFrame:
    """Metrics on the second table for every kernel and C.

    Choose with ``best_config`` on validation rows, not on the final test set.
    """
    lift, _ = fourier_lift(train, features, n_components, seed)
    out = None
    for kernel in kernels:
        a, b = [df.select(key, features, label) for df in (train, test)]
        own = lift if kernel == "rbf" else None
        for c, (svm, seconds) in fit_pairwise_svms(a, features, label, labels, cs, max_iter, own).items():
            scored = svm_predictions(svm, a.limit(0), b, features, label, key, own)
            row = classification_metrics(scored, labels, ["split"]).drop("split").select(
                F.lit(kernel).alias("kernel"), F.lit(float(c)).alias("c"), "*",
                F.lit(seconds).alias("train_seconds"))
            out = row if out is None else out.unionByName(row)
    return out
