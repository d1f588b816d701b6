"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed letter n-grams (3 to 6 bytes). The log-count ratio
of an n-gram compares the share of toxic and of other training texts that hold it;
these counts run over every labelled training row. Each present n-gram enters the
linear model with its ratio as value, scaled to unit length per text, and logistic
weights are fitted by AdaGrad steps in numpy.

The ratios use all labelled rows. The weights are fitted on a bounded sample of
them, about ``sample_toxic`` and ``sample_other`` whole texts chosen by a hash of
the id; both are parameters.

Rows: every input row gives one row; null texts count as empty and get the model's
score of a text without n-grams. Several labels of one id count as toxic if any is
1; null labels and labels without a document are left out. If the training rows do
not have both classes, every score is the share of toxic ones (0 without any).
Only id, text and label columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from .textkit import Bytes, letter_grams, pack, slices, unpack

#: n-gram lengths in bytes, hash buckets, and blocks in which count tables travel.
LENGTHS = (3, 4, 5, 6)
BUCKETS = 1 << 18
BLOCKS = 16


def distinct_grams(text: Bytes) -> Iterator[np.ndarray]:
    """The set of n-gram buckets of each document, in first-to-last text order."""
    parts = []
    for length in LENGTHS:
        index, per_doc = letter_grams(text, length, BUCKETS)
        parts.append((index, np.concatenate([[0], np.cumsum(per_doc)])))
    stamp = np.zeros(BUCKETS, np.int64)
    for d in range(text.docs):
        grams = np.concatenate([index[at[d]:at[d + 1]] for index, at in parts])
        order = np.arange(len(grams))
        stamp[grams] = order
        yield grams[stamp[grams] == order]


@dataclass
class Model:
    """``weight`` per bucket (ratio times fitted weight), squared ratio per bucket, and bias."""

    weight: np.ndarray
    square: np.ndarray
    bias: float

    def score(self, text: Bytes) -> np.ndarray:
        out = np.empty(text.docs)
        for d, grams in enumerate(distinct_grams(text)):
            length = float(np.sqrt(self.square[grams].sum(dtype=np.float64)))
            out[d] = self.bias + (float(self.weight[grams].sum(dtype=np.float64)) / length if length else 0.0)
        return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def log_count_ratios(counts: np.ndarray, sizes: np.ndarray, alpha: float = 2.0, deviations: float = 3.0) -> np.ndarray:
    """Log of the two classes' n-gram shares; smoothing follows class sizes, so unseen n-grams get 0.

    A ratio counts as 0 too while the toxic count is within ``deviations`` standard
    deviations of what independence would give: chance ratios of rare n-grams would
    otherwise fit the training texts and nothing else.
    """
    share = sizes / sizes.sum()
    smooth = (counts + alpha * share[:, None]) / (sizes + alpha * share)[:, None]
    expected = counts.sum(axis=0) * share[1]
    apart = np.abs(counts[1] - expected) / np.sqrt(expected * share[0] + 0.5)
    return np.where(apart >= deviations, np.log(smooth[1] / smooth[0]), 0).astype(np.float32)


def fit_weights(features: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, *, epochs: int = 8,
                rate: float = 0.1, decay: float = 1e-6, seed: int = 3) -> Model:
    weight, spread = np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32)
    bias, bias_spread = 0.0, 1e-6
    rng = np.random.default_rng(seed)
    importance = np.sqrt(len(labels) / (2 * np.maximum(np.bincount(labels, minlength=2), 1)))
    for _ in range(epochs):
        for i in rng.permutation(len(features)):
            grams = features[i]
            x = ratios[grams]
            x = x / (np.sqrt(x @ x) + 1e-9)
            error = 1 / (1 + np.exp(-np.clip(float(weight[grams] @ x) + bias, -60, 60))) - labels[i]
            error *= importance[labels[i]]
            step = error * x + decay * weight[grams]
            spread[grams] += step * step
            weight[grams] -= rate * step / np.sqrt(spread[grams] + 1e-8)
            bias_spread += error * error
            bias -= rate * error / np.sqrt(bias_spread)
    return Model(weight * ratios, ratios * ratios, float(bias))


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, *, sample_toxic: int = 3000, sample_other: int = 6000,
        doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | float:
    """Model from the labelled rows where ``learn_from`` (on the column ``i``, the id) holds; a constant if one class lacks."""
    marks = (labels.select(F.col(doc_id).alias("i"), F.col(label).cast("int").alias("y"))
             .where(F.col("i").isNotNull() & F.col("y").isNotNull() & learn_from)
             .groupBy("i").agg(F.max(F.when(F.col("y") == 1, 1).otherwise(0)).alias("y")))
    sizes = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return float(max(sizes, default=0))
    draw = F.pmod(F.xxhash64(F.lit(29), "i"), F.lit(1 << 30))
    bound = [int(min(1.0, n / sizes[y]) * (1 << 30)) for y, n in ((0, sample_other), (1, sample_toxic))]
    marks = marks.withColumn("chosen", draw < F.when(F.col("y") == 1, bound[1]).otherwise(bound[0]))
    # labels grow with the documents, so the plan is a merge join at every size
    rows = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("text")).join(marks.hint("merge"), "i") \
        .select("i", "text", "y", "chosen")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chosen texts' n-gram sets one by one, and one table of counts for the task."""
        counts, n = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for part in slices(batches):
            ids, _, ys, chosen = part.columns
            kept = []
            for d, grams in enumerate(distinct_grams(Bytes(part.column(1)))):
                y = ys[d].as_py()
                counts[y, grams] += 1
                n[y] += 1
                if chosen[d].as_py():
                    kept.append((-1 - y, ids[d].as_py(), pack(grams.astype(np.int32))))
            if kept:
                yield pa.RecordBatch.from_pydict(dict(zip(("block", "i", "data"), map(list, zip(*kept)))), schema=shape)
        if n.any():
            step = BUCKETS // BLOCKS
            blobs = [pack(counts[0, b * step:(b + 1) * step], counts[1, b * step:(b + 1) * step], n)
                     for b in range(BLOCKS)]
            yield pa.RecordBatch.from_pydict({"block": list(range(BLOCKS)), "i": [0] * BLOCKS, "data": blobs}, schema=shape)

    def add(table: pa.Table) -> pa.Table:
        total = None
        for blob in table.column("data"):
            parts = unpack(blob.as_py())
            total = [p.copy() for p in parts] if total is None else [a + b for a, b in zip(total, parts)]
        return pa.Table.from_pydict({"block": [table.column("block")[0].as_py()], "i": [0], "data": [pack(*total)]},
                                    schema=shape)

    shape = pa.schema([("block", pa.int32()), ("i", pa.int64()), ("data", pa.binary())])
    kind = "block int, i bigint, data binary"
    seen = rows.mapInArrow(count, kind).persist(StorageLevel.MEMORY_AND_DISK)
    blocks = seen.where("block >= 0").groupBy("block").applyInArrow(add, kind).collect()
    chosen = seen.where("block < 0").toArrow().sort_by([("i", "ascending"), ("block", "ascending")])
    seen.unpersist()
    if not blocks:
        return 0.0
    parts = [unpack(r["data"]) for r in sorted(blocks, key=lambda r: r["block"])]
    counts = np.array([np.concatenate([p[y] for p in parts]) for y in (0, 1)])
    n = parts[0][2].astype(float)
    if not n.all():
        return float(n[1] / n.sum())
    features = [unpack(x.as_py())[0] for x in chosen.column("data")]
    return fit_weights(features, -1 - chosen.column("block").to_numpy(), log_count_ratios(counts, n))


def score(docs: DataFrame, model: Model | float, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in slices(batches):
            s = model.score(Bytes(part.column(1))) if isinstance(model, Model) else np.full(part.num_rows, model)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(run, "doc_id bigint, score double, predicted int")
