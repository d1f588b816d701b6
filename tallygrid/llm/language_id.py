"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its subwords: byte n-grams of 1 to 5
bytes over lower-cased letters, where every run of other characters is a border.
One linear softmax layer reads the average. Embeddings and layer are trained
together by stochastic gradient descent in numpy. Because both layers are linear,
scoring needs one table only (subword bucket -> a logit per language), whose size
is fixed by parameters and which every task receives.

Fitting uses a bounded sample, about ``per_language`` labelled texts of each
language chosen by a hash of the id, and whole texts of those. A fifth of the
sample is held back to calibrate: a temperature makes the softmax's confidence
match its accuracy, and the rejection bound is the confidence that all but
``reject_share`` of the right held-back texts reach (never above ``reject_most``).

Rows: every input row gives one row. Null texts and texts without any letter get
``und`` with score 0 and are rejected. Null labels are never learned from. With no
labelled row at all every text is ``und``. Ties go to the first language in order
of name. Only the id, text and label columns are read, so other columns may have
any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from .textkit import Bytes, letter_grams, slices

#: Subword lengths in bytes, buckets, embedding width.
LENGTHS = (1, 2, 3, 4, 5)
BUCKETS = 1 << 18
WIDTH = 16
UNDETERMINED = "und"

#: A letter by Unicode category; number signs such as ½ are none.
_any_letter = regex.compile(r"\p{L}")


@dataclass
class Model:
    """What scoring needs: a logit per bucket and language, a bias, and the calibration."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def confidences(self, text: Bytes) -> np.ndarray:
        """Calibrated probability of each language for each document."""
        total = np.zeros((text.docs, len(self.languages)))
        count = np.zeros(text.docs)
        for length in LENGTHS:
            index, per_doc = letter_grams(text, length, len(self.logits))
            full = np.flatnonzero(per_doc)
            if len(full):
                first = (np.cumsum(per_doc) - per_doc)[full]
                total[full] += np.add.reduceat(self.logits[index], first, axis=0)
                count += per_doc
        z = (total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _sparse(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their shares, per text."""
    out = []
    for value in texts:
        text = Bytes(pa.array([value], pa.string()))
        index = np.concatenate([letter_grams(text, n, BUCKETS)[0] for n in LENGTHS])
        buckets, counts = np.unique(index, return_counts=True)
        out.append((buckets, (counts / max(1, len(index))).astype(np.float32)))
    return out


def train(texts: list[str], labels: list[str], *, epochs: int = 10, rate: float = 0.5, seed: int = 7,
          reject_share: float = 0.002, reject_most: float = 0.5) -> Model:
    """Fit embeddings and softmax by stochastic gradient descent, then calibrate on every fifth text."""
    languages = sorted(set(labels))
    number = {name: i for i, name in enumerate(languages)}
    target = np.array([number[x] for x in labels], np.int64)
    features = _sparse(texts)
    held = np.arange(len(texts)) % 5 == 4
    learn = np.flatnonzero(~held)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    seen = np.zeros(BUCKETS, bool)
    for i in learn:
        seen[features[i][0]] = True
    table[~seen] = 0
    for epoch in range(epochs):
        for turn, i in enumerate(rng.permutation(learn)):
            step = rate * (1 - (epoch + turn / len(learn)) / epochs)
            index, share = features[i]
            mean = share @ table[index]
            z = mean @ layer + bias
            z = np.exp(z - z.max())
            error = z / z.sum()
            error[target[i]] -= 1
            back = layer @ error
            layer -= step * np.outer(mean, error)
            bias -= 0.01 * step * error
            # shares are far below 1, so a subword's step is scaled up
            table[index] -= np.outer(share * (20 * step), back)
    model = Model(languages, (table @ layer).astype(np.float32), bias)
    check = np.flatnonzero(held) if held.any() else learn
    parts = [model.confidences(Bytes(pa.array([texts[i]], pa.string())))[0] for i in check]
    logs = np.log(np.maximum(np.array(parts), 1e-30))
    best = (np.inf, 1.0)
    for temperature in np.geomspace(0.2, 8, 38):
        z = logs / temperature
        z -= np.log(np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)) + z.max(axis=1, keepdims=True)
        best = min(best, (-z[np.arange(len(check)), target[check]].mean(), float(temperature)))
    model.temperature = best[1]
    z = np.exp((logs - logs.max(axis=1, keepdims=True)) / best[1])
    z /= z.sum(axis=1, keepdims=True)
    right = z.argmax(axis=1) == target[check]
    if right.any():
        model.reject_below = float(min(reject_most, np.quantile(z[right].max(axis=1), reject_share)))
    return model


def fit(docs: DataFrame, learn_from: Column, *, per_language: int = 400, doc_id: str = "doc_id",
        text: str = "text", label: str = "lang", **options) -> Model | None:
    """Train on about ``per_language`` texts a language among the rows where ``learn_from`` holds."""
    rows = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t"), F.col(label).alias("y")) \
        .where(learn_from & F.col("y").isNotNull() & F.col("t").isNotNull())
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64(F.lit(11), "i"), F.lit(1 << 30))
    bound = F.create_map(*[F.lit(v) for y, n in sizes.items() for v in (y, int(min(1.0, per_language / n) * (1 << 30)))])
    sample = rows.where(draw < bound[F.col("y")]).select("i", "t", "y").toArrow().sort_by([("i", "ascending")])
    texts, labels = sample.column("t").to_pylist(), sample.column("y").to_pylist()
    # the order of the sample decides which texts are held back, so it is dealt anew by a fixed rule
    order = np.random.default_rng(5).permutation(len(texts))
    return train([texts[i] for i in order], [labels[i] for i in order], **options) if texts else None


def judge(model: Model | None, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, calibrated confidence and rejection of each text."""
    letters = np.array([bool(x and _any_letter.search(x)) for x in texts.to_pylist()], bool)
    if model is None:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    sure = model.confidences(Bytes(texts))
    score = np.where(letters, sure.max(axis=1), 0.0)
    names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(sure.argmax(axis=1).tolist(), letters.tolist())]
    return names, score, ~letters | (score < model.reject_below)


def predict(docs: DataFrame, model: Model | None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id bigint, lang_pred string, score double, rejected boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in slices(batches):
            names, score, refused = judge(model, part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(refused)],
                names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def accept(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, unchanged.

    Only texts go to Python and only marks come back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def accepted(texts: pa.Array) -> pa.Array:
        kept = [~judge(shared.value, part.column(0))[2] for part in slices([pa.RecordBatch.from_arrays([texts], ["text"])])]
        return pa.array(np.concatenate(kept) if kept else np.zeros(0, bool))

    return docs.where(accepted(F.col(text)))
