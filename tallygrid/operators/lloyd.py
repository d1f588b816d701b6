"""K-Means with all restarts and all cluster numbers in one stack of centres.

Every pass is one scan: an Arrow batch meets the whole stack in one matrix product, each run takes its
nearest centres, and a task sends one row per centre (rows, cost, square sum, vector sum), which
Spark adds up. Runs whose centres stand still drop out of the stack. The last pass measures
all runs at their final centres.

The driver holds the stack (``restarts`` x sum of ``ks`` centres) and, for the starting centres only, a random
sample of ``sample_rows`` vectors. Rows without a vector take no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.vectors import as_array, lists, matrix

SAMPLE_ROWS = 20_000
BLOCK_CELLS = 4_000_000


@dataclass
class Run:
    """One restart of one cluster number; ``sizes``, ``costs`` and ``squares`` belong to the final centres."""

    k: int
    restart: int
    centers: np.ndarray
    passes: int = 0
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0))
    means: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cost: float = float("inf")

    def predict(self, vector: Column) -> Column:
        """Nearest centre of an array<double> column; ties go to the smaller number, null stays null."""
        centers = self.centers
        norms = (centers ** 2).sum(axis=1)

        @F.arrow_udf("int")
        def nearest(column: pa.Array) -> pa.Array:
            there = column.is_valid().to_numpy(zero_copy_only=False)
            out = np.zeros(len(column), np.int32)
            if there.any():
                x = matrix(column.drop_null())
                out[there] = (norms - 2 * (x @ centers.T)).argmin(axis=1)
            return pa.array(out, mask=~there)

        return nearest(vector)


def _spread_out(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ on the sample; centres beyond its distinct rows are repeated."""
    chosen = [int(rng.integers(len(sample)))]
    gap = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        total = gap.sum()
        chosen.append(int(rng.choice(len(sample), p=gap / total)) if total > 0 else int(rng.integers(len(sample))))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _pass(rows: DataFrame, runs: Sequence[Run], shift: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """(rows, cost, square sum, vector sum) per centre of every run, in coordinates relative to ``shift``."""
    stack = np.concatenate([r.centers for r in runs]) - shift
    ends = np.cumsum([len(r.centers) for r in runs])
    bounds = list(zip(ends - [len(r.centers) for r in runs], ends))
    norms = (stack ** 2).sum(axis=1)
    m, d = stack.shape
    block = max(1, BLOCK_CELLS // m)

    def scan(batches):
        n, cost, square, total = np.zeros(m), np.zeros(m), np.zeros(m), np.zeros((m, d))
        for batch in batches:
            every = matrix(batch.column(0))
            for start in range(0, len(every), block):
                x = every[start:start + block] - shift
                own = (x ** 2).sum(axis=1)
                gap = norms - 2 * (x @ stack.T)
                hit = np.zeros((len(x), m))
                at = np.arange(len(x))
                for a, b in bounds:
                    near = a + gap[:, a:b].argmin(axis=1)
                    hit[at, near] = 1
                    cost += np.bincount(near, np.maximum(gap[at, near] + own, 0), minlength=m)
                n += hit.sum(axis=0)
                square += own @ hit
                total += hit.T @ x
        used = np.flatnonzero(n)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), pa.array(cost[used]), pa.array(square[used]), lists(total[used])],
                                             names=["center", "n", "cost", "square", "total"])

    found = (rows.mapInArrow(scan, "center bigint, n double, cost double, square double, total array<double>")
             .groupBy("center").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.sum("square").alias("square"),
                                    vector_to_array(Summarizer.sum(array_to_vector(F.col("total")))).alias("total")).collect())
    n, cost, square, total = np.zeros(m), np.zeros(m), np.zeros(m), np.zeros((m, d))
    for r in found:
        n[r["center"]], cost[r["center"]], square[r["center"]], total[r["center"]] = r["n"], r["cost"], r["square"], r["total"]
    return [(n[a:b], cost[a:b], square[a:b], total[a:b]) for a, b in bounds]


def fit_many(df: DataFrame, features: str, ks: Sequence[int], restarts: int = 20, seed: int = 42, max_iter: int = 300,
             tol: float = 1e-4, sample_rows: int = SAMPLE_ROWS) -> list[Run]:
    """``restarts`` runs for every number of clusters in ``ks``, measured at their final centres.

    A run ends when the squared moves of its centres add up to at most ``tol`` times the mean variance of a column.
    A centre without rows stays where it is.
    """
    rows = df.select(as_array(df, features).alias("v")).where(F.col("v").isNotNull()).persist()
    try:
        sample = np.array([r["v"] for r in rows.orderBy(F.rand(seed)).limit(sample_rows).collect()])
        if not len(sample):
            raise ValueError("no vectors to cluster")
        shift = sample.mean(axis=0)
        still = tol * sample.var(axis=0).mean()
        runs = []
        for restart in range(restarts):
            # a smaller number of clusters starts from the first centres of a larger one
            start = _spread_out(sample, max(ks), np.random.default_rng(seed + restart))
            runs += [Run(int(k), restart, start[:k].copy()) for k in ks]
        active = runs
        for _ in range(max_iter):
            left = []
            for run, (n, _, _, total) in zip(active, _pass(rows, active, shift)):
                moved = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None] + shift, run.centers)
                gap = ((moved - run.centers) ** 2).sum()
                run.centers, run.passes = moved, run.passes + 1
                if gap > still:
                    left.append(run)
            active = left
            if not active:
                break
        for run, (n, cost, square, total) in zip(runs, _pass(rows, runs, shift)):
            mean = total / np.maximum(n, 1)[:, None]
            run.sizes, run.means = n, mean + shift
            run.spread = np.maximum(square - n * (mean ** 2).sum(axis=1), 0)
            run.cost = float(cost.sum())
        return runs
    finally:
        rows.unpersist()


def best_of(runs: Sequence[Run], k: int) -> Run:
    """The cheapest run of ``k`` clusters; ties go to the earlier restart."""
    return min((r for r in runs if r.k == k), key=lambda r: (r.cost, r.restart))


def silhouettes(df: DataFrame, features: str, runs: Sequence[Run]) -> list[float | None]:
    """Mean silhouette of squared distances of every run, all in one scan."""
    kept = []
    for run in runs:
        used = run.sizes > 0
        kept.append((run.centers[used], run.means[used], run.sizes[used], run.spread[used]))

    def scan(batches):
        total, rows = np.zeros(len(kept)), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0))
            rows += len(x)
            for i, (centers, means, sizes, spread) in enumerate(kept):
                own = ((centers ** 2).sum(axis=1) - 2 * (x @ centers.T)).argmin(axis=1)
                gaps = np.stack([((x - mean) ** 2).sum(axis=1) for mean in means], axis=1)
                total[i] += score(sizes * gaps + spread, own, sizes).sum()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(kept))), pa.array(total), pa.array(np.full(len(kept), float(rows)))],
                                             names=["run", "total", "n"])

    vectors = df.select(as_array(df, features).alias("v")).where(F.col("v").isNotNull())
    found = vectors.mapInArrow(scan, "run bigint, total double, n double").groupBy("run").agg((F.sum("total") / F.sum("n")).alias("s")).collect()
    at = {r["run"]: r["s"] for r in found}
    return [at.get(i) for i in range(len(kept))]


def score(sums: np.ndarray, own: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Silhouette per row from its summed distances to every cluster."""
    at = np.arange(len(own))
    a = sums[at, own] / np.maximum(sizes[own] - 1, 1)
    other = sums / sizes
    other[at, own] = np.inf
    b = other.min(axis=1)
    top = np.maximum(a, b)
    s = np.where(top > 0, (b - a) / np.where(top > 0, top, 1), 0.0)
    return np.where((sizes[own] == 1) | np.isinf(b), 0.0, s)
