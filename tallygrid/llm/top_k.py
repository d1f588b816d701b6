"""Exact top-k search by inner product: tiled matrix products, partial selection, tree merging.

Vectors are dealt into shards and queries into groups, both of bounded size. Each
(query group, shard) pair is one tile: a task multiplies two matrices and keeps the
k best of every query in the tile, ties included by id. Lists of one query then
merge in rounds of ``fan_in`` shards, so no task gathers the lists of all shards.

Components become floor(scale * x), so inner products are whole numbers. Products
are taken in double precision while every possible sum stays below 2**53 and in
Python integers beyond that, hence always exact; a score outside the 64-bit range is
reported as the nearest long.

Rows: vectors that are null, or hold a null or a non-finite component, take no part,
as query or as candidate; so do rows with a null id. Rows are kept apart where an id
repeats: each is a query of its own, if its id is asked for, and a candidate of the
others. Rows equal in id and whole components travel as one with a number of copies,
and are told apart from other rows of their id by a 64-bit hash of the components. A
query meets only vectors of its own length. Ties go to the smaller id. An empty table
gives no rows. Only id and vector columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Vectors per shard and queries per group; a tile of scores holds their product.
SHARD_ROWS = 4096
GROUP_QUERIES = 1024
FAN_IN = 16


def quantise(vectors: DataFrame, scale: int, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v, h, copies): usable vectors, components as floor(scale * x) in double precision, their hash, and equal rows."""
    x = F.col("v")
    usable = F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    whole = rows.where(usable).select("vec_id", F.transform("v", lambda c: _floor(c * scale)).alias("v"))
    return whole.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies")).withColumn("h", F.xxhash64("v"))


def _floor(x: Column) -> Column:
    """floor() that stays in double precision; components beyond 2**53 are whole already."""
    return F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)


def _matrix(table: pa.Table) -> np.ndarray:
    values = table.column("v").combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    top = max(1.0, float(np.abs(queries).max())) * max(1.0, float(np.abs(vectors).max())) * queries.shape[1]
    if top < 2.0 ** 53:
        return (queries @ vectors.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(queries) @ whole(vectors).T
    low, high = -(1 << 63), (1 << 63) - 1
    return np.vectorize(lambda s: min(max(s, low), high), otypes=[np.int64])(exact)


def tile_top(own: np.ndarray, vec_ids: np.ndarray, product: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Places (query, vector) and scores of the k best of each query in a tile, without the vectors marked ``own``."""
    low = np.iinfo(np.int64).min
    keep = ~own
    if product.shape[1] > k + 1:
        ranked = np.where(own, low, product)
        bound = np.partition(ranked, ranked.shape[1] - k, axis=1)[:, ranked.shape[1] - k]
        keep &= product >= bound[:, None]
    q, v = np.nonzero(keep)
    s = product[q, v]
    order = np.lexsort((vec_ids[v], -s.astype(object) if (s == low).any() else -s, q))
    q, v, s = q[order], v[order], s[order]
    first = np.searchsorted(q, q, side="left")
    best = np.arange(len(q)) - first < k
    return q[best], v[best], s[best]


def search(vectors: DataFrame, is_query: Column, k: int = 10, *, scale: int = 1024, vec_id: str = "vec_id",
           vector: str = "embedding", shard_rows: int = SHARD_ROWS, group_queries: int = GROUP_QUERIES,
           fan_in: int = FAN_IN) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best other rows. ``is_query`` reads ``vec_id``."""
    rows = quantise(vectors, scale, vec_id, vector).withColumn("n", F.size("v"))
    total, asked = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id")).agg(
        F.count("vec_id"), F.count(F.when(is_query, 1))).first()
    shards, groups = max(1, -(-total // shard_rows)), max(1, -(-asked // group_queries))

    def dealt(kind: str, into: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(kind), "vec_id", "h"), F.lit(into)).cast("int")

    candidates = rows.withColumn("shard", dealt("s", shards)) \
        .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    queries = rows.where(is_query).withColumn("group", dealt("g", groups)) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def tile(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        asking, found = left.slice(0, 0), right.slice(0, 0)
        score = np.zeros(0, np.int64)
        if left.num_rows and right.num_rows:
            of = lambda t, c: t.column(c).to_numpy()
            own = (of(left, "vec_id")[:, None] == of(right, "vec_id")) & (of(left, "h")[:, None] == of(right, "h"))
            q, v, score = tile_top(own & (of(right, "copies") == 1), of(right, "vec_id"), scores(_matrix(left), _matrix(right)), k)
            asking, found = left.take(q), right.take(v)
            found = found.set_column(found.schema.get_field_index("copies"), "copies", pa.array(of(found, "copies") - own[q, v]))
        return pa.Table.from_pydict({"query_id": asking.column("vec_id"), "h": asking.column("h"), "asked": asking.column("copies"),
                                     "vec_id": found.column("vec_id"), "score": score, "copies": found.column("copies"),
                                     "shard": pa.array([key[1].as_py()] * len(score), pa.int32())})

    keys = ("group", "shard", "n")

    def side(frame: DataFrame) -> DataFrame:
        """Columns of its own, because both sides come from one table."""
        return frame.select(*[F.col(c).alias(c) for c in ("vec_id", "v", "h", "copies", *keys)])

    lists = side(queries).groupBy(*keys).cogroup(side(candidates).groupBy(*keys)) \
        .applyInArrow(tile, "query_id bigint, h bigint, asked bigint, vec_id bigint, score bigint, copies bigint, shard int")
    order = (F.col("score").desc(), "vec_id")
    left = shards
    while True:
        left = -(-left // fan_in)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / fan_in).cast("int"))
        best = Window.partitionBy("query_id", "h", "shard").orderBy(*order)
        lists = lists.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        if left <= 1:
            break
        lists = lists.drop("rank")
    each = lists.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("copies", F.lit(k).cast("bigint")))))
    each = each.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "h", "shard").orderBy(*order))).where(F.col("rank") <= k)
    return each.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score",
                       F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("asked"))).alias("again")).drop("again")
