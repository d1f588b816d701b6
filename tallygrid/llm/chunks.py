"""Documents in chunks that ask buckets: exchanges of sorted keys instead of rows.

``dealt`` spreads documents over chunks of about ``chunk_bytes`` by a hash of id and
text. A chunk sends each bucket one packed block of its distinct keys (``ask``); the
bucket sees the keys of all chunks, and sends every chunk a block that answers its
keys in order (``answer``). However often a key occurs, a chunk names it once, so a
key of a third of all rows costs a bucket one entry per chunk.

Chunks and buckets grow with the table; keys are dealt to buckets by their hash.
A chunk is computed anew for each exchange; its distinct sorted keys do not depend
on the order of its documents, so answers fit after lost executors too.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textkit import pack, unpack

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 32 << 20

BLOCK = "bucket int, chunk int, stage int, data binary"


def dealt(docs: DataFrame, *, doc_id: str, text: str, chunk_bytes: int = CHUNK_BYTES,
          bucket_bytes: int = BUCKET_BYTES, more: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(doc_id, text, further columns, chunk) and the number of buckets."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *more)
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    chunks, buckets = max(1, -(-total // chunk_bytes)), max(1, -(-total // bucket_bytes))
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int")
    return rows.withColumn("chunk", chunk).repartition(int(chunks), "chunk"), int(buckets)


def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin in sorted 64-bit keys; buckets are equal ranges of key values."""
    own = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(own, np.arange(buckets + 1, dtype=np.uint64))


def key_bits(buckets: int) -> int:
    """Leading hash bits that tell the keys of a bucket apart: about one in 8,000 of a full bucket meets another one."""
    return min(48, 34 + (buckets - 1).bit_length())


def blocks(chunk: int, stage: int, keys: np.ndarray, columns: list[np.ndarray], buckets: int) -> pa.Table:
    """Blocks of a chunk's sorted keys and their columns, one per bucket that gets any."""
    at = bucket_bounds(keys, buckets)
    used = np.flatnonzero(np.diff(at))
    data = [pack(*[c[at[b]:at[b + 1]] for c in (keys, *columns)]) for b in used]
    return pa.Table.from_pydict({"bucket": pa.array(used, pa.int32()), "chunk": pa.array([chunk] * len(used), pa.int32()),
                                 "stage": pa.array([stage] * len(used), pa.int32()), "data": pa.array(data, pa.binary())})


def ask(rows: DataFrame, fn: Callable[[pa.Table, int, list[np.ndarray]], pa.Table],
        answers: DataFrame | None = None, schema: str = BLOCK,
        plain: Callable[[int, list[np.ndarray]], list[np.ndarray]] | None = None,
        opened: Callable[[bytes], list[np.ndarray]] = unpack) -> DataFrame:
    """Run ``fn(documents, chunk, answers by stage)`` for every chunk; ``plain(stage, columns)`` decodes an ``opened`` block."""

    def alone(table: pa.Table) -> pa.Table:
        out = fn(table, table.column("chunk")[0].as_py(), [])
        give_back()
        return out

    def answered(table: pa.Table, blocks: pa.Table) -> pa.Table:
        got: dict[int, list] = {}
        for stage, bucket, data in zip(*(blocks.column(c).to_pylist() for c in ("stage", "bucket", "data"))
                                       ) if blocks.num_rows else ():
            got.setdefault(stage, []).append((bucket, data))
        if not table.num_rows:
            raise ValueError("an answer for a chunk without documents")
        parts = [unpack_all([d for _, d in sorted(got.pop(s, []))], plain and partial(plain, s), opened) for s in range(max(got, default=-1) + 1)]
        out = fn(table, table.column("chunk")[0].as_py(), parts)
        del parts
        give_back()
        return out

    if answers is None:
        return rows.groupBy("chunk").applyInArrow(alone, schema)
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(answered, schema)


def give_back() -> None:
    """Hand memory that a group no longer needs back to the system: idle workers live on beside the busy ones."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def unpack_all(blobs: list[bytes], plain: Callable | None = None, opened: Callable = unpack) -> list[np.ndarray]:
    """Columns of several blocks, end to end."""
    parts = [plain(opened(b)) if plain else opened(b) for b in blobs]
    return [np.concatenate(c) for c in zip(*parts)] if parts else []


def by_bucket(asked: DataFrame, buckets: int) -> DataFrame:
    """Blocks dealt to a partition per bucket, which adaptive execution does not merge into larger ones."""
    return asked.repartition(buckets, "bucket")


def answer(asked: DataFrame, buckets: int, fn: Callable[[list[np.ndarray], np.ndarray], list[np.ndarray]]) -> DataFrame:
    """Run ``fn(columns, chunk of each entry)`` for every bucket; it returns columns in the same order."""

    def run(table: pa.Table) -> pa.Table:
        # blocks in order of their chunk, so that results do not depend on how they arrived
        order = np.argsort(table.column("chunk").to_numpy(), kind="stable")
        chunks = table.column("chunk").to_numpy()[order]
        parts = [unpack(table.column("data")[int(i)].as_py()) for i in order]
        sizes = np.array([len(p[0]) for p in parts])
        columns = fn([np.concatenate(c) for c in zip(*parts)], np.repeat(chunks, sizes))
        del parts
        give_back()
        ends = np.cumsum(sizes)
        data = [pack(*[c[e - n:e] for c in columns]) for n, e in zip(sizes, ends)]
        return pa.Table.from_pydict({
            "bucket": pa.array([table.column("bucket")[0].as_py()] * len(data), pa.int32()), "chunk": pa.array(chunks, pa.int32()),
            "stage": pa.array([table.column("stage")[0].as_py()] * len(data), pa.int32()), "data": pa.array(data, pa.binary())})

    return by_bucket(asked, buckets).groupBy("bucket").applyInArrow(run, BLOCK)


def parts_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """A chunk's documents as record batches."""
    return iter(table.combine_chunks().to_batches())
