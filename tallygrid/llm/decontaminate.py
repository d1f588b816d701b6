"""Benchmark decontamination by a prefix-filtered join on word shingles.

An item's windows are its runs of ``window`` words; a shorter item is one window.
A document word is hit if it lies in an occurrence of a window.

A window occurs exactly where all of its short shingles occur in place, so one of
them is a sufficient prefix: the rarest in the documents. The steps:

1. count how often the items' shingles occur in the documents (shingles of items are
   recognised by a bit table of fixed size, so the other ones are never shuffled);
2. keep, per window, the rarest shingle; windows with a shingle that never occurs go;
3. join documents and items on the kept shingles; the surroundings of both, at most a
   window to each side, travel along;
4. verify: count equal words to the left and right of the shingle. A run of at least a
   window (of the whole item, if it is shorter) is contained, and nothing else is.
   Positions bound the run at both texts' ends.

Shingle hashes only propose; words decide. Frequent shingles are salted over
``salts`` tasks, because a passage of a third of all documents has few keys.

Rows: every document row gives one row, repeated rows too. Null or empty texts have
no words; items without words or with null text have no windows; items with a null id
take part in hits but are not listed; items that share an id, or have none, each have
their own windows. An empty benchmark hits nothing. Only id and
text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scale import settle
from .rows import row_key, unused
from .textkit import IS_ALNUM, Bytes, shingle_hash, slices, span_hash

WINDOW = 13
#: Words in a shingle, bits in the table of item shingles (a power of two), tasks for one shingle.
SHINGLE = 3
BITS = 1 << 23
SALTS = 16


def _words(texts: pa.Array) -> tuple[Bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, word starts and ends, word hashes, and per document the first word's number."""
    text = Bytes(texts, lower=True)
    starts, ends, docs = text.words(IS_ALNUM)
    return text, starts, ends, span_hash(text.prefix(), starts, ends), np.searchsorted(docs, np.arange(text.docs + 1))


def _shingles(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles inside documents, with the number of their first word."""
    h = shingle_hash(words, width) + np.uint64(width)
    inside = np.ones(len(h), bool)
    for cut in range(1, width):
        at = first[1:-1] - cut
        inside[at[(at >= 0) & (at < len(h))]] = False
    at = np.flatnonzero(inside)
    return h[at], at


def _join(text: Bytes, starts: np.ndarray, ends: np.ndarray, a: int, b: int) -> str:
    return b" ".join(text.data[s:e].tobytes() for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())).decode()


def _bit_table(hashes: DataFrame, column: str) -> np.ndarray:
    """Marks of the hashes' places in a table of ``BITS`` bits; blocks are merged by the executors."""
    blocks = 16

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BITS, bool)
        for batch in batches:
            seen[batch.column(0).to_numpy().view(np.uint64) & np.uint64(BITS - 1)] = True
        if seen.any():
            parts = np.packbits(seen).reshape(blocks, -1)
            yield pa.RecordBatch.from_pydict({"block": pa.array(range(blocks), pa.int32()), "bits": [p.tobytes() for p in parts]})

    def merge(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_py(), np.uint8) for x in table.column("bits")]
        return pa.Table.from_pydict({"block": table.column("block").slice(0, 1), "bits": [np.bitwise_or.reduce(parts).tobytes()]})

    kind = "block int, bits binary"
    rows = hashes.select(column).mapInArrow(mark, kind).groupBy("block").applyInArrow(merge, kind).collect()
    if not rows:
        return np.zeros(BITS, bool)
    return np.unpackbits(np.frombuffer(b"".join(r["bits"] for r in sorted(rows, key=lambda r: r["block"])), np.uint8)).astype(bool)


def item_windows(items: DataFrame, window: int = WINDOW, *, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, body, w, h, at, width, size, near, near_at): each shingle of each window, with its surroundings.

    ``body`` marks the item's text: ids may be null, or stand for several texts.
    """
    shape = "item string, body string, w bigint, h bigint, at int, width int, size int, near string, near_at int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=1 << 18):
            body, starts, ends, words, first = _words(part.column(2))
            ids, bodies, out = part.column(0).to_pylist(), part.column(1).to_pylist(), []
            for d in range(body.docs):
                a, b = int(first[d]), int(first[d + 1])
                size, width = b - a, min(SHINGLE, b - a)
                if not size:
                    continue
                h = (shingle_hash(words[a:b], width) + np.uint64(width)).view(np.int64).tolist()
                near = [(_join(body, starts, ends, max(a, a + q - window), min(b, a + q + width + window)), min(q, window))
                        for q in range(len(h))]
                for w in range(max(1, size - window + 1)):
                    for q in range(w, w + min(window, size) - width + 1):
                        out.append((ids[d], bodies[d], w, h[q], q, width, size, *near[q]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(),
                                                               pa.int32(), pa.int32(), pa.string(), pa.int32()))],
                    names=["item", "body", "w", "h", "at", "width", "size", "near", "near_at"])

    return items.select(F.col(item_id).cast("string").alias("item"), F.sha2(F.col(text).cast("binary"), 256).alias("body"),
                        F.col(text).alias("text")).mapInArrow(run, shape)


def _counts(docs: DataFrame, table, widths: list[int]) -> DataFrame:
    """(h, n): how often the marked shingles occur; each task adds up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = table.value
        for part in slices(batches):
            _, _, _, words, first = _words(part.column(0))
            for width in widths:
                h, _ = _shingles(words, first, width)
                values, n = np.unique(h[marked[h & np.uint64(BITS - 1)]].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n.astype(np.int64))], names=["h", "n"])

    return docs.select("text").mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def _candidates(docs: DataFrame, table, widths: list[int], window: int) -> DataFrame:
    """Per document its words (h null), and per marked shingle its place and surroundings."""
    shape = "doc_id bigint, row string, h bigint, at int, n_words bigint, near string, near_at int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = table.value
        names = ["doc_id", "row", "h", "at", "n_words", "near", "near_at"]
        for part in slices(batches):
            body, starts, ends, words, first = _words(part.column(2))
            none = [pa.nulls(part.num_rows, t) for t in (pa.int64(), pa.int32(), pa.string(), pa.int32())]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), none[0], none[1],
                                              pa.array(np.diff(first).astype(np.int64)), none[2], none[3]], names=names)
            for width in widths:
                h, at = _shingles(words, first, width)
                hit = marked[h & np.uint64(BITS - 1)]
                h, at = h[hit], at[hit]
                if not len(h):
                    continue
                doc = np.searchsorted(first, at, side="right") - 1
                a, b = first[doc], first[doc + 1]
                low, high = np.maximum(a, at - window), np.minimum(b, at + width + window)
                near = [_join(body, starts, ends, x, y) for x, y in zip(low.tolist(), high.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), part.column(1).take(pa.array(doc)), pa.array(h.view(np.int64)),
                     pa.array((at - a).astype(np.int32)), pa.array((b - a).astype(np.int64)), pa.array(near),
                     pa.array((at - low).astype(np.int32))], names=names)

    return docs.mapInArrow(run, shape)


def equal_run(a: list[str], i: int, b: list[str], j: int, width: int) -> tuple[int, int]:
    """Equal words left of, and right behind, ``width`` equal words at a[i] and b[j]; (-1, -1) if those differ."""
    if a[i:i + width] != b[j:j + width]:
        return -1, -1
    left = 0
    while left < min(i, j) and a[i - left - 1] == b[j - left - 1]:
        left += 1
    i, j, right = i + width, j + width, 0
    while right < min(len(a) - i, len(b) - j) and a[i + right] == b[j + right]:
        right += 1
    return left, right


def _verified(pairs: DataFrame, window: int) -> DataFrame:
    """(row, item, start, end) of word runs that hold a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, item, at, near, near_at, q, width, size, own, own_at in zip(*(c.to_pylist() for c in batch.columns)):
                left, right = equal_run(near.split(" "), near_at, own.split(" "), own_at, width)
                if left >= 0 and left + width + right >= min(window, size):
                    out.append((row, item, at - left, at + width + right))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out), (pa.string(), pa.string(), pa.int32(), pa.int32()))], names=["row", "item", "start", "end"])

    return pairs.select("row", "item", "d_at", "d_near", "d_near_at", "at", "width", "size", "near", "near_at") \
        .mapInArrow(run, "row string, item string, start int, end int")


def _covered(spans: Column) -> Column:
    """Words in the union of [start, end) spans."""
    start = F.struct(F.lit(0).alias("to"), F.lit(0).cast("bigint").alias("n"))

    def step(state: Column, s: Column) -> Column:
        more = F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], state["to"]))
        return F.struct(F.greatest(state["to"], s["end"]).alias("to"), (state["n"] + more).alias("n"))

    return F.aggregate(F.array_sort(spans), start, step, lambda state: state["n"])


def contamination(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", salts: int = SALTS) -> DataFrame:
    """(doc_id, row, n_words, n_hit, items, spans): hit words and the sorted ids of the items found, one row per document."""
    spark = docs.sparkSession
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), row_key(doc_id, text).alias("row"), F.col(text).alias("text"))
    shingles = settle(item_windows(items, window, item_id=item_id, text=item_text))
    widths = sorted(r["width"] for r in shingles.select("width").distinct().collect())
    counts = _counts(plain, spark.sparkContext.broadcast(_bit_table(shingles, "h")), widths)
    ranked = shingles.join(counts, "h", "left").groupBy("item", "body", "w").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "at", "width", "size", "near", "near_at")).alias("best"))
    prefixes = settle(ranked.where("best.n > 0").select("item", "best.h", "best.at", "best.width", "best.size", "best.near",
                                                        "best.near_at").distinct())
    found = settle(_candidates(plain, spark.sparkContext.broadcast(_bit_table(prefixes, "h")), widths, window))
    places = found.where(F.col("h").isNotNull()).select(
        "row", "h", F.col("at").alias("d_at"), F.col("near").alias("d_near"), F.col("near_at").alias("d_near_at"),
        F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt"))
    spread = prefixes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hits = _verified(places.join(spread, ["h", "salt"]), window).groupBy("row").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    return found.where(F.col("h").isNull()).select("doc_id", "row", "n_words").join(hits, "row", "left").select(
        "doc_id", "row", "n_words", F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.array_sort("spans"), F.array().cast("array<struct<start:int,end:int>>")).alias("spans"))


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    bad = contamination(docs, items, doc_id=doc_id, text=text, **options).where(is_contaminated())
    row = unused(docs, "row")
    return docs.withColumn(row, row_key(doc_id, text)).join(bad.select(F.col("row").alias(row)).distinct(), row, "left_anti").select(*docs.columns)


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    rows = contamination(docs, items, **options)
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))
