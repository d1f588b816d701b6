"""BPE with word ends over a distinct-word table; decoding by an id-to-piece join.

1. Texts are split at white space into runs. A chunk of texts keeps a table of its distinct runs; a
   document becomes the places of its runs in that table. Both are materialised once, without the text.
2. Every bucket collects the runs of all chunks whose hash falls to it and encodes each distinct one once.
3. The ids come back to the chunks in the order in which their runs went out, and are joined to the
   documents by place.
4. Ids become pieces by a join with the vocabulary, whose size the tokenizer file fixes: for each distinct
   run in ``encode``, and as a broadcast join of exploded ids in ``decode``.

A run that fills a third of all texts costs a chunk one entry and the bucket one encoding. Runs are compared
as bytes, never by hash alone. White space (ASCII) cannot lie inside a word of the tokenizers handled here
(``Vocabulary`` refuses others), and nothing is composed across it, so runs are encoded independently; inside
a run, added tokens, the normaliser and the split rule of the file apply.

A null text is empty: no tokens, and the digests of nothing. Empty tables give no rows. Rows are encoded one by one, so
null or repeated ids and repeated rows stay as they are; columns beyond id and text are not read. A very long
text is one chunk; a run of any length is encoded by a heap, in n log n steps. Ties between equal merges go to
the left one.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tallygrid.functions.scale import settle

from .textkit import byte_planes, from_byte_planes, pack, unpack

CHUNK_BYTES = 32 << 20
BUCKET_BYTES = 24 << 20
PART_RUNS = 1 << 20

PACKED = "chunk bigint, bucket int, part int, data binary"
RESULT = "doc_id bigint, n_tokens bigint, ids array<int>, ids_sha256 string, decoded string, decoded_sha256 string"


class Vocabulary:
    """Ids, merges and split rule of a tokenizer file."""

    def __init__(self, config: str):
        parts = json.loads(config)
        model, added = parts["model"], parts["added_tokens"]
        library = Tokenizer.from_str(config)
        self.normalise = library.normalizer.normalize_str if library.normalizer else str
        self.split = library.pre_tokenizer.pre_tokenize_str if library.pre_tokenizer else lambda text: [(text, None)]
        plain = (model["type"] == "BPE" and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk",
                                                                       "byte_fallback", "ignore_merges"))
                 and parts["decoder"] is None and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
                 and not any(t["content"].split() != [t["content"]] for t in added)
                 and [w for w, _ in self.split(self.normalise("a b\tc\nd\x0be\x0cf\rg"))] == list("abcdefg"))
        if not plain:
            raise ValueError("only BPE files without a decoder whose words hold no white space are handled")
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in added}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.pieces = [""] * (1 + max(*self.ids.values(), *self.added.values(), 0))
        for piece, i in chain(self.ids.items(), self.added.items()):
            self.pieces[i] = piece
        self._words: dict[str, tuple[int, ...]] = {}

    def word(self, word: str) -> tuple[int, ...]:
        """Merges of one word, lowest rank first, the left one first among equals."""
        known = self._words.get(word)
        if known is not None:
            return known
        symbols = [self.ids[s] for s in (*word[:-1], word[-1] + self.suffix) if s in self.ids]
        after, before = [*range(1, len(symbols)), -1], [*range(-1, len(symbols) - 1)]
        heap = [(found[0], at, found[1], pair) for at, pair in enumerate(zip(symbols, symbols[1:])) if (found := self.merges.get(pair))]
        heapq.heapify(heap)
        while heap:
            _, at, merged, pair = heapq.heappop(heap)
            right = after[at]
            if right < 0 or symbols[at] != pair[0] or symbols[right] != pair[1]:
                continue
            symbols[at], symbols[right], after[at] = merged, -1, after[right]
            if after[at] >= 0:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] >= 0:
                    pair = symbols[left], symbols[after[left]]
                    if found := self.merges.get(pair):
                        heapq.heappush(heap, (found[0], left, found[1], pair))
        out = tuple(s for s in symbols if s >= 0)
        if len(word) <= 32:
            if len(self._words) >= 1 << 18:
                self._words.clear()
            self._words[word] = out
        return out

    def run(self, run: str) -> tuple[int, ...]:
        """Ids of a text without ASCII white space."""
        out: list[int] = []
        for part in self.marks.split(run) if self.marks else (run,):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                for word, _ in self.split(self.normalise(part)):
                    out.extend(self.word(word))
        return tuple(out)


_loaded: dict[str, Vocabulary] = {}


def vocabulary(config: str) -> Vocabulary:
    """The vocabulary of a file's content; a worker keeps the last one."""
    if config not in _loaded:
        _loaded.clear()
        _loaded[config] = Vocabulary(config)
    return _loaded[config]


def _small(values: np.ndarray) -> np.ndarray:
    return byte_planes(np.ascontiguousarray(values, np.uint32))


def _squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=9).compress(pack(*arrays))


def _open(blob: bytes) -> list[np.ndarray]:
    return unpack(zstandard.ZstdDecompressor().decompress(blob))


def _chunk(number: int, docs: list, slots: list, names: list, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rows of one chunk: its runs by bucket, and its documents as places of runs.

    Frequent runs come first; runs that occur once come last, in the order of the text, where a 0 stands for the next of them.
    """
    order = np.argsort(-counts, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    code = np.where(counts == 1, 0, place + 1)
    owner = np.fromiter((xxhash.xxh3_64_intdigest(names[i]) % buckets for i in order), np.int64, len(order))
    out = []
    by_owner = np.argsort(owner, kind="stable")
    edges = np.searchsorted(owner[by_owner], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        own = by_owner[edges[b]:edges[b + 1]]
        runs = b"\n".join([names[order[i]] for i in own])
        out.append((number, int(b), 0, _squeeze(_small(np.diff(own, prepend=0)), np.frombuffer(runs, np.uint8))))
    part, start = 0, 0
    lengths = np.array([len(s) for s in slots], np.int64)
    ends = np.cumsum(lengths)
    while start < len(docs):
        end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PART_RUNS, side="right")))
        known = np.array([d is not None for d in docs[start:end]])
        ids = np.array([d or 0 for d in docs[start:end]], np.int64)
        places = code[np.concatenate(slots[start:end])]
        out.append((number, None, part, _squeeze(ids, known, _small(lengths[start:end]), _small(places))))
        start, part = end, part + 1
    return pa.RecordBatch.from_pydict({"chunk": pa.array([r[0] for r in out], pa.int64()), "bucket": pa.array([r[1] for r in out], pa.int32()),
                                       "part": pa.array([r[2] for r in out], pa.int32()), "data": pa.array([r[3] for r in out], pa.binary())})


def split_runs(docs: DataFrame, doc_id: str, text: str, buckets: int, chunk_bytes: int) -> DataFrame:
    """Chunks of documents as places of runs, and the runs of each chunk by bucket (``PACKED``)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size = 0, 0
        docs, slots = [], []
        index: defaultdict[bytes, int] = defaultdict()
        index.default_factory = index.__len__
        base = TaskContext.get().partitionId() << 32

        def flush() -> pa.RecordBatch:
            counts = np.bincount(np.concatenate(slots), minlength=len(index)) if slots else np.zeros(0, np.int64)
            return _chunk(base + made, docs, slots, list(index), counts, buckets)

        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                data = data.as_py() or b""
                slots.append(np.array([index[run] for run in data.split()], np.int64))
                docs.append(doc)
                size += len(data)
                if size >= chunk_bytes:
                    yield flush()
                    made, size = made + 1, 0
                    docs.clear()
                    slots.clear()
                    index.clear()
        if docs:
            yield flush()

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(split, PACKED)


def encode_runs(packed: DataFrame, config: Broadcast) -> DataFrame:
    """Ids of the runs of each chunk, bucket by bucket; a bucket encodes a run once, whatever the number of its chunks."""

    def encode(table: pa.Table) -> pa.Table:
        words = vocabulary(config.value)
        known: dict[bytes, tuple[int, ...]] = {}
        data = []
        for blob in table.column("data"):
            gaps, runs = _open(blob.as_py())
            found = []
            for run in runs.tobytes().split(b"\n"):
                ids = known.get(run)
                if ids is None:
                    ids = known[run] = words.run(run.decode())
                found.append(ids)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            data.append(_squeeze(gaps, _small(sizes), _small(np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum())))))
        return pa.Table.from_pydict({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "part": table.column("part"),
                                     "data": pa.array(data, pa.binary())})

    return packed.where(F.col("bucket").isNotNull()).groupBy("bucket").applyInArrow(encode, PACKED)


def join_ids(packed: DataFrame, answers: DataFrame, config: Broadcast, keep_ids: bool, keep_text: bool) -> DataFrame:
    """Documents of each chunk with the ids of their runs, by place, and the pieces of those ids."""

    def join(docs: pa.Table, answers: pa.Table) -> pa.Table:
        pieces = vocabulary(config.value).pieces
        numbers = [str(i) for i in range(len(pieces))]
        parts = [_open(blob.as_py()) for blob in answers.column("data")]
        n = sum(len(p[0]) // 4 for p in parts)
        ids_of: list = [None] * n
        for gaps, sizes, flat in parts:
            flat, ends = from_byte_planes(flat, np.uint32).tolist(), np.cumsum(from_byte_planes(sizes, np.uint32)).tolist()
            start = 0
            for place, end in zip(np.cumsum(from_byte_planes(gaps, np.uint32)).tolist(), ends):
                ids_of[place] = flat[start:end]
                start = end
        if any(i is None for i in ids_of):
            raise ValueError("a chunk whose runs were not answered")
        sizes = np.fromiter(map(len, ids_of), np.int64, n)
        as_numbers = [" ".join([numbers[i] for i in ids]) for ids in ids_of]
        as_pieces = [" ".join([pieces[i] for i in ids]) for ids in ids_of]
        empty = bool((sizes == 0).any())
        rows = {c: [] for c in ("doc_id", "n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256")}
        blobs = [_open(blob) for _, blob in sorted(zip(docs.column("part").to_pylist(), docs.column("data").to_pylist()))]
        codes = [from_byte_planes(p[3], np.uint32).astype(np.int64) for p in blobs]
        new = n - sum(int((c == 0).sum()) for c in codes)
        for (doc_ids, known, lengths, _), code in zip(blobs, codes):
            single = code == 0
            places = np.where(single, new + np.cumsum(single) - 1, code - 1)
            new += int(single.sum())
            start = 0
            for doc, there, end in zip(doc_ids.tolist(), known.tolist(), np.cumsum(from_byte_planes(lengths, np.uint32)).tolist()):
                own = places[start:end]
                start = end
                if empty:
                    own = own[sizes[own] > 0]
                at = own.tolist()
                decoded = " ".join([as_pieces[i] for i in at])
                rows["doc_id"].append(doc if there else None)
                rows["n_tokens"].append(int(sizes[own].sum()))
                rows["ids"].append(list(chain.from_iterable([ids_of[i] for i in at])) if keep_ids else None)
                rows["ids_sha256"].append(hashlib.sha256(" ".join([as_numbers[i] for i in at]).encode()).hexdigest())
                rows["decoded"].append(decoded if keep_text else None)
                rows["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string(), pa.string(), pa.string())
        return pa.Table.from_pydict({c: pa.array(v, k) for (c, v), k in zip(rows.items(), kinds)})

    return (packed.where(F.col("bucket").isNull()).groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(join, RESULT))


def encode(docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = True, keep_text: bool = True,
           chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded, decoded_sha256) of every text by the tokenizer file at ``path``.

    Digests are of the decimal ids joined by a space and of the decoded text. ``keep_ids`` and ``keep_text`` drop the
    two long columns.
    """
    with open(path, encoding="utf-8") as file:
        config = docs.sparkSession.sparkContext.broadcast(file.read())
    vocabulary(config.value)
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // bucket_bytes))
    packed = settle(split_runs(docs, doc_id, text, int(buckets), chunk_bytes))
    rows = join_ids(packed, encode_runs(packed, config), config, keep_ids, keep_text)
    return rows.drop(*[c for c, keep in (("ids", keep_ids), ("decoded", keep_text)) if not keep])


def decode(rows: DataFrame, path: str, *, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, decoded) of lists of ids: exploded ids meet their pieces in a join, and go back in order.

    The vocabulary is broadcast: its size is that of the file. Ids that the file does not know give nothing, as do null
    or empty lists, which keep their row.
    """
    with open(path, encoding="utf-8") as file:
        pieces = vocabulary(file.read()).pieces
    table = rows.sparkSession.createDataFrame(list(enumerate(pieces)), "id int, piece string")
    keyed = settle(rows.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")))
    exploded = keyed.select("row", F.posexplode("ids").alias("place", "id")).join(F.broadcast(table), "id")
    joined = exploded.groupBy("row").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "piece"))), lambda s: s["piece"]), " ").alias("decoded"))
    return keyed.join(joined, "row", "left").select("doc_id", F.coalesce("decoded", F.lit("")).alias("decoded"))
