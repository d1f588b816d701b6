"""Phrases that hold together, mined from a weighted de Bruijn graph of words.

1. Words: a chunk of texts keeps a table of its distinct words per language; buckets add up the counts of all
   chunks, number the words of at least ``least`` occurrences and send the numbers back by place. A rarer word
   can be in no phrase of that count, so it ends a piece, like a separator.
2. Edges: every place of a piece starts one gram of ``LONGEST`` words, an edge between two overlapping nodes of one word less;
   a gram that the end of its piece cuts short is kept with zeros. Chunks count their edges, buckets add them up.
3. Flow: the count of a shorter gram is the flow out of its node, the sum over the edges that begin with it, plus
   the piece ends that the zeros mark. Width by width, sums of one bucket go on to the buckets of the next width.
4. Paths: the edges of at least ``least`` occurrences are compacted through nodes with one edge in and one out;
   the largest longer count around each node is read from the paths.

Only counts of distinct edges travel, already added up in their chunk, and buckets are dealt by the whole gram, so
neither a word, a phrase nor a line of a third of all texts gathers in one task. Chunks and buckets grow in number
with the text, not in size. All counts are exact, over all texts.

Null texts are empty, a null language is ``und``; ids are not read, so null and repeated ids and repeated rows count as
they stand, and so do columns of any other name. Very long texts are one chunk. Ties are ordered as stated at ``collocations``.
Empty tables give no phrases.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallygrid.functions.scale import settle

from .textkit import byte_planes, from_byte_planes, mix, pack, unpack

CHUNK_BYTES = 6 << 20
BUCKET_BYTES = 8 << 20
LONGEST = 4
LEAST = 30
PART_WORDS = 1 << 20
PATH_EDGES = 4096
SALTS = 64

#: What ends a piece, as bytes.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"

_STOP = b"\xff"  # never part of UTF-8
_FOLD = bytes.maketrans(bytes(range(65, 91)) + PIECE_ENDS, bytes(range(97, 123)) + b"\n" * len(PIECE_ENDS))

WORDS = "chunk bigint, bucket int, part int, lang string, data binary"
COUNTED = "kind string, chunk bigint, lang string, id bigint, word string, n bigint, data binary"
STEP = "bucket int, found boolean, data binary"


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=5).compress(data)


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes, four bytes each where they fit."""
    small = [a.astype(np.uint32 if not len(a) or int(a.max()) < 1 << 32 else np.uint64) for a in arrays]
    return _zip(pack(np.array([a.itemsize for a in small]), *map(byte_planes, small)))


def _plain(blob: bytes) -> list[np.ndarray]:
    sizes, *columns = unpack(_unzip(blob))
    return [from_byte_planes(c, np.uint32 if s == 4 else np.uint64).astype(np.uint64) for s, c in zip(sizes, columns)]


# ---------------------------------------------------------------- words

def split_words(docs: DataFrame, text: str, lang: str, buckets: int, chunk_bytes: int) -> DataFrame:
    """Chunks of texts as places of words (bucket null), and the words of each chunk with their counts by bucket and language."""

    def rows(chunk: int, places: list, index: dict[str, defaultdict]) -> Iterator[tuple]:
        # place 0 is the end of a piece; other places count through all languages
        every = np.concatenate(places)
        counts = np.bincount(every, minlength=1 + sum(map(len, index.values())))
        for name, words in index.items():
            owner: defaultdict[int, list] = defaultdict(list)
            for word in words:
                owner[xxhash.xxh3_64_intdigest(word, seed=1) % buckets].append(word)
            for bucket, own in owner.items():
                at = np.array([words[w] for w in own], np.uint64)
                yield chunk, bucket, 0, name, pack(np.frombuffer(_squeeze(at, counts[at]), np.uint8),
                                                   np.frombuffer(_zip(b" ".join(own)), np.uint8))
        for part, start in enumerate(range(0, len(every), PART_WORDS)):
            yield chunk, None, part, None, _squeeze(every[start:start + PART_WORDS])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, size, used = TaskContext.get().partitionId() << 32, 0, 0, 0
        places: list[np.ndarray] = []
        index: dict[str, defaultdict] = {}

        def flush() -> pa.RecordBatch:
            columns = zip(*rows(base + made, places, index))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.binary()))],
                                              names=["chunk", "bucket", "part", "lang", "data"])

        def fresh() -> int:
            nonlocal used
            used += 1
            return used

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                data = (data.as_py() or b"").translate(_FOLD).replace(b"\n", b" " + _STOP + b" ")
                words = index.get(name)
                if words is None:
                    words = index[name] = defaultdict(fresh)
                places.append(np.array([0 if w == _STOP else words[w] for w in data.split()] + [0], np.uint32))
                size += len(data)
                if size >= chunk_bytes:
                    yield flush()
                    made, size, used = made + 1, 0, 0
                    places.clear()
                    index.clear()
        if places:
            yield flush()

    return docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text")).mapInArrow(split, WORDS)


def count_words(split: DataFrame, buckets: int, least: int) -> DataFrame:
    """``COUNTED``: numbers of frequent words by place (``places``), the words themselves (``word``), all occurrences (``total``)."""

    def count(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        totals: dict[str, Counter] = defaultdict(Counter)
        parts = []
        for chunk, lang, blob in sorted(zip(*(table.column(c).to_pylist() for c in ("chunk", "lang", "data"))), key=lambda r: r[:2]):
            numbers, words = unpack(blob)
            at, counts = _plain(numbers.tobytes())
            words = _unzip(words.tobytes()).split(b" ")
            own = totals[lang]
            for word, n in zip(words, counts.tolist()):
                own[word] += n
            parts.append((chunk, lang, at, words))
        numbers: dict[str, dict] = {lang: {} for lang in totals}
        out = [("total", None, lang, None, None, sum(counts.values()), None) for lang, counts in totals.items()]
        # frequent words get small numbers, which pack well
        frequent = sorted((-n, lang, word) for lang, counts in totals.items() for word, n in counts.items() if n >= least)
        for given, (n, lang, word) in enumerate(frequent):
            numbers[lang][word] = 1 + bucket + buckets * given
            out.append(("word", None, lang, numbers[lang][word], word.decode(), -n, None))
        for chunk, lang, at, words in parts:
            ids = np.array([numbers[lang].get(w, 0) for w in words], np.uint64)
            out.append(("places", chunk, lang, None, None, None, _squeeze(at[ids > 0], ids[ids > 0])))
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
        names = [c.split()[0] for c in COUNTED.split(", ")]
        return pa.Table.from_pydict({n: pa.array(c, k) for n, c, k in zip(names, zip(*out), kinds)})

    return split.where(F.col("bucket").isNotNull()).groupBy("bucket").applyInArrow(count, COUNTED)


# ---------------------------------------------------------------- edges and flow

def add_up(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows in order and the sums of their counts."""
    if not len(n):
        return columns, n
    keys: list[np.ndarray] = []
    size = 1 << 63
    for c in columns:
        many = int(c.max()) + 1
        if size * many < 1 << 63:
            keys[-1] = keys[-1].astype(np.uint64) * np.uint64(many) + c
            size *= many
        else:
            keys.append(c)
            size = many
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(n), bool)
    new[0] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    return [c[order[first]] for c in columns], np.add.reduceat(n[order], first)


def _deal(columns: list[np.ndarray], n: np.ndarray, buckets: int, found: bool) -> list[tuple]:
    """Rows of ``STEP``: grams dealt to buckets by a hash of the whole gram."""
    h = np.zeros(len(n), np.uint64)
    for c in columns:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + c)
    owner = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    edges = np.searchsorted(owner[order], np.arange(buckets + 1))
    return [(int(b), found, _squeeze(*[c[order[edges[b]:edges[b + 1]]] for c in (*columns, n)])) for b in np.flatnonzero(np.diff(edges))]


def _steps(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_pydict({"bucket": pa.array([r[0] for r in rows], pa.int32()), "found": pa.array([r[1] for r in rows], pa.bool_()),
                                 "data": pa.array([r[2] for r in rows], pa.binary())})


def edges(split: DataFrame, counted: DataFrame, buckets: int) -> DataFrame:
    """Counts of the longest grams of every chunk, cut short by zeros at the ends of pieces."""

    def grams(docs: pa.Table, answers: pa.Table) -> pa.Table:
        # parts of a chunk are pieces of one sequence
        words = np.concatenate([*[_plain(blob)[0].astype(np.uint32) for _, blob in sorted(zip(
            docs.column("part").to_pylist(), docs.column("data").to_pylist()))], np.zeros(LONGEST - 1, np.uint32)])
        ids = np.zeros(1 + int(words.max()), np.uint64)
        for blob in answers.column("data"):
            place, number = _plain(blob.as_py())
            ids[place.astype(np.int64)] = number
        words[ids[words] == 0] = 0
        # grams of places, which are small; their distinct ones become grams of numbers
        at = np.flatnonzero((words[:-LONGEST + 1] > 0) & (words[1:len(words) - LONGEST + 2] > 0))
        columns = [words[at + k] for k in range(LONGEST)]
        del at, words
        for k in range(2, LONGEST):
            columns[k][columns[k - 1] == 0] = 0
        columns, n = add_up(columns, np.ones(len(columns[0]), np.uint32))
        out = _steps(_deal([ids[c] for c in columns], n.astype(np.uint64), buckets, False))
        pa.default_memory_pool().release_unused()
        return out

    docs = split.where(F.col("bucket").isNull()).select("chunk", "part", "data")
    answers = counted.where("kind = 'places'").select("chunk", "data")
    return docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(grams, STEP)


def flow(steps: DataFrame, width: int, buckets: int, least: int) -> DataFrame:
    """Totals of grams of ``width`` words; frequent ones are found, sums over the last word go on to the next width."""

    def total(table: pa.Table) -> pa.Table:
        out, parts = [], []
        for bucket, found, blob in zip(*(table.column(c).to_pylist() for c in ("bucket", "found", "data"))):
            if found:
                out.append((bucket, True, blob))
            else:
                parts.append(_plain(blob))
        if parts:
            *columns, n = [np.concatenate(c) for c in zip(*parts)]
            columns, n = add_up(columns, n)
            keep = (columns[-1] > 0) & (n >= least)
            if keep.any():
                out.append((int(table.column("bucket")[0].as_py()), True, _squeeze(*[c[keep] for c in columns], n[keep])))
            if width > 2:
                out += _deal(*add_up(columns[:-1], n), buckets, False)
        pa.default_memory_pool().release_unused()
        return _steps(out)

    return steps.groupBy("bucket").applyInArrow(total, STEP)


def grams(found: DataFrame) -> DataFrame:
    """(words array<bigint>, n) of the grams found."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                *columns, n = _plain(blob.as_py())
                flat = np.stack(columns, axis=1).astype(np.int64)
                offsets = np.arange(len(n) + 1, dtype=np.int32) * len(columns)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel())), pa.array(n.astype(np.int64))],
                                                 names=["words", "n"])

    return found.where("found").select("data").mapInArrow(rows, "words array<bigint>, n bigint")


def graph(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, chunk_bytes: int = CHUNK_BYTES,
          bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, n) of all grams of 2 to ``LONGEST`` words that occur ``least`` times, (lang, id, word, n) of such words, (lang, n) of all words."""
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    buckets = int(max(1, -(-size // bucket_bytes)))
    split = settle(split_words(docs, text, lang, buckets, chunk_bytes))
    counted = settle(count_words(split, buckets, least))
    steps = edges(split, counted, buckets)
    for width in range(LONGEST, 1, -1):
        steps = flow(steps, width, buckets, least)
    words = counted.where("kind = 'word'").select("lang", "id", "word", "n")
    totals = counted.where("kind = 'total'").groupBy("lang").agg(F.sum("n").alias("n"))
    return settle(grams(steps)), words, totals


# ---------------------------------------------------------------- paths

def _follow(links: DataFrame) -> DataFrame:
    """(edge, head, steps, lowest, done) by pointer doubling over (edge, before); edges of cycles are never done, starts have no head."""
    state = settle(links.select("edge", F.col("before").alias("head"), F.when(F.col("before").isNull(), 0).otherwise(1).cast("bigint").alias("steps"),
                                F.least("edge", "before").alias("lowest"), F.col("before").isNull().alias("done")))
    def double(state: DataFrame) -> DataFrame:
        back = state.select(F.col("edge").alias("head"), F.col("head").alias("further"), F.col("steps").alias("more"), F.col("lowest").alias("low"), F.col("done").alias("last"))
        return state.join(back, "head", "left").select(
            "edge", F.when(F.col("done"), F.col("head")).otherwise(F.coalesce("further", "head")).alias("head"),
            F.when(F.col("done"), F.col("steps")).otherwise(F.col("steps") + F.col("more")).alias("steps"),
            F.when(F.col("done"), F.col("lowest")).otherwise(F.least("lowest", "low")).alias("lowest"), (F.col("done") | F.col("last")).alias("done"))

    before = None
    while True:
        now = state.where("NOT done").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("edge", "lowest")).alias("h")).first()
        # each doubling finishes more of every open chain: when nothing moves, whole cycles are left, each with its smallest edge
        if not now["n"] or now == before:
            break
        before, state = now, settle(double(double(state)))
    return state


def paths(found: DataFrame, path_edges: int = PATH_EDGES) -> DataFrame:
    """(words, counts) of the frequent edges, compacted through nodes with one edge in and one out.

    ``words`` has ``LONGEST`` - 1 entries more than ``counts``. A cycle is opened at its smallest edge, and paths are cut after
    ``path_edges`` edges; pieces of a path share the node between them.
    """
    node = LONGEST - 1
    rows = settle(found.where(F.size("words") == LONGEST).select(
        F.col("words").alias("edge"), "n", F.slice("words", 1, node).alias("tail"), F.slice("words", 2, node).alias("tip")))
    into = rows.groupBy(F.col("tip").alias("node")).agg(F.count(F.lit(1)).alias("n_in"), F.min("edge").alias("before"))
    out = rows.groupBy(F.col("tail").alias("node")).agg(F.count(F.lit(1)).alias("n_out"), F.min("edge").alias("edge"))
    inner = into.where("n_in = 1").join(out.where("n_out = 1"), "node").select("edge", "before")
    # an edge that follows itself is a path of its own
    links = settle(rows.select("edge").join(inner.where("edge != before"), "edge", "left"))
    state = _follow(links)
    circles = state.where("NOT done")
    if not circles.isEmpty():
        opened = circles.select("edge", "lowest").join(links, "edge").select(
            "edge", F.when(F.col("edge") != F.col("lowest"), F.col("before")).alias("before"))
        state = state.where("done").unionByName(_follow(opened))
    placed = state.select("edge", F.coalesce("head", "edge").alias("head"), "steps", F.floor(F.col("steps") / path_edges).alias("piece"))
    return (placed.join(rows.select("edge", "n"), "edge").groupBy("head", "piece")
            .agg(F.array_sort(F.collect_list(F.struct("steps", "edge", "n"))).alias("e"))
            .select(F.concat(F.slice(F.col("e")[0]["edge"], 1, node), F.transform("e", lambda s: F.element_at(s["edge"], -1))).alias("words"),
                    F.transform("e", lambda s: s["n"]).alias("counts")))


def covers(found: DataFrame) -> DataFrame:
    """(words, most): the largest count among the longer grams that hold a gram."""
    node = LONGEST - 1
    walked = paths(found).select(F.explode(F.transform(F.sequence(F.lit(0), F.size("counts")), lambda i: F.struct(
        F.slice("words", i + 1, node).alias("words"),
        F.greatest(F.get("counts", i - 1), F.get("counts", i)).alias("most")))).alias("s")).select("s.words", "s.most")
    # a gram of two inside longer ones is also inside one of three, whose count is no smaller
    shorter = [found.where(F.size("words") == size).select(
        F.explode(F.array(F.slice("words", 1, size - 1), F.slice("words", 2, size - 1))).alias("words"), F.col("n").alias("most"))
        for size in range(3, LONGEST)]
    for rows in shorter:
        walked = walked.unionByName(rows)
    return walked.groupBy("words").agg(F.max("most").alias("most"))


# ---------------------------------------------------------------- collocations

def _exact(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = 2000, share: int = 80,
                 **sizes) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each language that hold together best.

    ``score`` is that of the weakest cut, floor(2,000,000 a / (l + r)), ties to the first cut; phrases inside a longer
    one with ``share`` percent of their count or more go. Order: score and a descending, phrase ascending in UTF-8 bytes.
    """
    found, words, totals = graph(docs, text=text, lang=lang, least=least, **sizes)
    known = found.select("words", F.col("n").alias("part")).unionByName(words.select(F.array("id").alias("words"), F.col("n").alias("part")))
    kept = found.join(covers(found), "words", "left").where(
        F.coalesce(_exact("most") * 100 < _exact("n") * share, F.lit(True))).select("words", F.col("n").alias("a"))
    size = F.size("words")
    cuts = kept.select("words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    sides = cuts.select(F.col("words").alias("phrase"), "a", "k", F.explode(F.array(
        F.struct(F.lit(True).alias("left"), F.slice("words", F.lit(1), F.col("k")).alias("words")),
        F.struct(F.lit(False).alias("left"), F.slice("words", F.col("k") + 1, size - F.col("k")).alias("words")))).alias("s")).select(
        "phrase", "a", "k", "s.left", "s.words")
    both = sides.join(known, "words").groupBy("phrase", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("part"))).alias("l"), F.max(F.when(~F.col("left"), F.col("part"))).alias("r"))
    floor = F.expr("CAST((CAST(a AS DECIMAL(20,0)) * CAST(2000000 AS DECIMAL(7,0))) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS BIGINT)")
    weakest = both.withColumn("score", floor).groupBy("phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = weakest.select("phrase", "a", "cut.l", "cut.r", "cut.score", F.col("phrase")[0].alias("id")).join(words.select("id", "lang"), "id")
    # ties beyond the last rank stay until the words are known
    by_lang = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(F.desc("score"), F.desc("a"))
    near = scored.withColumn("place", F.rank().over(salted)).where(F.col("place") <= top)
    near = near.withColumn("place", F.rank().over(by_lang)).where(F.col("place") <= top)
    spelled = near.select("phrase", F.posexplode("phrase").alias("at", "id")).join(words.select("id", "word"), "id").groupBy("phrase").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda s: s["word"]), " ").alias("text"))
    ranked = near.join(spelled, "phrase").withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text"))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
