"""N-gram Jaccard join by a token-group matrix: groups of similar documents, opened only where needed.

A document is the set of its distinct word shingles; two link when
100 * intersection >= 75 * union (parameters). The result is exact: candidates come
from necessary conditions only, and every link that decides a component is verified on
whole sets. The steps:

1. Chunks of documents ask buckets in how many documents their shingles occur (module
   ``chunks``). Ordering a set from rare to frequent, two linked sets share a shingle
   among the first n - ceil(0.75 n) + 1, and the smaller one has it among its first
   n - ceil(6 n / 7) + 1. Shingles of one document only need no index, which removes
   nearly all of the documents that have no near copy.
2. Equal sets form a class, and only classes go on.
3. Groups and families. Of the smallest classes of its size band at each of its indexed
   shingles, a class picks the one it shares most with. If the two link, it joins that
   one's group, which is connected by verified links; if they come half-way to a link, it
   joins that one's family (within two steps), which needs no link.
4. Token-group matrix. For the shingles indexed in several families, a row per shingle and
   family is stored, with the sizes in the family, and a hashed token union of each family
   (64 words of bits). A class's overlap with a family is at most the shared bits plus its
   own colliding shingles; families below the necessary overlap stay closed.
5. In tiles of two blocks of at most about ``BLOCK_CLASSES`` classes each, the classes of a
   family and those that opened it are compared as whole sets, by the product of their
   shingle tables. A family's largest group is never compared with itself, and a tile
   returns at most one link a class, so that rows do not grow with the pairs of a family.
   Groups joined by a link form a component.

Shingles are 64-bit hashes of the words. Exact copies are counted in step 1 as
documents, which only makes a set's shingles look less rare.

Rows: every input row gives one row; repeated rows are copies of each other. Null or
empty texts, and texts without words, have an empty set and link with nothing. A
component is named by its smallest id; null ids take part and are named by the smallest
other id, or null. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scale import release, settle
from . import chunks as ch
from .rows import row_key, unused
from .textkit import IS_SPACE, Bytes, byte_planes, distinct, from_byte_planes, from_planes, pack, planes, shingle_hash, slices, span_hash, unpack

WIDTH = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
BIT_WORDS = 64
#: Classes of a block; a tile holds two.
BLOCK_CLASSES = 256
#: Shingles of a tile that are tabled at once.
TABLE_SHINGLES = 4096


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter word sequence is one shingle."""
    body = Bytes(texts, lower=True)
    starts, ends, docs = body.words(~IS_SPACE)
    words = span_hash(body.prefix(), starts, ends)
    first = np.searchsorted(docs, np.arange(body.docs + 1)).tolist()
    whole = shingle_hash(words, width) + np.uint64(width)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        w = min(width, b - a)
        if w == width:
            out.append(distinct(whole[a:b - width + 1]))
        else:
            out.append(shingle_hash(words[a:b], w) + np.uint64(w) if w else np.zeros(0, np.uint64))
    return out


def _level(count: np.ndarray) -> np.ndarray:
    """0 for one document, then 1 + floor(log2(count))."""
    return np.where(count < 2, 0, 1 + np.floor(np.log2(np.maximum(count, 1)))).astype(np.uint8)


def _lists(arrays: list[np.ndarray | None]) -> pa.Array:
    """Whole numbers as a list column, without a Python object for each."""
    sizes = [0 if a is None else len(a) for a in arrays]
    values = np.concatenate([np.zeros(0, np.int64), *[a for a in arrays if a is not None]])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values),
                                    mask=pa.array([a is None for a in arrays], pa.bool_()))


def sets_with_index(docs: DataFrame, *, width: int = WIDTH, percent: int = PERCENT, doc_id: str = "doc_id",
                    text: str = "text", chunk_bytes: int = 2 * ch.CHUNK_BYTES, bucket_bytes: int = ch.BUCKET_BYTES // 2) -> DataFrame:
    """(doc_id, row, class, n, tokens, shorts, bits, members) per document.

    ``tokens`` (indexed shingles, rarest first, ``shorts`` of them for the smaller side),
    ``bits`` and ``members`` are given once per class and chunk, where there are any.
    """
    rows, buckets = ch.dealt(docs.withColumn("row", row_key(doc_id, text)), doc_id=doc_id, text=text, chunk_bytes=chunk_bytes,
                             bucket_bytes=bucket_bytes, more=("row",))
    # frequencies are those of leading bits: a shingle that meets another one there only looks less rare
    cut = np.uint64(64 - ch.key_bits(buckets))

    def chunk_sets(table: pa.Table) -> list[np.ndarray]:
        return [s for part in slices(ch.parts_of(table)) for s in shingle_sets(part.column(1), width)]

    def ask(table: pa.Table, chunk: int, _: list) -> pa.Table:
        keys, count = np.unique(np.concatenate(chunk_sets(table)) >> cut, return_counts=True)
        at = ch.bucket_bounds(keys << cut, buckets)
        used = np.flatnonzero(np.diff(at))
        data = [pack(planes(keys[at[b]:at[b + 1]]), byte_planes(count[at[b]:at[b + 1]].astype(np.uint32))) for b in used]
        n = len(used)
        return pa.Table.from_pydict({"bucket": pa.array(used, pa.int32()), "chunk": pa.array([chunk] * n, pa.int32()),
                                     "stage": pa.array([0] * n, pa.int32()), "data": pa.array(data, pa.binary())})

    def frequency(table: pa.Table) -> pa.Table:
        parts = [unpack(x.as_py()) for x in table.column("data")]
        keys = [from_planes(p[0]) for p in parts]
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        level = _level(np.bincount(place, np.concatenate([from_byte_planes(p[1], np.uint32) for p in parts])))[place]
        ends = np.cumsum([len(k) for k in keys])
        data = [pack(level[e - len(k):e]) for k, e in zip(keys, ends)]
        return table.set_column(table.schema.get_field_index("data"), "data", pa.array(data, pa.binary()))

    def index(table: pa.Table, chunk: int, answers: list) -> pa.Table:
        sets = chunk_sets(table)
        _, place = np.unique(np.concatenate(sets) >> cut, return_inverse=True)
        level = (answers[0][0] if answers and answers[0] else np.zeros(0, np.uint8))[place]
        ends = np.cumsum([len(s) for s in sets])
        out, known = {c: [] for c in ("class", "n", "tokens", "shorts", "bits", "members")}, set()
        for s, end in zip(sets, ends.tolist()):
            n = len(s)
            name = hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if n else None
            tokens = bits = members = shorts = None
            own = level[end - n:end]
            if name not in known and own.any():
                known.add(name)
                order = np.argsort(own, kind="stable")[:n - ceil(percent * n / 100) + 1]
                shared = own[order] > 0
                if shared.any():
                    tokens = s[order[shared]].view(np.int64)
                    shorts = int(shared[:n - ceil(2 * percent * n / (100 + percent)) + 1].sum())
                    mark = np.zeros(64 * BIT_WORDS, np.uint8)
                    mark[s & np.uint64(64 * BIT_WORDS - 1)] = 1
                    bits, members = np.packbits(mark).view(np.int64), s.tobytes()
            for c, v in zip(out, (name, n, tokens, shorts, bits, members)):
                out[c].append(v)
        return pa.Table.from_arrays([*[table.column(c).combine_chunks() for c in ("doc_id", "row")], *[
            _lists(out[c]) if t is None else pa.array(out[c], t) for c, t in zip(out, (
                pa.string(), pa.int64(), None, pa.int32(), None, pa.binary()))]],
            names=["doc_id", "row", *out])

    answers = ch.by_bucket(ch.ask(rows, ask), buckets).groupBy("bucket").applyInArrow(frequency, ch.BLOCK)
    return ch.ask(rows, index, answers, "doc_id bigint, row string, class string, n bigint, tokens array<bigint>, shorts int, "
                                        "bits array<bigint>, members binary")


def compared(pairs: DataFrame, members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, linked, near) of (a, b) pairs by their whole sets; near is half-way to a link. ``members`` has (class, members)."""

    def run(batches):
        for batch in batches:
            linked, near = [], []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
                near.append(200 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(linked, pa.bool_()), pa.array(near, pa.bool_())],
                                             names=["a", "b", "linked", "near"])

    left = members.select(F.col("class").alias("a"), F.col("members").alias("x"))
    right = members.select(F.col("class").alias("b"), F.col("members").alias("y"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(
        run, "a string, b string, linked boolean, near boolean")


def followed(parents: DataFrame) -> DataFrame:
    """(node, root) from (node, root) pointers without cycles, by doubling until nothing moves."""
    at = settle(parents)
    while True:
        up = at.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = settle(at.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root"),
                                                        F.coalesce(F.col("next") != F.col("root"), F.lit(False)).alias("moved")))
        at = new.drop("moved")
        if not new.where("moved").limit(1).count():
            return at


def components(links: DataFrame) -> DataFrame:
    """(node, root) of an undirected graph (a, b): smallest name reachable, by labels that also follow each other."""
    edges = settle(links.select("a", "b").union(links.select("b", "a")).distinct())
    at = settle(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")))
    while True:
        near = edges.join(at.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        step = at.join(near.withColumnRenamed("a", "node"), "node", "left").select("node", "root", F.least("root", "near").alias("low"))
        up = at.select(F.col("node").alias("low"), F.col("root").alias("lower"))
        new = settle(step.join(up, "low", "left").select("node", F.least("low", "lower").alias("new"), "root"))
        moved = new.where(F.col("new") != F.col("root")).limit(1).count()
        at = new.select("node", F.col("new").alias("root"))
        if not moved:
            return at


def _shared_bits(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseAND(b))), F.lit(0), lambda s, c: s + c)


def _own_bits(x: Column) -> Column:
    return F.aggregate(F.transform(x, F.bit_count), F.lit(0), lambda s, c: s + c)


def groups_of(classes: DataFrame, members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(class, group, family): classes gathered around smaller ones they link with or come near; a group is connected."""
    # sets that link lie in the same size band or in neighbouring ones
    band = F.floor(F.log(F.col("n").cast("double")) / log(100 / percent)) if percent < 100 else F.col("n")
    entries = classes.select("class", "n", band.alias("band"), F.explode("tokens").alias("token"))
    heads = entries.groupBy("token", "band").agg(F.min(F.struct("n", "class")).alias("head"), F.count(F.lit(1)).alias("size")) \
        .where(F.col("size") > 1).select("token", "band", "head")
    picked = entries.join(heads, ["token", "band"]).where(F.col("head.class") != F.col("class")) \
        .groupBy("class", "head").agg(F.count(F.lit(1)).alias("shared")) \
        .groupBy("class").agg(F.max(F.struct("shared", (-F.col("head.n")).alias("size"), F.col("head.class").alias("a"))).alias("best"))
    met = settle(compared(picked.select(F.col("best.a").alias("a"), F.col("class").alias("b")), members, percent))
    alone = classes.select(F.col("class").alias("b"))
    # a pointer goes to a smaller (size, class) pair, so pointers have no cycles
    groups = followed(alone.join(met.where("linked"), "b", "left").select(F.col("b").alias("node"), F.coalesce("a", "b").alias("root")))
    near = met.where("near").select(F.col("b").alias("class"), F.col("a").alias("first"))
    beyond = near.select(F.col("class").alias("first"), F.col("first").alias("second"))
    family = near.join(beyond, "first", "left").select("class", F.coalesce("second", "first").alias("family"))
    return groups.select(F.col("node").alias("class"), F.col("root").alias("group")).join(family, "class", "left").select(
        "class", "group", F.coalesce("family", "class").alias("family"))


def opened(classes: DataFrame, groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(class, family): families in which a class of another, smaller-named family may have a link."""
    own = classes.join(groups, "class").select("class", "family", "n", "shorts", "tokens", "bits")
    entries = own.select("class", "family", "n", "shorts", F.posexplode("tokens").alias("i", "token")) \
        .select("class", "family", "n", "token", (F.col("i") < F.col("shorts")).alias("short"))
    matrix = settle(entries.groupBy("token", "family").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("short").alias("any_short")))
    mixed = matrix.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("token")
    cells = matrix.join(mixed, "token").select("token", F.col("family").alias("other"), "least", "most", "any_short")
    asked = entries.join(cells, "token").where(
        (F.col("family") < F.col("other")) & (100 * F.col("most") >= percent * F.col("n"))
        & (percent * F.col("least") <= 100 * F.col("n")) & (F.col("short") | F.col("any_short"))) \
        .select("class", "other").distinct()
    asked = settle(asked)
    union = own.join(asked.select(F.col("other").alias("family")).distinct(), "family", "left_semi").groupBy("family").agg(
        *[F.bit_or(F.col("bits")[i]).alias(f"w{i}") for i in range(BIT_WORDS)]) \
        .select(F.col("family").alias("other"), F.array(*[f"w{i}" for i in range(BIT_WORDS)]).alias("union"))
    sized = own.select("class", "n", "bits")
    most = _shared_bits(F.col("bits"), F.col("union")) + F.col("n") - _own_bits(F.col("bits"))
    return asked.join(sized, "class").join(union, "other").where(100 * most >= percent * F.col("n")).select(
        "class", F.col("other").alias("family"))


def tile_links(sets: list[np.ndarray], may: np.ndarray, percent: int) -> np.ndarray:
    """For each set the first set of its component, by links among the pairs marked in ``may``."""
    n = np.array([len(s) for s in sets])
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), n)
    shared = count > 1
    column = np.cumsum(shared) - 1
    keep = shared[place]
    row, column = row[keep], column[place[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(shared.sum()), TABLE_SHINGLES):
        a, b = np.searchsorted(column, [start, start + TABLE_SHINGLES])
        table = np.zeros((len(sets), TABLE_SHINGLES), np.float32)
        table[row[a:b], column[a:b] - start] = 1
        both += table @ table.T
    links = may & (100 * both.astype(np.int64) >= percent * (n[:, None] + n[None, :] - both.astype(np.int64)))
    links |= links.T
    label = np.arange(len(sets))
    while True:
        low = np.minimum(label, np.where(links, label[None, :], len(sets)).min(axis=1, initial=len(sets)))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def links_between(classes: DataFrame, members: DataFrame, groups: DataFrame, percent: int = PERCENT,
                  block: int = BLOCK_CLASSES) -> DataFrame:
    """(a, b) groups joined by verified links: all links between groups follow from these."""
    sizes = settle(groups.groupBy("family", "group").agg(F.count(F.lit(1)).alias("size")))
    main = sizes.groupBy("family").agg(F.max(F.struct("size", "group")).alias("main"))
    asking = opened(classes, groups, percent).join(groups.select("class", "group"), "class").select(
        "family", "class", "group", F.lit(True).alias("asks"))
    several = sizes.groupBy("family").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("family")
    asking = settle(asking)
    wanted = several.union(asking.select("family")).distinct()
    inside = groups.join(wanted, "family", "left_semi").select("family", "class", "group", F.lit(False).alias("asks"))
    rows = inside.union(asking).join(main, "family").select(
        "family", "class", "group", "asks", (~F.col("asks") & (F.col("group") == F.col("main.group"))).alias("core"))
    # the blocks of the main group come first and do not meet each other
    shape = rows.groupBy("family").agg(F.ceil(F.sum(F.col("core").cast("int")) / block).alias("cores"),
                                       F.ceil(F.sum((~F.col("core")).cast("int")) / block).alias("rests"))
    at = F.pmod(F.xxhash64("class"), F.when(F.col("core"), F.col("cores")).otherwise(F.col("rests"))) \
        + F.when(F.col("core"), 0).otherwise(F.col("cores"))
    others = F.when(F.col("core"), F.sequence("cores", F.col("cores") + F.col("rests") - 1)) \
        .otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("cores") + F.col("rests") - 1))
    placed = rows.join(shape, "family").withColumn("at", at).withColumn("other", others).join(members, "class").select(
        "family", "group", "asks", "at", "members", F.explode("other").alias("other"))
    tiles = placed.select("family", F.least("at", "other").alias("x"), F.greatest("at", "other").alias("y"), "group", "asks", "at", "members")

    def tile(table: pa.Table) -> pa.Table:
        names = np.array(table.column("group").to_pylist(), object)
        _, group = np.unique(names.astype(str), return_inverse=True)
        asks, at = (table.column(c).to_numpy() for c in ("asks", "at"))
        may = (group[:, None] != group[None, :]) & ~(asks[:, None] & asks[None, :])
        if table.column("x")[0].as_py() != table.column("y")[0].as_py():
            may &= at[:, None] != at[None, :]
        root = tile_links([np.frombuffer(b, np.uint64) for b in table.column("members").to_pylist()], may, percent) if may.any() \
            else np.arange(len(names))
        joined = np.flatnonzero(group != group[root])
        return pa.table({"a": pa.array(names[joined], pa.string()), "b": pa.array(names[root[joined]], pa.string())})

    return tiles.groupBy("family", "x", "y").applyInArrow(tile, "a string, b string").distinct()


def membership(docs: DataFrame, *, width: int = WIDTH, percent: int = PERCENT, **columns) -> DataFrame:
    """(doc_id, row, n, root) for every document; ``root`` names its component, null for an empty set."""
    spark = docs.sparkSession
    sets = settle(sets_with_index(docs, width=width, percent=percent, **columns))
    release(spark)
    indexed = sets.where(F.col("tokens").isNotNull())
    classes = settle(indexed.select("class", "n", "tokens", "shorts", "bits").dropDuplicates(["class"]))
    members = indexed.select("class", "members").dropDuplicates(["class"])
    groups = settle(groups_of(classes, members, percent))
    release(spark)
    joined = components(links_between(classes, members, groups, percent))
    release(spark)
    roots = groups.join(joined.withColumnRenamed("node", "group"), "group", "left").select(
        "class", F.coalesce("root", "group").alias("root"))
    return sets.select("doc_id", "row", "class", "n").join(roots, "class", "left").select(
        "doc_id", "row", "n", F.coalesce("root", "class").alias("root"))


def join(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id, component_size) for every document."""
    rows = settle(membership(docs, **options))
    ids = rows.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("size"))
    return rows.join(ids, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("first")).alias("component_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("component_size"))


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one document of each component, the one of smallest id, unchanged.

    Documents without words all stay; rows that agree in id and text count as one document.
    """
    rows = membership(docs, doc_id=doc_id, text=text, **options)
    kept = rows.groupBy(F.coalesce("root", "row").alias("root")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    row = unused(docs, "row")
    keyed = docs.withColumn(row, row_key(doc_id, text))
    return keyed.join(kept.select(F.col("first.row").alias(row)), row, "left_semi").dropDuplicates([row]).select(*docs.columns)
