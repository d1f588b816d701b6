"""Prefix trie of conversations by whole-sequence collapse.

1. Conversations are rebuilt from slim rows: a turn travels as two 64-bit hashes of (role, text)
   and its code points, once its place among the turns of its conversation is known.
2. Identical rebuilt conversations become one weighted sequence, represented by its smallest id,
   with the list of the conversations that end there.
3. Sequences that are proper prefixes of another sequence go by an anti-join; the rest are leaves.
4. The prefixes of the weighted sequences are aggregated to nodes.

A prefix of d turns is named by its depth and two xors of hashes of (place, turn), 128 bits in all.
A conversation with many turns is cut into blocks whose xors and lengths are added up afterwards,
so no conversation has to fit into a task. Every aggregate combines on the map side: a turn that
opens a third of all conversations costs a row per task.

Sums over subtrees need no walk. A node belongs to its smallest conversation; that conversation
owns the deep end of its own sequence, from depth ``lo`` on. With A(s, d) the code points of
sequence s from turn d on and w its weight, the subtree of a node of depth d saves
sum(w A(s, d)) - sum(A(s, max(d, lo))) over the sequences s that pass through it.

Null conv_ids belong to no conversation. Null roles and texts are empty; null turns come first; equal turns
are ordered by role, then text (UTF-8 bytes); repeated rows are turns of their own. Very long texts
are hashed where they are read. Columns beyond the four named ones are not read. An empty table has
no conversation, hence no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallygrid.functions.scale import HOT_ROWS, settle, windowed

BLOCK_TURNS = 4096
LIST_IDS = 4096


def rebuild(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            family: int = 100, heads: int = 6, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(conv_id, depth, a, b, size): hashes and code points of every turn of the rebuilt conversations, and a row of depth 0 for each.

    A conversation c takes the first h turns of conversation c - c % ``family``, h = crc32(c) % ``heads``, then its own after h.
    """
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    numbered = windowed(rows, ["conv_id"], ["turn", "role", "text"], lambda frame, _: frame, position="place", hot_rows=hot_rows)
    numbered = settle(numbered.select(
        "conv_id", F.col("place").cast("bigint").alias("place"), F.xxhash64(F.lit(1), "role", "text").alias("a"),
        F.xxhash64(F.lit(2), "role", "text").alias("b"), F.char_length("text").cast("bigint").alias("size")))
    first = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    own = numbered.where(F.col("place") > first)
    known = numbered.where(F.col("place") == 1).select(
        F.col("conv_id").alias("conv"), (F.col("conv_id") - F.col("conv_id") % family).alias("conv_id"), first.alias("h"))
    opening = numbered.where((F.col("conv_id") % family == 0) & (F.col("place") < heads))
    copied = known.join(opening, "conv_id").where(F.col("place") <= F.col("h")).select(F.col("conv").alias("conv_id"), "place", "a", "b", "size")
    roots = known.select(F.col("conv").alias("conv_id"), *[F.lit(0).cast("bigint").alias(c) for c in ("place", "a", "b", "size")])
    joined = roots.unionByName(copied).unionByName(own)
    deep = windowed(joined, ["conv_id"], ["place"], lambda frame, _: frame, position="depth", hot_rows=hot_rows)
    return deep.select("conv_id", (F.col("depth") - 1).alias("depth"), "a", "b", "size")


def _placed(turn: str) -> Column:
    return F.when(F.col("depth") == 0, F.lit(0).cast("bigint")).otherwise(F.xxhash64("depth", turn))


def sequences(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, end, x, y, total) of every conversation, and the distinct sequences: conv_id of the smallest, weight."""
    whole = turns.groupBy("conv_id").agg(
        F.max("depth").alias("end"), F.bit_xor(_placed("a")).alias("x"), F.bit_xor(_placed("b")).alias("y"), F.sum("size").alias("total"))
    distinct = whole.groupBy("end", "x", "y").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.first("total").alias("total"))
    return whole, distinct


def prefixes(turns: DataFrame, distinct: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Every prefix of the distinct sequences: its key (depth, x, y), its parent's, code points of its last turn and so far."""
    rows = (turns.join(distinct.select("conv_id", "end", "weight", "total"), "conv_id")
            .withColumn("ax", _placed("a")).withColumn("by", _placed("b"))
            .withColumn("block", F.floor(F.col("depth") / block_turns)))
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (rows.where(F.col("end") >= block_turns).groupBy("conv_id", "block")
              .agg(F.bit_xor("ax").alias("ax"), F.bit_xor("by").alias("by"), F.sum("size").alias("size"))
              .select("conv_id", "block", F.bit_xor("ax").over(before).alias("x0"), F.bit_xor("by").over(before).alias("y0"),
                      F.sum("size").over(before).alias("s0")).where(F.col("block") > 0))
    inner = rows.select("*", F.bit_xor("ax").over(inside).alias("x1"), F.bit_xor("by").over(inside).alias("y1"),
                        F.sum("size").over(inside).alias("s1"))
    zero = F.lit(0).cast("bigint")
    keyed = (inner.join(blocks, ["conv_id", "block"], "left")
             .withColumn("x", F.col("x1").bitwiseXOR(F.coalesce("x0", zero))).withColumn("y", F.col("y1").bitwiseXOR(F.coalesce("y0", zero)))
             .withColumn("so_far", F.col("s1") + F.coalesce("s0", zero)))
    return keyed.select("conv_id", "depth", "x", "y", F.col("x").bitwiseXOR(F.col("ax")).alias("px"),
                        F.col("y").bitwiseXOR(F.col("by")).alias("py"), "size", "so_far", "end", "weight", "total")


def leaves(distinct: DataFrame, steps: DataFrame) -> DataFrame:
    """conv_id of the sequences that are no proper prefix of another one."""
    proper = steps.where(F.col("depth") < F.col("end")).select(F.col("depth").alias("end"), "x", "y").distinct()
    return distinct.join(proper, ["end", "x", "y"], "left_anti").select("conv_id")


def end_lists(whole: DataFrame, list_ids: int = LIST_IDS) -> DataFrame:
    """SHA-256 of the ascending ids that end at a node.

    Ids are sorted by ranges, which split a sequence of any weight, and written as pieces of text there; a digest then
    streams over the pieces of its node, which is all that one task has to do in order.
    """
    sized = whole.select("end", "x", "y", "conv_id").repartitionByRange("end", "x", "y", "conv_id").sortWithinPartitions("end", "x", "y", "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["end", "x", "y", "low", "ids"]
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("end", "x", "y", "conv_id")]
            out, start = [], 0
            keys = list(zip(*columns[:3]))
            for at in range(1, len(keys) + 1):
                if at == len(keys) or keys[at] != keys[start] or at - start == list_ids:
                    out.append((*keys[start], columns[3][start], ",".join(map(str, columns[3][start:at]))))
                    start = at
            yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.string() if n == "ids" else pa.int64()) for n, c in zip(names, zip(*out))} if out else
                                             {n: pa.array([], pa.string() if n == "ids" else pa.int64()) for n in names})

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"depth": pa.array([key[0]], pa.int64()), "x": pa.array([key[1]], pa.int64()),
                                               "y": pa.array([key[2]], pa.int64()), "ends_sha256": pa.array([state.hexdigest()])})

        for batch in batches:
            for *now, ids in zip(*(batch.column(c).to_pylist() for c in ("end", "x", "y", "ids"))):
                if now != key:
                    if key is not None:
                        yield row()
                    key, state = now, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if key is not None:
            yield row()

    listed = sized.mapInArrow(pieces, "end bigint, x bigint, y bigint, low bigint, ids string")
    return (listed.repartition("end", "x", "y").sortWithinPartitions("end", "x", "y", "low")
            .mapInArrow(digest, "depth bigint, x bigint, y bigint, ends_sha256 string"))


def nodes(turns: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt conversations (``rebuild``): smallest member, counts, leaves, saved code points, ends."""
    turns = settle(turns)
    whole, distinct = sequences(turns)
    whole, distinct = settle(whole), settle(distinct)
    steps = settle(prefixes(turns, distinct))
    key = ["depth", "x", "y"]
    found = settle(steps.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.first("px").alias("px"), F.first("py").alias("py"),
        F.first("size").alias("size"), F.first("so_far").alias("so_far")))
    # where each sequence begins to own its nodes, and its code points from there on
    owned = found.groupBy("conv_id").agg(F.min_by(F.struct("depth", (F.col("so_far") - F.col("size")).alias("before")), "depth").alias("lo"))
    ends = (distinct.select("conv_id", "total").join(owned, "conv_id", "left")
            .join(leaves(distinct, steps).withColumn("leaf", F.lit(1).cast("bigint")), "conv_id", "left")
            .select("conv_id", F.col("lo.depth").alias("lo"), F.coalesce(F.col("total") - F.col("lo.before"), F.lit(0).cast("bigint")).alias("owned"),
                    F.coalesce("leaf", F.lit(0).cast("bigint")).alias("leaf")))
    rest = F.col("total") - F.col("so_far") + F.col("size")
    below = (steps.join(ends, "conv_id").groupBy(*key).agg(
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("weight") * rest - F.when(F.col("depth") >= F.col("lo"), rest).otherwise(F.col("owned"))).alias("saved_tokens")))
    inner = found.where(F.col("depth") > 0)
    up = [(F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")]
    children = inner.groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    parents = found.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"))
    return (found.join(below, key).join(children, key, "left").join(end_lists(whole), key, "left")
            .join(parents, ["depth", "px", "py"], "left")
            .select("conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs",
                    F.coalesce("n_children", F.lit(0).cast("bigint")).alias("n_children"), "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
