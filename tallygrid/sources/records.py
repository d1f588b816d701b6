"""Records of quoted CSV files, read by many tasks even where quotes hold line breaks.

Spark's text source cuts a file into blocks and gives each task whole lines. Whether a
line begins a record depends on all text before it, so two passes decide it:

1. Every block tells how it ends (inside quotes or not) for both ways it may begin. These
   small functions, one per block, are composed in file order and give each block's start.
2. Every block joins its lines to records. A record that goes over a block's border comes
   as fragments, at most two per block, which are put together by file and first block.

Lines end at a line feed; a carriage return before it belongs to the line end. A quote
counts only where a field begins, a doubled one inside quotes is text, and what stands
after a closing quote goes on to the next comma, as in Spark's own reader.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

_FIELDS = rb'(?>(?:"(?:[^"]|"")*+"[^,]*+|[^,"][^,]*+)?+,)*+'
_OPEN = re.compile(_FIELDS + rb'"(?:[^"]|"")*+\Z')
_CLOSED = re.compile(rb'(?:[^"]|"")*+"[^,]*+')


def inside_after(line: bytes, inside: bool) -> bool:
    """Whether quotes are open after a line that begins inside quotes or at a field."""
    start = 0
    if inside:
        closed = _CLOSED.match(line)
        if not closed:
            return True
        start = closed.end() + 1
    return _OPEN.match(line, start) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array, list[int]]]:
    """Each block's lines in a batch, and which of them have quotes."""
    keys = pa.compute.run_end_encode(batch.column(1)), pa.compute.run_end_encode(pc.dictionary_encode(batch.column(0)).indices)
    ends = sorted(set(keys[0].run_ends.to_pylist()) | set(keys[1].run_ends.to_pylist()))
    for a, b in zip([0, *ends], ends):
        lines = batch.column(2).slice(a, b - a)
        quoted = pc.indices_nonzero(pc.match_substring(lines, '"')).to_pylist()
        yield (batch.column(0)[a].as_py(), batch.column(1)[a].as_py()), lines, quoted


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, end when begun outside, end when begun inside) for every block."""
    ends: dict[tuple[str, int], list[bool]] = {}
    for batch in batches:
        for key, lines, quoted in _runs(batch):
            state = ends.setdefault(key, [False, True])
            for i in quoted:
                line = lines[i].as_py()
                first = inside_after(line, state[0])
                state[1] = first if state[1] == state[0] else inside_after(line, state[1])
                state[0] = first
    if ends:
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in ends]), pa.array([k[1] for k in ends], pa.int64()),
             *[pa.array([e[s] for e in ends.values()], pa.bool_()) for s in (0, 1)]], names=["file", "block", "outside", "inside"])


def block_starts(lines: DataFrame) -> DataFrame:
    """(file, block, begins inside quotes): the ends of the blocks before, composed in file order."""
    ends = lines.mapInArrow(_ends, "file string, block bigint, outside boolean, inside boolean")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # a block keeps the state, turns it over, or ends the same way whatever it was
    fixed = F.col("outside") == F.col("inside")
    turns = ends.withColumn("turns", F.sum((F.col("outside") & ~F.col("inside")).cast("int")).over(
        Window.partitionBy("file").orderBy("block")))
    last = F.last(F.when(fixed, F.struct("outside", "turns")), ignorenulls=True).over(before)
    now = turns.select("file", "block", last.alias("last"), F.lag("turns", 1, 0).over(
        Window.partitionBy("file").orderBy("block")).alias("turns"))
    odd = (F.col("turns") - F.coalesce("last.turns", F.lit(0))) % 2 == 1
    return now.select("file", "block", (F.coalesce("last.outside", F.lit(False)) != odd).alias("inside"))


_PIECES = "file string, block bigint, header boolean, before boolean, after boolean, data binary"


def _pieces(starts: dict[tuple[str, int], bool]):
    """Records of blocks whose starts are known, and fragments of those that cross a border.

    ``before`` and ``after`` say on which sides a fragment goes on; whole records carry no file.
    """

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                          names=["file", "block", "header", "before", "after", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, held, before, first = None, False, [], False, False

        def piece(data: list[bytes], after: bool) -> tuple:
            crossing = before or after
            return (key[0] if crossing else None, key[1] if crossing else None, first, before, after, b"\n".join(data))

        for batch in batches:
            out = []
            for own, lines, quoted in _runs(batch):
                if own != key:
                    if held:
                        out.append(piece(held, True))
                    if own not in starts:
                        raise RuntimeError(f"{own}: the file or its blocks changed between two passes")
                    key, inside, held = own, starts[own], []
                    before, first = inside, own[1] == 0
                values, at = lines.to_pylist(), 0
                for i in [*quoted, len(values)]:
                    if inside:
                        held += values[at:i]
                    else:
                        for line in values[at:i]:
                            out.append(piece([line], False))
                            first = False
                    if i == len(values):
                        break
                    held.append(values[i])
                    inside, at = inside_after(values[i], inside), i + 1
                    if not inside:
                        out.append(piece(held, False))
                        held, before, first = [], False, False
            if out:
                yield batch_of(out)
        if held:
            yield batch_of([piece(held, True)])

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record) for every record after each file's first, empty lines left out.

    The blocks' starts, one mark per block of ``spark.sql.files.maxPartitionBytes``, are
    shipped to the tasks: fewer entries than the file listing that the driver holds anyway.
    A file of one unclosed quote is one record, that is, one cell.
    """
    lines = _lines(spark, path)
    starts = {(r["file"], r["block"]): r["inside"] for r in block_starts(lines).toLocalIterator()}
    pieces = lines.mapInArrow(_pieces(starts), _PIECES)
    whole = pieces.where(F.col("file").isNull() & ~F.col("header")).select("data")
    crossing = pieces.where(F.col("file").isNotNull())
    order = Window.partitionBy("file").orderBy("block", F.col("before").desc())
    chain = F.last(F.when(~F.col("before"), F.col("block")), ignorenulls=True).over(order)
    joined = crossing.withColumn("chain", chain).groupBy("file", "chain").agg(
        F.max("header").alias("header"), F.array_sort(F.collect_list(F.struct("block", "data"))).alias("parts")) \
        .where(~F.col("header")).select(F.array_join(F.transform("parts", lambda p: p["data"].cast("string")), "\n").alias("record"))
    text = whole.select(F.col("data").cast("string").alias("record")).unionAll(joined)
    return text.select(F.regexp_replace("record", r"\r\z", "").alias("record")).where(F.col("record") != "")


def quoted_csv(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """Text columns of header CSV files with commas and double quotes, as Spark's multi-line reader gives them."""
    names = spark.read.csv(path, header=True, multiLine=True, **options).columns
    shape = ", ".join(f"c{i} string" for i in range(len(names)))
    parsed = records(spark, path).select(F.from_csv("record", shape, {**options, "multiLine": "true"}).alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(names)])
