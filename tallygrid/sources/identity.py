"""Identity of files and tables, and coverage of required keys."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import count_if


def _digest(path: str, step: int) -> tuple[int, str]:
    """Bytes and SHA-256 of the file at a percent-encoded address."""
    local = re.match(r"file:/+", path)
    system, name = (fs.LocalFileSystem(), "/" + unquote(path[local.end():])) if local else fs.FileSystem.from_uri(path)
    digest, length = hashlib.sha256(), 0
    with system.open_input_stream(name) as stream:
        while part := stream.read(step):
            digest.update(part)
            length += len(part)
    return length, digest.hexdigest()


def file_fingerprint(spark: SparkSession, path_glob: str, step: int = 1 << 20) -> DataFrame:
    """SHA-256 per file, of any size: paths are rows, and a file is hashed ``step`` bytes at a time in one task.

    Spark lists the files, empty ones included; tasks open them by the file systems Arrow knows.
    """
    paths = spark.read.format("binaryFile").load(path_glob).inputFiles()
    tasks = max(1, min(len(paths), 8 * spark.sparkContext.defaultParallelism))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            found = [_digest(path, step) for path in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array([unquote(p) for p in names], pa.string()), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([d for _, d in found], pa.string())], names=["path", "length", "sha256"])

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)
    return files.mapInArrow(digests, "path string, length bigint, sha256 string")


def table_fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Order-free fingerprint: sums of two 56-bit parts of each row's hash, copies counted.

    A cell enters with its length in front, a null as a mark without one, so no two
    different rows share a text.
    """
    text = [F.col(c).cast("string") for c in (cols or df.columns)]
    cells = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("n")) for t in text]
    digest = F.sha2(F.concat_ws(",", *cells), 256)
    parts = [F.conv(F.substring(digest, at, 14), 16, 10).cast("decimal(20,0)").alias(f"h{at}") for at in (1, 15)]
    sums = [F.coalesce(F.sum(f"h{at}"), F.lit(0)).cast("string") for at in (1, 15)]
    return df.select(*parts).agg(F.count(F.lit(1)).alias("rows"), F.concat_ws("-", *sums).alias("fingerprint"))


def coverage_missing(required: DataFrame, present: DataFrame, key: str, criterion: str) -> DataFrame:
    """Required keys that are absent, one row each."""
    return required.select(criterion, key).distinct().join(present.select(key), key, "left_anti") \
        .select(F.col(criterion).alias("criterion"), F.col(key).alias("key"))


def coverage_check(required: DataFrame, present: DataFrame, key: str, criterion: str) -> DataFrame:
    """PASS/FAIL per criterion with the number of missing keys.

    The keys themselves are rows of ``coverage_missing``: a list per criterion
    could outgrow one task.
    """
    have = present.select(key).distinct().withColumn("_have", F.lit(True))
    joined = required.select(criterion, key).distinct().join(have, key, "left")
    return joined.groupBy(F.col(criterion).alias("criterion")).agg(
        F.count(F.lit(1)).alias("required"), count_if(F.col("_have").isNull()).alias("missing")
    ).select("criterion", F.when(F.col("missing") == 0, "PASS").otherwise("FAIL").alias("status"),
             "required", "missing")
