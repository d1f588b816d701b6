"""A key for document rows that survives joins whatever the ids are, and column names that clash with none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def row_key(doc_id: str, text: str) -> Column:
    """Id (null included) and a 64-bit hash of the text; rows that agree in both are the same row repeated."""
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")),
                       F.hex(F.xxhash64(F.coalesce(F.col(text), F.lit("")))))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it differ from all columns (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name
