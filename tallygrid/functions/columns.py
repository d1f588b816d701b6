"""Small column and schema helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def kind_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return "numeric"
    return "categorical" if isinstance(data_type, T.StringType) else "other"


def count_if(condition: Column) -> Column:
    """Rows where the condition is true; nulls do not count."""
    return F.count(F.when(condition, 1))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as double, null when the bottom is zero or null."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part.cast("double") * 100, whole)


def unpivot_values(df: DataFrame, cols: Sequence[str], as_type: str,
                   keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., variable, value) with every listed column cast to one type."""
    cast = df.select(*keep, *[F.col(c).cast(as_type).alias(c) for c in cols])
    return cast.unpivot(list(keep), list(cols), "variable", "value")


def stack_columns(df: DataFrame, names: Sequence[str], stats: Sequence[str],
                  types: Sequence[str] | None = None) -> DataFrame:
    """One-row wide result ``<stat>__<i>`` -> one row per name with the stats as columns.

    ``df`` must hold a single row, so this never touches data-sized input.
    """
    entries = [
        F.struct(F.lit(name).alias("variable"),
                 *[F.col(f"{stat}__{i}").alias(stat) for stat in stats])
        for i, name in enumerate(names)
    ]
    return df.select(F.inline(F.array(*entries)))


def rounded(df: DataFrame, digits: int = 6, keep: Sequence[str] = ()) -> DataFrame:
    """Round every double column, so results can be compared across engines."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in keep
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
