"""CSV input with NA tokens, and verified output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions.columns import count_if
from .records import quoted_csv

# The texts a CSV reader of data frames takes as missing by default.
DEFAULT_NA = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Text that cannot occur in a file, so the reader itself turns nothing into null.
_NEVER = "\u0001\u0002never\u0002\u0001"


def normalize_na(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = DEFAULT_NA) -> DataFrame:
    """Replace the tokens by null in the listed string columns."""
    return df.withColumns({c: F.when(~F.col(c).isin(list(tokens)), F.col(c)) for c in cols})


# A number as people write it; a cast alone would also take codes such as 1D or 2F.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Rows of a written CSV file.
FILE_ROWS = 200_000


def _raw(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    options = {"nullValue": _NEVER, "escape": '"'}
    raw = quoted_csv(spark, path, options) if multi_line else spark.read.csv(path, header=True, **options)
    return raw.fillna("")


def _inferred(df: DataFrame) -> DataFrame:
    """Cast text columns to bigint, double or timestamp-free text: one aggregate decides."""
    cols = df.columns
    seen = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.count(F.col(f"`{c}`")).alias(f"n{i}"),
        count_if(F.expr(f"try_cast(`{c}` AS BIGINT)").isNotNull()
                 & F.col(f"`{c}`").rlike(r"^\s*[+-]?\d+\s*$")).alias(f"i{i}"),
        count_if(F.expr(f"try_cast(`{c}` AS DOUBLE)").isNotNull() & F.col(f"`{c}`").rlike(_NUMBER))
        .alias(f"d{i}"))]).first()

    def typed(i, c):
        column = F.col(f"`{c}`")
        if seen[f"n{i}"] and seen[f"i{i}"] == seen[f"n{i}"]:
            return F.trim(column).cast("bigint").alias(c)
        if seen[f"n{i}"] and seen[f"d{i}"] == seen[f"n{i}"]:
            return column.cast("double").alias(c)
        return column.alias(c)
    return df.select(*[typed(i, c) for i, c in enumerate(cols)])


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             na_tokens: Sequence[str] = DEFAULT_NA, multi_line: bool = True) -> DataFrame:
    """Header CSV; NA tokens become null before types are found or the schema is applied.

    Files with quoted line breaks are split over tasks too (module ``records``), at the cost of
    one more reading pass; ``multi_line=False`` saves it for data without such breaks.
    """
    raw = _raw(spark, path, multi_line)
    text = normalize_na(raw, raw.columns, na_tokens)
    if schema is None:
        return _inferred(text)
    return text.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def scan_csv_literal(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     multi_line: bool = True) -> DataFrame:
    """Header CSV where every text stays text, empty cells included."""
    text = _raw(spark, path, multi_line)
    if schema is None:
        return _inferred(text)
    return text.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def write_verified(df: DataFrame, path: str, format: str = "parquet",
                   allow_nulls: bool = False) -> DataFrame:
    """Write, read back, and fail unless shape and absence of nulls survived.

    The rows written are counted by the write job itself.
    """
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode("overwrite")
    spark = df.sparkSession
    if format == "csv":
        writer.options(header=True, emptyValue="", escape='"', quoteAll=True, maxRecordsPerFile=FILE_ROWS,
                       ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
        back = scan_csv_literal(spark, path, df.schema)
    else:
        writer.format(format).save(path)
        back = spark.read.format(format).load(path)
    cells = [count_if(F.col(f"`{c}`").isNull()) for c in back.columns]
    total = cells[0]
    for cell in cells[1:]:
        total = total + cell
    found = back.agg(F.count(F.lit(1)).alias("rows"), total.alias("nulls")).first()
    rows_in, cols_in, cols_out = seen.get["rows"], len(df.columns), len(back.columns)
    same = rows_in == found["rows"] and cols_in == cols_out
    if not same or (found["nulls"] and not allow_nulls):
        raise RuntimeError(f"{path}: rows {rows_in}/{found['rows']}, columns {cols_in}/{cols_out}, "
                           f"nulls {found['nulls']}")
    return spark.createDataFrame(
        [(rows_in, found["rows"], cols_in, cols_out, found["nulls"], True)],
        "rows_in long, rows_out long, cols_in int, cols_out int, nulls_out long, ok boolean")
