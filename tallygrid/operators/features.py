"""Feature preparation: every statistic is fitted on train rows and applied anywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.pipeline import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import kind_of, ratio, unpivot_values
from ..functions.radix import quantiles
from .profile import missing_summary

# Fixed values of the preparation: the fill text for categories and its category limit.
FILL_TEXT = "None"


def band_target(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str],
                out: str) -> DataFrame:
    """Ordered bands with inclusive upper edges; above the last edge the last label."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    x = F.col(col)
    band = F.when(x.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        band = band.when(x <= edge, label)
    return df.withColumn(out, band.otherwise(labels[-1]))


def feature_catalog(df: DataFrame, id_cols: Sequence[str], target: str,
                    forbidden: Sequence[str] = ()) -> DataFrame:
    kinds = F.create_map(*[F.lit(v) for f in df.schema.fields
                           for v in (f.name, kind_of(f.dataType))])
    barred = [*id_cols, target, *forbidden]
    kind = kinds[F.col("variable")]
    return missing_summary(df, only_missing=False).select(
        F.col("variable").alias("feature"), "dtype", kind.alias("kind"), "missing_count",
        F.when(kind == "numeric", "median").when(kind == "categorical", "constant + one-hot")
        .otherwise("none").alias("preparation"),
        F.col("variable").isin(barred).alias("forbidden"))


def medians(train: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact median per column; the result has one row per column."""
    rows = quantiles(unpivot_values(train, cols, "double"), ["variable"], "value", [0.5]).collect()
    return {r["variable"]: r["q"][0] for r in rows if r["q"] is not None}


def fit_median_impute(train: DataFrame, apply_to: DataFrame, cols: Sequence[str]) -> DataFrame:
    fills = medians(train, cols)
    return apply_to.select(*[
        F.coalesce(F.col(c).cast("double"), F.lit(fills.get(c))).alias(c) if c in cols else F.col(c)
        for c in apply_to.columns])


def fit_constant_impute(df: DataFrame, cols: Sequence[str], value: str = FILL_TEXT) -> DataFrame:
    return df.fillna(value, subset=list(cols))


def categories(train: DataFrame, col: str) -> list[str]:
    """Sorted category list; for columns that make dense vectors, whose width it is."""
    return sorted(str(r[0]) for r in train.select(col).where(F.col(col).isNotNull()).distinct().collect())


def one_hot(train: DataFrame, apply_to: DataFrame, cols: Sequence[str], key: str,
            dense: bool = False) -> DataFrame:
    """(key, feature, value) with features ``<column>_<category>`` known from train.

    Only the ones are rows, found by a join with the distinct train pairs, so any
    number of categories will do; a category not seen in train gives no row.
    ``dense=True`` adds the zeros.
    """
    if not dense:
        def pairs(df: DataFrame, *more: str) -> DataFrame:
            cells = [F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols]
            return df.select(*more, F.inline(F.array(*cells))).where(F.col("v").isNotNull())
        return pairs(apply_to, key).join(pairs(train).distinct(), ["c", "v"], "left_semi").select(
            key, F.concat_ws("_", "c", "v").alias("feature"), F.lit(1).alias("value"))
    cells = [F.struct(F.lit(f"{c}_{v}").alias("feature"),
                      F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias("value"))
             for c in cols for v in categories(train, c)]
    out = apply_to.select(key, F.inline(F.array(*cells)))
    return out


def scale_stats(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: mean and population std per column; std 0 becomes 1."""
    aggs = []
    for c in cols:
        std = F.stddev_pop(F.col(c).cast("double"))
        aggs += [F.avg(F.col(c).cast("double")).alias(f"mean_{c}"),
                 F.when(std == 0, 1.0).otherwise(std).alias(f"std_{c}")]
    return train.agg(*aggs)


def _with_stats(apply_to: DataFrame, train: DataFrame, cols: Sequence[str],
                formula) -> DataFrame:
    stats = scale_stats(train, cols)
    packed = apply_to.withColumn("_s", stats.select(F.struct("*")).scalar())
    return packed.select(*[
        formula(F.col(c).cast("double"), F.col("_s")[f"mean_{c}"], F.col("_s")[f"std_{c}"]).alias(c)
        if c in cols else F.col(c) for c in apply_to.columns])


def standard_scale(train: DataFrame, apply_to: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _with_stats(apply_to, train, cols, lambda x, mean, std: (x - mean) / std)


def inverse_scale(scaled: DataFrame, train: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _with_stats(scaled, train, cols, lambda x, mean, std: x * std + mean)


def target_scale(train: DataFrame, apply_to: DataFrame, target: str, key: str) -> DataFrame:
    rows = apply_to.select(key, F.col(target).alias("scaled"))
    scaled = standard_scale(train.select(F.col(target).alias("scaled")), rows, ["scaled"])
    stats = scale_stats(train, [target]).select(F.struct("*")).scalar()
    return scaled.withColumn("_s", stats).select(
        key, "scaled",
        (F.col("scaled") * F.col("_s")[f"std_{target}"] + F.col("_s")[f"mean_{target}"]).alias("restored"))


def label_encode(df: DataFrame, col: str, labels: Sequence[str]) -> DataFrame:
    """Fixed label order -> 0..k-1; any other label is an error."""
    code = F.create_map(*[v for i, name in enumerate(labels) for v in (F.lit(name), F.lit(i))])
    known = F.try_element_at(code, F.col(col))
    return df.withColumn("label_id", F.when(known.isNotNull(), known).otherwise(
        F.raise_error(F.concat(F.lit("unknown label: "),
                               F.coalesce(F.col(col).cast("string"), F.lit("null")))).cast("int")))


def feature_pipeline(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                     scale: bool = False, out: str = "features") -> PipelineModel:
    """Impute, encode, optionally scale, assemble; fitted on ``train`` only.

    Numerics: median (and mean/population std of the imputed values). Categories:
    null -> fixed text, one-hot without a column for unseen values.
    """
    fills = medians(train, numeric) if numeric else {}
    imputed = train.select(*[F.coalesce(F.col(c).cast("double"), F.lit(fills.get(c))).alias(c)
                             for c in numeric])
    stats = scale_stats(imputed, numeric).first().asDict() if scale and numeric else {}
    parts = []
    for i, c in enumerate(numeric):
        value = f"coalesce(CAST(`{c}` AS DOUBLE), {_number(fills.get(c))})"
        if scale:
            value = f"({value} - {_number(stats[f'mean_{c}'])}) / {_number(stats[f'std_{c}'])}"
        parts.append(f"{value} AS _n{i}")
    parts += [f"coalesce(`{c}`, '{FILL_TEXT}') AS _c{i}" for i, c in enumerate(categorical)]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")]
    if categorical:
        indexed = [f"_i{i}" for i in range(len(categorical))]
        encoded = [f"_o{i}" for i in range(len(categorical))]
        stages += [
            StringIndexer(inputCols=[f"_c{i}" for i in range(len(categorical))], outputCols=indexed,
                          handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True)]
    else:
        encoded = []
    stages.append(VectorAssembler(inputCols=[f"_n{i}" for i in range(len(numeric))] + encoded,
                                  outputCol=out))
    return Pipeline(stages=stages).fit(train)


def _number(value: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if value is None else f"CAST('{value!r}' AS DOUBLE)"


def feature_names(model: PipelineModel, numeric: Sequence[str],
                  categorical: Sequence[str] = ()) -> list[tuple[str, str]]:
    """(transformed feature, original column) in vector order."""
    names = [(c, c) for c in numeric]
    if categorical:
        indexer = model.stages[1]
        for c, labels in zip(categorical, indexer.labelsArray):
            names += [(f"{c}_{v}", c) for v in labels]
    return names


def feature_vectors(model: PipelineModel, df: DataFrame, keep: Sequence[str],
                    out: str = "features") -> DataFrame:
    return model.transform(df).select(*keep, out)
