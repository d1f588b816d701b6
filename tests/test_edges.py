"""Edge cases: empty input, all-null and constant columns, ties, NA tokens, bad labels."""

import hashlib
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallygrid.operators import categorical as cat, correlation as cor, evaluate as ev, features as feat
from tallygrid.operators import missing as mis, profile as prof, sequences as seq, splits as spl
from tallygrid.sources import csv, identity


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(
        [(1, 5.0, None, "a"), (2, 5.0, None, "b"), (3, 5.0, None, None), (4, 5.0, None, "b"), (5, 5.0, None, "a")],
        "k int, same double, gone double, t string")


def test_profile_of_constant_and_null_columns(odd):
    rows = {r["variable"]: r for r in prof.numeric_profile(odd, ["same", "gone"]).collect()}
    assert rows["same"]["std"] == 0 and rows["same"]["skewness"] is None and rows["same"]["iqr"] == 0
    assert rows["gone"]["count"] == 0 and rows["gone"]["median"] is None
    assert rows["gone"]["missing_pct"] == 100


def test_empty_input(odd):
    empty = odd.where("false")
    assert prof.numeric_profile(empty, ["same"]).count() == 0
    assert prof.duplicate_rows(empty).first().asDict() == {"rows": 0, "distinct_rows": 0, "duplicates": 0}
    assert cat.categorical_summary(empty).count() == 0
    assert prof.missing_summary(empty).count() == 0
    assert prof.histogram(empty, "same", 3).agg(F.sum("count")).first()[0] == 0
    assert spl.split_random(empty, "k").count() == 0
    assert all(r["r"] is None for r in cor.corr_matrix(empty, ["same", "k"]).collect())
    assert ev.regression_metrics(odd.where("false").select(
        F.lit("test").alias("split"), F.col("same").alias("actual"), F.col("same").alias("predicted"))).count() == 0


def test_correlation_with_constant_is_null(odd):
    table = {(r["v1"], r["v2"]): r["r"] for r in cor.corr_matrix(odd, ["k", "same", "gone"]).collect()}
    assert table[("k", "same")] is None and table[("k", "gone")] is None and table[("k", "k")] == 1.0
    assert table[("same", "same")] is None


def test_ties_go_to_the_smaller_value(odd):
    row = prof.cardinality_summary(odd, ["t"]).first()
    assert (row["top_value"], row["top_count"], row["missing_count"]) == ("a", 2, 1)
    assert mis.impute_mode(odd, ["t"]).where("k = 3").first()["t"] == "a"


def test_histogram_of_a_constant(odd):
    rows = prof.histogram(odd, "same", 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [0, 0, 5, 0]
    assert rows[0]["lower"] == 4.5 and rows[-1]["upper"] == 5.5


def test_imbalance_of_one_class(odd):
    row = spl.imbalance_ratio(odd.where("t = 'a'"), "t").first()
    assert (row["majority"], row["minority"], row["ratio"]) == ("a", "a", 1.0)


def test_undefined_class_metrics_are_zero(spark):
    pred = spark.createDataFrame([("test", "a", "a"), ("test", "b", "a")], "split string, actual string, predicted string")
    rows = {r["label"]: r for r in ev.per_class_metrics(pred, ["a", "b", "c"]).collect()}
    assert rows["b"]["precision"] == 0 and rows["c"]["f1"] == 0
    m = ev.classification_metrics(pred, ["a", "b", "c"]).first()
    assert m["accuracy"] == 0.5 and m["balanced_accuracy"] == 0.5 and abs(m["macro_recall"] - 1 / 3) < 1e-12


def test_csv_tokens_and_types(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("i,d,s,q\n1,1.5,NA,x\n2,,None,\"a,b\"\nnull,3,x,\n")
    df = csv.scan_csv(spark, str(path))
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "double", "string", "string"]
    assert [tuple(r) for r in df.orderBy("d").collect()] == [
        (2, None, None, "a,b"), (1, 1.5, None, "x"), (None, 3.0, "x", None)]
    kept = csv.scan_csv_literal(spark, str(path))
    assert {r["s"] for r in kept.collect()} == {"NA", "None", "x"}
    assert kept.where("q = ''").count() == 1


def test_write_verified_refuses_nulls(spark, tmp_path, odd):
    with pytest.raises(RuntimeError):
        csv.write_verified(odd, str(tmp_path / "a"))
    row = csv.write_verified(odd.select("k", "same"), str(tmp_path / "b"), "csv").first()
    assert row["ok"] and row["rows_out"] == 5


def test_file_fingerprint_equals_hashlib(spark):
    sf = "/root/testdata/sf0.001"
    for r in identity.file_fingerprint(spark, f"{sf}/*.parquet").collect():
        name = os.path.join(sf, os.path.basename(r["path"]))
        with open(name, "rb") as f:
            assert hashlib.sha256(f.read()).hexdigest() == r["sha256"]


def test_file_fingerprint_reads_in_steps(spark, tmp_path):
    """A step far below the file's size, an empty file, and names with blanks and percent signs."""
    held = {"a b.bin": os.urandom(100_003), "c%20d.bin": b"", "é#?.bin": b"x" * 7}
    for name, data in held.items():
        (tmp_path / name).write_bytes(data)
    got = {os.path.basename(r["path"]): (r["length"], r["sha256"]) for r in
           identity.file_fingerprint(spark, str(tmp_path), step=1000).collect()}
    assert got == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in held.items()}


def test_column_overview_of_long_values(spark):
    """Long values that differ in their last byte only, values as long as a digest, nulls and empty texts."""
    values = [None, "", "x" * 31, "x" * 32, "x" * 33, "y" * 5000 + "a", "y" * 5000 + "b", "y" * 5000 + "b", "é" * 16, None]
    got = prof.column_overview(spark.createDataFrame([(v,) for v in values], "v string")).first()
    assert (got["missing_count"], got["n_distinct"]) == (2, 7)


def test_fingerprint_ignores_order_and_counts_copies(odd):
    a = identity.table_fingerprint(odd).first()
    assert identity.table_fingerprint(odd.orderBy(F.desc("k")).repartition(3)).first() == a
    assert identity.table_fingerprint(odd.union(odd.limit(1))).first() != a


def test_unseen_category_and_unknown_label(spark, odd):
    test = spark.createDataFrame([(9, "zzz")], "k int, t string")
    assert feat.one_hot(odd, test, ["t"], "k").count() == 0
    assert {r["value"] for r in feat.one_hot(odd, test, ["t"], "k", dense=True).collect()} == {0}
    with pytest.raises(PySparkException):
        feat.label_encode(test, "t", ["a", "b"]).collect()
    with pytest.raises(PySparkException):
        mis.no_missing_gate(odd, strict=True).collect()


def test_feature_pipeline_size_and_unseen(spark, odd):
    model = feat.feature_pipeline(odd, ["k", "same"], ["t"], scale=True)
    other = spark.createDataFrame([(3, 5.0, "zzz")], "k int, same double, t string")
    vector = feat.feature_vectors(model, other, ["k"]).first()["features"].toArray()
    assert list(vector) == [0.0, 0.0, 0.0, 0.0, 0.0]  # two numbers, then None, a, b
    assert [f for f, _ in feat.feature_names(model, ["k", "same"], ["t"])] == ["k", "same", "t_None", "t_a", "t_b"]


@pytest.mark.parametrize("n,test_rows", [(1, 1), (5, 1), (6, 2), (101, 21)])
def test_split_sizes_are_exact(spark, n, test_rows):
    s = spl.split_random(spark.range(n), "id")
    assert s.count() == n and s.where("split = 'test'").count() == test_rows


def test_stratified_total_is_exact(spark):
    df = spark.range(103).select("id", F.when(F.col("id") < 3, "a").when(F.col("id") < 30, "b").otherwise("c").alias("y"))
    s = spl.split_stratified(df, "id", "y")
    assert s.where("split = 'test'").count() == 21
    got = {r["y"]: r["count"] for r in s.where("split = 'test'").groupBy("y").count().collect()}
    assert got == {"a": 1, "b": 5, "c": 15}


def test_band_edges_are_inclusive(spark):
    df = spark.createDataFrame([(10.0,), (10.1,), (20.0,), (None,)], "x double")
    assert [r["b"] for r in feat.band_target(df, "x", [10, 20], ["l", "m", "h"], "b").collect()] == ["l", "m", "m", None]


@pytest.mark.parametrize("hot_rows", [3, 10_000])
def test_rolling_mean_with_a_hot_key(spark, hot_rows):
    df = spark.range(120).select((F.col("id") % 4 == 3).cast("int").alias("u"), "id",
                                 (F.col("id") * 1.0).alias("x"))
    got = {r["id"]: r["rolling_mean"] for r in seq.rolling_mean(df, "u", ["id"], "x", 5, hot_rows=hot_rows).collect()}
    pdf = df.toPandas().sort_values("id")
    want = pdf.groupby("u")["x"].transform(lambda s: s.rolling(5, min_periods=1).mean())
    for i, v in zip(pdf["id"], want):
        assert abs(got[i] - v) < 1e-9


def test_q_values_of_a_known_chain(spark):
    moves = spark.createDataFrame(
        [("a", "go", "b", 1, 1.0, 0.0), ("b", "go", "end", 1, 10.0, 1.0), ("a", "stay", "a", 1, 0.0, 0.0)],
        "state string, action string, next_state string, count long, mean_reward double, terminal_share double")
    q = {(r["state"], r["action"]): r["q"] for r in seq.q_iteration(moves, 0.9, 6, settle_every=2).collect()}
    assert abs(q[("b", "go")] - 10) < 1e-12 and abs(q[("a", "go")] - 10) < 1e-12
    assert abs(q[("a", "stay")] - 9) < 1e-12
    best = {r["state"]: r["action"] for r in seq.greedy_policy(seq.q_iteration(moves, 0.9, 6)).collect()}
    assert best == {"a": "go", "b": "go"}


def test_integer_column_is_filled_by_a_half_median(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (9,), (2,), (3,), (None,)], "x bigint")
    rule = [mis.FillRule("x", "median", "missing at random")]
    assert sorted(r["x"] for r in mis.impute_apply(df, mis.impute_plan(df, rule)).collect()) == [1, 2, 2, 2, 2, 3, 9]
    df = spark.createDataFrame([(1,), (2,), (None,)], "x bigint")
    assert sorted(r["x"] for r in mis.impute_apply(df, mis.impute_plan(df, rule)).collect()) == [1.0, 1.5, 2.0]


def test_csv_keeps_codes_and_line_breaks(spark, tmp_path):
    rows = [("1D", "a\nb", "1e3", " x "), ("2F", 'say "hi", ok', ".5", "y")]
    df = spark.createDataFrame(rows, "code string, note string, number string, padded string")
    csv.write_verified(df, str(tmp_path / "out"), "csv")
    back = csv.scan_csv(spark, str(tmp_path / "out"))
    assert dict(back.dtypes) == {"code": "string", "note": "string", "number": "double", "padded": "string"}
    assert sorted(tuple(r)[:2] + tuple(r)[3:] for r in back.collect()) == sorted(r[:2] + r[3:] for r in rows)


def test_fingerprint_tells_nulls_and_borders_apart(spark):
    tables = [[(None, "a")], [("\\N", "a")], [("n", "a")], [("a,1:b", "c")], [("a", "b,1:c")]]
    prints = {identity.table_fingerprint(spark.createDataFrame(t, "x string, y string")).first()["fingerprint"] for t in tables}
    assert len(prints) == len(tables)


def test_marking_deals_no_rows_by_group(spark, capsys):
    """One group of nearly all rows must not become one task's input."""
    from tallygrid.operators.splits import mark_first_by_hash

    rows = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") > 9, "most").alias("g"))
    marked = mark_first_by_hash(rows, "k", lambda sizes: sizes.select("g", F.floor(F.col("n") / 5).alias("quota")), ["g"])
    marked.explain()
    assert "SortMergeJoin" not in capsys.readouterr().out
    assert {r["g"]: r["n"] for r in marked.where("chosen").groupBy("g").agg(F.count("*").alias("n")).collect()} == {None: 2, "most": 598}


@pytest.mark.parametrize("name", ["fit_median_impute", "feature_vectors", "feature_pipeline"])
def test_fits_read_their_joined_rows_once(spark, capsys, name):
    """Medians, indexes and results read rows that are settled, not the joins anew."""
    from tallygrid.plans import preparing

    preparing.QUERIES[name](spark, "/root/testdata/sf0.001").explain()
    assert "parquet" not in capsys.readouterr().out
