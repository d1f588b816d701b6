"""Splittable quoted CSV against Spark's one-task multi-line reader."""

import random

import pytest
from pyspark.sql import functions as F

from tallygrid.sources import csv, records


def whole(spark, path):
    return sorted(map(tuple, spark.read.csv(path, header=True, multiLine=True, escape='"', nullValue=csv._NEVER).fillna("").collect()))


def split(spark, path, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        return sorted(map(tuple, csv._raw(spark, path, True).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("line,inside,after", [
    ("a,b", False, False), ("a,b", True, True), ('"a', False, True), ('"a"', False, False), ('"a""', False, True),
    ('"a""b"', False, False), ('a"b,c', False, False), ('a,"b', False, True), ('b",c', True, False), ('b",c,"d', True, True),
    ('""', True, True), ('"', True, False), ('"x"","y', False, False), ('"a"b,"c', False, True), (",,", False, False),
    ('b""c', True, True), ('"",""', False, False), ('",""', True, False), ('","', True, True)])
def test_state_after_a_line(line, inside, after):
    assert records.inside_after(line.encode(), inside) == after


EDGES = {
    "breaks": 'a,b\n1,"x\ny"\n"2\n\n3",z\n4,"q ""w""\n""e"\n5,\n',
    "no_last_line_end": 'a,b\n1,"x\ny"',
    "header_breaks": '"a\nb",c\n1,2\n"3\n4",5\n',
    "empty_lines": 'a,b\n\n1,2\n\n"x\n\n\ny",3\n\n',
    "quotes_inside_fields": 'a,b\n1"2,3\n5" pipe,"x\ny"\n"c"d,4\n',
    "short_and_long_rows": 'a,b,c\n1\n1,2,3,4\n"x\ny",2\n',
    "only_header": "a,b\n",
    "long_quote": 'a,b\n1,"' + "line\n" * 60 + '"\n2,x\n',
    "letters": 'a,b\né,"ü\nß"\n日,"本\n語"\n',
}


@pytest.mark.parametrize("name", EDGES)
def test_every_cut_gives_the_same_rows(spark, tmp_path, name):
    path = tmp_path / "t.csv"
    path.write_bytes(EDGES[name].encode())
    want = whole(spark, str(path))
    for size in (1, 2, 7, 13, 1000) if len(EDGES[name]) < 100 else (7, 50):
        assert split(spark, str(path), size) == want, size


def test_random_files(spark, tmp_path):
    rng = random.Random(4)
    cells = ["", "a", "b c", "x,y", 'say "hi"', "two\nlines", '"', "\n", '","', '\n"\n', "tail\n"]

    def cell():
        value = rng.choice(cells)
        return '"' + value.replace('"', '""') + '"' if re_quoted(value) or rng.random() < 0.3 else value

    def re_quoted(value):
        return any(c in value for c in ',"\n')

    for k in range(3):
        rows = [f"{k}-{n},{cell()},{cell()}" for n in range(150)]
        (tmp_path / f"f{k}.csv").write_bytes(("id,x,y\n" + "\n".join(rows) + "\n").encode())
    want = whole(spark, str(tmp_path))
    assert len(want) == 450
    for size in (61, 400):
        assert split(spark, str(tmp_path), size) == want


def test_a_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes(("id,x\n" + "".join(f'{n},"one\ntwo {n}"\n' for n in range(2000))).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        df = csv.scan_csv(spark, str(path))
        tasks = df.withColumn("t", F.spark_partition_id()).groupBy("t").count().where("count > 0").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks > 4 and df.dtypes == [("id", "bigint"), ("x", "string")] and df.agg(F.sum("id")).first()[0] == 1999 * 1000


def test_carriage_returns(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes(b'a,b\r\n1,"x"\r\n2,y\r\n')
    assert split(spark, str(path), 5) == [("1", "x"), ("2", "y")] == whole(spark, str(path))
