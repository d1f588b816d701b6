"""Run registered queries against their DuckDB oracles (also usable from the shell)."""

from __future__ import annotations

import glob
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
         "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float", "FLOAT[]": "array<float>"}


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and an oracle result; empty when equal."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = [TYPES.get(str(t), str(t)) for t in con.sql(sql).types]
    want_schema = dict(zip(names, types))
    got_schema = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    problems = []
    if want_schema != got_schema:
        problems.append(f"schema: spark {got_schema} / oracle {want_schema}")
        if set(want_schema) != set(got_schema):
            return problems
    cols = sorted(want_schema)
    key = lambda row: tuple((v is None, str(v)) for v in row)
    got = sorted([tuple(_plain(r[c]) for c in cols) for r in df.collect()], key=key)
    want = sorted([tuple(_plain(dict(zip(names, r))[c]) for c in cols) for r in cur.fetchall()], key=key)
    if len(got) != len(want):
        problems.append(f"rows: spark {len(got)} / oracle {len(want)}")
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {cols}\n    spark  {bad[0][0]}\n    oracle {bad[0][1]}")
    return problems


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", os.environ.get("SHUFFLE", "8"))
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "12g")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallygrid-oracle-"))
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not argv or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in argv)]
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracles:
                problems = compare(df, con, oracles[name])
                note = "ok" if not problems else "DIFF " + "; ".join(problems)
            else:
                rows = df.collect()
                problems, note = ([] if rows else ["no rows"]), f"rows={len(rows)} first={rows[:1]}"[:300]
        except Exception as error:  # noqa: BLE001
            problems, note = [str(error)], "ERROR " + str(error)[:1500]
        failed += bool(problems)
        print(f"{name:32s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
