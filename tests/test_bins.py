from tallygrid.plans import fixtures as fx


def test_rows_are_not_dealt_by_price_bin(spark, tmp_path):
    """A few bins would make a few large tasks, whatever the number of rows."""
    n = 400
    rows = spark.range(n)
    rows.selectExpr("id div 4 AS l_orderkey", "cast(id % 4 AS int) AS l_linenumber", "id % 10 AS l_partkey", "id % 7 AS l_suppkey",
                    "1.0D AS l_quantity", "id * 500.0D AS l_extendedprice", "0.0D AS l_discount", "0.0D AS l_tax", "'N' AS l_returnflag") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(10).selectExpr("id AS p_partkey", "1 AS p_size", "1.0D AS p_retailprice", "'x' AS p_type") \
        .write.parquet(str(tmp_path / "part.parquet"))
    spark.range(n).selectExpr("id AS o_orderkey", "1.0D AS o_totalprice", "'1-URGENT' AS o_orderpriority") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    pred = fx.pred_reg(spark, str(tmp_path))
    assert "hashpartitioning(bin" not in pred._jdf.queryExecution().executedPlan().toString()
    got = pred.collect()
    train = [r for r in got if r["split"] == "train"]
    for r in got:
        same = [t["actual"] for t in train if t["actual"] // 5000 == r["actual"] // 5000] or [t["actual"] for t in train]
        assert len(got) == n and abs(r["predicted"] - sum(same) / len(same)) < 1e-6
