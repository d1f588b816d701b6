"""Derived views of the driver tables: DataFrame form for Spark, CTE text for the oracles."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scale import sent, settle, windowed


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def _line_id() -> F.Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in
                              ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                       F.round(F.col("l_extendedprice") * 100).cast("long").cast("string"))


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with part and order columns, two derived amounts and the target ``charge``."""
    l = table(spark, sf, "lineitem")
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    joined = l.join(p, l.l_partkey == p.p_partkey).join(o, l.l_orderkey == o.o_orderkey)
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return joined.select(
        _line_id().alias("line_id"), "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "p_size", "p_retailprice", "o_totalprice", "l_returnflag", "p_type", "o_orderpriority",
        net.alias("disc_price"),
        F.when(F.col("l_discount") >= 0.1, F.col("l_extendedprice") * 0.01)
        .otherwise(0.0).alias("rebate"),
        F.when((F.col("l_discount") == 0) & (F.col("l_tax") == 0), "exempt")
        .otherwise("regular").alias("fee_kind"),
        (net * (1 + F.col("l_tax"))).alias("charge"))


def missing(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with nulls placed by rule."""
    l = table(spark, sf, "lineitem")
    key = F.col
    return l.select(
        _line_id().alias("line_id"), "l_quantity",
        F.when((key("l_orderkey") * 7 + key("l_partkey") * 3 + key("l_linenumber")) % 11 != 0,
               key("l_extendedprice")).alias("price"),
        F.when((key("l_orderkey") + key("l_partkey")) % 997 != 0, key("l_discount")).alias("discount"),
        F.when(key("l_discount") != 0,
               F.concat(F.lit("D"), F.round(key("l_discount") * 100).cast("int").cast("string")))
        .alias("discount_code"),
        F.when(key("l_suppkey") % 50 != 0, key("l_returnflag")).alias("returnflag"),
        F.when(key("l_tax") != 0, key("l_tax")).alias("tax"))


BANDS = ("low", "mid", "high")


def split(spark: SparkSession, sf: str) -> DataFrame:
    """Three bands of ``charge`` with a deterministic 20 % test set per band."""
    from ..operators.features import band_target
    from ..operators.splits import mark_first_by_hash

    banded = band_target(lines(spark, sf).select("line_id", "charge"), "charge",
                         [10000, 100000], list(BANDS), "band")
    marked = mark_first_by_hash(
        banded, "line_id",
        lambda sizes: sizes.select("band", F.floor(0.2 * F.col("n") + 0.5).cast("long").alias("quota")),
        ["band"], seed=42)
    return marked.select("line_id", "charge", "band",
                         F.when(F.col("chosen"), "test").otherwise("train").alias("split"))


def pred_reg(spark: SparkSession, sf: str) -> DataFrame:
    """Train mean of ``charge`` per 5,000-wide price bin, as a stand-in regressor."""
    rows = split(spark, sf).join(lines(spark, sf).select("line_id", "l_extendedprice"), "line_id")
    b = rows.select("line_id", "split", "charge",
                    F.floor(F.col("l_extendedprice") / 5000).cast("int").alias("bin"))
    train = b.where(F.col("split") == "train")
    # a few bins would deal the rows to a few tasks
    means = sent(settle(train.groupBy("bin").agg(F.avg("charge").alias("mu"))))
    overall = train.agg(F.avg("charge").alias("mu")).scalar()
    return b.join(means, "bin", "left").select(
        "line_id", "split", F.col("charge").alias("actual"),
        F.coalesce("mu", overall).alias("predicted"))


def pred_cls(spark: SparkSession, sf: str) -> DataFrame:
    """Band of the list price, as a stand-in classifier."""
    from ..operators.features import band_target

    guessed = band_target(lines(spark, sf).select("line_id", "l_extendedprice"), "l_extendedprice",
                          [10000, 100000], list(BANDS), "predicted")
    return split(spark, sf).join(guessed, "line_id").select(
        "line_id", "split", F.col("band").alias("actual"), "predicted")


def steps(spark: SparkSession, sf: str) -> DataFrame:
    """Logged steps: one episode per user and day."""
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))

    def build(frame, w):
        return frame.withColumn("state", F.coalesce(F.lag("event_type").over(w), F.lit("start")))

    built = windowed(e, ["user_id", "day"], ["ts", "event_id"], build, lookback=1, position="step")
    return built.select(
        "user_id", F.concat(F.col("user_id").cast("string"), F.lit("-"),
                            F.col("day").cast("string")).alias("episode"),
        "ts", "event_id", "step", "state", F.col("event_type").alias("action"),
        F.col("value").alias("reward"), (F.col("event_type") == "purchase").alias("is_goal"))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings")


_LINE_ID = ("concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), "
            "CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), "
            "CAST(CAST(round(l_extendedprice*100) AS BIGINT) AS STRING))")

VIEWS = {
    "fx_lines": f"""
SELECT {_LINE_ID} AS line_id, l_quantity, l_extendedprice, l_discount, l_tax,
       p_size, p_retailprice, o_totalprice, l_returnflag, p_type, o_orderpriority,
       l_extendedprice*(1-l_discount) AS disc_price,
       CASE WHEN l_discount >= 0.1 THEN l_extendedprice*0.01 ELSE 0.0 END AS rebate,
       CASE WHEN l_discount = 0 AND l_tax = 0 THEN 'exempt' ELSE 'regular' END AS fee_kind,
       l_extendedprice*(1-l_discount)*(1+l_tax) AS charge
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "fx_missing": f"""
SELECT {_LINE_ID} AS line_id, l_quantity,
       CASE WHEN (l_orderkey*7+l_partkey*3+l_linenumber)%11 = 0 THEN NULL ELSE l_extendedprice END AS price,
       CASE WHEN (l_orderkey+l_partkey)%997 = 0 THEN NULL ELSE l_discount END AS discount,
       CASE WHEN l_discount = 0 THEN NULL ELSE concat('D', CAST(CAST(round(l_discount*100) AS INT) AS STRING)) END AS discount_code,
       CASE WHEN l_suppkey%50 = 0 THEN NULL ELSE l_returnflag END AS returnflag,
       CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS tax
FROM lineitem""",
    "fx_split": """
SELECT line_id, charge, band,
       CASE WHEN row_number() OVER (PARTITION BY band ORDER BY md5(concat('42|', line_id)), line_id)
                 <= floor(0.2*count(*) OVER (PARTITION BY band) + 0.5) THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, CASE WHEN charge <= 10000 THEN 'low' WHEN charge <= 100000 THEN 'mid' ELSE 'high' END AS band
      FROM fx_lines) t""",
    "fx_pred_reg": """
SELECT b.line_id, b.split, b.charge AS actual, coalesce(m.mu, g.mu) AS predicted
FROM (SELECT s.line_id, s.split, s.charge, CAST(floor(f.l_extendedprice/5000) AS INT) AS bin
      FROM fx_split s JOIN fx_lines f ON s.line_id = f.line_id) b
LEFT JOIN (SELECT CAST(floor(f.l_extendedprice/5000) AS INT) AS bin, avg(s.charge) AS mu
           FROM fx_split s JOIN fx_lines f ON s.line_id = f.line_id WHERE s.split = 'train' GROUP BY 1) m
       ON b.bin = m.bin
CROSS JOIN (SELECT avg(charge) AS mu FROM fx_split WHERE split = 'train') g""",
    "fx_pred_cls": """
SELECT s.line_id, s.split, s.band AS actual,
       CASE WHEN f.l_extendedprice <= 10000 THEN 'low' WHEN f.l_extendedprice <= 100000 THEN 'mid' ELSE 'high' END AS predicted
FROM fx_split s JOIN fx_lines f ON s.line_id = f.line_id""",
    "fx_steps": """
SELECT user_id, concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS episode, ts, event_id,
       row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS step,
       coalesce(lag(event_type) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id), 'start') AS state,
       event_type AS action, value AS reward, event_type = 'purchase' AS is_goal
FROM events""",
    "fx_vec": "SELECT vec_id, embedding, label FROM embeddings",
}

_NEEDS = {"fx_split": ["fx_lines"], "fx_pred_reg": ["fx_lines", "fx_split"],
          "fx_pred_cls": ["fx_lines", "fx_split"]}


def with_views(names: str, body: str) -> str:
    """``WITH <views> body``; a body that opens with WITH keeps its own CTEs."""
    order: list[str] = []
    for name in names.split():
        for need in [*_NEEDS.get(name, []), name]:
            if need not in order:
                order.append(need)
    body = body.strip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in order)
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
