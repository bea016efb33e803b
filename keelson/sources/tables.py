"""Table sources: the driver tables and the views that give them the roles of
the regression pipeline (scored table, run log, metric log, trials, stage
log). Every view is a projection over a Parquet scan, so filters and column
pruning reach the reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.config import METRIC_KEYS, STAGES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TARGET = "charge"
CATEGORY = "l_returnflag"
# Row key of lineitem; (l_orderkey, l_linenumber) alone is not unique.
LINEITEM_KEY = ["l_orderkey", "l_linenumber", "ship_epoch", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A2: full scan of one saved table (Parquet)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_all(spark: SparkSession, sf_dir: str) -> None:
    """Register every driver table as a temp view under its own name."""
    for t in TABLES:
        table(spark, sf_dir, t).createOrReplaceTempView(t)


def reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression table: lineitem with the learnable target ``charge``."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.unix_timestamp("l_shipdate").alias("ship_epoch"),
        *FEATURES, "l_returnflag", "l_linestatus",
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias(TARGET),
    )


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored table with a known answer: prediction = price after discount."""
    return reg(spark, sf_dir).withColumn(
        "prediction", F.col("l_extendedprice") * (1 - F.col("l_discount")))


def runs_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run list from orders."""
    o = table(spark, sf_dir, "orders")
    status = (F.when(F.col("o_orderstatus") == "F", "FINISHED")
              .when(F.col("o_orderstatus") == "O", "RUNNING")
              .when(F.col("o_orderstatus") == "P", "FAILED"))
    return o.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_custkey").alias("experiment_id"),
        F.col("o_orderpriority").alias("run_name"),
        status.alias("status"),
        F.col("o_orderdate").alias("end_time"),
        F.col("o_totalprice").alias("metric"),
    )


def metric_key_expr(linenumber_col: str = "l_linenumber"):
    expr = None
    for i, k in enumerate(METRIC_KEYS, start=1):
        expr = (F.when(F.col(linenumber_col) == i, k) if expr is None
                else expr.when(F.col(linenumber_col) == i, k))
    return expr


def metrics_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long metric log from lineitem: (run_id, key, value, ts, tie1, tie2)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("run_id"),
        metric_key_expr().alias("key"),
        F.col("l_extendedprice").alias("value"),
        F.unix_timestamp("l_shipdate").alias("ts"),
        F.col("l_partkey").alias("tie1"),
        F.col("l_suppkey").alias("tie2"),
    )


def trials_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search trials from part: one trial per part, family = p_type."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_type").alias("family"),
        F.col("p_partkey").alias("trial_id"),
        F.col("p_brand"), F.col("p_name"), F.col("p_size"),
        F.col("p_retailprice").alias("loss"),
        F.lit("ok").alias("status"),
    )


def stage_expr(seq_col: str = "event_id"):
    m = F.col(seq_col) % len(STAGES)
    expr = None
    for i, s in enumerate(STAGES):
        expr = F.when(m == i, s) if expr is None else expr.when(m == i, s)
    return expr


def stages_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage-change log from events: (name, version, stage, ts, seq, note)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("name"),
        F.col("user_id").alias("version"),
        stage_expr().alias("stage"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        F.col("props").alias("note"),
    )


def experiments_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiments from customer."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("experiment_id"), F.col("c_name").alias("name"))
