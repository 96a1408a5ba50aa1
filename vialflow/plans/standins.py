"""Domain stand-ins built from the fixture tables.

These only rename and scale columns so the library jobs see the schema they
expect (runs with conditions, an arm log, papers, vectors). They do none of
the job's work.

* runs    = lineitem: entity ``l_suppkey``; conditions
            (l_returnflag, l_linestatus, l_discount, l_tax); outcome
            ``yield`` = l_quantity / 50, ``purity`` = 1 - l_discount * 5,
            ``price`` = l_extendedprice.
* arm log = events: arm ``event_type``, entity ``user_id``, reward
            ``value / 500`` (values are below 500).
* papers  = documents; full text = pages.html; labels joined on doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialflow.sources.tables import Tables

CONDS = ["l_returnflag", "l_linestatus", "l_discount", "l_tax"]
ENTITY = "l_suppkey"


def runs(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", ENTITY, *CONDS,
        (F.col("l_quantity") / F.lit(50.0)).alias("yield"),
        (F.lit(1.0) - F.col("l_discount") * F.lit(5.0)).alias("purity"),
        F.col("l_extendedprice").alias("price"), "l_shipdate")


def arm_log(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events
    return ev.select("event_id", "ts", "user_id", F.col("event_type").alias("arm"),
                     (F.col("value") / F.lit(500.0)).alias("reward"), "props")


# SQL twins of the stand-ins, used inside oracle statements.
RUNS_SQL = """(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
  l_discount, l_tax, l_quantity / 50.0 AS yield, 1.0 - l_discount * 5.0 AS purity,
  l_extendedprice AS price, l_shipdate FROM lineitem)"""
ARMS_SQL = """(SELECT event_id, ts, user_id, event_type AS arm, value / 500.0 AS reward, props
  FROM events)"""
