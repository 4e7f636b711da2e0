"""Registry and shared views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where there is one, the SQL with the same answer."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def nation_id(column: str):
    return F.concat(F.lit("N"), F.lpad(F.col(column).cast("string"), 2, "0"))


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a long census table: area, three keys and an integer value."""
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        nation_id("c_nationkey").alias("GEO_ID"),
        F.col("c_mktsegment").alias("segment"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        cents("o_totalprice").alias("cents"),
        F.year("o_orderdate").cast("bigint").alias("year"),
    )


OBS = """obs AS (
  SELECT 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS "GEO_ID", c_mktsegment AS segment,
         o_orderstatus AS status, o_orderpriority AS priority,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         CAST(year(o_orderdate) AS BIGINT) AS year
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def population(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as a population table: area, age, sex and count."""
    lineitem = table(spark, sf, "lineitem").select(
        "l_partkey", "l_suppkey", "l_returnflag", "l_quantity"
    )
    part = table(spark, sf, "part").select("p_partkey", "p_size")
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return (
        lineitem.join(part, lineitem.l_partkey == part.p_partkey)
        .join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
        .select(
            nation_id("s_nationkey").alias("GEO_ID"),
            (F.col("p_size") - 1).cast("bigint").alias("age"),
            F.when(F.col("l_returnflag") == "A", "Female")
            .when(F.col("l_returnflag") == "R", "Male")
            .alias("sex"),
            F.col("l_quantity").cast("bigint").alias("count"),
        )
    )


POP = """pop AS (
  SELECT 'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS "GEO_ID",
         CAST(p_size - 1 AS BIGINT) AS age,
         CASE l_returnflag WHEN 'A' THEN 'Female' WHEN 'R' THEN 'Male' END AS sex,
         CAST(l_quantity AS BIGINT) AS count
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""

# The key sets of the driver tables.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"
