"""The given tables seen as contest tables, in Spark and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivalry.operators.cleanse import wide_to_long
from rivalry.operators.joins import pair_contestants


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as contests of customers: F wins, O loses, P is a draw."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("contest_id"),
        F.col("o_custkey").alias("entity_id"),
        F.to_date("o_orderdate").alias("event_date"),
        (F.col("o_orderstatus") == "F").alias("win"),
        (F.col("o_orderstatus") == "O").alias("loss"),
        F.lower("o_orderpriority").alias("method"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("stat"),
    )


HISTORY = """
history as (
  select o_orderkey contest_id, o_custkey entity_id, cast(o_orderdate as date) event_date,
         o_orderstatus = 'F' win, o_orderstatus = 'O' loss, lower(o_orderpriority) as "method",
         case when o_orderpriority <> '5-LOW' then o_totalprice end stat
  from orders)"""


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as contests of users at unequal times: a purchase wins, an error loses."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("contest_id"),
        F.col("user_id").alias("entity_id"),
        F.col("ts").alias("event_time"),
        (F.col("event_type") == "purchase").alias("win"),
        (F.col("event_type") == "error").alias("loss"),
        "value",
    )


STREAM = """
stream as (
  select event_id contest_id, user_id entity_id, ts event_time, event_type = 'purchase' win,
         event_type = 'error' loss, "value"
  from events)"""


def bouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide two-sided contests: the first and the last supplier of each order."""
    orders = table(spark, sf_dir, "orders")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("entity1_id"), F.max("l_suppkey").alias("entity2_id"))
        .where(F.col("entity1_id") != F.col("entity2_id"))
    )
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_orderkey").alias("contest_id"),
        F.to_date("o_orderdate").alias("event_date"),
        "entity1_id",
        "entity2_id",
        (F.col("o_orderstatus") == "F").alias("entity1_win"),
        (F.col("o_orderstatus") == "O").alias("entity2_win"),
    )


BOUTS = """
bouts as (
  select o_orderkey contest_id, cast(o_orderdate as date) event_date, entity1_id, entity2_id,
         o_orderstatus = 'F' entity1_win, o_orderstatus = 'O' entity2_win
  from (select l_orderkey, min(l_suppkey) entity1_id, max(l_suppkey) entity2_id
        from lineitem group by l_orderkey) l
  join orders on l_orderkey = o_orderkey
  where entity1_id <> entity2_id)"""


def sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bouts in long form: one row per contest and contestant."""
    return wide_to_long(bouts(spark, sf_dir), ["entity1", "entity2"], "entity")


SIDES = f"""{BOUTS},
sides as (
  select contest_id, event_date, entity1_id entity_id, entity1_win entity_win from bouts
  union all
  select contest_id, event_date, entity2_id, entity2_win from bouts)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each contestant's row with the opponent's columns."""
    return pair_contestants(
        sides(spark, sf_dir), "contest_id", "entity_id", ("entity", "opponent"), ["event_date"]
    )


PAIRS = f"""{SIDES},
pairs as (
  select a.*, b.entity_id opponent_id, b.entity_win opponent_win
  from sides a join sides b on a.contest_id = b.contest_id and a.entity_id <> b.entity_id)"""
