"""The roles that the driver's tables play, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormline.registry import table

DAY0 = 1704067200  # 2024-01-01 00:00 UTC

PINGS = """pings AS (
  SELECT event_id, 'v' || (event_id // 6000) || '_' || (event_id % 12) AS vehicle_id,
         CASE WHEN event_id % 211 <> 0 THEN 'T' || (event_id // 6000) || '_' || (event_id % 12) || '_' || (seq // 100) END AS trip_id,
         CASE event_id % 4 WHEN 0 THEN 'B' || (event_id % 12) WHEN 1 THEN 'X' || (event_id % 12) WHEN 2 THEN 'M' || (event_id % 12) || '+' ELSE 'Q' || (event_id % 12) END AS route_id,
         '20240101' AS start_date, 's' || (pos // 5) AS stop_id, 1704067200 + (seq - CASE WHEN seq % 25 = 24 THEN 1 ELSE 0 END) * 84 + event_id % 12 + CASE WHEN seq >= 250 THEN 400 ELSE 0 END AS ts,
         (40.6::DOUBLE + 0.003::DOUBLE * pos) AS lat, (-73.9::DOUBLE + 0.001::DOUBLE * (event_id % 12)) AS lon, 1704067230 + seq * 84 AS fetched_at, seq, event_id % 2 AS direction_id, value
  FROM (SELECT *, (seq // 50) * 46 + greatest(seq % 50 - 4, 0) AS pos FROM (SELECT *, (event_id % 6000) // 12 AS seq FROM events))
)"""


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions: a fleet of twelve vehicles for every 6000 events, 84 s apart, with stops held at times."""
    e = table(spark, sf_dir, "events")
    e = e.withColumn("seq", F.expr("(event_id % 6000) div 12"))
    e = e.withColumn("pos", F.expr("(seq div 50) * 46 + greatest(seq % 50 - 4, 0)"))
    return e.select(
        "event_id",
        F.expr("concat('v', event_id div 6000, '_', event_id % 12)").alias("vehicle_id"),
        F.expr("CASE WHEN event_id % 211 <> 0 THEN concat('T', event_id div 6000, '_', event_id % 12, '_', seq div 100) END").alias("trip_id"),
        F.expr("CASE event_id % 4 WHEN 0 THEN concat('B', event_id % 12) WHEN 1 THEN concat('X', event_id % 12) WHEN 2 THEN concat('M', event_id % 12, '+') ELSE concat('Q', event_id % 12) END").alias("route_id"),
        F.lit("20240101").alias("start_date"),
        F.expr("concat('s', pos div 5)").alias("stop_id"),
        F.expr(f"{DAY0} + (seq - CASE WHEN seq % 25 = 24 THEN 1 ELSE 0 END) * 84 + event_id % 12 + CASE WHEN seq >= 250 THEN 400 ELSE 0 END").alias("ts"),
        F.expr("40.6D + 0.003D * pos").alias("lat"), F.expr("-73.9D + 0.001D * (event_id % 12)").alias("lon"),
        F.expr(f"{DAY0 + 30} + seq * 84").alias("fetched_at"), "seq", F.expr("event_id % 2").alias("direction_id"), "value",
    )


RAIN = """rain AS (
  SELECT cell, h, CASE WHEN n > 0 THEN mm END AS mm FROM (
    SELECT c.cell, h.h, count(o.mm) AS n, round(sum(o.mm), 6) AS mm
    FROM (SELECT DISTINCT c_nationkey AS cell FROM customer) c
    CROSS JOIN (SELECT unnest(range(0, 240)) AS h) h
    LEFT JOIN (SELECT c_nationkey AS cell, o_orderkey % 240 AS h, (CASE WHEN o_orderkey % 7 < 3 THEN (o_orderkey % 11) * 0.4 END)::DOUBLE AS mm FROM orders JOIN customer ON o_custkey = c_custkey) o
      ON o.cell = c.cell AND o.h = h.h
    GROUP BY ALL)
)"""


def rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense (cell, hour) rain: nations are cells, orders bring readings, four of seven of them none, and an hour without any is missing."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    falls = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("cell"), F.expr("o_orderkey % 240").alias("h"), F.expr("CASE WHEN o_orderkey % 7 < 3 THEN (o_orderkey % 11) * 0.4D END").alias("mm")
    )
    cells = customer.select(F.col("c_nationkey").alias("cell")).distinct()
    spine = cells.withColumn("h", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(239).cast("long"))))
    amounts = falls.groupBy("cell", "h").agg(F.round(F.sum("mm"), 6).alias("mm"))
    return spine.join(amounts, ["cell", "h"], "left")


SPOTS = """spots AS (
  SELECT s_suppkey AS spot_id, -74.05::DOUBLE + 0.0131::DOUBLE * (s_suppkey % 23) + 0.0007::DOUBLE * (s_suppkey // 23 % 17) AS lon, 40.62::DOUBLE + 0.0097::DOUBLE * (s_suppkey % 19) + 0.0003::DOUBLE * (s_suppkey // 19 % 29) AS lat, s_nationkey AS zone, s_acctbal AS depth FROM supplier
)"""
PLACES = """places AS (
  SELECT c_custkey AS place_id, -74.05::DOUBLE + 0.0029::DOUBLE * (c_custkey % 101) AS lon, 40.62::DOUBLE + 0.0023::DOUBLE * (c_custkey // 101 % 83) AS lat, c_nationkey AS zone, c_mktsegment AS kind, c_acctbal AS score FROM customer
)"""


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported spots: suppliers at places that follow from their keys."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("spot_id"),
        F.expr("-74.05D + 0.0131D * (s_suppkey % 23) + 0.0007D * (s_suppkey div 23 % 17)").alias("lon"),
        F.expr("40.62D + 0.0097D * (s_suppkey % 19) + 0.0003D * (s_suppkey div 19 % 29)").alias("lat"),
        F.col("s_nationkey").alias("zone"), F.col("s_acctbal").alias("depth"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets: customers on a grid of places."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("place_id"), F.expr("-74.05D + 0.0029D * (c_custkey % 101)").alias("lon"),
        F.expr("40.62D + 0.0023D * (c_custkey div 101 % 83)").alias("lat"), F.col("c_nationkey").alias("zone"),
        F.col("c_mktsegment").alias("kind"), F.col("c_acctbal").alias("score"),
    )
