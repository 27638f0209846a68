"""D24: the training matrix of customers as units and stormy spells as events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.catalog.detecting import REPLAY, storm
from stormline.catalog.roles import DAY0
from stormline.operators.windows import with_trailing
from stormline.plans.matrix import training_matrix
from stormline.registry import query, table

DENSITY_H = 240


def parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The matrix and its census; hours count from DAY0."""
    hourly = storm(spark, sf).select("cell", ((F.col("hour_end") - DAY0) / 3600).cast("long").alias("h"), "mm")
    dense = hourly.select("cell").distinct().withColumn("h", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(719).cast("long")))).join(hourly, ["cell", "h"], "left")
    rain = with_trailing(dense, ["cell"], "h", "mm", [20]).select("cell", "h", "mm", F.col("mm_20").alias("mm_24h"))
    events = spark.range(6).select((F.col("id") + 1).alias("event_id"), (F.col("id") * 124 + 30).alias("open_h"), (F.col("id") * 124 + 30 + 20 + F.col("id") * 2).alias("close_h"))
    k = F.col("c_custkey")
    units = table(spark, sf, "customer").select(
        k.alias("asset_id"), F.when(k % 6 == 0, "cell").otherwise("point").alias("role"), F.col("c_nationkey").cast("long").alias("cell"), (F.col("c_acctbal") / 100).alias("elev_m"), (k % 5 != 0).alias("grade_ok"),
        F.when(k % 11 != 0, F.col("c_acctbal") / 120).alias("ring_m"), F.element_at(F.array(F.lit("deep"), F.lit("nuisance"), F.lit("none")), (k % 3 + 1).cast("int")).alias("category"),
    )
    pairs = units.crossJoin(F.broadcast(events.select("event_id"))).select("asset_id", "role", "cell", "event_id", ((F.col("asset_id") * 7 + F.col("event_id")) % 13 == 0).alias("flooded"), ((F.col("asset_id") + F.col("event_id")) % 17 != 0).alias("pairable"))
    reports = table(spark, sf, "events").where("event_type = 'error'").select((F.col("user_id") % 25).alias("cell"), ((F.unix_timestamp(F.col("ts").cast("timestamp")) - DAY0) / 3600).cast("long").alias("h"))
    shares = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("cell"), (F.col("n_nationkey") / 100.0).alias("share_deep"), (F.col("n_nationkey") / 50.0).alias("share_nuisance"))
    return training_matrix(pairs, events, rain, reports, units, shares, DENSITY_H)


MATRIX = f"""{REPLAY}, ev AS (SELECT i + 1 AS event_id, i * 124 + 30 AS open_h, i * 124 + 50 + i * 2 AS close_h FROM (SELECT unnest(range(0, 6)) AS i)
), full_h AS (SELECT cell, h, mm FROM (SELECT n_nationkey::BIGINT AS cell, unnest(range(0, 720)) AS h FROM nation) LEFT JOIN storm USING (cell, h)
), r24 AS (SELECT *, CASE WHEN count(mm) OVER w = 20 THEN sum(mm) OVER w END AS mm_24h FROM full_h WINDOW w AS (PARTITION BY cell ORDER BY h ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
), pw AS (SELECT cell, event_id, ln(1 + max(mm) FILTER (WHERE h > open_h)) AS log_max, ln(1 + sum(mm) FILTER (WHERE h > open_h)) AS log_total, ln(1 + max(mm_24h) FILTER (WHERE h = open_h)) AS log_before FROM r24 JOIN ev ON h >= open_h AND h <= close_h GROUP BY ALL
), rep AS (SELECT user_id % 25 AS cell, floor((floor(epoch(ts)) - {DAY0}) / 3600)::BIGINT AS h FROM events WHERE event_type = 'error'
), dens AS (SELECT rep.cell, event_id, count(*) AS density FROM rep JOIN ev ON h >= open_h - {DENSITY_H} AND h < open_h GROUP BY ALL
), x AS (
  SELECT c_custkey AS asset_id, CASE WHEN c_custkey % 6 = 0 THEN 'cell' ELSE 'point' END AS role, c_nationkey::BIGINT AS cell, event_id, (c_custkey * 7 + event_id) % 13 = 0 AS flooded, (c_custkey + event_id) % 17 <> 0 AS pairable,
         CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal / 120 END AS ring, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal / 100 WHEN c_custkey % 11 <> 0 THEN c_acctbal / 120 END AS elev, ['deep', 'nuisance', 'none'][c_custkey % 3 + 1] AS category FROM customer, ev
), m AS (
  SELECT x.*, log_max, log_total, log_before, coalesce(density, 0) AS density, CASE WHEN NOT pairable THEN 'unpairable' WHEN role = 'point' AND (elev IS NULL OR ring IS NULL) THEN 'out_of_footprint' WHEN log_max IS NULL OR log_total IS NULL OR log_before IS NULL THEN 'no_rain' WHEN flooded THEN 'positive' ELSE 'negative' END AS reason
  FROM x LEFT JOIN pw USING (cell, event_id) LEFT JOIN dens USING (cell, event_id))"""


@query("d24_matrix_rows", f"""
WITH {MATRIX} SELECT asset_id, role, cell, event_id, flooded, round(log_max, 6) AS log_max, round(log_total, 6) AS log_total, round(log_before, 6) AS log_before, CASE WHEN role = 'point' THEN round(elev * 3937 / 1200, 9) END AS elev_ft,
  CASE WHEN role = 'point' THEN round((elev - ring) * 3937 / 1200, 9) END AS relief_ft, CASE WHEN role = 'point' THEN category END AS category, CASE WHEN role = 'cell' THEN cell / 100.0::DOUBLE END AS share_deep, CASE WHEN role = 'cell' THEN density END AS density
FROM m WHERE reason IN ('positive', 'negative')""")
def d24_rows(spark, sf):
    rounded = [F.round(c, d).alias(c) for c, d in (("log_max", 6), ("log_total", 6), ("log_before", 6), ("elev_ft", 9), ("relief_ft", 9))]
    return parts(spark, sf)[0].select("asset_id", "role", "cell", "event_id", "flooded", *rounded, "category", "share_deep", "density")


@query("d24_matrix_census", f"WITH {MATRIX} SELECT role, reason, count(*) AS n FROM m GROUP BY ALL")
def d24_census(spark, sf):
    return parts(spark, sf)[1]
