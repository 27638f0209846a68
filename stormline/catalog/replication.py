"""D42: universes over thresholds and radii. The SQL rebuilds spine and labels; a test holds the fits against single ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.catalog.joins import distance_sql
from stormline.catalog.roles import PLACES, SPOTS, places, spots
from stormline.plans import universe
from stormline.registry import query, table

UNIVERSES = [(0, 0.8, 200.0), (1, 0.8, 60.0), (2, 0.8, 500.0), (3, 0.6, 200.0), (4, 0.95, 200.0), (5, 0.6, 500.0)]
FEATURES = ["x1", "x2"]


def reports(spark, sf) -> DataFrame:
    """Errors as reports at suppliers' spots."""
    n = table(spark, sf, "supplier").agg(F.count("*").alias("n"))  # one row
    e = table(spark, sf, "events").where("event_type = 'error'").crossJoin(F.broadcast(n))
    return e.select(F.to_date("ts").alias("day"), (F.col("event_id") % F.col("n")).alias("spot_id"))


def assets(spark, sf) -> DataFrame:
    p = places(spark, sf)
    return p.select(F.col("place_id").alias("asset_id"), F.col("lon").alias("x"), F.col("lat").alias("y"), (F.col("score") / 1000).alias("x1"), (F.col("place_id") % 7).cast("double").alias("x2"))


@query("d42_universe_rebuild", f"""
WITH {SPOTS}, {PLACES}, u AS (SELECT unnest({[x[0] for x in UNIVERSES]}) AS universe, unnest({[x[1] for x in UNIVERSES]})::DOUBLE AS q, unnest({[x[2] for x in UNIVERSES]})::DOUBLE AS radius_m),
r AS (SELECT ts::DATE AS day, event_id % (SELECT count(*) FROM supplier) AS spot_id FROM events WHERE event_type = 'error'), c AS (SELECT day, count(*) AS n FROM r GROUP BY day),
cut AS (SELECT universe, list_sort(list(n))[greatest(ceil(q * count(*)), 1)::BIGINT] AS cut FROM u, c GROUP BY universe, q),
d AS (SELECT universe, day FROM c, u JOIN cut USING (universe) WHERE n >= cut), i AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY universe ORDER BY day) AS INTEGER) AS island FROM d),
e AS (SELECT universe, day, min(day) OVER (PARTITION BY universe, island) AS event FROM i),
x AS (SELECT spot_id, place_id, s.lon AS lon1, s.lat AS lat1, p.lon AS lon2, p.lat AS lat2 FROM spots s, places p WHERE abs(s.lon - p.lon) < 0.01 AND abs(s.lat - p.lat) < 0.01), {distance_sql('x', 'dd')},
l AS (SELECT DISTINCT e.universe, event, place_id FROM e JOIN r USING (day) JOIN dd USING (spot_id) JOIN u ON u.universe = e.universe WHERE dist_m <= radius_m),
t AS (SELECT universe, q, radius_m, (SELECT count(*) FROM e WHERE e.universe = u.universe) AS n_days, (SELECT count(DISTINCT event) FROM e WHERE e.universe = u.universe) AS n_events, (SELECT count(*) FROM l WHERE l.universe = u.universe) AS n_labels FROM u)
SELECT *, n_events - (SELECT n_events FROM t WHERE universe = 0) AS delta_events, n_labels - (SELECT n_labels FROM t WHERE universe = 0) AS delta_labels FROM t""")
def d42_rebuild(spark, sf):
    u = spark.createDataFrame(UNIVERSES, universe.PARAMETERS)
    out = universe.universe_table(reports(spark, sf), spots(spark, sf), assets(spark, sf), FEATURES, u, 0)
    return out.select("universe", "q", "radius_m", "n_days", "n_events", "n_labels", "delta_events", "delta_labels")


SPANS = [("reports", "2024-01-01", "2024-01-31"), ("alerts", "2024-01-10", "2024-01-31"), ("storms", "2024-01-01", "2024-01-20"), ("tides", "2023-01-01", "2025-01-01")]


@query("d21_dated_events", f"""
WITH c AS (SELECT user_id % 2 AS dataset, ts::DATE AS day, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL), q AS (SELECT dataset, quantile_disc(n, 0.9) AS cut FROM c GROUP BY dataset),
h AS (SELECT user_id % 3 AS station, floor(epoch(ts) / 3600)::BIGINT * 3600 AS ts, max(value) AS level FROM events GROUP BY ALL), hi AS (SELECT *, ts - 3600 * row_number() OVER (PARTITION BY station ORDER BY ts) AS run FROM h WHERE level >= 215),
hr AS (SELECT station, run, min(ts) AS a, max(ts) AS b FROM hi GROUP BY ALL HAVING count(*) >= 2),
t AS (SELECT 'reports' AS source, day FROM c JOIN q USING (dataset) WHERE n >= cut UNION SELECT 'alerts', ts::DATE FROM events WHERE event_type = 'click' AND value > 300
  UNION SELECT 'tides', make_timestamp((unnest(range(a, b + 1, 3600)) - 18000) * 1000000)::DATE FROM hr UNION SELECT 'storms', ts::DATE + unnest([0, 1])::INTEGER FROM events WHERE event_type = 'view' AND value > 290 AND user_id % 4 IN (1, 2)),
d AS (SELECT day, bool_or(source = 'reports') AS reports, bool_or(source = 'alerts') AS alerts, bool_or(source = 'storms') AS storms, bool_or(source = 'tides') AS tides, day(day) % 9 - 4 <= 0 AND month(day) IN (12, 1, 2, 3) AND year(day) = 2024 AS snow FROM t GROUP BY day),
i AS (SELECT *, day - row_number() OVER (ORDER BY day)::INTEGER AS island FROM d),
e AS (SELECT min(day) AS a, max(day) AS b, count(*) AS n_days, bool_or(reports) AS reports, bool_or(alerts) AS alerts, bool_or(storms) AS storms, bool_or(tides) AS tides, bool_or(snow) AS snow FROM i GROUP BY island),
s AS (SELECT unnest({[x[0] for x in SPANS]}) AS source, unnest({[x[1] for x in SPANS]})::DATE AS f, unnest({[x[2] for x in SPANS]})::DATE AS l)
SELECT strftime(a, '%Y%m%d') AS event_id, n_days, reports, alerts, storms, tides, epoch(a)::BIGINT + 18000 - 10800 AS window_start, epoch(b)::BIGINT + 86400 + 18000 + 10800 AS window_end,
  coalesce((SELECT string_agg(source, ',' ORDER BY source) FROM s WHERE f <= a AND b <= l), '') AS covered_by,
  CASE WHEN (reports OR alerts OR storms) AND tides THEN 'mixed' WHEN tides THEN 'coastal' WHEN (reports OR alerts OR storms) AND snow THEN 'snowmelt' WHEN reports OR alerts OR storms THEN 'pluvial' ELSE 'unclassified' END AS event_class FROM e""")
def d21_dated(spark, sf):
    from stormline.plans import spine

    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    hour = (F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000) * 3600).cast("long")
    readings = e.groupBy((F.col("user_id") % 3).alias("station"), hour.alias("ts")).agg(F.max("value").alias("level"))
    storms = e.where("event_type = 'view' AND value > 290").select(F.when(F.col("user_id") % 2 == 0, "Z").otherwise("C").alias("kind"), (F.col("user_id") % 4).cast("string").alias("place"), F.col("day").alias("first_day"), F.date_add("day", 1).alias("last_day"))
    days = {
        "reports": spine.report_days(e.where("event_type = 'error'").select((F.col("user_id") % 2).alias("dataset"), "day"), 0.9), "alerts": e.where("event_type = 'click' AND value > 300").select("day").distinct(),
        "storms": spine.storm_days(storms, ["1"], ["2"]), "tides": spine.tide_days(readings, 215.0, 3600),
    }
    spans = spark.createDataFrame(SPANS, "source string, a string, b string").select("source", F.to_date("a").alias("first_day"), F.to_date("b").alias("last_day"))
    january = spark.range(31).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    highs = january.select("day", (F.dayofmonth("day") % 9 - 4).cast("double").alias("tmax_c"))
    out = spine.dated_events(days, spans, highs)
    return out.select("event_id", "n_days", "reports", "alerts", "storms", "tides", "window_start", "window_end", F.array_join("covered_by", ",").alias("covered_by"), "event_class")
