"""D36: what event days did to the service of three complexes; one of them has an outage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.plans import impact
from stormline.registry import query, table

EVENT_DAYS = ("2024-01-15", "2024-01-16", "2024-01-19")
ERA = ("2024-01-01", "2024-01-30")
LINES = [(0, "a"), (0, "b"), (1, "a"), (2, "b"), (3, None)]


def calls(spark, sf) -> DataFrame:
    """Events as calls of trips at stops; one in fifty calls twice, and on two mornings complex 1 has a quarter of its calls."""
    at = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    e = table(spark, sf, "events").select("event_id", (F.col("user_id") % 3).alias("complex_id"), F.col("event_type").alias("route_id"), at.alias("ts"))
    hour, day = F.expr("(ts - 18000) div 3600 % 24"), F.expr("(ts - 18000) div 86400 - 19722")
    e = e.where(~((F.col("complex_id") == 1) & day.isin(15, 16) & hour.between(9, 12) & (F.col("event_id") % 4 != 0)))
    e = e.unionByName(e.where("event_id % 50 = 0").withColumn("ts", F.col("ts") + 600))
    return e.select(F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("trip_id"), F.concat(F.lit("s"), F.col("complex_id").cast("string")).alias("stop_id"), "complex_id", "route_id", "ts")


def ratios(spark, sf) -> DataFrame:
    events = spark.createDataFrame([(d,) for d in EVENT_DAYS], "d string").select(F.to_date("d").alias("day"))
    lines = spark.createDataFrame(LINES, "complex_id long, line string")
    return impact.service_ratios(impact.hourly_service(calls(spark, sf)), events, impact.control_days(events, *ERA), lines)


#: Days count from 2024-01-01 as 1; in January local time is five hours behind.
RATIOS = """c AS (
  SELECT event_id, user_id % 3 AS complex_id, event_type AS route_id, floor(epoch(ts))::BIGINT AS ts, (floor(epoch(ts))::BIGINT - 18000) // 86400 - 19722 AS day, (floor(epoch(ts))::BIGINT - 18000) // 3600 % 24 AS hour FROM events
), k AS (SELECT * FROM c WHERE NOT (complex_id = 1 AND day IN (15, 16) AND hour BETWEEN 9 AND 12 AND event_id % 4 <> 0)
), g AS (SELECT *, lag(ts) OVER w AS before, lag(day) OVER w AS was FROM k WINDOW w AS (PARTITION BY complex_id ORDER BY ts, event_id)
), h AS (SELECT complex_id, route_id, day, hour, count(*) AS n, max(CASE WHEN was >= day - 1 THEN ts - before END) AS gap FROM g GROUP BY ALL
), ev AS (SELECT unnest([15, 16, 19]) AS e
), ct AS (SELECT e, e + unnest([-14, -7, 7, 14]) AS day FROM ev
), ctl AS (SELECT e, h.* FROM ct JOIN h USING (day) WHERE day BETWEEN 1 AND 30 AND day NOT IN (15, 16, 19)
), d AS (SELECT day AS e, complex_id, hour, sum(n) AS n, max(gap) AS gap FROM h WHERE day IN (15, 16, 19) GROUP BY ALL
), b AS (SELECT e, complex_id, hour, count(*) AS n_controls, median(n) AS base_calls, median(gap) AS base_gap FROM (SELECT e, complex_id, hour, day, sum(n) AS n, max(gap) AS gap FROM ctl GROUP BY ALL) GROUP BY ALL
), sys AS (
  SELECT e, route_id, hour, x.n / y.n AS r FROM (SELECT day AS e, route_id, hour, sum(n) AS n FROM h WHERE day IN (15, 16, 19) GROUP BY ALL) x
  JOIN (SELECT e, route_id, hour, median(n) AS n FROM (SELECT e, route_id, hour, day, sum(n) AS n FROM ctl GROUP BY ALL) GROUP BY ALL) y USING (e, route_id, hour)
), x AS (SELECT e, complex_id, hour, sum(n * coalesce(r, 1)) AS expected FROM (SELECT e, complex_id, route_id, hour, median(n) AS n FROM (SELECT e, complex_id, route_id, hour, day, sum(n) AS n FROM ctl GROUP BY ALL) GROUP BY ALL) LEFT JOIN sys USING (e, route_id, hour) GROUP BY e, complex_id, hour
), r AS (
  SELECT e, complex_id, hour, coalesce(d.n, 0)::BIGINT AS n_calls, d.gap AS max_gap_s, n_controls, base_calls, base_gap, coalesce(d.n, 0) / base_calls AS service_ratio, d.gap / nullif(base_gap, 0) AS gap_ratio, coalesce(d.n, 0) / nullif(expected, 0) AS residual_ratio
  FROM d FULL JOIN b USING (e, complex_id, hour) LEFT JOIN x USING (e, complex_id, hour)
), ln AS (SELECT unnest([0, 0, 1, 2]) AS complex_id, unnest(['a', 'b', 'a', 'b']) AS line
), lv AS (SELECT e, hour, l.complex_id, median(m) AS level FROM ln l JOIN (SELECT e, hour, line, median(service_ratio) AS m FROM r JOIN ln USING (complex_id) GROUP BY ALL) USING (line) GROUP BY ALL
), ratios AS (SELECT r.*, service_ratio / nullif(level, 0) AS peer_ratio FROM r LEFT JOIN lv USING (e, complex_id, hour))"""


@query("d36_service_ratios", f"""
WITH {RATIOS} SELECT e, complex_id, hour, n_calls, max_gap_s, n_controls, base_calls, base_gap, round(service_ratio, 9) AS service_ratio, round(gap_ratio, 9) AS gap_ratio, round(residual_ratio, 9) AS residual_ratio, round(peer_ratio, 9) AS peer_ratio FROM ratios""")
def d36_ratios(spark, sf):
    r = ratios(spark, sf)
    rounded = [F.round(c, 9).alias(c) for c in ("service_ratio", "gap_ratio", "residual_ratio", "peer_ratio")]
    return r.select(F.dayofmonth("event_day").cast("long").alias("e"), "complex_id", F.col("hour").cast("long").alias("hour"), "n_calls", "max_gap_s", "n_controls", "base_calls", "base_gap", *rounded)


@query("d36_caught", f"""
WITH {RATIOS}, hit AS (
  SELECT e, complex_id, hour FROM ratios WHERE hour BETWEEN 6 AND 21 AND base_calls >= 5 AND n_controls >= 2 AND (service_ratio <= 0.5 OR gap_ratio >= 2.0) AND coalesce(residual_ratio, 0) <= 0.8 AND coalesce(peer_ratio, 0) <= 0.8
), i AS (SELECT *, hour - row_number() OVER (PARTITION BY e, complex_id ORDER BY hour) AS run FROM hit), j AS (SELECT e, complex_id, min(hour) AS hour, count(*) AS n FROM i GROUP BY e, complex_id, run HAVING count(*) >= 2)
SELECT e, complex_id, min(hour) AS first_hour, sum(n)::BIGINT AS n_hours FROM j GROUP BY ALL""")
def d36_caught(spark, sf):
    c = impact.caught(ratios(spark, sf))
    return c.select(F.dayofmonth("event_day").cast("long").alias("e"), "complex_id", F.col("first_hour").cast("long").alias("first_hour"), "n_hours")
