"""D16: speeds of wet hours against dry ones, cell by cell, over a month of events as legs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.catalog.detecting import REPLAY, storm
from stormline.catalog.roles import DAY0
from stormline.operators.aggregates import T_975
from stormline.operators.windows import with_trailing
from stormline.plans import contrast
from stormline.registry import query, table

STORM_HOURS = (31, 42)


def rain_hours(spark, sf) -> DataFrame:
    mm = F.when(F.col("mm").isNotNull(), F.greatest(F.col("mm") - 0.2, F.lit(0.0)))
    known = storm(spark, sf).select("cell", ((F.col("hour_end") - DAY0) / 3600).cast("long").alias("h"), mm.alias("mm_1h"))
    return table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("cell")).withColumn("h", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(719).cast("long")))).join(known, ["cell", "h"], "left")


def speeds(spark, sf) -> DataFrame:
    """Cell hours with legs; rain slows them. Bins are hours of the day."""
    w = with_trailing(rain_hours(spark, sf), ["cell"], "h", "mm_1h", [6])
    from pyspark.sql import Window

    rain = w.select("cell", "h", "mm_1h", F.lag("mm_1h").over(Window.partitionBy("cell").orderBy("h")).alias("mm_prev"), F.col("mm_1h_6").alias("mm_6h"))
    h = ((F.unix_timestamp(F.col("ts").cast("timestamp")) - DAY0) / 3600).cast("long")
    legs = table(spark, sf, "events").groupBy((F.col("user_id") % 25).alias("cell"), h.alias("h")).agg(F.count("*").alias("n_legs"), F.sum(F.col("event_id") % 13 + 20).alias("s"), F.sum(F.col("event_id") % 7 + 5).alias("dt"))
    slow = F.when(F.col("mm_1h") >= 1, 0.8).otherwise(1.0)
    return legs.join(rain, ["cell", "h"]).select("cell", "h", (F.col("h") % 24).alias("hw"), "n_legs", (F.col("s") * slow).alias("dist"), "dt", "mm_1h", "mm_prev", "mm_6h")


HOURS = f"""{REPLAY}, rh AS (SELECT c.cell, c.h, CASE WHEN mm IS NOT NULL THEN greatest(mm - 0.2::DOUBLE, 0) END AS mm_1h FROM (SELECT n_nationkey::BIGINT AS cell, unnest(range(0, 720)) AS h FROM nation) c LEFT JOIN storm USING (cell, h)
), rn AS (SELECT *, lag(mm_1h) OVER w AS mm_prev, CASE WHEN count(mm_1h) OVER s = 6 THEN sum(mm_1h) OVER s END AS mm_6h FROM rh WINDOW w AS (PARTITION BY cell ORDER BY h), s AS (PARTITION BY cell ORDER BY h ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
), lg AS (SELECT user_id % 25 AS cell, floor((floor(epoch(ts)) - {DAY0}) / 3600)::BIGINT AS h, count(*) AS n_legs, sum(event_id % 13 + 20) AS s, sum(event_id % 7 + 5)::BIGINT AS dt FROM events GROUP BY ALL
), hr AS (SELECT rn.*, h % 24 AS hw, n_legs, dt, s * CASE WHEN mm_1h >= 1 THEN 0.8::DOUBLE ELSE 1 END AS dist, s * CASE WHEN mm_1h >= 1 THEN 0.8::DOUBLE ELSE 1 END / dt AS d FROM lg JOIN rn USING (cell, h)
), dr AS (SELECT * FROM hr WHERE mm_1h < 0.1 AND mm_prev < 0.1 AND mm_6h < 0.5
), q AS (SELECT cell, hw, sum(dist) / sum(dt) AS norm, sum(dt) AS sw, sum(dist) AS b_dist, count(*) AS n_dry FROM dr GROUP BY ALL
), bin AS (SELECT cell, hw, norm, n_dry, sqrt(n_dry / (n_dry - 1) * sum((dt * (d - norm)) ** 2)) / sw AS se, sw, b_dist FROM dr JOIN q USING (cell, hw) WHERE n_dry >= 2 GROUP BY cell, hw, norm, n_dry, sw, b_dist
), tc AS (SELECT i AS df, {list(T_975)}[i]::DOUBLE AS t FROM (SELECT unnest(range(1, 31)) AS i)
), ev AS (SELECT h, sum(fresh) OVER (ORDER BY h) AS event FROM (SELECT h, CASE WHEN h - lag(h) OVER (ORDER BY h) <= 7 THEN 0 ELSE 1 END AS fresh FROM (SELECT DISTINCT h FROM rh WHERE mm_1h >= 1))
), wt AS (SELECT hr.*, event, d / norm AS a FROM hr JOIN ev USING (h) JOIN bin USING (cell, hw) WHERE mm_1h >= 1)"""


@query("d16_storm_hours", f"""
WITH {HOURS}, x AS (SELECT h, cell, d / norm AS ratio, coalesce(t, 1.96) * se / norm AS rel, n_legs, n_dry FROM hr JOIN bin USING (cell, hw) LEFT JOIN tc ON df = n_dry - 1 WHERE h BETWEEN {STORM_HOURS[0]} AND {STORM_HOURS[1]})
SELECT h, cell, round(ratio, 8) AS ratio, round(rel * ratio, 8) AS half, n_legs, n_dry, 2 * rel < 0.3 AND rel * ratio > 0 AS published FROM x""")
def d16_storm(spark, sf):
    hours = speeds(spark, sf)
    storm_ = spark.range(STORM_HOURS[0], STORM_HOURS[1] + 1).withColumnRenamed("id", "h")
    r = contrast.storm_cells(hours, contrast.dry_bins(hours), storm_)
    return r.select("h", "cell", F.round("ratio", 8).alias("ratio"), F.round("half", 8).alias("half"), "n_legs", "n_dry", "published")


@query("d16_lag_curve", f"""
WITH {HOURS}, l AS (SELECT cell, h, h - max(CASE WHEN mm_1h >= 1 THEN h END) OVER w AS lag_h, arg_max(mm_1h, CASE WHEN mm_1h >= 1 THEN h END) OVER w AS last_mm FROM rh WINDOW w AS (PARTITION BY cell ORDER BY h ROWS BETWEEN 48 PRECEDING AND CURRENT ROW)),
x AS (SELECT * FROM hr JOIN l USING (cell, h) JOIN bin USING (cell, hw) WHERE lag_h <= 12)
SELECT rain, lag_h, round((sum(dist) / sum(dt)) / (sum(b_dist) / sum(sw)), 8) AS ratio, sum(n_legs)::BIGINT AS n_legs, count(DISTINCT cell) AS n_cells
FROM (SELECT 'all' AS rain, * FROM x UNION ALL SELECT 'heavy', * FROM x WHERE last_mm >= 10) GROUP BY rain, lag_h""")
def d16_lags(spark, sf):
    hours = speeds(spark, sf)
    r = contrast.lag_curve(hours, rain_hours(spark, sf), contrast.dry_bins(hours))
    return r.withColumn("ratio", F.round("ratio", 8))


@query("d16_headline", f"""
WITH {HOURS}, c AS (SELECT 'city' AS g, event AS k, a, dt, cell FROM wt UNION ALL SELECT 'day', h // 24, a, dt, cell FROM wt UNION ALL SELECT 'cell' || cell, event, a, dt, cell FROM wt),
m AS (SELECT g, sum(a * dt) / sum(dt) AS mean, sum(dt) AS sw, count(DISTINCT k) AS n FROM c GROUP BY g), s AS (SELECT g, k, mean, sw, n, sum(dt * (a - mean)) AS e FROM c JOIN m USING (g) GROUP BY ALL),
i AS (SELECT g, mean, n, coalesce(t, 1.96) * sqrt(n / (n - 1) * sum(e * e)) / sw AS half FROM s LEFT JOIN tc ON df = n - 1 WHERE n >= 2 GROUP BY g, mean, n, sw, t),
v AS (SELECT (SELECT sum(dist) / sum(dt) FROM wt) AS v_wet, (SELECT sum(dist) / sum(dt) FROM dr JOIN bin USING (cell, hw)) AS v_dry),
p AS (SELECT median(mean) AS median_cell, count(*) AS n_cells FROM i WHERE g LIKE 'cell%' AND 2 * half < 0.3)
SELECT round(x.mean, 8) AS ratio, round(x.mean - x.half, 8) AS lo, round(x.mean + x.half, 8) AS hi, x.n AS n_events, round(y.mean - y.half, 8) AS lo_day, round(y.mean + y.half, 8) AS hi_day, y.n AS n_days,
  round(x.mean * CASE WHEN v_wet >= 10 THEN 1.016 WHEN v_wet >= 6 THEN 1.015 WHEN v_wet >= 3 THEN 1.025 ELSE 1.164 END / CASE WHEN v_dry >= 10 THEN 1.016 WHEN v_dry >= 6 THEN 1.015 WHEN v_dry >= 3 THEN 1.025 ELSE 1.164 END, 8)::DOUBLE AS band,
  round(median_cell, 8) AS median_cell, n_cells, (SELECT count(DISTINCT cell) FROM wt) - n_cells AS n_hidden, (SELECT count(*) FROM wt) AS n_cell_hours
FROM i x, i y, v, p WHERE x.g = 'city' AND y.g = 'day'""")
def d16_head(spark, sf):
    hours = speeds(spark, sf)
    r = contrast.headline(hours, contrast.dry_bins(hours))
    rounded = [F.round(c, 8).alias(c) for c in ("ratio", "lo", "hi", "lo_day", "hi_day", "band", "median_cell")]
    return r.select(*rounded, "n_events", "n_days", "n_cells", "n_hidden", "n_cell_hours")
