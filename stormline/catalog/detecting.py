"""D39 and D40: replays of the detector's cycles over a month of hourly rain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.catalog.roles import DAY0
from stormline.operators.scratch import stored
from stormline.plans import detector, notify
from stormline.plans.notify import CYCLE_FUSE, HANDLE_CAP
from stormline.registry import query, table

CYCLES = 95
MODELS = {
    "stop": ({"log_max": 0.9, "log_total": 0.5, "log_antecedent": 0.1, "static": 1.5}, -4.0),
    "entrance": ({"log_max": 1.1, "log_total": 0.3, "log_antecedent": 0.2, "static": -0.7}, -3.0),
}


def storm(spark, sf) -> DataFrame:
    """Hourly rain of 25 cells over a month: events bring it in stormy spells; some hours are missing, one cell is dark, others have holes."""
    cells = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("cell"))
    dense = cells.withColumn("h", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(719).cast("long")))).where("h * 7 % 97 <> 5")
    e = table(spark, sf, "events").groupBy((F.col("user_id") % 25).alias("cell"), ((F.unix_timestamp(F.col("ts").cast("timestamp")) - DAY0) / 3600).cast("long").alias("h")).agg((F.max("value") * 0.1).alias("mm"))
    mm = F.expr("CASE WHEN cell = 24 OR cell * h % 23 = 7 THEN NULL WHEN h div 31 % 4 = 1 THEN coalesce(mm, 0D) ELSE 0.2D END")
    return stored(dense.join(e, ["cell", "h"], "left").select("cell", (F.col("h") * 3600 + DAY0).alias("hour_end"), mm.alias("mm")), "storm")  # a row a cell and hour, read for each step of a replay


def cycles(spark) -> DataFrame:
    """A cycle every seven hours; some have no temperature, some freeze."""
    i = spark.range(CYCLES).withColumnRenamed("id", "i")
    return i.select((F.lit(DAY0) + (F.col("i") * 7 + 50) * 3600).alias("now"), F.expr("CASE WHEN i % 9 = 4 THEN NULL WHEN i % 11 = 3 THEN 0.5D ELSE 4D + i % 5 END").alias("temp_c"))


def units(spark, sf) -> DataFrame:
    kind = F.expr("CASE c_custkey % 4 WHEN 0 THEN 'entrance' WHEN 3 THEN 'complex' ELSE 'stop' END")
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("asset_id"), kind.alias("kind"), F.col("c_nationkey").cast("long").alias("cell"), F.expr("c_custkey div 8").alias("complex_id"), (F.col("c_acctbal") / 10000).alias("static"))


#: Hours count from DAY0. In January local 21:00 is 02:00 UTC.
REPLAY = f"""storm AS (
  SELECT cell, h, CASE WHEN cell = 24 OR cell * h % 23 = 7 THEN NULL WHEN h // 31 % 4 = 1 THEN coalesce(mm, 0) ELSE 0.2::DOUBLE END AS mm
  FROM (SELECT n_nationkey::BIGINT AS cell, h FROM nation, (SELECT unnest(range(0, 720)) AS h) WHERE h * 7 % 97 <> 5)
  LEFT JOIN (SELECT user_id % 25 AS cell, floor((floor(epoch(ts)) - {DAY0}) / 3600)::BIGINT AS h, max(value) * 0.1::DOUBLE AS mm FROM events GROUP BY ALL) USING (cell, h)
), wet AS (SELECT h, count(*) FILTER (WHERE mm >= 1) AS n FROM storm GROUP BY h
), cyc AS (SELECT i, i * 7 + 50 AS now, CASE WHEN i % 9 = 4 THEN true WHEN i % 11 = 3 THEN true ELSE false END AS winter FROM (SELECT unnest(range(0, {CYCLES})) AS i)
), cand AS (SELECT now, back, (now - 26) // 24 * 24 + 26 - 24 * back AS a FROM cyc, (SELECT unnest(range(0, 7)) AS back)
), pad AS (SELECT now, back, a, count(n) AS known, coalesce(max(n), 0) AS most FROM (SELECT *, a - unnest(range(0, 3)) AS h FROM cand) LEFT JOIN wet USING (h) GROUP BY ALL
), hit AS (SELECT now, min(back) AS back FROM pad WHERE known < 3 OR most < 5 GROUP BY now
), walk AS (
  SELECT cyc.*, coalesce(hit.back, 6) AS walked_days, CASE WHEN hit.back IS NULL THEN 'WINDOW_CAPPED' WHEN known < 3 THEN 'INSUFFICIENT_DATA' ELSE 'OK' END AS state, CASE WHEN known = 3 THEN a END AS anchor
  FROM cyc LEFT JOIN hit USING (now) LEFT JOIN pad ON pad.now = hit.now AND pad.back = hit.back
), feat AS (
  SELECT now, anchor, cell, coalesce(max(mm) FILTER (WHERE h > anchor), 0) AS mm_max, coalesce(sum(mm) FILTER (WHERE h > anchor), 0) AS mm_total, coalesce(sum(mm) FILTER (WHERE h <= anchor), 0) AS mm_antecedent,
         count(*) FILTER (WHERE h > anchor) AS window_hours, count(*) FILTER (WHERE h <= anchor) AS antecedent_hours
  FROM walk JOIN storm ON h > anchor - 24 AND h <= now WHERE state = 'OK' AND mm IS NOT NULL GROUP BY ALL
)"""


@query("d39_anchor_walk", f"""
WITH {REPLAY}, city AS (SELECT now, count(*) AS n_cells, avg(CASE WHEN now > anchor THEN window_hours / (now - anchor) ELSE 1 END) AS coverage FROM feat GROUP BY now)
SELECT now * 3600 + {DAY0} AS now, anchor * 3600 + {DAY0} AS anchor, state, walked_days, n_cells, round(coverage, 9) AS coverage FROM walk LEFT JOIN city USING (now)""")
def d39_walk(spark, sf):
    rain = storm(spark, sf)
    walked = detector.anchor_walk(cycles(spark), detector.wet_cells(rain))
    city = detector.city_coverage(detector.cycle_features(rain, walked)).select("now", "n_cells", F.round("coverage", 9).alias("coverage"))
    return walked.withColumn("walked_days", F.col("walked_days").cast("long")).join(city, "now", "left")


@query("d39_cycle_features", f"""
WITH {REPLAY} SELECT now * 3600 + {DAY0} AS now, cell, round(mm_max, 6) AS mm_max, round(mm_total, 4) AS mm_total, round(mm_antecedent, 4) AS mm_antecedent, window_hours, antecedent_hours FROM feat""")
def d39_features(spark, sf):
    rain = storm(spark, sf)
    f = detector.cycle_features(rain, detector.anchor_walk(cycles(spark), detector.wet_cells(rain)))
    return f.select("now", "cell", F.round("mm_max", 6).alias("mm_max"), F.round("mm_total", 4).alias("mm_total"), F.round("mm_antecedent", 4).alias("mm_antecedent"), "window_hours", "antecedent_hours")


def score_sql(kind: str) -> str:
    m, c = MODELS[kind]
    return f"{c} + {m['log_max']} * ln(1 + mm_max) + {m['log_total']} * ln(1 + mm_total) + {m['log_antecedent']} * ln(1 + mm_antecedent) + {m['static']} * static"


D40_SQL = f"""{REPLAY}, dry AS (
  SELECT now, CASE WHEN w.n IS NULL THEN NULL ELSE now - coalesce((SELECT max(h) FROM (SELECT h FROM wet WHERE n >= 5 UNION ALL SELECT h FROM (SELECT unnest(range(-1, 720)) AS h) WHERE h NOT IN (SELECT h FROM wet)) x WHERE x.h <= now), -1) END AS dry
  FROM cyc LEFT JOIN wet w ON w.h = now
), u AS (SELECT c_custkey AS asset_id, CASE c_custkey % 4 WHEN 0 THEN 'entrance' WHEN 3 THEN 'complex' ELSE 'stop' END AS kind, c_nationkey::BIGINT AS cell, c_custkey // 8 AS complex_id, c_acctbal / 10000 AS static FROM customer
), s AS (SELECT now, asset_id, kind, complex_id, cell, mm_total, round(CASE kind WHEN 'stop' THEN {score_sql('stop')} ELSE {score_sql('entrance')} END, 9) AS score FROM u JOIN feat USING (cell) WHERE kind <> 'complex'
), door AS (SELECT *, row_number() OVER (PARTITION BY now, complex_id ORDER BY score DESC, cell) AS r FROM s WHERE kind = 'entrance'
), shown AS (SELECT now, asset_id, kind, cell, mm_total, score FROM s WHERE kind = 'stop' UNION ALL SELECT d.now, u.asset_id, 'complex', d.cell, d.mm_total, d.score FROM u JOIN door d USING (complex_id) WHERE u.kind = 'complex' AND r = 1
), t AS (
  SELECT shown.*, i, anchor, winter, dry, CASE WHEN dry = 0 AND mm_total >= 2 THEN CASE WHEN rk >= 0.98 THEN 2 WHEN rk >= 0.9 THEN 1 ELSE 0 END ELSE 0 END AS tier_now
  FROM (SELECT *, cume_dist() OVER (PARTITION BY now, kind ORDER BY score) AS rk FROM shown) shown JOIN walk USING (now) JOIN dry USING (now)
), g AS (SELECT *, CASE WHEN lag(i) OVER w = i - 1 AND lag(anchor) OVER w = anchor AND NOT lag(winter) OVER w THEN 0 ELSE 1 END AS fresh FROM t WINDOW w AS (PARTITION BY asset_id ORDER BY i)
), p AS (SELECT *, sum(fresh) OVER (PARTITION BY asset_id ORDER BY i) AS part FROM g
), l AS (SELECT *, CASE WHEN winter THEN 0 ELSE max(tier_now) OVER (PARTITION BY asset_id, part ORDER BY i) END AS tier FROM p)"""


@query("d40_detector_cycles", f"""
WITH {D40_SQL}
SELECT now * 3600 + {DAY0} AS now, asset_id, kind, cell, tier_now, tier, winter AS suppressed, coalesce(dry >= 3, false) AS dimmed FROM l""")
def d40_cycles(spark, sf):
    out = detector.detector_cycles(storm(spark, sf), cycles(spark), units(spark, sf), MODELS)
    return out.select("now", "asset_id", "kind", "cell", "tier_now", "tier", "suppressed", "dimmed")


def subscribers(spark, sf) -> DataFrame:
    """Customers' stops and complexes, each with the handle of its segment and nation, a third of them without ELEVATED."""
    c = table(spark, sf, "customer").where("c_custkey % 4 <> 0")
    return c.select(F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("handle"), F.col("c_custkey").alias("asset_id"), (F.col("c_custkey") % 3 != 0).alias("elevated_optin"))


#: One cycle after the other, as a fuse that trips leaves room under later caps. A handle's first `own` rows of a cycle are sent, `total` so far in the window.
NOTIFIED = f"""{D40_SQL}, seen AS (SELECT *, dense_rank() OVER (PARTITION BY anchor ORDER BY i) AS n FROM l WHERE NOT winter),
en AS (SELECT * FROM (SELECT *, CASE WHEN lag(n) OVER w = n - 1 THEN lag(tier) OVER w ELSE 0 END AS was FROM seen WINDOW w AS (PARTITION BY anchor, asset_id ORDER BY i)) WHERE tier >= 1 AND tier > was),
wanted AS (SELECT en.*, c_mktsegment || '-' || c_nationkey AS handle, tier <> 2 AND ((now - 5) % 24 >= 22 OR (now - 5) % 24 < 7) AS quiet FROM en JOIN customer ON c_custkey = asset_id WHERE tier = 2 OR c_custkey % 3 <> 0),
loud AS MATERIALIZED (SELECT now, anchor, handle, asset_id, dense_rank() OVER (ORDER BY i) AS step, row_number() OVER (PARTITION BY i, handle ORDER BY asset_id) AS nth FROM wanted WHERE NOT quiet),
turns AS (
  SELECT 0::BIGINT AS step, NULL::BIGINT AS anchor, NULL::VARCHAR AS handle, 0::BIGINT AS own, 0::BIGINT AS total
  UNION ALL
  SELECT * FROM (
    WITH turn AS (SELECT DISTINCT loud.step, loud.anchor FROM loud WHERE loud.step = (SELECT max(step) + 1 FROM turns)),
    kept AS (SELECT handle, total FROM turns WHERE anchor = (SELECT anchor FROM turn)),
    asks AS (SELECT handle, nth <= {HANDLE_CAP} - coalesce(total, 0) AS passes, asset_id FROM loud JOIN turn USING (step) LEFT JOIN kept USING (handle)),
    placed AS (SELECT handle, passes AND sum(passes::INT) OVER (ORDER BY asset_id, handle) <= {CYCLE_FUSE} AS goes FROM asks),
    told AS (SELECT handle, count(*) FILTER (WHERE goes) AS own FROM placed GROUP BY handle)
    SELECT step, anchor, handle, coalesce(own, 0) AS own, coalesce(own, 0) + coalesce(total, 0) AS total FROM turn, told FULL JOIN kept USING (handle)
  )
), caps AS (
  SELECT wanted.*, CASE WHEN quiet THEN 'quiet' WHEN nth <= own THEN NULL WHEN total >= {HANDLE_CAP} THEN 'handle_cap' ELSE 'cycle_fuse' END AS dropped
  FROM wanted LEFT JOIN loud USING (now, handle, asset_id) LEFT JOIN turns USING (step, handle)
)"""


@query("d46_notification_decisions", f"WITH RECURSIVE {NOTIFIED} SELECT now * 3600 + {DAY0} AS now, handle, asset_id, kind, tier, dropped FROM caps")
def d46_decisions(spark, sf):
    out = detector.detector_cycles(storm(spark, sf), cycles(spark), units(spark, sf), MODELS).withColumn("silent", F.col("suppressed"))
    out = out.select("now", "anchor", "asset_id", "kind", "tier", "silent")
    return notify.decisions(notify.tier_entries(out), subscribers(spark, sf)).select("now", "handle", "asset_id", "kind", "tier", "dropped")
