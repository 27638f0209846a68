"""W: window operators on pings, rain and the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormline.catalog.roles import PINGS, RAIN, pings, rain
from stormline.operators import windows as w
from stormline.registry import query, table


@query("w1_latest_by", f"""
WITH {PINGS} SELECT vehicle_id, ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id, ts ORDER BY fetched_at DESC, event_id) AS r FROM pings) WHERE r = 1""")
def w1(spark, sf):
    return w.latest_by(pings(spark, sf), ["vehicle_id", "ts"], [F.desc("fetched_at")]).select("vehicle_id", "ts", "event_id")


@query("w2_next_in_run", f"""
WITH {PINGS} SELECT event_id, lead(ts) OVER o AS ts_next, lead(stop_id) OVER o AS stop_id_next FROM pings
WINDOW o AS (PARTITION BY vehicle_id, trip_id ORDER BY ts, event_id)""")
def w2(spark, sf):
    return w.with_next(pings(spark, sf), ["vehicle_id", "trip_id"], ["ts", "event_id"], ["ts", "stop_id"]).select("event_id", "ts_next", "stop_id_next")


@query("w3_run_islands", f"""
WITH {PINGS}, m AS (SELECT *, CASE WHEN trip_id IS NOT DISTINCT FROM lag(trip_id) OVER o AND row_number() OVER o > 1 THEN 0 ELSE 1 END AS new_run
  FROM pings WINDOW o AS (PARTITION BY vehicle_id ORDER BY ts, event_id))
SELECT event_id, (sum(new_run) OVER (PARTITION BY vehicle_id ORDER BY ts, event_id))::BIGINT AS run_id FROM m""")
def w3(spark, sf):
    return w.with_runs(pings(spark, sf), ["vehicle_id"], ["ts", "event_id"], ["trip_id"]).select("event_id", "run_id")


@query("w4_flip_counts", f"""
WITH {PINGS}, n AS (SELECT *, lead(stop_id) OVER (PARTITION BY vehicle_id, trip_id ORDER BY ts, event_id) AS nxt FROM pings),
f AS (SELECT *, CASE WHEN stop_id IS DISTINCT FROM nxt THEN 1 ELSE 0 END AS flip FROM n)
SELECT event_id, (sum(flip) OVER (PARTITION BY vehicle_id, trip_id ORDER BY ts, event_id))::BIGINT AS flips_so_far,
       (sum(flip) OVER (PARTITION BY vehicle_id, trip_id))::BIGINT AS flips_total FROM f""")
def w4(spark, sf):
    keys, order = ["vehicle_id", "trip_id"], ["ts", "event_id"]
    p = w.with_next(pings(spark, sf), keys, order, ["stop_id"])
    return w.with_flips(p, keys, order, ~F.col("stop_id").eqNullSafe(F.col("stop_id_next"))).select("event_id", "flips_so_far", "flips_total")


@query("w5_previous_other", f"""
WITH {PINGS}, a AS (SELECT event_id, stop_id, direction_id, vehicle_id, trip_id, ts FROM pings)
SELECT x.event_id, max(y.ts) AS prev_other FROM a x LEFT JOIN a y
  ON x.stop_id = y.stop_id AND x.direction_id = y.direction_id AND y.ts < x.ts AND y.vehicle_id <> x.vehicle_id AND y.trip_id <> x.trip_id
GROUP BY x.event_id""")
def w5(spark, sf):
    a = pings(spark, sf).select("event_id", "stop_id", "direction_id", "vehicle_id", "trip_id", "ts")
    return w.previous_other(a, ["stop_id", "direction_id"], "ts", ["vehicle_id", "trip_id"], "prev_other").select("event_id", "prev_other")


@query("w6_monotone_envelope", """
WITH e AS (SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS envelope FROM events)
SELECT event_id, envelope, lag(envelope) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS envelope_before FROM e""")
def w6(spark, sf):
    return w.with_envelope(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "value").select("event_id", "envelope", "envelope_before")


@query("w7_trailing_frames", f"""
WITH {RAIN} SELECT cell, h,
  round(CASE WHEN count(mm) OVER w3 = 3 THEN sum(mm) OVER w3 END, 4) AS mm_3, round(CASE WHEN count(mm) OVER w6 = 6 THEN sum(mm) OVER w6 END, 4) AS mm_6,
  round(CASE WHEN count(mm) OVER w24 = 24 THEN sum(mm) OVER w24 END, 4) AS mm_24, count(mm) OVER w24 AS n_24 FROM rain
WINDOW w3 AS (PARTITION BY cell ORDER BY h ROWS 2 PRECEDING), w6 AS (PARTITION BY cell ORDER BY h ROWS 5 PRECEDING), w24 AS (PARTITION BY cell ORDER BY h ROWS 23 PRECEDING)""")
def w7(spark, sf):
    r = w.with_trailing(rain(spark, sf), ["cell"], "h", "mm", [3, 6, 24])
    return r.select("cell", "h", *[F.round(c, 4).alias(c) for c in ("mm_3", "mm_6", "mm_24")], "n_24")


@query("w8_hours_since_wet", f"""
WITH {RAIN}, x AS (SELECT cell, h, max(CASE WHEN mm >= 1.0 THEN h END) OVER o AS last_hit, max(CASE WHEN mm >= 1.0 THEN mm END) OVER o AS deepest FROM rain
WINDOW o AS (PARTITION BY cell ORDER BY h ROWS 48 PRECEDING))
SELECT x.cell, x.h, x.last_hit, x.h - x.last_hit AS since_hit, r.mm AS depth_at_hit FROM x LEFT JOIN rain r ON r.cell = x.cell AND r.h = x.last_hit""")
def w8(spark, sf):
    from pyspark.sql import Window

    wet = F.col("mm") >= 1.0
    r = w.with_rows_since(rain(spark, sf), ["cell"], "h", wet, 48)
    back = Window.partitionBy("cell").orderBy("h").rowsBetween(-48, 0)
    return r.select("cell", "h", "last_hit", "since_hit", F.max_by("mm", F.when(wet, F.col("h"))).over(back).alias("depth_at_hit"))


@query("w9_gap_sessions", """
WITH e AS (SELECT event_id, user_id, floor(epoch(ts))::BIGINT AS s FROM events),
m AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s) <= 25200 THEN 0 ELSE 1 END AS new FROM e)
SELECT user_id, session, min(s) AS first_s, max(s) AS last_s, count(*) AS n FROM (
  SELECT *, (sum(new) OVER (PARTITION BY user_id ORDER BY s))::BIGINT AS session FROM m) GROUP BY user_id, session""")
def w9(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("s"))
    return w.with_sessions(e, ["user_id"], "s", 7 * 3600).groupBy("user_id", "session").agg(
        F.min("s").alias("first_s"), F.max("s").alias("last_s"), F.count("*").alias("n"))


@query("w10_day_runs", """
WITH d AS (SELECT DISTINCT o_custkey, o_orderdate::DATE AS day FROM orders),
i AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY day) AS INTEGER) AS island FROM d)
SELECT o_custkey, min(day) AS first_day, max(day) AS last_day, count(*) AS n_days FROM i GROUP BY o_custkey, island""")
def w10(spark, sf):
    return w.day_runs(table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day")), "day", ["o_custkey"])


@query("w11_exceedance_runs", f"""
WITH {RAIN}, x AS (SELECT cell, h, h - row_number() OVER (PARTITION BY cell ORDER BY h) AS island FROM rain WHERE mm >= 0.8)
SELECT cell, min(h) AS "first", max(h) AS "last", count(*) AS n FROM x GROUP BY cell, island HAVING count(*) >= 2""")
def w11(spark, sf):
    return w.consecutive_hits(rain(spark, sf), ["cell"], "h", 1, F.col("mm") >= 0.8, 2)


@query("w12_segment_deltas", f"""
WITH {PINGS} SELECT event_id, ts - lag(ts) OVER o AS actual_s, seq * 80 - lag(seq * 80) OVER o AS planned_s,
  (ts - lag(ts) OVER o) - (seq * 80 - lag(seq * 80) OVER o) AS excess_s FROM pings WHERE trip_id IS NOT NULL
WINDOW o AS (PARTITION BY vehicle_id, trip_id ORDER BY seq)""")
def w12(spark, sf):
    from stormline.plans.passages import segment_deltas

    p = pings(spark, sf).where("trip_id IS NOT NULL").withColumn("arrival_s", F.col("seq") * 80)
    return segment_deltas(p, ["vehicle_id", "trip_id"], "seq", "ts", "arrival_s").select("event_id", "actual_s", "planned_s", "excess_s")


@query("w13_scheduled_headway", f"""
WITH {PINGS} SELECT event_id, seq * 80 - lag(seq * 80) OVER (PARTITION BY route_id, direction_id, stop_id ORDER BY seq, event_id) AS headway_s FROM pings""")
def w13(spark, sf):
    from stormline.plans.passages import scheduled_headway

    p = pings(spark, sf).withColumn("arrival_s", F.col("seq") * 80)
    return scheduled_headway(p, ["route_id", "direction_id", "stop_id"], ["arrival_s", "event_id"], "arrival_s").select("event_id", "headway_s")


@query("w14_prediction_changes", """
WITH c AS (SELECT user_id, event_type, CASE WHEN value <> lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) THEN 1 ELSE 0 END AS changed FROM events)
SELECT user_id, event_type, sum(changed)::BIGINT AS n_changes FROM c GROUP BY ALL""")
def w14(spark, sf):
    from stormline.plans.passages import change_counts

    return change_counts(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"], "value")


@query("w15_cume_dist", """
SELECT c_custkey, round(cume_dist() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal), 9) AS rank_index FROM customer""")
def w15(spark, sf):
    from pyspark.sql import Window

    return table(spark, sf, "customer").select(
        "c_custkey", F.round(F.cume_dist().over(Window.partitionBy("c_mktsegment").orderBy("c_acctbal")), 9).alias("rank_index"))


@query("w16_top_share_tiers", """
WITH s AS (SELECT c_custkey, cume_dist() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS top_share FROM customer)
SELECT c_custkey, round(top_share, 9) AS top_share, CASE WHEN top_share <= 0.02 THEN 'severe' WHEN top_share <= 0.1 THEN 'high' WHEN top_share <= 0.25 THEN 'raised' END AS tier FROM s""")
def w16(spark, sf):
    cuts = [("severe", 0.02), ("high", 0.1), ("raised", 0.25)]
    return w.top_tiers(table(spark, sf, "customer"), ["c_nationkey"], "c_acctbal", cuts).select("c_custkey", F.round("top_share", 9).alias("top_share"), "tier")


@query("w17_latched_level", f"""
WITH {RAIN}, l AS (SELECT cell, h, h // 24 AS wid, CASE WHEN mm >= 2 THEN 2 WHEN mm >= 1 THEN 1 ELSE 0 END AS level FROM rain)
SELECT cell, h, max(level) OVER (PARTITION BY cell, wid ORDER BY h) AS latched FROM l""")
def w17(spark, sf):
    r = rain(spark, sf).select("cell", "h", F.expr("h div 24").alias("wid"), F.expr("CASE WHEN mm >= 2 THEN 2 WHEN mm >= 1 THEN 1 ELSE 0 END").alias("level"))
    return w.with_latch(r, ["cell", "wid"], ["h"], "level").select("cell", "h", "latched")


@query("w18_downward_revisions", """
WITH v AS (SELECT o_custkey, o_orderkey, o_totalprice, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS was FROM orders)
SELECT o_orderkey, was, o_totalprice AS now, round(was - o_totalprice, 2) AS cut FROM v WHERE was > o_totalprice""")
def w18(spark, sf):
    from stormline.plans.detector import downward_revisions

    return downward_revisions(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice").select(
        "o_orderkey", "was", F.col("o_totalprice").alias("now"), F.round("cut", 2).alias("cut"))


@query("w19_dry_run_hours", f"""
WITH {RAIN}, g AS (SELECT h, count(*) FILTER (WHERE mm >= 1.0) AS wet FROM rain GROUP BY h),
x AS (SELECT h, max(CASE WHEN wet >= 3 THEN h END) OVER (ORDER BY h) AS last_wet FROM g)
SELECT h, last_wet, h - last_wet AS dry_hours FROM x""")
def w19(spark, sf):
    from stormline.plans.detector import dry_run_hours

    return dry_run_hours(rain(spark, sf), "h", F.col("mm") >= 1.0, 3)


@query("w20_overlap_merge", """
WITH s AS (SELECT o_custkey, epoch(o_orderdate)::BIGINT // 86400 AS a, epoch(o_orderdate)::BIGINT // 86400 + o_orderkey % 60 AS b FROM orders),
m AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY o_custkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM s),
c AS (SELECT *, sum(new) OVER (PARTITION BY o_custkey ORDER BY a, b) AS span FROM m)
SELECT o_custkey, min(a) AS "first", max(b) AS "last", count(*) AS n FROM c GROUP BY o_custkey, span""")
def w20(spark, sf):
    day = F.expr("unix_timestamp(CAST(o_orderdate AS TIMESTAMP)) div 86400")
    s = table(spark, sf, "orders").select("o_custkey", day.alias("a"), (day + F.col("o_orderkey") % 60).alias("b"))
    return w.merged_spans(s, ["o_custkey"], "a", "b")


@query("w21_revision_rank", """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS revision FROM orders""")
def w21(spark, sf):
    from pyspark.sql import Window

    o = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", (F.row_number().over(o) - 1).cast("long").alias("revision"))


@query("w22_trailing_run_above", f"""
WITH {RAIN}, x AS (SELECT cell, h, mm, max(CASE WHEN coalesce(mm, 0) < 0.4 THEN h END) OVER (PARTITION BY cell) AS last_below, max(h) OVER (PARTITION BY cell) AS last_h FROM rain)
SELECT cell, count(*) FILTER (WHERE h > coalesce(last_below, -1)) AS run_length, min(h) FILTER (WHERE h > coalesce(last_below, -1)) AS onset FROM x GROUP BY cell""")
def w22(spark, sf):
    from stormline.plans.sensors import trailing_runs

    return trailing_runs(rain(spark, sf), ["cell"], "h", F.coalesce("mm", F.lit(0.0)) >= 0.4)


@query("w23_cumulative_max_null_kept", f"""
WITH {RAIN} SELECT cell, h, CASE WHEN mm IS NOT NULL THEN max(mm) OVER (PARTITION BY cell ORDER BY h) END AS mm_max FROM rain""")
def w23(spark, sf):
    from stormline.plans.schedule import cumulative_max

    return cumulative_max(rain(spark, sf), ["cell"], "h", "mm", "mm_max").select("cell", "h", "mm_max")


@query("w25_sustained_hours", f"""
WITH {RAIN}, x AS (SELECT cell, h, h - row_number() OVER (PARTITION BY cell ORDER BY h) AS island FROM rain WHERE mm >= 0.4)
SELECT DISTINCT cell FROM x GROUP BY cell, island HAVING count(*) >= 3""")
def w25(spark, sf):
    return w.consecutive_hits(rain(spark, sf), ["cell"], "h", 1, F.col("mm") >= 0.4, 3).select("cell").distinct()


@query("w26_gap_across_midnight", f"""
WITH {PINGS}, g AS (SELECT event_id, ts, ts - lag(ts) OVER (PARTITION BY stop_id ORDER BY ts, event_id) AS gap_s FROM pings)
SELECT event_id, gap_s FROM g WHERE ts >= 1704067200 + 21600""")
def w26(spark, sf):
    from stormline.plans.impact import gaps_at_place

    return gaps_at_place(pings(spark, sf), ["stop_id"], ["ts", "event_id"], "ts").where(F.col("ts") >= 1704067200 + 21600).select("event_id", "gap_s")
