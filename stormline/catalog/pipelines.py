"""D: the domain pipelines on the roles that the driver's tables play."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormline.catalog.joins import CROSSWALK, crosswalk, distance_sql, pixels
from stormline.catalog.roles import PINGS, PLACES, RAIN, SPOTS, pings, places, rain, spots
from stormline.operators import aggregates as a
from stormline.plans import legs as lg
from stormline.registry import query, table

CLASS = "CASE WHEN starts_with(upper(route_id), 'X') OR starts_with(upper(route_id), 'BM') OR starts_with(upper(route_id), 'QM') OR starts_with(upper(route_id), 'BXM') OR starts_with(upper(route_id), 'SIM') THEN 'express' WHEN ends_with(route_id, '+') THEN 'sbs' ELSE 'local' END"

LEGS = f"""{PINGS},
l0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id, ts ORDER BY fetched_at, direction_id, event_id) AS rk FROM pings) WHERE rk = 1),
l1 AS (SELECT *, CASE WHEN trip_id IS NOT DISTINCT FROM lag(trip_id) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new_run FROM l0 WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts)),
l2 AS (SELECT *, sum(new_run) OVER (PARTITION BY vehicle_id ORDER BY ts) AS run FROM l1),
l3 AS (SELECT *, lead(ts) OVER w AS ts1, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2, lead(stop_id) OVER w AS stop1, lat AS lat1, lon AS lon1 FROM l2 WHERE trip_id IS NOT NULL WINDOW w AS (PARTITION BY vehicle_id, run ORDER BY ts)),
l4 AS (SELECT *, ts1 - ts AS dt_s, CASE WHEN stop_id IS DISTINCT FROM stop1 THEN 1 ELSE 0 END AS flip FROM l3 WHERE ts1 IS NOT NULL),
l5 AS (SELECT *, sum(flip) OVER (PARTITION BY vehicle_id, run ORDER BY ts) AS so_far, sum(flip) OVER (PARTITION BY vehicle_id, run) AS total FROM l4), {distance_sql('l5', 'ld')},
legs AS (SELECT vehicle_id, trip_id, route_id, {CLASS} AS route_class, dist_m, dt_s, (ceil((ts + ts1) / 2.0 / 3600) * 3600)::BIGINT AS hour_end_s,
  CASE WHEN dt_s > 300 THEN 'dark' WHEN dist_m < 25 AND (so_far = 0 OR (flip = 0 AND so_far = total)) THEN 'terminal' END AS dropped FROM ld WHERE NOT (dt_s <= 300 AND dist_m > dt_s * 30.0))"""


@query("d1_legs", f"WITH {LEGS} SELECT vehicle_id, trip_id, route_class, hour_end_s, dropped, count(*) AS n, round(sum(dist_m), 2) AS dist_m, sum(dt_s)::BIGINT AS dt_s FROM legs GROUP BY ALL")
def d1(spark, sf):
    return lg.legs(pings(spark, sf)).groupBy("vehicle_id", "trip_id", "route_class", "hour_end_s", "dropped").agg(
        F.count("*").alias("n"), F.round(F.sum("dist_m"), 2).alias("dist_m"), F.sum("dt_s").alias("dt_s"))


@query("d2_leg_hours", f"""
WITH {LEGS} SELECT hour_end_s, route_id, route_class, count(*) FILTER (WHERE dropped IS NULL) AS n_legs, round(sum(dist_m) FILTER (WHERE dropped IS NULL), 2) AS dist_m_sum, (sum(dt_s) FILTER (WHERE dropped IS NULL))::BIGINT AS dt_s_sum,
  count(*) FILTER (WHERE dropped = 'terminal') AS n_terminal, count(*) FILTER (WHERE dropped = 'dark') AS n_dark FROM legs GROUP BY ALL""")
def d2(spark, sf):
    r = lg.leg_hours(pings(spark, sf)).groupBy("hour_end_s", "route_id", "route_class")
    return r.agg(F.sum("n_legs").alias("n_legs"), F.round(F.sum("dist_m_sum"), 2).alias("dist_m_sum"), F.sum("dt_s_sum").alias("dt_s_sum"), F.sum("n_terminal").alias("n_terminal"), F.sum("n_dark").alias("n_dark"))


SCHED = """sched AS (SELECT DISTINCT trip_id, stop_id, CAST(substr(stop_id, 2) AS INTEGER) AS stop_sequence, CASE WHEN CAST(substr(stop_id, 2) AS INTEGER) % 7 <> 3 THEN CAST(substr(stop_id, 2) AS INTEGER) * 100.0 + CAST(substr(stop_id, 2) AS INTEGER) % 5 END AS dist FROM pings WHERE trip_id IS NOT NULL)"""


def sched(spark, sf):
    p = pings(spark, sf).where("trip_id IS NOT NULL").select("trip_id", "stop_id").distinct()
    n = F.expr("CAST(substr(stop_id, 2) AS INT)")
    return p.withColumn("stop_sequence", n).withColumn("dist", F.expr("CASE WHEN stop_sequence % 7 <> 3 THEN CAST(stop_sequence * 100 + stop_sequence % 5 AS DOUBLE) END"))


@query("d3_passages_matched", f"""
WITH {PINGS}, {SCHED}, m AS (SELECT p.*, s.stop_sequence AS sq FROM pings p LEFT JOIN sched s USING (trip_id, stop_id)),
e AS (SELECT *, max(sq) OVER (PARTITION BY vehicle_id, trip_id, start_date ORDER BY ts, fetched_at, stop_id) AS env FROM m),
g AS (SELECT *, lag(env) OVER w AS env0, lag(ts) OVER w AS ts0 FROM e WINDOW w AS (PARTITION BY vehicle_id, trip_id, start_date ORDER BY ts, fetched_at, stop_id)),
x AS (SELECT vehicle_id, trip_id, env0, env, ts, (ts0 + ts) / 2.0 AS mid, unnest(range(env0, env)) AS k FROM g WHERE env > env0),
y AS (SELECT x.*, s.dist AS dk, s.stop_sequence AS known, a.dist AS d0, b.dist AS d1 FROM x LEFT JOIN sched s ON s.trip_id = x.trip_id AND s.stop_sequence = k LEFT JOIN sched a ON a.trip_id = x.trip_id AND a.stop_sequence = env0 LEFT JOIN sched b ON b.trip_id = x.trip_id AND b.stop_sequence = env)
SELECT vehicle_id, trip_id, k::INTEGER AS stop_sequence, CASE WHEN k = env0 THEN mid::DOUBLE ELSE round(mid + CASE WHEN dk > d0 AND dk < d1 THEN (dk - d0) / (d1 - d0) ELSE (k - env0) / (env - env0)::DOUBLE END * (ts - mid), 3)::DOUBLE END AS arr, k > env0 AS interpolated
FROM y WHERE k = env0 OR known IS NOT NULL""")
def d3(spark, sf):
    from stormline.plans.passages import matched

    return matched(pings(spark, sf), sched(spark, sf)).select("vehicle_id", "trip_id", F.col("stop_sequence").cast("int").alias("stop_sequence"), "arr", "interpolated")


@query("d4_passages_observed", f"""
WITH {PINGS}, o AS (SELECT *, lag(stop_id) OVER w AS passed, lag(ts) OVER w AS ts0 FROM pings WHERE trip_id IS NOT NULL WINDOW w AS (PARTITION BY vehicle_id, trip_id, start_date ORDER BY ts, fetched_at, stop_id)),
f AS (SELECT *, row_number() OVER (PARTITION BY vehicle_id, trip_id, start_date, passed ORDER BY ts0) AS r FROM o WHERE passed <> stop_id)
SELECT vehicle_id, trip_id, passed AS stop_id, row_number() OVER (PARTITION BY vehicle_id, trip_id, start_date ORDER BY ts0)::INTEGER AS stop_sequence, ((ts0 + ts) / 2.0)::DOUBLE AS arr FROM f WHERE r = 1""")
def d4(spark, sf):
    from stormline.plans.passages import observed

    return observed(pings(spark, sf)).select("vehicle_id", "trip_id", "stop_id", F.col("stop_sequence").cast("int").alias("stop_sequence"), "arr")


@query("d7_headway_family", f"""
WITH {PINGS}, h AS (SELECT route_id, direction_id, seq // 43 AS hour, seq * 80 - lag(seq * 80) OVER (PARTITION BY route_id, direction_id, stop_id ORDER BY seq, event_id) AS headway_s FROM pings)
SELECT route_id, direction_id, hour, median(headway_s) AS median_s, CASE WHEN median(headway_s) <= 60 THEN 'headway' ELSE 'schedule' END AS family FROM h GROUP BY ALL""")
def d7(spark, sf):
    from stormline.plans.passages import scheduled_headway
    from stormline.plans.schedule import headway_family

    p = pings(spark, sf).withColumn("arrival_s", F.col("seq") * 80).withColumn("hour", F.expr("seq div 43"))
    return headway_family(scheduled_headway(p, ["route_id", "direction_id", "stop_id"], ["arrival_s", "event_id"], "arrival_s"), ["route_id", "direction_id", "hour"], "headway_s", 60)


@query("d8_service_days", """
WITH c AS (SELECT n_nationkey AS service_id, DATE '2024-01-01' + n_nationkey AS a, DATE '2024-01-01' + n_nationkey + 27 AS b FROM nation),
s AS (SELECT service_id, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM c),
x AS (SELECT DISTINCT (o_orderkey % 25)::INTEGER AS service_id, DATE '2024-01-01' + (o_orderkey % 50)::INTEGER AS d, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS kind FROM orders)
SELECT service_id, d AS service_date FROM (SELECT service_id, d FROM s WHERE isodow(d) <= 5 OR service_id % 2 = 0 UNION SELECT service_id, d FROM x WHERE kind = 1) t WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.kind = 2 AND x.service_id = t.service_id AND x.d = t.d)""")
def d8(spark, sf):
    from stormline.plans.schedule import WEEKDAYS, service_days

    start = F.expr("date_add(DATE '2024-01-01', n_nationkey)")
    weekend = (F.col("n_nationkey") % 2 == 0).cast("int")
    cal = table(spark, sf, "nation").select(F.col("n_nationkey").alias("service_id"), start.alias("start_date"), F.date_add(start, 27).alias("end_date"), *[(weekend if d in ("saturday", "sunday") else F.lit(1)).alias(d) for d in WEEKDAYS])
    ex = table(spark, sf, "orders").select(F.expr("CAST(o_orderkey % 25 AS INT)").alias("service_id"), F.expr("date_add(DATE '2024-01-01', CAST(o_orderkey % 50 AS INT))").alias("date"), F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END").alias("exception_type"))
    return service_days(cal, ex)


@query("d9_prediction_agreement", """
WITH p AS (SELECT o_orderkey AS k, o_custkey AS arr FROM orders), q AS (SELECT o_orderkey AS k, o_custkey + o_orderkey % 90 AS pred FROM orders WHERE o_orderkey % 4 <> 0)
SELECT count(*) AS n, count(pred) AS n_predicted, count(*) FILTER (WHERE abs(pred - arr) <= 30) AS n_met FROM p LEFT JOIN q USING (k)""")
def d9(spark, sf):
    from stormline.plans.gold import agreement

    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "k")
    pred = o.where("k % 4 <> 0").select("k", (F.col("o_custkey") + F.col("k") % 90).alias("pred"))
    return agreement(pred, o.select("k", F.col("o_custkey").alias("arr")), ["k"], 30)


@query("d10_cell_hour_speed", f"""
WITH {LEGS} SELECT hour_end_s, route_class, count(*) AS n_legs, round(sum(dist_m) / sum(dt_s), 6) AS speed_mps FROM legs WHERE dropped IS NULL GROUP BY ALL""")
def d10(spark, sf):
    from stormline.plans.gold import cell_hour_speed

    s = cell_hour_speed(lg.leg_hours(pings(spark, sf))).where("n_legs > 0")
    return s.groupBy("hour_end_s", "route_class").agg(F.sum("n_legs").alias("n_legs"), F.round(F.sum("dist_m_sum") / F.sum("dt_s_sum"), 6).alias("speed_mps"))


@query("d11_cell_hour_route", """
WITH x AS (SELECT l_suppkey, l_returnflag, CASE WHEN l_linenumber <> 3 THEN l_quantity * 20 - 300 END AS delay_s, l_quantity AS headway_s, 20.0 + l_linenumber AS sched_s FROM lineitem)
SELECT l_suppkey, l_returnflag, count(*) AS n, round(avg((delay_s > 300)::INT), 9) AS late_share, round(avg((delay_s < -60)::INT), 9) AS early_share, round(sum(headway_s * headway_s) / (2 * sum(headway_s)) - sum(sched_s * sched_s) / (2 * sum(sched_s)), 6) AS excess_wait_s, round(avg((headway_s <= sched_s / 4)::INT), 9) AS bunched_share, count(delay_s) AS n_known FROM x GROUP BY ALL""")
def d11(spark, sf):
    from stormline.plans.gold import cell_hour_route

    p = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", F.expr("CASE WHEN l_linenumber <> 3 THEN l_quantity * 20 - 300 END").alias("delay_s"), F.col("l_quantity").alias("headway_s"), (F.lit(20.0) + F.col("l_linenumber")).alias("headway_sched_s"))
    r = cell_hour_route(p, ["l_suppkey", "l_returnflag"])
    return r.select("l_suppkey", "l_returnflag", "n", *[F.round(c, 9).alias(c) for c in ("late_share", "early_share")], F.round("excess_wait_s", 6).alias("excess_wait_s"), F.round("bunched_share", 9).alias("bunched_share"), "n_known")


@query("d12_hour_of_week_norm", f"""
WITH {RAIN}, s AS (SELECT (l_suppkey % 25)::INTEGER AS cell, l_orderkey % 240 AS h, count(*) AS n, sum(l_extendedprice) AS d, sum(l_quantity) AS t FROM lineitem GROUP BY ALL)
SELECT cell, h % 24 AS how, round(sum(d) / sum(t), 6) AS norm, count(DISTINCT h) AS n_hours, sum(n)::BIGINT AS n_legs FROM s JOIN rain USING (cell, h) WHERE coalesce(mm, 0) < 0.5 GROUP BY ALL""")
def d12(spark, sf):
    from stormline.plans.gold import hour_of_week_norm

    s = table(spark, sf, "lineitem").groupBy(F.expr("CAST(l_suppkey % 25 AS INT)").alias("cell"), (F.col("l_orderkey") % 240).alias("hour_end_s")).agg(
        F.count("*").alias("n_legs"), F.sum("l_extendedprice").alias("dist_m_sum"), F.sum("l_quantity").alias("dt_s_sum"))
    r = rain(spark, sf).withColumnRenamed("h", "hour_end_s")
    out = hour_of_week_norm(s.withColumn("how", F.col("hour_end_s") % 24), r, F.coalesce("mm", F.lit(0.0)) < 0.5, ["cell", "how"])
    return out.select("cell", "how", F.round("norm", 6).alias("norm"), "n_hours", "n_legs")


@query("d14_dense_cell_rain", f"""
WITH {RAIN}, {CROSSWALK}, g AS (SELECT cell, h, sum(weight) AS got, sum(mm * weight) AS s FROM px JOIN cw USING (i, j) GROUP BY ALL), m AS (SELECT cell, h, CASE WHEN got >= 1 - 1e-6 THEN s / got END AS mm FROM g),
d AS (SELECT n.cell, n.h, m.mm FROM (SELECT DISTINCT cw.cell, h.h FROM cw, (SELECT unnest(range(0, 240)) AS h) h) n LEFT JOIN m ON m.cell = n.cell AND m.h = n.h)
SELECT cell, h, round(mm, 6) AS mm, round(CASE WHEN count(mm) OVER w3 = 3 THEN sum(mm) OVER w3 END, 4) AS mm_3, count(mm) OVER w24 AS n_24 FROM d WINDOW w3 AS (PARTITION BY cell ORDER BY h ROWS 2 PRECEDING), w24 AS (PARTITION BY cell ORDER BY h ROWS 23 PRECEDING)""")
def d14(spark, sf):
    from stormline.plans.rainfall import cell_hourly

    r = cell_hourly(pixels(spark, sf), crosswalk(spark, sf), 0, 239)
    return r.select("cell", "h", F.round("mm", 6).alias("mm"), F.round("mm_3", 4).alias("mm_3"), "n_24")


@query("d15_live_cell_rain", f"""
WITH {RAIN}, {CROSSWALK}, l AS (SELECT i, j, h, mm FROM px WHERE h = (SELECT max(h) FROM px)), g AS (SELECT cell, h, sum(weight) AS got, sum(mm * weight) AS s FROM l JOIN cw USING (i, j) GROUP BY ALL)
SELECT cell, h, round(CASE WHEN got >= 1 - 1e-6 THEN s / got END, 6) AS mm FROM g""")
def d15(spark, sf):
    from stormline.plans.rainfall import live_cells

    p = pixels(spark, sf)
    twice = p.withColumn("fetched_at", F.lit(2)).unionByName(p.withColumn("mm", F.col("mm") * 3).withColumn("fetched_at", F.lit(1)))
    return live_cells(twice, crosswalk(spark, sf)).select("cell", "h", F.round("mm", 6).alias("mm"))


CONTRAST = """x AS (SELECT l_suppkey, l_returnflag, l_orderkey % 97 AS storm, l_extendedprice AS d, l_quantity AS t FROM lineitem),
n AS (SELECT l_suppkey, sum(d) / sum(t) AS norm FROM x WHERE l_returnflag <> 'R' GROUP BY l_suppkey),
o AS (SELECT x.*, d / t / norm AS r, (l_suppkey % 5)::INTEGER AS zone FROM x JOIN n USING (l_suppkey) WHERE l_returnflag = 'R')"""


def contrast(spark, sf, by):
    from stormline.plans.contrast import dry_norm, wet_contrast

    x = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", (F.col("l_orderkey") % 97).alias("storm"), F.col("l_extendedprice").alias("d"), F.col("l_quantity").alias("t"), F.expr("CAST(l_suppkey % 5 AS INT)").alias("zone"))
    is_wet = F.col("l_returnflag") == "R"
    norms = dry_norm(x, ["l_suppkey"], ~is_wet, "d", "t")
    r = wet_contrast(x, norms, ["l_suppkey"], by, is_wet, "d", "t", "storm")
    return r.select(*by, F.round("mean", 8).alias("mean"), "n_clusters", F.round("se", 8).alias("se"))


def contrast_sql(by: str) -> str:
    return f"""WITH {CONTRAST}, b AS (SELECT {by}, storm, sum(r * t) AS sv, sum(t) AS sw FROM o GROUP BY ALL), t AS (SELECT {by}, sum(sv) / sum(sw) AS mean, sum(sw) AS w, count(*) AS g FROM b GROUP BY ALL)
SELECT {by}, round(mean, 8) AS mean, g AS n_clusters, round(sqrt(sum((sv - mean * sw) ** 2) * g / (g - 1)) / w, 8) AS se FROM b JOIN t USING ({by}) GROUP BY {by}, mean, w, g"""


@query("d16_wet_contrast", contrast_sql("zone"))
def d16(spark, sf):
    return contrast(spark, sf, ["zone"])


@query("d17_route_contrast", contrast_sql("l_suppkey"))
def d17(spark, sf):
    return contrast(spark, sf, ["l_suppkey"])


@query("d18_schedule_versions", """
WITH v AS (SELECT o_orderkey AS version, 'C' || (o_orderkey % 5) AS code, o_orderdate::DATE AS published, o_orderdate::DATE AS valid_from, o_orderdate::DATE + 60 AS valid_to FROM orders),
d AS (SELECT DISTINCT 'C' || (l_orderkey % 6) AS code, l_shipdate::DATE AS day FROM lineitem)
SELECT code, day, version FROM (SELECT d.code, day, version, row_number() OVER (PARTITION BY d.code, day ORDER BY published DESC NULLS LAST, version) AS r FROM d LEFT JOIN v ON v.code = d.code AND published <= day + 1 AND day BETWEEN valid_from AND valid_to) WHERE r = 1""")
def d18(spark, sf):
    from stormline.plans.versions import resolved

    day = F.to_date("o_orderdate")
    v = table(spark, sf, "orders").select(F.col("o_orderkey").alias("version"), F.expr("concat('C', o_orderkey % 5)").alias("code"), day.alias("published"), day.alias("valid_from"), F.date_add(day, 60).alias("valid_to"))
    d = table(spark, sf, "lineitem").select(F.expr("concat('C', l_orderkey % 6)").alias("code"), F.to_date("l_shipdate").alias("day")).distinct()
    return resolved(d, v, "code", "day")


@query("d19_observation_union", f"""
WITH {SPOTS} SELECT source, count(*) AS n, count(depth_mm) AS n_depth, count(ts_s) AS n_ts FROM (
  SELECT 'sensor' AS source, depth AS depth_mm, NULL::BIGINT AS ts_s FROM spots UNION ALL SELECT 'call', NULL, epoch(ts)::BIGINT FROM events WHERE event_type = 'error' UNION ALL SELECT 'report', NULL, NULL FROM documents) GROUP BY source""")
def d19(spark, sf):
    from stormline.sources.archives import observation

    s = observation(spots(spark, sf), "sensor", source_id=F.col("spot_id"), lon=F.col("lon"), lat=F.col("lat"), depth_mm=F.col("depth"))
    e = observation(table(spark, sf, "events").where("event_type = 'error'"), "call", source_id=F.col("event_id"), ts_s=F.unix_timestamp(F.col("ts").cast("timestamp")))
    d = observation(table(spark, sf, "documents"), "report", source_id=F.col("doc_id"), text=F.col("text"))
    return s.unionByName(e).unionByName(d).groupBy("source").agg(F.count("*").alias("n"), F.count("depth_mm").alias("n_depth"), F.count("ts_s").alias("n_ts"))


@query("d21_event_spine", """
WITH c AS (SELECT ts::DATE AS day, count(*) FILTER (WHERE event_type = 'error') AS e, count(*) FILTER (WHERE value > 90) AS v, count(*) FILTER (WHERE event_type = 'click' AND value > 95) AS s FROM events GROUP BY ALL),
f AS (SELECT day, e >= (SELECT quantile_disc(e, 0.7) FROM c) AS rain, v >= (SELECT quantile_disc(v, 0.7) FROM c) AS tide, s >= (SELECT quantile_disc(s, 0.7) FROM c) AS snow FROM c), d AS (SELECT * FROM f WHERE rain OR tide OR snow),
i AS (SELECT *, day - row_number() OVER (ORDER BY day)::INTEGER AS island FROM d)
SELECT min(day) AS first_day, max(day) AS last_day, count(*) AS n_days, bool_or(rain) AS rain, bool_or(tide) AS tide, bool_or(snow) AS snow, strftime(min(day), '%Y%m%d') AS event_id,
  CASE WHEN bool_or(rain) AND bool_or(tide) THEN 'mixed' WHEN bool_or(tide) THEN 'coastal' WHEN bool_or(rain) AND bool_or(snow) THEN 'snowmelt' WHEN bool_or(rain) THEN 'pluvial' ELSE 'unclassified' END AS event_class FROM i GROUP BY island""")
def d21(spark, sf):
    from stormline.plans import spine

    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    c = e.groupBy("day").agg(a.count_if(F.col("event_type") == "error").alias("e"), a.count_if(F.col("value") > 90).alias("v"), a.count_if((F.col("event_type") == "click") & (F.col("value") > 95)).alias("s"))
    over = lambda col: spine.trigger_days(c.select("day", F.col(col).alias("n")), 0.7).select("day")
    return spine.events(spine.triggered({"rain": over("e"), "tide": over("v"), "snow": over("s")}), "rain", "tide", "snow")


@query("d22_label_attachment", f"""
WITH {SPOTS}, {PLACES}, x AS (SELECT spot_id, place_id, depth, s.zone AS z1, p.zone AS z2, s.lon AS lon1, s.lat AS lat1, p.lon AS lon2, p.lat AS lat2 FROM spots s JOIN places p ON abs(s.lat - p.lat) < 0.01 AND abs(s.lon - p.lon) < 0.02), {distance_sql('x')},
u AS (SELECT place_id, spot_id % 12 AS event, 1 AS bit, 'radius' AS support, depth FROM d WHERE dist_m <= 300 UNION ALL SELECT place_id, spot_id % 12, 2, 'zone', NULL FROM spots s JOIN places p ON s.zone = p.zone)
SELECT place_id, event, bit_or(bit)::INTEGER AS source_mix, array_to_string(list_sort(list_distinct(list(support))), ',') AS label_support, max(depth) AS depth FROM u GROUP BY ALL""")
def d22(spark, sf):
    from stormline.plans.labels import attached, in_radius, in_zone

    s, p = spots(spark, sf).withColumn("event", F.col("spot_id") % 12), places(spark, sf)
    by_radius = in_radius(s, p, ("lon", "lat"), 300.0, "place_id", "event", "depth").select("place_id", "event", F.lit(1).alias("source_bit"), F.lit("radius").alias("support"), "depth")
    by_zone = in_zone(s, p, "zone", "place_id", "event").select("place_id", "event", F.lit(2).alias("source_bit"), F.lit("zone").alias("support"), F.lit(None).cast("double").alias("depth"))
    return attached(by_radius.unionByName(by_zone), "place_id", "event").withColumn("label_support", F.array_join("label_support", ","))


@query("d23_negative_census", """
WITH p AS (SELECT c_custkey, m, c_acctbal, c_nationkey FROM customer, (SELECT unnest(range(1, 13)) AS m))
SELECT count(*) AS n, count(*) FILTER (WHERE c_acctbal <= 0) AS uncovered, count(*) FILTER (WHERE c_acctbal > 0 AND c_nationkey >= 20) AS outside, count(*) FILTER (WHERE c_acctbal > 0 AND c_nationkey < 20) AS kept FROM p""")
def d23(spark, sf):
    from stormline.plans.labels import drop_census

    months = spark.range(1, 13).withColumnRenamed("id", "m")  # twelve rows
    p = table(spark, sf, "customer").crossJoin(F.broadcast(months))
    return drop_census(p, [("uncovered", F.col("c_acctbal") <= 0), ("outside", F.col("c_nationkey") >= 20)])


FEATURES = """f AS (SELECT doc_id, quality AS y, source, ln(1 + n_chars) AS x1, CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END AS x2 FROM documents JOIN labels USING (doc_id))"""


def features(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return d.select("doc_id", F.col("quality").alias("y"), "source", F.log1p("n_chars").alias("x1"), F.expr("CASE WHEN lang = 'en' THEN 1.0D ELSE 0.0D END").alias("x2"))


@query("d24_training_matrix", f"WITH {FEATURES} SELECT doc_id, y, source, round(x1, 9) AS x1, x2::DOUBLE AS x2 FROM f")
def d24(spark, sf):
    return features(spark, sf).withColumn("x1", F.round("x1", 9))


@query("d27_logistic_fit")
def d27(spark, sf):
    from stormline.plans.model import fit_logistic

    f = fit_logistic(features(spark, sf), ["x1", "x2"], "y", 1.0)
    return spark.createDataFrame([(k, float(v)) for k, v in [*f.coef.items(), ("intercept", f.intercept)]], "term string, value double")


@query("d28_grouped_cross_validation")
def d28(spark, sf):
    from stormline.plans.model import cross_validated

    return cross_validated(features(spark, sf), ["x1", "x2"], "y", "source", 3).select("doc_id", "fold", F.round("score", 6).alias("score"))


@query("d29_base_rates", """
WITH f AS (SELECT source, quality AS y, (doc_id % 4)::INTEGER AS fold FROM documents JOIN labels USING (doc_id)), g AS (SELECT source, fold, sum(y) AS s, count(*) AS n FROM f GROUP BY ALL), t AS (SELECT source, sum(s) AS ts, sum(n) AS tn FROM g GROUP BY source)
SELECT fold, source, round(CASE WHEN tn - n > 0 THEN (ts - s) / (tn - n) END, 9) AS rate FROM g JOIN t USING (source)""")
def d29(spark, sf):
    from stormline.plans.model import base_rates

    f = features(spark, sf).withColumn("fold", F.expr("CAST(doc_id % 4 AS INT)"))
    return base_rates(f, ["source"], "y", "fold").select("fold", "source", F.round("rate", 9).alias("rate"))


@query("d30_evaluation_table", """
WITH s AS (SELECT source, quality AS y, n_chars >= 1200 AS p FROM documents JOIN labels USING (doc_id)), c AS (SELECT source, count(*) FILTER (WHERE p AND y = 1) AS tp, count(*) FILTER (WHERE p AND y = 0) AS fp, count(*) FILTER (WHERE NOT p AND y = 1) AS fn FROM s GROUP BY source)
SELECT sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, round(sum(tp) / sum(tp + fp + fn), 9) AS csi, sum(tp) / sum(tp + fp + fn) > 0.2 AS ship FROM c""")
def d30(spark, sf):
    s = features(spark, sf).join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    by = s.groupBy("source").agg(*a.confusion(F.col("n_chars") >= 1200, F.col("y") == 1))
    pooled = by.agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])
    r = a.skill(pooled)
    return r.select("tp", "fp", "fn", F.round("csi", 9).alias("csi"), (F.col("csi") > 0.2).alias("ship"))


@query("d32_exposure_scores", """
WITH m AS (SELECT c_mktsegment, median(c_acctbal) FILTER (WHERE c_custkey % 9 <> 0) AS med FROM customer GROUP BY 1), s AS (SELECT c_custkey, c_mktsegment, c_custkey % 9 = 0 AS filled, 1 / (1 + exp(-(-2.0 + 0.0003 * CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal ELSE med END))) AS score FROM customer JOIN m USING (c_mktsegment))
SELECT c_custkey, filled, round(score, 9) AS score, round(cume_dist() OVER (PARTITION BY c_mktsegment ORDER BY round(score, 12)), 9) AS rank_index FROM s""")
def d32(spark, sf):
    from stormline.plans.exposure import scored

    c = table(spark, sf, "customer").withColumn("x", F.expr("CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END"))
    r = scored(c, "c_mktsegment", {"x": 0.0003}, -2.0)
    return r.select("c_custkey", "filled", F.round("score", 9).alias("score"), F.round("rank_index", 9).alias("rank_index"))


@query("d33_surge_margins", f"""
WITH {PLACES}, st AS (SELECT n_nationkey AS site, -74.05::DOUBLE + 0.02::DOUBLE * (n_nationkey % 7) AS lon2, 40.62::DOUBLE + 0.03::DOUBLE * (n_nationkey // 7) AS lat2, 1.5::DOUBLE + n_nationkey * 0.1::DOUBLE AS threshold FROM nation), x AS (SELECT place_id, score, lon AS lon1, lat AS lat1, site, lon2, lat2, threshold FROM places, st), {distance_sql('x')}
SELECT place_id, site, round(score / 1000 - threshold, 6) AS margin FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY dist_m, site) AS rk FROM d) WHERE rk = 1""")
def d33(spark, sf):
    from stormline.plans.exposure import surge_margins

    sites = table(spark, sf, "nation").select(F.col("n_nationkey").alias("site"), F.expr("-74.05D + 0.02D * (n_nationkey % 7)").alias("lon2"), F.expr("40.62D + 0.03D * (n_nationkey div 7)").alias("lat2"), F.expr("1.5D + n_nationkey * 0.1D").alias("threshold"))
    p = places(spark, sf).withColumn("elevation", F.col("score") / 1000)
    return surge_margins(p, sites, "place_id").select("place_id", "site", F.round("margin", 6).alias("margin"))


@query("d36_service_impact", """
WITH e AS (SELECT c_nationkey, count(*) AS v FROM orders JOIN customer ON o_custkey = c_custkey WHERE month(o_orderdate) = 1 AND year(o_orderdate) = 1996 GROUP BY 1), k AS (SELECT c_nationkey, count(*) AS v FROM orders JOIN customer ON o_custkey = c_custkey WHERE month(o_orderdate) = 2 AND year(o_orderdate) = 1996 GROUP BY 1)
SELECT c_nationkey, coalesce(e.v, 0) AS event_value, coalesce(k.v, 0) AS control_value, round(coalesce(e.v, 0) / nullif(coalesce(k.v, 0), 0), 6) AS ratio FROM e FULL JOIN k USING (c_nationkey)""")
def d36(spark, sf):
    from stormline.plans.impact import with_controls

    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).where(F.year("o_orderdate") == 1996)
    n = lambda m: o.where(F.month("o_orderdate") == m).groupBy("c_nationkey").agg(F.count("*").alias("v"))
    r = with_controls(n(1), n(2), ["c_nationkey"], "v")
    return r.withColumn("ratio", F.round(a.ratio(F.col("event_value"), F.col("control_value")), 6))


@query("d39_window_features", f"""
WITH {RAIN}, w AS (SELECT n_nationkey::BIGINT * 9 + 6 AS anchor FROM nation)
SELECT cell, anchor, round(max(mm) FILTER (WHERE h >= anchor), 6) AS mm_max, round(sum(mm) FILTER (WHERE h >= anchor), 4) AS mm_total, round(sum(mm) FILTER (WHERE h < anchor), 4) AS mm_antecedent, count(mm) FILTER (WHERE h >= anchor) AS n_hours
FROM w JOIN rain ON h >= anchor - 6 AND h < anchor + 12 GROUP BY ALL""")
def d39(spark, sf):
    from stormline.plans.detector import window_features

    anchors = table(spark, sf, "nation").select((F.col("n_nationkey").cast("long") * 9 + 6).alias("anchor"))
    r = window_features(rain(spark, sf), anchors, 12, 6)
    return r.select("cell", "anchor", F.round("mm_max", 6).alias("mm_max"), F.round("mm_total", 4).alias("mm_total"), F.round("mm_antecedent", 4).alias("mm_antecedent"), "n_hours")


@query("d46_notification_candidates", """
WITH l AS (SELECT o_custkey, o_orderkey, o_orderdate, CASE WHEN o_totalprice >= 300000 THEN 2 WHEN o_totalprice >= 150000 THEN 1 ELSE 0 END AS tier FROM orders), c AS (SELECT *, coalesce(max(tier) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM l),
x AS (SELECT c.*, c_mktsegment, row_number() OVER (PARTITION BY c_nationkey ORDER BY tier DESC, o_orderdate, o_orderkey) AS rk FROM c JOIN customer ON o_custkey = c_custkey WHERE tier > before)
SELECT o_orderkey, tier, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'opted_out' WHEN rk > 20 THEN 'over_cap' END AS dropped FROM x""")
def d46(spark, sf):
    from stormline.plans.notify import candidates

    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    o = o.withColumn("tier", F.expr("CASE WHEN o_totalprice >= 300000 THEN 2 WHEN o_totalprice >= 150000 THEN 1 ELSE 0 END")).withColumn("opted_in", F.col("c_mktsegment") != "MACHINERY")
    return candidates(o, "o_custkey", ["o_orderdate", "o_orderkey"], "c_nationkey", 20).select("o_orderkey", "tier", "dropped")


@query("d49_leg_rule_variants", f"""
WITH {LEGS}, r AS (SELECT 'all' AS rule, count(*) AS n, round(sum(dist_m) / sum(dt_s), 6) AS speed FROM legs WHERE dropped IS DISTINCT FROM 'dark' UNION ALL SELECT 'no_terminal', count(*), round(sum(dist_m) / sum(dt_s), 6) FROM legs WHERE dropped IS NULL) SELECT * FROM r""")
def d49(spark, sf):
    p = pings(spark, sf)
    one = lambda name, rules: lg.legs(p, rules).where("dropped IS NULL").agg(F.lit(name).alias("rule"), F.count("*").alias("n"), F.round(F.sum("dist_m") / F.sum("dt_s"), 6).alias("speed"))
    return one("all", lg.LegRules(drop_terminal=False)).union(one("no_terminal", lg.LegRules()))


@query("d50_wet_census", f"""
WITH {RAIN} SELECT h // 24 AS day, round(avg((mm >= 1)::INT), 9) AS wet, round(avg((mm < 0.1)::INT), 9) AS dry, round(avg((mm >= 0.1 AND cell % 3 = 0)::INT) FILTER (WHERE mm IS NOT NULL), 9) AS frozen, count(mm) AS n FROM rain GROUP BY ALL""")
def d50(spark, sf):
    from stormline.plans.rainfall import wet_census

    r = rain(spark, sf).withColumn("day", F.expr("h div 24")).withColumn("t2m_k", F.when(F.col("cell") % 3 == 0, 270.0).otherwise(280.0))
    c = wet_census(r, "day")
    return c.select("day", *[F.round(x, 9).alias(x) for x in ("wet", "dry", "frozen")], "n")
