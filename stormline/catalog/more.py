"""More of D, F, J, W and X: routes, shapes, alerts, scoring and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormline.catalog.joins import distance_sql
from stormline.catalog.pipelines import FEATURES, SCHED, features, sched
from stormline.catalog.roles import PINGS, PLACES, RAIN, SPOTS, pings, places, rain, spots
from stormline.functions import lookups, shapes
from stormline.plans import alerts, routes
from stormline.registry import query, table

LINE = "line AS (SELECT vehicle_id AS shape, seq AS k, lon, lat FROM pings)"


def line(spark, sf):
    return pings(spark, sf).select(F.col("vehicle_id").alias("shape"), F.col("seq").alias("k"), "lon", "lat")


@query("w24_distance_along_shape", f"""
WITH {PINGS}, {LINE}, x AS (SELECT shape, k, lon AS lon2, lat AS lat2, coalesce(lag(lon) OVER w, lon) AS lon1, coalesce(lag(lat) OVER w, lat) AS lat1 FROM line WINDOW w AS (PARTITION BY shape ORDER BY k)), {distance_sql('x')}
SELECT shape, k, round(sum(dist_m) OVER (PARTITION BY shape ORDER BY k), 2) AS dist_m FROM d""")
def w24(spark, sf):
    return routes.with_distance(line(spark, sf), ["shape"], "k").select("shape", "k", F.round("dist_m", 2).alias("dist_m"))


@query("f8_within_distance", f"""
WITH {SPOTS}, x AS (SELECT spot_id, lon AS lon1, lat AS lat1, -74.0::DOUBLE AS lon2, 40.7::DOUBLE AS lat2 FROM spots), {distance_sql('x')} SELECT spot_id FROM d WHERE dist_m <= 6000""")
def f8(spark, sf):
    from stormline.functions.geo import geodesic_m

    return spots(spark, sf).where(geodesic_m(F.col("lon"), F.col("lat"), F.lit(-74.0), F.lit(40.7)) <= 6000).select("spot_id")


@query("f12_linear_reference", """
WITH s AS (SELECT s_suppkey AS stop, (s_suppkey % 5)::INTEGER AS shape, (s_suppkey * 7 % 100)::DOUBLE AS px, (s_suppkey * 3 % 9)::DOUBLE AS py FROM supplier),
g AS (SELECT shape, seg, seg * 10.0::DOUBLE AS ax, (seg + 1) * 10.0::DOUBLE AS bx, shape::DOUBLE AS y FROM (SELECT unnest(range(0, 5))::INTEGER AS shape), (SELECT unnest(range(0, 10)) AS seg)),
n AS (SELECT s.shape, stop, ax + least(greatest((px - ax) / 10, 0), 1) * 10 AS d, (ax + least(greatest((px - ax) / 10, 0), 1) * 10 - px) ** 2 + (y - py) ** 2 AS off FROM s JOIN g USING (shape))
SELECT shape, stop, round(arg_min(d, (off, d)), 6) AS dist_m FROM n GROUP BY shape, stop""")
def f12(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("stop"), F.expr("CAST(s_suppkey % 5 AS INT)").alias("shape"), F.expr("CAST(s_suppkey * 7 % 100 AS DOUBLE)").alias("stop_x"), F.expr("CAST(s_suppkey * 3 % 9 AS DOUBLE)").alias("stop_y"))
    pts = spark.range(5).select(F.col("id").cast("int").alias("shape"), F.explode(F.sequence(F.lit(0), F.lit(10))).alias("k"))
    pts = pts.select("shape", "k", (F.col("k") * 10.0).alias("lon"), F.col("shape").cast("double").alias("lat"), (F.col("k") * 10.0).alias("dist_m"))
    r = routes.stop_distances(s, routes.segments(pts, ["shape"], "k"), "shape", "stop")
    return r.select("shape", "stop", F.round("dist_m", 6).alias("dist_m"))


@query("f14_interpolation_fraction", """
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_quantity > 10 AND l_quantity < 40 THEN (l_quantity - 10) / 30 ELSE (l_linenumber - 0) / 8.0 END, 9)::DOUBLE AS frac FROM lineitem""")
def f14(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(lookups.interpolated(F.col("l_quantity"), F.lit(10.0), F.lit(40.0), F.col("l_linenumber"), F.lit(0), F.lit(8)), 9).alias("frac"))


@query("f17_alert_ids", "SELECT o_orderkey, o_custkey::VARCHAR AS incident, (o_orderkey % 4)::INTEGER AS revision FROM orders")
def f17(spark, sf):
    a = F.expr("concat('lmm:planned:', o_custkey, '_v', o_orderkey % 4)")
    o = table(spark, sf, "orders").withColumn("a", a).withColumn("incident", alerts.incident_of(F.col("a")))
    return o.select("o_orderkey", "incident", alerts.revision_of(F.col("a"), F.col("incident"), ["o_orderkey"]).alias("revision"))


SEGS = "sg AS (SELECT s_suppkey AS route, s_suppkey AS seg_id, (s_suppkey % 13)::DOUBLE AS ax, (s_suppkey % 7)::DOUBLE AS ay, (s_suppkey % 13 + 3)::DOUBLE AS bx, (s_suppkey % 7)::DOUBLE AS by_ FROM supplier), bx_ AS (SELECT n_nationkey AS box_id, (n_nationkey % 5 * 3 + 0.5)::DOUBLE AS x0, (n_nationkey // 5 * 2 - 0.5)::DOUBLE AS y0, (n_nationkey % 5 * 3 + 2.5)::DOUBLE AS x1, (n_nationkey // 5 * 2 + 0.5)::DOUBLE AS y1 FROM nation)"


def box_lengths(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("route"), F.col("s_suppkey").alias("seg_id"), F.expr("CAST(s_suppkey % 13 AS DOUBLE)").alias("lon"), F.expr("CAST(s_suppkey % 7 AS DOUBLE)").alias("lat"), F.expr("CAST(s_suppkey % 13 + 3 AS DOUBLE)").alias("lon_b"), F.expr("CAST(s_suppkey % 7 AS DOUBLE)").alias("lat_b"), F.lit(0.0).alias("dist_m"), F.lit(3.0).alias("dist_m_b"))
    b = table(spark, sf, "nation").select(F.col("n_nationkey").alias("box_id"), F.expr("n_nationkey % 5 * 3 + 0.5D").alias("x0"), F.expr("n_nationkey div 5 * 2 - 0.5D").alias("y0"), F.expr("n_nationkey % 5 * 3 + 2.5D").alias("x1"), F.expr("n_nationkey div 5 * 2 + 0.5D").alias("y1"))
    return routes.length_in_boxes(s, b, ["route"], 2.0)


@query("j15_line_in_cells", f"""
WITH {SEGS} SELECT route, box_id, round(greatest(least(bx, x1) - greatest(ax, x0), 0), 6) AS length FROM sg JOIN bx_ ON ay >= y0 AND ay <= y1 AND least(bx, x1) - greatest(ax, x0) > 0""")
def j15(spark, sf):
    return box_lengths(spark, sf).select("route", "box_id", F.round("length", 6).alias("length"))


@query("d34_route_footprint", f"""
WITH {SEGS}, l AS (SELECT route, box_id, greatest(least(bx, x1) - greatest(ax, x0), 0) AS length FROM sg JOIN bx_ ON ay >= y0 AND ay <= y1 AND least(bx, x1) - greatest(ax, x0) > 0) SELECT route, round(sum(length) / 3, 6) AS share, count(DISTINCT box_id) AS n_boxes FROM l GROUP BY route""")
def d34(spark, sf):
    return box_lengths(spark, sf).groupBy("route").agg(F.round(F.sum("length") / 3, 6).alias("share"), F.countDistinct("box_id").alias("n_boxes"))


@query("d5_final_arrivals", f"""
WITH {PINGS}, {SCHED}, seqs AS (SELECT trip_id, list_sort(list_distinct(list(stop_sequence)), 'DESC') AS q FROM sched GROUP BY trip_id), e AS (SELECT trip_id, q[1] AS last_seq, q[2] AS gate, 's' || q[1] AS stop_id FROM seqs WHERE len(q) > 1),
o AS (SELECT *, lag(stop_id) OVER w AS passed, lag(ts) OVER w AS ts0 FROM pings WHERE trip_id IS NOT NULL WINDOW w AS (PARTITION BY vehicle_id, trip_id ORDER BY ts, fetched_at, stop_id)),
p AS (SELECT vehicle_id, trip_id, max(CAST(substr(passed, 2) AS INTEGER)) AS got, max((ts0 + ts) / 2.0) AS last_arr FROM o WHERE passed <> stop_id GROUP BY ALL)
SELECT p.vehicle_id, p.trip_id, e.last_seq AS stop_sequence, p.last_arr::DOUBLE + 60 AS arr FROM p JOIN e USING (trip_id) WHERE got = gate""")
def d5(spark, sf):
    from stormline.plans.passages import final_arrivals, observed

    n = F.expr("CAST(substr(stop_id, 2) AS INT)")
    passed = observed(pings(spark, sf)).withColumn("stop_sequence", n)
    s = sched(spark, sf)
    last = passed.groupBy("vehicle_id", "trip_id").agg((F.max("arr") + 60).alias("pred"))
    preds = last.join(s.groupBy("trip_id").agg(F.max_by("stop_id", "stop_sequence").alias("stop_id")), "trip_id").withColumn("fetched_at", F.lit(1))
    return final_arrivals(passed, s, preds).select("vehicle_id", "trip_id", "stop_sequence", "arr")


@query("d6_passage_facts", f"""
WITH {PINGS}, o AS (SELECT *, lag(stop_id) OVER w AS passed, lag(ts) OVER w AS ts0 FROM pings WHERE trip_id IS NOT NULL WINDOW w AS (PARTITION BY vehicle_id, trip_id, start_date ORDER BY ts, fetched_at, stop_id)),
f AS (SELECT vehicle_id, trip_id, start_date, route_id, passed AS stop_id, ((ts0 + ts) / 2.0)::DOUBLE AS arr, row_number() OVER (PARTITION BY vehicle_id, trip_id, start_date, passed ORDER BY ts0) AS r FROM o WHERE passed <> stop_id), p AS (SELECT * FROM f WHERE r = 1)
SELECT x.vehicle_id, x.trip_id, x.stop_id, x.arr, x.arr - max(y.arr) AS headway_s FROM p x LEFT JOIN p y ON y.stop_id = x.stop_id AND y.start_date = x.start_date AND y.arr < x.arr AND y.vehicle_id <> x.vehicle_id AND y.trip_id <> x.trip_id GROUP BY x.vehicle_id, x.trip_id, x.stop_id, x.arr""")
def d6(spark, sf):
    from stormline.operators.scratch import stored
    from stormline.operators.windows import previous_other
    from stormline.plans.passages import observed

    p = stored(observed(pings(spark, sf)).select("vehicle_id", "trip_id", "start_date", "stop_id", "arr"), "passages")
    r = previous_other(p, ["stop_id", "start_date"], "arr", ["vehicle_id", "trip_id"], "before")
    return r.select("vehicle_id", "trip_id", "stop_id", "arr", (F.col("arr") - F.col("before")).alias("headway_s"))


@query("d13_cell_pixel_crosswalk", """
SELECT cell, count(*) AS n_pixels, round(sum(w), 9) AS total, round(max(w), 9) AS most FROM (
  SELECT cell, greatest(least(cx + 400, (i + 1) * 300.0::DOUBLE) - greatest(cx - 400, i * 300.0::DOUBLE), 0) * greatest(least(cy + 400, (j + 1) * 300.0::DOUBLE) - greatest(cy - 400, j * 300.0::DOUBLE), 0) / 640000.0::DOUBLE AS w
  FROM (SELECT s_suppkey AS cell, (s_suppkey * 37 % 1000)::DOUBLE AS cx, (s_suppkey * 91 % 1000)::DOUBLE AS cy FROM supplier), (SELECT unnest(range(-3, 6)) AS i), (SELECT unnest(range(-3, 6)) AS j))
WHERE w > 0 GROUP BY cell""")
def d13(spark, sf):
    from stormline.functions.geo import box_share

    x, y = (F.col("s_suppkey") * 37 % 1000).cast("double"), (F.col("s_suppkey") * 91 % 1000).cast("double")
    c = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("cell"), x.alias("cx"), y.alias("cy"))
    step = 300.0  # a pixel's side
    lo, hi = lambda v: F.floor((v - 400) / step), lambda v: F.floor((v + 400) / step)
    p = c.withColumn("i", F.explode(F.sequence(lo(F.col("cx")), hi(F.col("cx"))))).withColumn("j", F.explode(F.sequence(lo(F.col("cy")), hi(F.col("cy")))))
    pixel = (F.col("i") * step, F.col("j") * step, (F.col("i") + 1) * step, (F.col("j") + 1) * step)
    box = (F.col("cx") - 400, F.col("cy") - 400, F.col("cx") + 400, F.col("cy") + 400)
    w = p.withColumn("weight", box_share(box, pixel)).where("weight > 0")
    return w.groupBy("cell").agg(F.count("*").alias("n_pixels"), F.round(F.sum("weight"), 9).alias("total"), F.round(F.max("weight"), 9).alias("most"))


@query("d20_alert_mentions", """
WITH w AS (SELECT doc_id, list_filter(string_split(regexp_replace(upper(text), '[^A-Z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents), b AS (SELECT item_id, list_filter(string_split(regexp_replace(upper(text), '[^A-Z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM benchmark),
a AS (SELECT array_to_string(w[1:6], ' ') AS alias, min(item_id) AS asset_id FROM b GROUP BY 1 HAVING count(DISTINCT item_id) = 1), r AS (SELECT doc_id, array_to_string(w[i:i + 5], ' ') AS alias FROM (SELECT doc_id, w, unnest(range(1, len(w) - 4)) AS i FROM w))
SELECT doc_id, asset_id, count(*) AS n_mentions FROM r JOIN a USING (alias) GROUP BY ALL""")
def d20(spark, sf):
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("asset_id"), F.array_join(F.slice(alerts.words(F.col("text")), 1, 6), " ").alias("alias"))
    return alerts.mentions(table(spark, sf, "documents"), "doc_id", "text", b, 6)


@query("d25_terrain_features", f"""
WITH {SPOTS}, r AS (SELECT spot_id, k, CASE WHEN (spot_id + k) % 5 <> 0 THEN depth / 10 + k END AS z FROM spots, (SELECT unnest(range(0, 8)) AS k)) SELECT spot_id, round(min(z), 6) AS ring_min, round(median(z), 6) AS ring_median, count(z) >= 6 AS enough FROM r GROUP BY spot_id""")
def d25(spark, sf):
    from stormline.functions.geo import ring_points

    r = spots(spark, sf).select("spot_id", "depth", F.explode(ring_points(F.col("lon"), F.col("lat"), 8, 50.0)).alias("p")).withColumn("k", F.col("p.k"))
    z = F.expr("CASE WHEN (spot_id + k) % 5 <> 0 THEN depth / 10 + k END")
    return r.withColumn("z", z).groupBy("spot_id").agg(F.round(F.min("z"), 6).alias("ring_min"), F.round(F.median("z"), 6).alias("ring_median"), (F.count("z") >= 6).alias("enough"))


@query("d26_category_shares", """
WITH x AS (SELECT (s_suppkey % 20)::INTEGER AS cell, CASE s_suppkey % 3 WHEN 0 THEN 'deep' WHEN 1 THEN 'nuisance' ELSE 'none' END AS category, greatest(least(s_suppkey % 20 + 1.0, s_suppkey % 23 + 0.5) - greatest(s_suppkey % 20, s_suppkey % 23 - 0.5), 0) / 50 AS share FROM supplier)
SELECT cell, category, round(least(sum(share), 1), 9)::DOUBLE AS share FROM x GROUP BY ALL""")
def d26(spark, sf):
    c = F.col("s_suppkey")
    lo = (c % 20).cast("double")
    part = shapes.interval_share(lo, lo + 1, (c % 23).cast("double") - 0.5, (c % 23).cast("double") + 0.5) / 50
    x = table(spark, sf, "supplier").select((c % 20).cast("int").alias("cell"), F.expr("CASE s_suppkey % 3 WHEN 0 THEN 'deep' WHEN 1 THEN 'nuisance' ELSE 'none' END").alias("category"), part.alias("share"))
    return x.groupBy("cell", "category").agg(F.round(F.least(F.sum("share"), F.lit(1.0)), 9).alias("share"))


@query("d31_penalty_sweep")
def d31(spark, sf):
    from stormline.plans.model import fit_logistic

    f = features(spark, sf).persist()
    rows = []
    for l2 in (0.1, 1.0, 10.0):
        for drop in (None, "x1", "x2"):
            fit = fit_logistic(f, [c for c in ("x1", "x2") if c != drop], "y", l2)
            rows += [(l2, drop or "none", k, float(v)) for k, v in fit.coef.items()]
    f.unpersist()
    return spark.createDataFrame(rows, "l2 double, dropped string, term string, value double")


@query("d35_route_exhibit", """
SELECT l_suppkey, round(sum(CASE WHEN l_returnflag = 'R' THEN l_discount * l_quantity END) / sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 9) AS event_value, round(sum(CASE WHEN l_returnflag <> 'R' THEN l_discount * l_quantity END) / sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity END), 9) AS other_value, count(*) FILTER (WHERE l_returnflag = 'R') AS n_event FROM lineitem GROUP BY l_suppkey""")
def d35(spark, sf):
    r = routes.exhibit(table(spark, sf, "lineitem"), ["l_suppkey"], F.col("l_returnflag") == "R", "l_discount", "l_quantity")
    return r.select("l_suppkey", F.round("event_value", 9).alias("event_value"), F.round("other_value", 9).alias("other_value"), "n_event")


@query("d37_speed_impact", """
WITH s AS (SELECT (l_suppkey % 25)::INTEGER AS cell, l_orderkey % 168 AS how, l_returnflag = 'R' AS ev, sum(l_extendedprice) AS d, sum(l_quantity) AS t FROM lineitem GROUP BY ALL), b AS (SELECT cell, how, d / t AS norm FROM s WHERE NOT ev)
SELECT cell, round(sum(d) / sum(norm * t), 8) AS ratio, count(*) AS n FROM s JOIN b USING (cell, how) WHERE ev GROUP BY cell""")
def d37(spark, sf):
    from stormline.operators.aggregates import ratio

    s = table(spark, sf, "lineitem").groupBy(F.expr("CAST(l_suppkey % 25 AS INT)").alias("cell"), (F.col("l_orderkey") % 168).alias("how"), (F.col("l_returnflag") == "R").alias("ev")).agg(F.sum("l_extendedprice").alias("d"), F.sum("l_quantity").alias("t"))
    norm = s.where("NOT ev").select("cell", "how", ratio(F.col("d"), F.col("t")).alias("norm"))
    return s.where("ev").join(norm, ["cell", "how"]).groupBy("cell").agg(F.round(ratio(F.sum("d"), F.sum(F.col("norm") * F.col("t"))), 8).alias("ratio"), F.count("*").alias("n"))


@query("d38_last_hour_overlay", """
WITH h AS (SELECT user_id, date_trunc('hour', ts) AS h, value, event_id, ts FROM events), l AS (SELECT max(h) AS h FROM h), c AS (SELECT user_id, arg_max(value, (ts, event_id)) AS last_value FROM h WHERE h.h >= (SELECT h - INTERVAL 48 HOUR FROM l) GROUP BY user_id)
SELECT user_id, round(last_value / (SELECT median(last_value) FROM c), 6) AS ratio FROM c""")
def d38(spark, sf):
    h = table(spark, sf, "events").withColumn("h", F.date_trunc("hour", "ts"))
    last = h.agg(F.max("h").alias("last"))
    c = h.crossJoin(F.broadcast(last)).where(F.col("h") >= F.col("last") - F.expr("INTERVAL 48 HOURS"))  # one row
    c = c.groupBy("user_id").agg(F.max_by("value", F.struct("ts", "event_id")).alias("last_value"))
    level = c.agg(F.median("last_value").alias("level"))
    return c.crossJoin(F.broadcast(level)).select("user_id", F.round(F.col("last_value") / F.col("level"), 6).alias("ratio"))  # one row


SCORE = f"""{RAIN}, s AS (SELECT cell, h, h // 24 AS win, CASE WHEN mm IS NOT NULL THEN 1 / (1 + exp(-(-3 + 0.8 * mm + 0.02 * cell))) END AS score FROM rain),
t AS (SELECT *, cume_dist() OVER (PARTITION BY h ORDER BY score DESC) AS top FROM s WHERE score IS NOT NULL), v AS (SELECT cell, h, win, CASE WHEN round(top, 9) <= 0.04 THEN 3 WHEN round(top, 9) <= 0.2 THEN 2 WHEN round(top, 9) <= 0.4 THEN 1 ELSE 0 END AS tier FROM t)"""


def detector(spark, sf):
    from stormline.operators.windows import top_tiers, with_latch
    from stormline.plans.detector import scored_hours

    s = scored_hours(rain(spark, sf), {"mm": 0.8, "cell": 0.02}, -3.0).withColumn("win", F.expr("h div 24"))
    t = top_tiers(s, ["h"], "score", [("3", 0.04 + 1e-10), ("2", 0.2 + 1e-10), ("1", 0.4 + 1e-10)]).withColumn("tier", F.coalesce(F.col("tier").cast("int"), F.lit(0)))
    return with_latch(t, ["cell", "win"], ["h"], "tier")


@query("d40_detector_scores", f"WITH {SCORE} SELECT cell, h, tier, max(tier) OVER (PARTITION BY cell, win ORDER BY h) AS latched FROM v")
def d40(spark, sf):
    return detector(spark, sf).select("cell", "h", "tier", "latched")


@query("d41_detector_backtest", f"""
WITH {SCORE}, u AS (SELECT cell, win, max(tier) AS tier FROM v GROUP BY ALL), y AS (SELECT DISTINCT cell, h // 24 AS win FROM rain WHERE mm >= 8)
SELECT u.win, count(*) FILTER (WHERE tier >= 2 AND y.cell IS NOT NULL) AS tp, count(*) FILTER (WHERE tier >= 2 AND y.cell IS NULL) AS fp, count(*) FILTER (WHERE tier < 2 AND y.cell IS NOT NULL) AS fn FROM u LEFT JOIN y ON y.cell = u.cell AND y.win = u.win GROUP BY u.win""")
def d41(spark, sf):
    from stormline.operators.aggregates import confusion

    u = detector(spark, sf).groupBy("cell", "win").agg(F.max("tier").alias("tier"))
    y = rain(spark, sf).where("mm >= 8").select("cell", F.expr("h div 24").alias("win")).distinct().withColumn("y", F.lit(True))
    both = u.join(y, ["cell", "win"], "left").withColumn("y", F.coalesce("y", F.lit(False)))
    return both.groupBy("win").agg(*confusion(F.col("tier") >= 2, F.col("y"))[:3])


@query("d42_threshold_universes", """
WITH c AS (SELECT ts::DATE AS day, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL), q AS (SELECT unnest([0.5, 0.7, 0.9]) AS q)
SELECT q::DOUBLE AS q, count(*) AS n_days FROM q, c WHERE n >= CASE q WHEN 0.5 THEN (SELECT quantile_disc(n, 0.5) FROM c) WHEN 0.7 THEN (SELECT quantile_disc(n, 0.7) FROM c) ELSE (SELECT quantile_disc(n, 0.9) FROM c) END GROUP BY q""")
def d42(spark, sf):
    from stormline.plans.spine import daily_counts, trigger_days

    c = daily_counts(table(spark, sf, "events").where("event_type = 'error'"), F.to_date("ts"))
    out = None
    for q in (0.5, 0.7, 0.9):  # one universe a setting
        one = trigger_days(c, q).agg(F.lit(q).alias("q"), F.count("*").alias("n_days"))
        out = one if out is None else out.union(one)
    return out


@query("d43_water_sensors", f"""
WITH {RAIN}, x AS (SELECT cell, h, mm FROM rain WHERE h >= 180), b AS (SELECT cell, max(CASE WHEN coalesce(mm, 0) < 0.4 THEN h END) AS below, max(h) AS last_h, arg_max(mm, h) FILTER (WHERE mm IS NOT NULL) - arg_min(mm, h) FILTER (WHERE mm IS NOT NULL) AS rise FROM x GROUP BY cell)
SELECT cell, round(rise, 6) AS rise, last_h - coalesce(below, 179) AS run_length, CASE WHEN cell % 6 = 0 THEN 'muted' WHEN last_h - coalesce(below, 179) >= 2 THEN 'wet' ELSE 'dry' END AS state FROM b""")
def d43(spark, sf):
    from stormline.plans.sensors import water_states

    r = rain(spark, sf).where("h >= 180")
    muted = r.select("cell").distinct().where("cell % 6 = 0")
    return water_states(r, muted, "cell", "h", "mm", 0.4, 2).select("cell", F.round("rise", 6).alias("rise"), "run_length", "state")


@query("d44_alert_chips", """
WITH n AS (SELECT o_custkey, count(*) AS n_revisions, bool_or(o_orderstatus = 'O') AS active, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS newest FROM orders GROUP BY o_custkey) SELECT o_custkey, newest AS o_orderkey, n_revisions, CASE WHEN active THEN 'active' ELSE 'closed' END AS state FROM n""")
def d44(spark, sf):
    return alerts.chips(table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "O").select("o_custkey", "o_orderkey", "n_revisions", "state")


@query("d45_tide_residuals", f"""
WITH {RAIN} SELECT a.cell, round(avg(a.mm - b.mm), 8) AS residual, count(*) AS n FROM rain a JOIN rain b ON b.h = a.h AND b.cell = (a.cell + 3) % 25 WHERE a.mm IS NOT NULL AND b.mm IS NOT NULL GROUP BY a.cell""")
def d45(spark, sf):
    from stormline.plans.sensors import tide_residuals

    r = rain(spark, sf).where("mm IS NOT NULL")
    p = r.select(((F.col("cell") + 22) % 25).alias("cell"), "h", "mm")
    return tide_residuals(r, p, ["cell"], "h", "mm").select("cell", F.round("residual", 8).alias("residual"), "n")


@query("d47_published_comparison", """
WITH o AS (SELECT l_suppkey, sum(l_extendedprice) / sum(l_quantity) AS ours, sum(l_extendedprice * (1 + l_tax)) / sum(l_quantity) AS published FROM lineitem GROUP BY l_suppkey), r AS (SELECT *, rank() OVER (ORDER BY ours) AS ra, rank() OVER (ORDER BY published) AS rb FROM o)
SELECT count(*) AS n, round(avg(ours / published), 8) AS mean_ratio, round(quantile_cont(ours / published, 0.1), 8) AS q10, round(quantile_cont(ours / published, 0.9), 8) AS q90, round(corr(ra, rb), 8) AS spearman FROM r""")
def d47(spark, sf):
    from stormline.operators.aggregates import rank_correlation

    o = table(spark, sf, "lineitem").groupBy("l_suppkey").agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias("ours"), (F.sum(F.col("l_extendedprice") * (1 + F.col("l_tax"))) / F.sum("l_quantity")).alias("published"))
    r = F.col("ours") / F.col("published")
    a = o.agg(F.count("*").alias("n"), F.round(F.avg(r), 8).alias("mean_ratio"), F.round(F.percentile(r, 0.1), 8).alias("q10"), F.round(F.percentile(r, 0.9), 8).alias("q90"))
    return a.crossJoin(rank_correlation(o, "ours", "published").select(F.round("spearman", 8).alias("spearman")))  # one row each


@query("d48_point_against_area", f"""
WITH {RAIN}, p AS (SELECT l_suppkey % 25 AS cell, l_orderkey % 240 AS h, count(*) AS n FROM lineitem GROUP BY ALL), a AS (SELECT h, avg(mm) AS area FROM rain GROUP BY h) SELECT round(corr(mm, area), 8) AS r, round(regr_slope(mm, area), 8) AS slope, count(*) AS n FROM p JOIN rain USING (cell, h) JOIN a USING (h) WHERE mm IS NOT NULL""")
def d48(spark, sf):
    r = rain(spark, sf)
    p = table(spark, sf, "lineitem").select(F.expr("CAST(l_suppkey % 25 AS INT)").alias("cell"), (F.col("l_orderkey") % 240).alias("h")).distinct()
    area = r.groupBy("h").agg(F.avg("mm").alias("area"))
    return p.join(r.where("mm IS NOT NULL"), ["cell", "h"]).join(area, "h").agg(F.round(F.corr("mm", "area"), 8).alias("r"), F.round(F.regr_slope("mm", "area"), 8).alias("slope"), F.count("*").alias("n"))


@query("s2_optional_predictions", f"WITH {PINGS} SELECT count(*) AS n FROM pings WHERE trip_id IS NOT NULL")
def s2(spark, sf):
    from stormline.catalog.streams import folder
    from stormline.sources.lake import read_optional

    path = folder(spark, "tu")
    assert read_optional(spark, path) is None  # nothing was captured yet
    pings(spark, sf).where("trip_id IS NOT NULL").write.parquet(path)
    return read_optional(spark, path).agg(F.count("*").alias("n"))


@query("f10_point_in_ring", """
SELECT s_suppkey, (s_suppkey % 10) + 0.5 > 2 AND (s_suppkey % 10) + 0.5 < 7 AND (s_suppkey % 7) + 0.25 > 1 AND (s_suppkey % 7) + 0.25 < 5 AS inside FROM supplier""")
def f10(spark, sf):
    from stormline.functions.geo import in_ring

    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((2, 1), (7, 1), (7, 5), (2, 5), (2, 1))])
    return table(spark, sf, "supplier").select("s_suppkey", in_ring(F.expr("s_suppkey % 10 + 0.5D"), F.expr("s_suppkey % 7 + 0.25D"), ring).alias("inside"))
