"""J, T and U: joins, sorts and set operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stormline.catalog.roles import PINGS, PLACES, RAIN, SPOTS, pings, places, rain, spots
from stormline.operators import joins as j
from stormline.operators import windows as w
from stormline.operators.ranks import range_counts
from stormline.operators.sets import key_diff, multiset_diff, top_n
from stormline.registry import query, table

# The distance of roles' points in SQL: the same closed form as functions.geo.geodesic_m.
DIST = """CASE WHEN s = 0 THEN 0 ELSE 2 * w * 6378137.0 * (1 + f * ((3 * r - 1) / (2 * c) * sp * cq - (3 * r + 1) / (2 * s) * cp * sq)) END"""


def distance_sql(pairs: str, name: str = "d") -> str:
    """CTEs that add dist_m to `pairs`, a relation with lon1, lat1, lon2, lat2."""
    return f"""
{name}0 AS (SELECT *, 1 / 298.257223563 AS f, sin(radians((lat1 + lat2) / 2)) ** 2 AS sp, cos(radians((lat1 + lat2) / 2)) ** 2 AS cp, sin(radians((lat1 - lat2) / 2)) ** 2 AS sq,
  cos(radians((lat1 - lat2) / 2)) ** 2 AS cq, sin(radians((lon1 - lon2) / 2)) ** 2 AS sd, cos(radians((lon1 - lon2) / 2)) ** 2 AS cd FROM {pairs}),
{name}1 AS (SELECT *, sq * cd + cp * sd AS s, cq * cd + sp * sd AS c FROM {name}0),
{name}2 AS (SELECT *, atan(sqrt(s / c)) AS w FROM {name}1),
{name}3 AS (SELECT *, CASE WHEN s = 0 THEN 0 ELSE sqrt(s * c) / w END AS r FROM {name}2),
{name} AS (SELECT *, {DIST} AS dist_m FROM {name}3)"""


@query("j1_semi_anti", """
SELECT 'with' AS side, count(*) AS n FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL
SELECT 'without', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def j1(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    a, b = j.semi_counts(c, o, ["c_custkey"])
    return a.agg(F.lit("with").alias("side"), F.count("*").alias("n")).union(b.agg(F.lit("without").alias("side"), F.count("*").alias("n")))


@query("j2_version_in_effect", """
WITH v AS (SELECT o_custkey, o_orderkey, o_orderdate::DATE AS published FROM orders), d AS (SELECT l_orderkey, l_linenumber, o_custkey, l_shipdate::DATE AS service_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, service_date, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, d.o_custkey, service_date ORDER BY published DESC, o_orderkey) AS r
  FROM d JOIN v ON d.o_custkey = v.o_custkey AND published <= service_date + 1) WHERE r = 1""")
def j2(spark, sf):
    from stormline.plans.schedule import in_effect

    o = table(spark, sf, "orders")
    v = o.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("published"))
    d = table(spark, sf, "lineitem").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    d = d.select("l_orderkey", "l_linenumber", "o_custkey", F.to_date("l_shipdate").alias("service_date"))
    return in_effect(d.join(v, "o_custkey"), ["l_orderkey", "l_linenumber", "o_custkey"], "published", "service_date", "o_orderkey").select("l_orderkey", "l_linenumber", "service_date", "o_orderkey")


CROSSWALK = """cw AS (SELECT n_nationkey AS cell, n_nationkey AS i, k AS j, (CASE k WHEN 0 THEN 0.6 ELSE 0.4 END)::DOUBLE AS weight FROM nation, (SELECT unnest([0, 1]) AS k)),
px AS (SELECT c.i, c.j, r.h, r.mm * (1 + c.j) AS mm FROM rain r JOIN cw c ON r.cell = (c.i + c.j) % 25 WHERE r.mm IS NOT NULL)"""


def crosswalk(spark, sf):
    n = table(spark, sf, "nation")
    return n.select(F.col("n_nationkey").alias("cell"), F.col("n_nationkey").alias("i"), F.explode(F.array(F.lit(0), F.lit(1))).alias("j")).withColumn("weight", F.expr("CASE j WHEN 0 THEN 0.6D ELSE 0.4D END"))


def pixels(spark, sf):
    c = crosswalk(spark, sf).select("i", "j", ((F.col("i") + F.col("j")) % 25).alias("cell"))
    return rain(spark, sf).where("mm IS NOT NULL").join(c, "cell").select("i", "j", "h", (F.col("mm") * (1 + F.col("j"))).alias("mm"))


@query("j3_pixel_remap", f"""
WITH {RAIN}, {CROSSWALK}, g AS (SELECT cell, h, sum(weight) AS got, sum(mm * weight) AS s FROM px JOIN cw USING (i, j) GROUP BY ALL)
SELECT cell, h, round(CASE WHEN got >= 1 - 1e-6 THEN s / got END, 6) AS mm FROM g""")
def j3(spark, sf):
    from stormline.operators.aggregates import weighted_mean

    m = pixels(spark, sf).join(crosswalk(spark, sf), ["i", "j"]).groupBy("cell", "h").agg(weighted_mean(F.col("mm"), F.col("weight")).alias("mm"))
    return m.select("cell", "h", F.round("mm", 6).alias("mm"))


@query("j4_dense_spine", f"WITH {RAIN} SELECT cell, count(*) AS n_hours, count(mm) AS n_known FROM rain GROUP BY cell")
def j4(spark, sf):
    return rain(spark, sf).groupBy("cell").agg(F.count("*").alias("n_hours"), F.count("mm").alias("n_known"))


@query("j5_broadcast_lookup", "SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def j5(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    zones = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")  # nations and regions: a fixed list
    return table(spark, sf, "customer").join(F.broadcast(zones), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name", "r_name")


@query("j6_previous_other_vehicle", f"""
WITH {PINGS}, a AS (SELECT * FROM pings)
SELECT x.event_id, x.ts - max(y.ts) AS headway_s FROM a x LEFT JOIN a y ON x.stop_id = y.stop_id AND x.direction_id IS NOT DISTINCT FROM y.direction_id
  AND y.ts < x.ts AND y.vehicle_id <> x.vehicle_id AND y.trip_id <> x.trip_id GROUP BY x.event_id, x.ts""")
def j6(spark, sf):
    a = pings(spark, sf).select("event_id", "stop_id", "direction_id", "vehicle_id", "trip_id", "ts")
    r = w.previous_other(a, ["stop_id", "direction_id"], "ts", ["vehicle_id", "trip_id"], "before")
    return r.select("event_id", (F.col("ts") - F.col("before")).alias("headway_s"))


@query("j7_prediction_at_horizon", """
WITH e AS (SELECT o_custkey, o_orderkey, epoch(o_orderdate)::BIGINT // 86400 AS arr FROM orders), p AS (SELECT o_custkey, epoch(o_orderdate)::BIGINT // 86400 AS fetched_at, o_orderkey AS pred FROM orders)
SELECT o_custkey, o_orderkey, arr, arg_max(pred, (fetched_at, pred)) FILTER (WHERE fetched_at <= arr - 600) - arr AS pred_err_s, arg_max(pred, (fetched_at, pred)) - arr AS pred_last_off_s, max(pred) - min(pred) AS pred_range_s FROM e JOIN p USING (o_custkey) GROUP BY o_custkey, o_orderkey, arr""")
def j7(spark, sf):
    from stormline.plans.passages import at_horizon

    day = F.expr("unix_timestamp(CAST(o_orderdate AS TIMESTAMP)) div 86400")
    o = table(spark, sf, "orders")
    e = o.select("o_custkey", "o_orderkey", day.alias("arr"))
    p = o.select("o_custkey", day.alias("fetched_at"), F.col("o_orderkey").alias("pred"))
    return at_horizon(e, p, ["o_custkey"], "arr", 600)


@query("j8_asof_join", """
WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate FROM orders), e AS (SELECT event_id, user_id AS o_custkey, TIMESTAMP '1992-01-01' + to_days((event_id % 3000)::INTEGER) AS moment FROM events)
SELECT event_id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderkey IS NOT NULL) AS o_orderkey_asof FROM e LEFT JOIN o ON o.o_custkey = e.o_custkey AND o_orderdate <= moment GROUP BY event_id""")
def j8(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    e = table(spark, sf, "events").select("event_id", F.col("user_id").alias("o_custkey"), F.expr("CAST(TIMESTAMP_NTZ '1992-01-01' + make_dt_interval(CAST(event_id % 3000 AS INT)) AS TIMESTAMP_NTZ)").alias("at"))
    return j.asof_join(e, o, ["o_custkey"], "at", "o_orderdate", ["o_orderkey"]).select("event_id", "o_orderkey_asof")


@query("j9_range_join", """
WITH s AS (SELECT o_orderkey, epoch(o_orderdate)::BIGINT // 86400 AS a, epoch(o_orderdate)::BIGINT // 86400 + o_orderkey % 9 AS b FROM orders), p AS (SELECT l_orderkey, l_linenumber, epoch(l_shipdate)::BIGINT // 86400 AS d FROM lineitem)
SELECT o_orderkey, count(*) AS n FROM p JOIN s ON d >= a AND d < b GROUP BY o_orderkey""")
def j9(spark, sf):
    day = lambda c: F.expr(f"unix_timestamp(CAST({c} AS TIMESTAMP)) div 86400")
    s = table(spark, sf, "orders").select("o_orderkey", day("o_orderdate").alias("a"), (day("o_orderdate") + F.col("o_orderkey") % 9).alias("b"))
    p = table(spark, sf, "lineitem").select(day("l_shipdate").alias("d"))
    return range_counts(p, s, "d", "a", "b").where("n > 0").select("o_orderkey", "n")


@query("j9_keyed_range_join", """
WITH s AS (SELECT o_custkey, o_orderkey, epoch(o_orderdate)::BIGINT // 86400 AS a, epoch(o_orderdate)::BIGINT // 86400 + 30 + o_orderkey % 90 AS b FROM orders)
SELECT s.o_orderkey, p.o_orderkey AS inside FROM s JOIN s p ON s.o_custkey = p.o_custkey AND p.a >= s.a AND p.a < s.b""")
def j9_keyed(spark, sf):
    day = F.expr("unix_timestamp(CAST(o_orderdate AS TIMESTAMP)) div 86400")
    o = table(spark, sf, "orders")
    s = o.select("o_custkey", "o_orderkey", day.alias("a"), (day + 30 + F.col("o_orderkey") % 90).alias("b"))
    p = o.select("o_custkey", F.col("o_orderkey").alias("inside"), day.alias("at"))
    return j.range_join(p, s, "at", "a", "b", 30, ["o_custkey"]).select("o_orderkey", "inside")


@query("j10_trailing_density", """
WITH d AS (SELECT o_custkey, epoch(o_orderdate)::BIGINT // 86400 AS day, o_orderkey FROM orders)
SELECT x.o_orderkey, count(y.o_orderkey) AS n_before FROM d x LEFT JOIN d y ON x.o_custkey = y.o_custkey AND y.day >= x.day - 1095 AND y.day < x.day GROUP BY x.o_orderkey""")
def j10(spark, sf):
    from stormline.plans.matrix import trailing_density

    d = table(spark, sf, "orders").select("o_custkey", F.expr("unix_timestamp(CAST(o_orderdate AS TIMESTAMP)) div 86400").alias("day"), "o_orderkey")
    return trailing_density(d, ["o_custkey"], "day", 1095).select("o_orderkey", "n_before")


@query("j11_hours_in_window", f"""
WITH {RAIN}, e AS (SELECT n_nationkey AS cell, n_nationkey * 7 AS a, n_nationkey * 7 + 12 AS b FROM nation)
SELECT e.cell, count(mm) AS n_known, round(max(mm), 6) AS mm_max, round(sum(mm), 4) AS mm_sum FROM e JOIN rain r ON r.cell = e.cell AND r.h >= a AND r.h < b GROUP BY e.cell""")
def j11(spark, sf):
    from stormline.plans.matrix import window_rain

    e = table(spark, sf, "nation").select(F.col("n_nationkey").alias("cell"), (F.col("n_nationkey") * 7).cast("long").alias("a"), (F.col("n_nationkey") * 7 + 12).cast("long").alias("b"))
    return window_rain(e, rain(spark, sf), ["cell"], "a", "b").select("cell", "n_known", F.round("mm_max", 6).alias("mm_max"), F.round("mm_sum", 4).alias("mm_sum"))


NEAR = f"""WITH {SPOTS}, {PLACES}, x AS (SELECT spot_id, place_id, s.lon AS lon1, s.lat AS lat1, p.lon AS lon2, p.lat AS lat2 FROM spots s JOIN places p ON abs(s.lat - p.lat) < 0.01 AND abs(s.lon - p.lon) < 0.02), {distance_sql('x')}"""


@query("j12_radius_join", NEAR + " SELECT spot_id, place_id, round(dist_m, 3) AS dist_m FROM d WHERE dist_m <= 400")
def j12(spark, sf):
    s = spots(spark, sf).select("spot_id", F.col("lon").alias("lon1"), F.col("lat").alias("lat1"))
    p = places(spark, sf).select("place_id", F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    return j.radius_join(s, p, ("lon1", "lat1"), ("lon2", "lat2"), 400.0).select("spot_id", "place_id", F.round("dist_m", 3).alias("dist_m"))


CELL = """(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END + 1048576)::BIGINT * 2097152 + (CASE WHEN dq > dr AND dq > ds THEN rr WHEN dr > ds THEN -rq - rs ELSE rr END + 1048576)::BIGINT"""


def cell_sql(relation: str, name: str = "g") -> str:
    """CTEs that add `cell` to a relation with lon and lat: the same cells as functions.geo.cell_of."""
    return f"""
{name}0 AS (SELECT *, (((lon + 74.0) * (111320.0 * 0.758)) * (sqrt(3.0::DOUBLE) / 3) - ((lat - 40.7) * 111320.0) / 3) / 500.0 AS q, ((lat - 40.7) * 111320.0) * (2.0::DOUBLE / 3) / 500.0 AS r FROM {relation}),
{name}1 AS (SELECT *, floor(q + 0.5) AS rq, floor(r + 0.5) AS rr, floor(-q - r + 0.5) AS rs FROM {name}0),
{name}2 AS (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs + q + r) AS ds FROM {name}1),
{name} AS (SELECT * EXCLUDE (q, r, rq, rr, rs, dq, dr, ds), {CELL} AS cell FROM {name}2)"""


@query("j13_cell_join", f"""
WITH {SPOTS}, {PLACES}, {cell_sql('spots', 'a')}, {cell_sql('places', 'b')} SELECT spot_id, place_id, cell FROM a JOIN b USING (cell)""")
def j13(spark, sf):
    a, b = j.with_cell(spots(spark, sf)), j.with_cell(places(spark, sf))
    return a.join(b.select("cell", "place_id"), "cell").select("spot_id", "place_id", "cell")


@query("j14_point_in_polygon", f"""
WITH {SPOTS}, {PLACES} SELECT spot_id, place_id FROM spots s JOIN places p
ON abs(p.lon - s.lon) + abs(p.lat - s.lat) * 1.0 < 0.004 AND abs(abs(p.lon - s.lon) + abs(p.lat - s.lat) - 0.004) > 1e-9""")
def j14(spark, sf):
    from stormline.functions.geo import in_ring

    r = 0.004
    corner = lambda dx, dy: F.struct((F.col("sx") + dx).alias("x"), (F.col("sy") + dy).alias("y"))
    s = spots(spark, sf).select("spot_id", F.col("lon").alias("sx"), F.col("lat").alias("sy"))
    s = s.withColumn("ring", F.array(corner(r, 0.0), corner(0.0, r), corner(-r, 0.0), corner(0.0, -r), corner(r, 0.0)))
    s = s.select("spot_id", "ring", (F.col("sx") - r).alias("x0"), (F.col("sy") - r).alias("y0"), (F.col("sx") + r).alias("x1"), (F.col("sy") + r).alias("y1"), "sx", "sy")
    p = places(spark, sf).select("place_id", "lon", "lat")
    edge = F.abs(F.abs(F.col("lon") - F.col("sx")) + F.abs(F.col("lat") - F.col("sy")) - r) > 1e-9
    return j.box_join(p, s, ("lon", "lat"), ("x0", "y0", "x1", "y1"), 0.008, in_ring(F.col("lon"), F.col("lat"), F.col("ring")) & edge).select("spot_id", "place_id")


@query("j16_members_rollup", """
WITH u AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey - c_custkey % 10 END AS parent FROM customer), m AS (SELECT id AS unit, id AS member FROM u UNION SELECT parent, id FROM u WHERE parent IS NOT NULL)
SELECT unit, count(*) AS n_orders FROM m JOIN orders ON o_custkey = member GROUP BY unit""")
def j16(spark, sf):
    u = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.expr("CASE WHEN c_custkey % 10 <> 0 THEN c_custkey - c_custkey % 10 END").alias("parent"))
    return j.members(u, "id", "parent").join(table(spark, sf, "orders"), F.col("member") == F.col("o_custkey")).groupBy("unit").agg(F.count("*").alias("n_orders"))


@query("j17_full_outer_controls", """
WITH a AS (SELECT l_suppkey, count(*) AS v FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45 GROUP BY 1), b AS (SELECT l_suppkey, count(*) AS v FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 46 GROUP BY 1)
SELECT l_suppkey, coalesce(a.v, 0) AS event_value, coalesce(b.v, 0) AS control_value FROM a FULL JOIN b USING (l_suppkey)""")
def j17(spark, sf):
    from stormline.plans.impact import with_controls

    li = table(spark, sf, "lineitem")
    n = lambda cond: li.where(cond).groupBy("l_suppkey").agg(F.count("*").alias("v"))
    return with_controls(n("l_returnflag = 'R' AND l_quantity > 45"), n("l_returnflag = 'A' AND l_quantity > 46"), ["l_suppkey"], "v")


@query("j18_window_holes", f"""
WITH {RAIN} SELECT n_nationkey AS cell, h FROM nation, (SELECT unnest(range(0, 240)) AS h) WHERE (n_nationkey, h) NOT IN (SELECT (cell, h) FROM rain WHERE mm IS NOT NULL)""")
def j18(spark, sf):
    want = j.spine(table(spark, sf, "nation").select(F.col("n_nationkey").alias("cell")), "h", 0, 239)
    return want.join(rain(spark, sf).where("mm IS NOT NULL"), ["cell", "h"], "left_anti")


@query("j19_negatives", """
WITH m AS (SELECT unnest(range(1, 13)) AS month), pos AS (SELECT DISTINCT o_custkey, month(o_orderdate) AS month FROM orders)
SELECT c_custkey, m.month::INTEGER AS month FROM customer, m WHERE NOT EXISTS (SELECT 1 FROM pos WHERE o_custkey = c_custkey AND pos.month = m.month)""")
def j19(spark, sf):
    from stormline.plans.labels import negatives

    months = spark.range(1, 13).select(F.col("id").cast("int").alias("month"))
    pos = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.month("o_orderdate").alias("month"))
    return negatives(table(spark, sf, "customer").select("c_custkey"), months, pos, ["c_custkey", "month"])


@query("j20_matched_baseline", """
WITH b AS (SELECT l_suppkey, month(l_shipdate) AS m, sum(l_extendedprice) / sum(l_quantity) AS norm FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL)
SELECT l_suppkey, m, round(sum(l_extendedprice) / sum(l_quantity) / norm, 6) AS ratio FROM lineitem JOIN b USING (l_suppkey) WHERE m = month(l_shipdate) AND l_returnflag = 'R' GROUP BY l_suppkey, m, norm""")
def j20(spark, sf):
    from stormline.operators.aggregates import ratio

    li = table(spark, sf, "lineitem").withColumn("m", F.month("l_shipdate").cast("long"))
    speed = ratio(F.sum("l_extendedprice"), F.sum("l_quantity"))
    norm = li.where("l_returnflag <> 'R'").groupBy("l_suppkey", "m").agg(speed.alias("norm"))
    wet = li.where("l_returnflag = 'R'").groupBy("l_suppkey", "m").agg(speed.alias("s"))
    return wet.join(norm, ["l_suppkey", "m"]).select("l_suppkey", "m", F.round(F.col("s") / F.col("norm"), 6).alias("ratio"))


@query("j21_latest_with_next", """
WITH l AS (SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id), n AS (SELECT user_id, min(event_id) AS next_error FROM events WHERE event_type = 'error' AND value > 50 GROUP BY user_id)
SELECT user_id, event_id, next_error FROM l LEFT JOIN n USING (user_id)""")
def j21(spark, sf):
    e = table(spark, sf, "events")
    last = w.latest_by(e, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id")
    nxt = e.where("event_type = 'error' AND value > 50").groupBy("user_id").agg(F.min("event_id").alias("next_error"))
    return last.join(nxt, "user_id", "left")


@query("j22_null_safe_equality", f"""
WITH {RAIN} SELECT x.cell, count(*) AS n_same FROM rain x JOIN rain y ON y.cell = x.cell AND y.h = x.h + 1 AND x.mm IS NOT DISTINCT FROM y.mm GROUP BY x.cell""")
def j22(spark, sf):
    r = rain(spark, sf)
    nxt = r.select("cell", (F.col("h") - 1).alias("h"), F.col("mm").alias("mm2"))
    return r.join(nxt, ["cell", "h"]).where(F.col("mm").eqNullSafe(F.col("mm2"))).groupBy("cell").agg(F.count("*").alias("n_same"))


@query("j23_two_source_agreement", f"""
WITH {RAIN}, b AS (SELECT (cell + 1) % 25 AS cell, h, mm FROM rain) SELECT r.cell, count(*) AS n, round(sum(b.mm) / nullif(sum(r.mm), 0), 6) AS forcing_ratio FROM rain r JOIN b ON b.cell = r.cell AND b.h = r.h WHERE r.mm IS NOT NULL AND b.mm IS NOT NULL GROUP BY r.cell""")
def j23(spark, sf):
    from stormline.operators.aggregates import ratio

    r = rain(spark, sf).where("mm IS NOT NULL")
    b = r.select(((F.col("cell") + 1) % 25).alias("cell"), "h", F.col("mm").alias("other"))
    return r.join(b, ["cell", "h"]).groupBy("cell").agg(F.count("*").alias("n"), F.round(ratio(F.sum("other"), F.sum("mm")), 6).alias("forcing_ratio"))


@query("j24_nearest_k_in_radius", NEAR + """
SELECT spot_id, place_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY spot_id ORDER BY dist_m, place_id) AS rank FROM d WHERE dist_m <= 600) WHERE rank <= 3""")
def j24(spark, sf):
    s = spots(spark, sf).select("spot_id", F.col("lon").alias("lon1"), F.col("lat").alias("lat1"))
    p = places(spark, sf).select("place_id", F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    near = j.nearest_in_radius(s, p, ["spot_id"], ("lon1", "lat1"), ("lon2", "lat2"), "place_id", 600.0, 3)
    return near.select("spot_id", "place_id", F.col("rank").cast("long").alias("rank"))


@query("j25_nearest_site", f"""
WITH {PLACES}, st AS (SELECT n_nationkey AS site, -74.05::DOUBLE + 0.02::DOUBLE * (n_nationkey % 7) AS lon2, 40.62::DOUBLE + 0.03::DOUBLE * (n_nationkey // 7) AS lat2 FROM nation), x AS (SELECT place_id, lon AS lon1, lat AS lat1, site, lon2, lat2 FROM places, st), {distance_sql('x')}
SELECT place_id, arg_min(site, (dist_m, site)) AS site, round(min(dist_m), 3) AS dist_m FROM d GROUP BY place_id""")
def j25(spark, sf):
    sites = table(spark, sf, "nation").select(F.col("n_nationkey").alias("site"), F.expr("-74.05D + 0.02D * (n_nationkey % 7)").alias("lon2"), F.expr("40.62D + 0.03D * (n_nationkey div 7)").alias("lat2"))
    r = j.nearest(places(spark, sf), sites, ["place_id"], ("lon", "lat"), ("lon2", "lat2"), "site")
    return r.select("place_id", "site", F.round("dist_m", 3).alias("dist_m"))


@query("t1_sorted_partitions", "SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS first_key FROM orders GROUP BY o_orderstatus")
def t1(spark, sf):
    from stormline.sources.lake import sorted_by

    o = sorted_by(table(spark, sf, "orders"), ["o_orderstatus"], ["o_orderkey"])
    return o.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


@query("t2_top_n_per_kind", "SELECT c_mktsegment, c_custkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer WHERE c_acctbal > 0) WHERE rank <= 10")
def t2(spark, sf):
    c = table(spark, sf, "customer").where("c_acctbal > 0")
    return top_n(c, ["c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")], 10).select("c_mktsegment", "c_custkey", F.col("rank").cast("long").alias("rank"))


@query("t3_most_frequent", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 25")
def t3(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(25)


@query("t4_ordered_list", "SELECT n_regionkey, string_agg(n_name, ';' ORDER BY n_nationkey DESC) AS names FROM nation GROUP BY n_regionkey")
def t4(spark, sf):
    return table(spark, sf, "nation").groupBy("n_regionkey").agg(F.expr("listagg(n_name, ';') WITHIN GROUP (ORDER BY n_nationkey DESC)").alias("names"))


@query("t5_newest_hour", "SELECT max(strftime(ts, '%Y-%m-%dT%H')) AS valid_ts FROM events WHERE strftime(ts, '%Y-%m-%dT%H') <= '2024-01-20T12'")
def t5(spark, sf):
    h = F.date_format("ts", "yyyy-MM-dd'T'HH")
    return table(spark, sf, "events").select(h.alias("h")).where("h <= '2024-01-20T12'").agg(F.max("h").alias("valid_ts"))


@query("u1_union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::INTEGER AS size FROM customer UNION ALL SELECT p_partkey, p_name, NULL, p_size FROM part""")
def u1(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"), F.col("p_name").alias("name"))
    return c.unionByName(p, allowMissingColumns=True)


@query("u2_distinct_by_total_order", """
SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS r FROM events) WHERE r = 1""")
def u2(spark, sf):
    return w.latest_by(table(spark, sf, "events"), ["user_id", "event_type"], [F.desc("value")]).select("user_id", "event_type", "event_id")


@query("u3_multiset_difference", """
WITH a AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A')
SELECT 'removed' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'added', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def u3(spark, sf):
    li = table(spark, sf, "lineitem")
    return multiset_diff(li.where("l_returnflag = 'R'").select("l_partkey", "l_suppkey"), li.where("l_returnflag = 'A'").select("l_partkey", "l_suppkey"))


@query("u4_key_diff", """
WITH a AS (SELECT o_orderkey AS k, o_custkey AS v FROM orders WHERE o_orderkey % 5 <> 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 1 ELSE o_custkey END AS v FROM orders WHERE o_orderkey % 3 <> 0)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'moved' END AS change FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.v IS DISTINCT FROM b.v""")
def u4(spark, sf):
    o = table(spark, sf, "orders")
    a = o.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"))
    b = o.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("k"), F.expr("CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 1 ELSE o_custkey END").alias("v"))
    return key_diff(a, b, ["k"], ["v"])


@query("u5_union_of_triggers", """
WITH a AS (SELECT DISTINCT ts::DATE AS day FROM events WHERE value > 95), b AS (SELECT DISTINCT ts::DATE AS day FROM events WHERE event_type = 'error')
SELECT day, bool_or(t = 'a') AS high, bool_or(t = 'b') AS error FROM (SELECT day, 'a' AS t FROM a UNION ALL SELECT day, 'b' FROM b) GROUP BY day""")
def u5(spark, sf):
    from stormline.plans.spine import triggered

    e = table(spark, sf, "events").select(F.to_date("ts").alias("day"), "value", "event_type")
    return triggered({"high": e.where("value > 95").select("day").distinct(), "error": e.where("event_type = 'error'").select("day").distinct()})


@query("j25_nearest_of_many", f"""
WITH {PLACES}, st AS (SELECT s_suppkey AS site, -74.05::DOUBLE + 0.0031::DOUBLE * (s_suppkey * 37 % 101) AS lon2, 40.62::DOUBLE + 0.0027::DOUBLE * (s_suppkey * 53 % 97) AS lat2 FROM supplier), x AS (SELECT place_id, lon AS lon1, lat AS lat1, site, lon2, lat2 FROM places, st), {distance_sql('x')}
SELECT place_id, site, round(dist_m, 4) AS dist_m FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY round(dist_m, 6), site) AS rk FROM d) WHERE rk = 1""")
def j25_many(spark, sf):
    sites = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("site"), F.expr("-74.05D + 0.0031D * (s_suppkey * 37 % 101)").alias("lon2"), F.expr("40.62D + 0.0027D * (s_suppkey * 53 % 97)").alias("lat2"))
    return j.nearest(places(spark, sf), sites, ["place_id"], ("lon", "lat"), ("lon2", "lat2"), "site", few=16).withColumn("dist_m", F.round("dist_m", 4))
