"""F and P: scalar functions and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormline.catalog.joins import cell_sql, distance_sql
from stormline.catalog.roles import PINGS, PLACES, RAIN, SPOTS, pings, places, rain, spots
from stormline.functions import geo, scores, texts, times
from stormline.registry import query, table

UTC_S = "epoch(ts)::BIGINT"


def ev(spark, sf):
    return table(spark, sf, "events").withColumn("t", F.col("ts").cast("timestamp"))


@query("f1_ceil_hour", """
SELECT event_id, epoch(CASE WHEN date_trunc('hour', ts) = ts THEN ts ELSE date_trunc('hour', ts) + INTERVAL 1 HOUR END)::BIGINT AS hour_end_s FROM events""")
def f1(spark, sf):
    return ev(spark, sf).select("event_id", F.unix_timestamp(times.ceil_hour(F.col("t"))).alias("hour_end_s"))


@query("f2_service_day_time", """
SELECT o_orderkey, epoch(timezone('UTC', timezone('America/New_York', o_orderdate::DATE + INTERVAL 12 HOUR)) - INTERVAL 12 HOUR + to_seconds(o_orderkey % 100000))::BIGINT AS sched_s FROM orders""")
def f2(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.unix_timestamp(times.sched_ts(F.date_format("o_orderdate", "yyyyMMdd"), F.col("o_orderkey") % 100000)).alias("sched_s"))


@query("f3_hour_of_week", """
SELECT event_id, ((isodow(l) - 1) * 24 + hour(l))::INTEGER AS hour_of_week FROM (SELECT event_id, timezone('America/New_York', timezone('UTC', ts - INTERVAL 1 HOUR)) AS l FROM events)""")
def f3(spark, sf):
    return ev(spark, sf).select("event_id", times.hour_of_week(F.col("t")).alias("hour_of_week"))


@query("f4_hms_seconds", """
SELECT event_id, ((event_id % 30) * 3600 + (event_id % 60) * 60 + (event_id * 7) % 60)::INTEGER AS s FROM events""")
def f4(spark, sf):
    hms = F.format_string("%d:%02d:%02d", F.expr("event_id % 30"), F.expr("event_id % 60"), F.expr("(event_id * 7) % 60"))
    return table(spark, sf, "events").select("event_id", times.hms_seconds(hms).alias("s"))


@query("f5_route_class", f"""
WITH {PINGS} SELECT route_id, CASE WHEN starts_with(upper(route_id), 'X') OR starts_with(upper(route_id), 'BM') OR starts_with(upper(route_id), 'QM') OR starts_with(upper(route_id), 'BXM') OR starts_with(upper(route_id), 'SIM') THEN 'express' WHEN ends_with(route_id, '+') THEN 'sbs' ELSE 'local' END AS route_class, count(*) AS n FROM pings GROUP BY ALL""")
def f5(spark, sf):
    return pings(spark, sf).groupBy("route_id", texts.route_class(F.col("route_id")).alias("route_class")).agg(F.count("*").alias("n"))


@query("f6_trip_code", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'C' || (o_orderkey % 5) WHEN o_orderkey % 3 = 1 THEN 'D' || (o_orderkey % 7) END AS code FROM orders""")
def f6(spark, sf):
    trip = F.expr("CASE o_orderkey % 3 WHEN 0 THEN concat('UP_C', o_orderkey % 5, '-Weekday-', o_orderkey) WHEN 1 THEN concat(o_orderkey, '-D', o_orderkey % 7, '_X') ELSE concat('free', o_orderkey) END")
    return table(spark, sf, "orders").select("o_orderkey", texts.trip_code(trip, [r"^[A-Z]{2}_([A-Z]\d)-", r"^\d+-([A-Z]\d)_"]).alias("code"))


@query("f7_geodesic", f"""
WITH {PLACES}, x AS (SELECT a.place_id, a.lon AS lon1, a.lat AS lat1, b.lon AS lon2, b.lat AS lat2 FROM places a JOIN places b ON b.place_id = (a.place_id * 7 + 3) % 150 AND a.place_id <> b.place_id), {distance_sql('x')}
SELECT place_id, round(dist_m, 3) AS dist_m FROM d""")
def f7(spark, sf):
    p = places(spark, sf)
    b = p.select(F.col("place_id").alias("k"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    x = p.withColumn("k", (F.col("place_id") * 7 + 3) % 150).join(b, "k").where("place_id <> k")
    return x.select("place_id", F.round(geo.geodesic_m(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2")), 3).alias("dist_m"))


@query("f9_cell_of_point", f"WITH {PLACES}, {cell_sql('places')} SELECT place_id, cell FROM g")
def f9(spark, sf):
    return places(spark, sf).select("place_id", geo.cell_of(F.col("lon"), F.col("lat")).alias("cell"))


@query("f11_box_share", """
SELECT s_suppkey, round((greatest(least((s_suppkey % 10) + 1.0, 5.5) - greatest((s_suppkey % 10) + 0.0, 2.5), 0) * greatest(least((s_suppkey % 7) + 1.0, 4.25) - greatest((s_suppkey % 7) + 0.0, 1.5), 0))::DOUBLE, 9) AS share FROM supplier""")
def f11(spark, sf):
    x, y = F.expr("CAST(s_suppkey % 10 AS DOUBLE)"), F.expr("CAST(s_suppkey % 7 AS DOUBLE)")
    other = tuple(F.lit(v) for v in (2.5, 1.5, 5.5, 4.25))
    return table(spark, sf, "supplier").select("s_suppkey", F.round(geo.box_share((x, y, x + 1, y + 1), other), 9).alias("share"))


@query("f13_ring_of_points", f"""
WITH {SPOTS} SELECT spot_id, k, round(lon + cos(k * (2 * pi() / 8)) * (50.0 / 111320.0) / cos(radians(lat)), 9) AS x, round(lat + sin(k * (2 * pi() / 8)) * (50.0 / 111320.0), 9) AS y FROM spots, (SELECT unnest(range(0, 8))::INTEGER AS k)""")
def f13(spark, sf):
    r = spots(spark, sf).select("spot_id", F.explode(geo.ring_points(F.col("lon"), F.col("lat"), 8, 50.0)).alias("p"))
    return r.select("spot_id", "p.k", F.round("p.lon", 9).alias("x"), F.round("p.lat", 9).alias("y"))


@query("f15_log1p", "SELECT s_suppkey, round(CASE WHEN s_acctbal >= 0 THEN ln(1 + s_acctbal) END, 9) AS x FROM supplier")
def f15(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", F.round(scores.log1p_or_null(F.col("s_acctbal")), 9).alias("x"))


@query("f16_text_norm", """
SELECT p_partkey, 'AVENUE ' || upper(replace(p_name, ' ', ' ')) || ' 42' AS words FROM part""")
def f16(spark, sf):
    raw = F.concat(F.lit("Ave' "), F.col("p_name"), F.lit(", 42nd!"))
    return table(spark, sf, "part").select("p_partkey", texts.norm_words(raw, {"AVE": "AVENUE", "ST": "STREET"}).alias("words"))


@query("f18_local_to_utc", """
SELECT o_orderkey, epoch(timezone('UTC', timezone('America/New_York', o_orderdate + INTERVAL 15 HOUR)))::BIGINT AS utc_s FROM orders""")
def f18(spark, sf):
    text = F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 15 HOURS"), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "orders").select("o_orderkey", F.unix_timestamp(times.from_local(text, "yyyy-MM-dd HH:mm:ss")).alias("utc_s"))


@query("f19_enum_names", """
SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'STOPPED' WHEN 2 THEN 'IN_TRANSIT' WHEN 3 THEN 'INCOMING' END AS status FROM lineitem""")
def f19(spark, sf):
    names = ["UNKNOWN", "STOPPED", "IN_TRANSIT", "INCOMING"]
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", texts.enum_name(F.col("l_linenumber"), names).alias("status"))


@query("f20_mask_names", """
SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_custkey & 1 <> 0 THEN 'calls' END, CASE WHEN c_custkey & 2 <> 0 THEN 'sensors' END, CASE WHEN c_custkey & 4 <> 0 THEN 'alerts' END], lambda x: x IS NOT NULL), ',') AS sources FROM customer""")
def f20(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.array_join(texts.mask_names(F.col("c_custkey"), ["calls", "sensors", "alerts"]), ",").alias("sources"))


@query("f21_cell_hex", f"WITH {PLACES}, {cell_sql('places')} SELECT place_id, lower(hex(cell)) AS cell_hex, cell AS back FROM g")
def f21(spark, sf):
    h = texts.cell_hex(geo.cell_of(F.col("lon"), F.col("lat")))
    return places(spark, sf).select("place_id", h.alias("cell_hex"), texts.cell_from_hex(h).alias("back"))


@query("f22_hash_fold", """
SELECT c_custkey, list_reduce(list_transform(string_split(sha1('s' || c_custkey), ''), lambda d: (instr('0123456789abcdef', d) - 1)::BIGINT), lambda a, d: (a * 16 + d) % 5)::INTEGER AS fold FROM customer""")
def f22(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", scores.fold_of(F.col("c_custkey").cast("string"), 5, "s").alias("fold"))


@query("f23_linear_score", "SELECT l_orderkey, l_linenumber, round(-1.5 + 0.02 * l_quantity + 3.0 * l_discount - 2.5 * l_tax, 9) AS eta FROM lineitem")
def f23(spark, sf):
    model = {"l_quantity": 0.02, "l_discount": 3.0, "l_tax": -2.5}
    li = scores.need_columns(table(spark, sf, "lineitem"), list(model))
    return li.select("l_orderkey", "l_linenumber", F.round(scores.linear(model, -1.5), 9).alias("eta"))


@query("f24_dummies", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS status_O, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS status_P FROM orders""")
def f24(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", *scores.dummies(F.col("o_orderstatus"), ["F", "O", "P"], "status"))


@query("f25_correction_band", """
SELECT s_suppkey, CASE WHEN s_acctbal >= 5000 THEN 0.95 WHEN s_acctbal >= 1000 THEN 0.9 WHEN s_acctbal >= 0 THEN 0.8 END::DOUBLE AS factor FROM supplier""")
def f25(spark, sf):
    from stormline.functions.lookups import band

    floors = [(0.0, 0.8), (1000.0, 0.9), (5000.0, 0.95)]
    return table(spark, sf, "supplier").select("s_suppkey", band(F.col("s_acctbal"), floors).alias("factor"))


@query("f26_rain_bracket", f"WITH {RAIN} SELECT cell, h, CASE WHEN mm >= 4 THEN '10y' WHEN mm >= 2 THEN '5y' WHEN mm >= 1 THEN '2y' END AS bracket FROM rain")
def f26(spark, sf):
    return rain(spark, sf).select("cell", "h", scores.bracket(F.col("mm"), [("2y", 1.0), ("5y", 2.0), ("10y", 4.0)]).alias("bracket"))


@query("f27_elevation_fallback", f"""
WITH {SPOTS} SELECT spot_id, coalesce(CASE WHEN depth > 0 THEN depth END, CASE WHEN spot_id % 3 = 0 THEN 12.5 END, 99.0)::DOUBLE AS elevation, CASE WHEN depth > 0 THEN round(depth - 1.5, 4) END AS relief FROM spots""")
def f27(spark, sf):
    from stormline.plans.matrix import elevation, relief

    own = F.when(F.col("depth") > 0, F.col("depth"))
    return spots(spark, sf).select("spot_id", elevation(own, F.expr("CASE WHEN spot_id % 3 = 0 THEN 12.5D END"), F.lit(99.0)).alias("elevation"), F.round(relief(own, F.lit(1.5)), 4).alias("relief"))


@query("f28_datum_margin", "SELECT s_suppkey, round(s_acctbal / 100 - 2.34, 6) AS margin FROM supplier")
def f28(spark, sf):
    from stormline.functions.lookups import datum_margin

    return table(spark, sf, "supplier").select("s_suppkey", F.round(datum_margin(F.col("s_acctbal") / 100, F.lit(2.34)), 6).alias("margin"))


@query("f29_event_class", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 THEN 'mixed' WHEN o_orderkey % 3 = 0 THEN 'coastal' WHEN o_orderkey % 2 = 0 AND o_orderkey % 5 = 0 THEN 'snowmelt' WHEN o_orderkey % 2 = 0 THEN 'pluvial' ELSE 'unclassified' END AS event_class FROM orders""")
def f29(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", scores.event_class(k % 2 == 0, k % 3 == 0, k % 5 == 0).alias("event_class"))


@query("f30_freshness", """
SELECT event_id, CASE WHEN a < 0 OR a > 900 THEN 'DOWN' WHEN a > 300 THEN 'STALE' ELSE 'FRESH' END AS state FROM (SELECT event_id, event_id % 1500 - 100 AS a FROM events)""")
def f30(spark, sf):
    return table(spark, sf, "events").select("event_id", scores.freshness(F.col("event_id") % 1500 - 100, 300, 900).alias("state"))


@query("p1_service_date", f"WITH {PINGS} SELECT event_id FROM pings WHERE start_date = '20240101' AND seq = 7")
def p1(spark, sf):
    return pings(spark, sf).where((F.col("start_date") == "20240101") & (F.col("seq") == 7)).select("event_id")


@query("p2_not_cancelled", "SELECT event_id FROM events WHERE coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE event_type END, '') <> 'click'")
def p2(spark, sf):
    from stormline.functions.lookups import not_cancelled

    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return table(spark, sf, "events").where(not_cancelled(kind, "click")).select("event_id")


@query("p3_range_gates", f"WITH {PINGS} SELECT event_id FROM pings WHERE lat BETWEEN 40.7 AND 41.0 AND lon BETWEEN -73.9 AND -73.893 AND ts >= 1704067200 AND ts < 1704067200 + 36000")
def p3(spark, sf):
    from stormline.functions.lookups import in_box

    p = pings(spark, sf)
    return p.where(in_box(F.col("lon"), F.col("lat"), (-73.9, 40.7, -73.893, 41.0)) & (F.col("ts") >= 1704067200) & (F.col("ts") < 1704067200 + 36000)).select("event_id")


@query("p4_keywords", "SELECT doc_id FROM documents WHERE regexp_matches(upper(concat_ws(' ', source, text)), 'LICENSE|COPYRIGHT')")
def p4(spark, sf):
    from stormline.sources.archives import keyword_rows

    return keyword_rows(table(spark, sf, "documents"), ["source", "text"], "LICENSE|COPYRIGHT").select("doc_id")


@query("p5_wet_dry_mask", f"""
WITH {RAIN}, x AS (SELECT cell, h, mm, lag(mm) OVER w AS mm_before, CASE WHEN count(mm) OVER w6 = 6 THEN sum(mm) OVER w6 END AS mm_6 FROM rain WINDOW w AS (PARTITION BY cell ORDER BY h), w6 AS (PARTITION BY cell ORDER BY h ROWS 5 PRECEDING))
SELECT cell, count(*) FILTER (WHERE mm < 0.9 AND mm_before < 0.9 AND mm_6 < 4.5) AS n_dry, count(*) FILTER (WHERE mm >= 1.0) AS n_wet FROM x GROUP BY cell""")
def p5(spark, sf):
    from pyspark.sql import Window

    from stormline.operators.aggregates import count_if
    from stormline.operators.windows import with_trailing
    from stormline.plans.contrast import dry, wet

    r = with_trailing(rain(spark, sf), ["cell"], "h", "mm", [6]).withColumn("before", F.lag("mm").over(Window.partitionBy("cell").orderBy("h")))
    # The rule's limits are 0.1, 0.1 and 0.5 mm; these amounts are nine times coarser.
    return r.groupBy("cell").agg(count_if(dry(F.col("mm") / 9, F.col("before") / 9, F.col("mm_6") / 9)).alias("n_dry"), count_if(wet(F.col("mm"))).alias("n_wet"))


@query("p6_clock_change", """
SELECT o_orderkey, timezone('America/New_York', timezone('UTC', t)) - t <> timezone('America/New_York', timezone('UTC', t - INTERVAL 1 HOUR)) - (t - INTERVAL 1 HOUR) AS crosses FROM (SELECT o_orderkey, o_orderdate + to_hours((o_orderkey % 24)::INTEGER) AS t FROM orders)""")
def p6(spark, sf):
    t = (F.col("o_orderdate") + F.expr("make_dt_interval(0, CAST(o_orderkey % 24 AS INT))")).cast("timestamp")
    return table(spark, sf, "orders").select("o_orderkey", times.crosses_clock_change(t).alias("crosses"))


@query("p7_two_hour_prune", """
SELECT count(*) AS n FROM events WHERE date_trunc('hour', ts) IN (TIMESTAMP '2024-01-02 00:00:00', TIMESTAMP '2024-01-01 23:00:00')""")
def p7(spark, sf):
    from stormline.sources.lake import prune_two_hours

    e = ev(spark, sf).withColumn("date", F.date_format("t", "yyyy-MM-dd")).withColumn("hour", F.date_format("t", "HH"))
    return prune_two_hours(e, 1704067200 + 86400 + 600).agg(F.count("*").alias("n"))


@query("p8_barred_columns", "SELECT count(*) AS n FROM lineitem")
def p8(spark, sf):
    return scores.bar_columns(table(spark, sf, "lineitem"), ["label", "event_depth"]).agg(F.count("*").alias("n"))


@query("p9_month_span", "SELECT count(*) AS n_read, count(*) FILTER (WHERE month(o_orderdate) = 3) AS n_kept FROM orders WHERE o_orderdate::DATE BETWEEN '1996-02-29' AND '1996-03-31'")
def p9(spark, sf):
    from stormline.operators.aggregates import count_if
    from stormline.sources.lake import month_span

    lo, hi = month_span("1996-03")
    o = table(spark, sf, "orders").where(F.to_date("o_orderdate").between(F.lit(lo), F.lit(hi)))
    return o.agg(F.count("*").alias("n_read"), count_if(F.month("o_orderdate") == 3).alias("n_kept"))


@query("p10_pairable", """
SELECT c_custkey FROM customer WHERE coalesce(c_acctbal > 0, false) AND c_nationkey < 20 AND (CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey END IS NULL OR c_custkey <= 1000)""")
def p10(spark, sf):
    from stormline.plans.labels import pairable

    built = F.expr("CASE WHEN c_custkey % 4 <> 0 THEN c_custkey END")
    return table(spark, sf, "customer").where(pairable(F.col("c_acctbal") > 0, built, F.lit(1000), F.col("c_nationkey") < 20)).select("c_custkey")
