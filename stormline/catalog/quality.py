"""C and Q: data-quality checks and the query surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormline.catalog.joins import NEAR, cell_sql
from stormline.catalog.roles import PINGS, PLACES, RAIN, pings, places, rain, spots
from stormline.functions.geo import cell_of
from stormline.operators.joins import spine
from stormline.plans import quality as c
from stormline.plans import surface as s
from stormline.registry import query, table


@query("c1_results_and_code", f"""
WITH {RAIN}, r AS (SELECT cell, count(mm) / count(*) AS share FROM rain GROUP BY cell) SELECT CASE WHEN bool_or(share < 0.3) THEN 1 ELSE 0 END::INTEGER AS rc FROM r""")
def c1(spark, sf):
    r = rain(spark, sf).groupBy("cell").agg((F.count("mm") / F.count("*")).alias("share"))
    return c.exit_code(r.select(*c.result("hours_known", F.col("cell"), F.col("share") >= 0.3, F.col("share"))))


@query("c2_missing_hours", f"WITH {RAIN} SELECT cell, h FROM rain WHERE mm IS NULL AND cell % 5 <> 0")
def c2(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("cell"))
    want = spine(n, "h", 0, 239)
    dead = want.where("cell % 5 = 0")
    return c.missing_hours(rain(spark, sf).where("mm IS NOT NULL"), want, ["cell", "h"], dead)


@query("c2_stale_dead", f"WITH {RAIN} SELECT cell, h FROM rain WHERE mm IS NOT NULL AND cell % 5 = 0")
def c2b(spark, sf):
    dead = spine(table(spark, sf, "nation").select(F.col("n_nationkey").alias("cell")), "h", 0, 239).where("cell % 5 = 0")
    return c.stale_dead(rain(spark, sf).where("mm IS NOT NULL"), dead, ["cell", "h"])


@query("c3_fill_fidelity", """
WITH x AS (SELECT count(*) FILTER (WHERE event_id % 20 <> 0) / count(*) AS r, count(DISTINCT CASE WHEN event_id % 20 <> 0 THEN user_id END) / count(DISTINCT user_id) AS k FROM events)
SELECT 'row_ratio' AS "check", 'rows' AS subject, CASE WHEN r BETWEEN 0.9 AND 1.1 THEN 'ok' ELSE 'fail' END AS status, r AS measure FROM x UNION ALL SELECT 'key_ratio', 'keys', CASE WHEN k BETWEEN 0.9 AND 1.1 THEN 'ok' ELSE 'fail' END, k FROM x""")
def c3(spark, sf):
    e = table(spark, sf, "events")
    return c.fidelity(e.where("event_id % 20 <> 0"), e, "user_id")


@query("c5_build_parity", """
SELECT o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 'differs' ELSE 'equal' END AS verdict FROM orders GROUP BY o_orderstatus""")
def c5(spark, sf):
    o = table(spark, sf, "orders")
    changed = o.withColumn("o_custkey", F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 0), F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    return c.parity(o, changed.repartition(5), ["o_orderstatus"])


@query("c6_slice_gates", """
SELECT 'unique_key' AS "check", CASE WHEN count(*) = count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)) THEN 'ok' ELSE 'fail' END AS status FROM lineitem
UNION ALL SELECT 'in_range', CASE WHEN bool_and(l_discount BETWEEN 0 AND 0.1) THEN 'ok' ELSE 'fail' END FROM lineitem UNION ALL SELECT 'three_flags', CASE WHEN count(DISTINCT l_returnflag) = 3 THEN 'ok' ELSE 'fail' END FROM lineitem""")
def c6(spark, sf):
    key = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return c.gates(table(spark, sf, "lineitem"), {
        "unique_key": F.count("*") == F.countDistinct(key), "in_range": F.bool_and(F.col("l_discount").between(0, 0.1)), "three_flags": F.countDistinct("l_returnflag") == 3})


@query("c7_storm_gates", """
WITH x AS (SELECT sum(l_extendedprice) FILTER (WHERE l_returnflag = 'R') / sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS storm, sum(l_extendedprice) FILTER (WHERE l_returnflag = 'A') / sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS dry, count(*) FILTER (WHERE l_returnflag = 'R') AS n, count(*) FILTER (WHERE l_suppkey IS NULL) AS nulls FROM lineitem)
SELECT 'slower' AS "check", CASE WHEN storm / dry <= 0.85 THEN 'ok' ELSE 'fail' END AS status FROM x UNION ALL SELECT 'enough', CASE WHEN n >= 15000 THEN 'ok' ELSE 'fail' END FROM x UNION ALL SELECT 'no_null_cell', CASE WHEN nulls = 0 THEN 'ok' ELSE 'fail' END FROM x""")
def c7(spark, sf):
    speed = lambda f: F.sum(F.when(F.col("l_returnflag") == f, F.col("l_extendedprice"))) / F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity")))
    return c.gates(table(spark, sf, "lineitem"), {
        "slower": speed("R") / speed("A") <= 0.85, "enough": F.count(F.when(F.col("l_returnflag") == "R", 1)) >= 15000, "no_null_cell": F.count(F.when(F.col("l_suppkey").isNull(), 1)) == 0})


@query("c8_duplicate_and_orphan_keys", """
SELECT 'duplicate' AS kind, count(*) AS n FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1) UNION ALL
SELECT 'orphan', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)""")
def c8(spark, sf):
    d = c.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).agg(F.lit("duplicate").alias("kind"), F.count("*").alias("n"))
    cust = table(spark, sf, "customer").where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("o_custkey"))
    return d.union(c.orphans(table(spark, sf, "orders"), cust, ["o_custkey"]).agg(F.lit("orphan"), F.count("*")))


@query("c9_no_missing_features", f"WITH {RAIN} SELECT 'mm' AS \"column\", count(*) FILTER (WHERE mm IS NULL) AS n_null FROM rain UNION ALL SELECT 'cell', count(*) FILTER (WHERE cell IS NULL) FROM rain")
def c9(spark, sf):
    return c.null_counts(rain(spark, sf), ["mm", "cell"])


@query("c10_window_coverage", f"WITH {RAIN} SELECT h // 24 AS win, count(*) = 24 * (SELECT count(DISTINCT cell) FROM rain) AS covered FROM rain GROUP BY ALL")
def c10(spark, sf):
    r = rain(spark, sf)
    cells = r.agg(F.countDistinct("cell").alias("k"))
    by = r.groupBy(F.expr("h div 24").alias("win")).agg(F.count("*").alias("n"))
    return by.crossJoin(F.broadcast(cells)).select("win", (F.col("n") == 24 * F.col("k")).alias("covered"))  # one row


@query("c11_expectations", """
SELECT 'positive' AS expectation, round(avg((o_totalprice > 0)::INT), 9) AS share, avg((o_totalprice > 0)::INT) >= 1 AS ok FROM orders UNION ALL SELECT 'open_or_filled', round(avg((o_orderstatus IN ('O', 'F'))::INT), 9), avg((o_orderstatus IN ('O', 'F'))::INT) >= 0.9 FROM orders""")
def c11(spark, sf):
    r = c.expectations(table(spark, sf, "orders"), [("positive", "o_totalprice > 0", 1.0), ("open_or_filled", "o_orderstatus IN ('O', 'F')", 0.9)])
    return r.select("expectation", F.round("share", 9).alias("share"), "ok")


@query("c12_id_scheme_rate", "SELECT c_nationkey, round(avg((c_custkey % 50 <> 0)::INT), 9) AS rate, avg((c_custkey % 50 <> 0)::INT) >= 0.98 AS ok FROM customer GROUP BY c_nationkey")
def c12(spark, sf):
    from stormline.plans.versions import match_rate

    d = table(spark, sf, "customer").withColumn("id", F.when(F.col("c_custkey") % 50 != 0, F.col("c_name")).otherwise("x"))
    return match_rate(d, ["c_nationkey"], r"^Customer#\d+$", "id").select("c_nationkey", F.round("rate", 9).alias("rate"), "ok")


def units(spark, sf):
    return places(spark, sf).select(F.col("place_id").alias("asset_id"), F.expr("CASE WHEN place_id % 10 <> 0 THEN place_id - place_id % 10 END").alias("parent_asset_id"), "kind", "lon", "lat", cell_of(F.col("lon"), F.col("lat")).alias("cell"), "score")


def asked(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("asset_id"))


@query("q1_events_for_assets", """
WITH u AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey - c_custkey % 10 END AS parent FROM customer), m AS (SELECT id AS unit, id AS member FROM u UNION SELECT parent, id FROM u WHERE parent IS NOT NULL),
a AS (SELECT p_partkey AS asset_id FROM part), l AS (SELECT o_custkey AS member, strftime(o_orderdate, '%Y%m%d') AS event_id FROM orders)
SELECT asset_id, CASE WHEN asset_id NOT IN (SELECT id FROM u) THEN 'unknown_asset' WHEN count(DISTINCT event_id) = 0 THEN 'no_events' END AS reason, count(DISTINCT event_id) AS n_events, max(event_id) AS last_event FROM a LEFT JOIN m ON unit = asset_id LEFT JOIN l USING (member) GROUP BY asset_id""")
def q1(spark, sf):
    labels = table(spark, sf, "orders").select(F.col("o_custkey").alias("asset_id"), F.date_format("o_orderdate", "yyyyMMdd").alias("event_id"))
    return s.events_for_assets(asked(spark, sf), units(spark, sf), labels)


@query("q2_exposure_of", """
SELECT p_partkey AS asset_id, CASE WHEN c_custkey IS NULL THEN 'unknown_asset' WHEN c_acctbal <= 0 THEN 'not_a_unit' END AS reason, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS score FROM part LEFT JOIN customer ON c_custkey = p_partkey""")
def q2(spark, sf):
    u = units(spark, sf)
    return s.exposure_of(asked(spark, sf), u.where("score > 0"), u)


@query("q3_assets_in_box", f"""
WITH {PLACES}, {cell_sql('places')} SELECT place_id AS asset_id, cell, NULL::VARCHAR AS reason FROM g WHERE lon BETWEEN -74.0 AND -73.95 AND lat BETWEEN 40.62 AND 40.65""")
def q3(spark, sf):
    return s.assets_in_box(units(spark, sf), (-74.0, 40.62, -73.95, 40.65))


@query("q4_observations_near", NEAR + " SELECT spot_id AS point_id, place_id AS obs_id, round(dist_m, 3) AS dist_m, rank FROM (SELECT *, row_number() OVER (PARTITION BY spot_id ORDER BY dist_m, place_id) AS rank FROM d WHERE dist_m <= 500) WHERE rank <= 5")
def q4(spark, sf):
    a = spots(spark, sf).select(F.col("spot_id").alias("point_id"), F.col("lon").alias("lon1"), F.col("lat").alias("lat1"))
    b = places(spark, sf).select(F.col("place_id").alias("obs_id"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    return s.observations_near(a, b, 500.0, 5).select("point_id", "obs_id", F.round("dist_m", 3).alias("dist_m"), F.col("rank").cast("long").alias("rank"))


@query("q5_recent_summary", """
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderdate::DATE > (SELECT max(o_orderdate)::DATE - 30 FROM orders) GROUP BY o_orderpriority""")
def q5(spark, sf):
    o = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    return s.recent(o, "day", 30, ["o_orderpriority"], F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("q6_history_manifest", """
WITH u AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey - c_custkey % 10 END AS parent FROM customer), m AS (SELECT id AS unit, id AS member FROM u UNION SELECT parent, id FROM u WHERE parent IS NOT NULL)
SELECT unit AS asset_id, count(DISTINCT o_orderdate) AS n_events, max(o_orderdate)::DATE AS last_day FROM m JOIN orders ON o_custkey = member GROUP BY unit""")
def q6(spark, sf):
    from stormline.operators.joins import members

    edges = members(units(spark, sf), "asset_id", "parent_asset_id")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("member"), "o_orderdate")
    return edges.join(o, "member").groupBy(F.col("unit").alias("asset_id")).agg(F.countDistinct("o_orderdate").alias("n_events"), F.to_date(F.max("o_orderdate")).alias("last_day"))


@query("q7_version_stamp", "SELECT count(DISTINCT l_linestatus) AS n_versions, max(l_linestatus) AS version, CASE WHEN count(DISTINCT l_linestatus) <> 1 THEN 'mixed_versions' END AS reason FROM lineitem")
def q7(spark, sf):
    return s.one_version(table(spark, sf, "lineitem"), "l_linestatus")


@query("q8_redacted", f"WITH {PLACES} SELECT place_id, zone, kind, score FROM places")
def q8(spark, sf):
    return s.redacted(places(spark, sf), "public")
