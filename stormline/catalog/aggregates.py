"""A: aggregates on the star tables, pings and rain."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormline.catalog.roles import PINGS, RAIN, pings, rain
from stormline.operators import aggregates as a
from stormline.registry import query, table


def li(spark, sf):
    return table(spark, sf, "lineitem")


@query("a1_conditional_sums", """
SELECT l_shipdate::DATE AS day, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned, count(*) FILTER (WHERE l_linestatus = 'O') AS n_open,
  round(sum(l_quantity) FILTER (WHERE l_returnflag <> 'R'), 2) AS kept_quantity FROM lineitem GROUP BY ALL""")
def a1(spark, sf):
    kept = F.col("l_returnflag") != "R"
    return li(spark, sf).groupBy(F.to_date("l_shipdate").alias("day")).agg(
        a.count_if(~kept).alias("n_returned"), a.count_if(F.col("l_linestatus") == "O").alias("n_open"),
        F.round(a.sum_if(kept, F.col("l_quantity")), 2).alias("kept_quantity"))


@query("a2_approx_distinct", """
SELECT l_returnflag, count(DISTINCT l_partkey) AS exact, true AS within_bound FROM lineitem GROUP BY l_returnflag""")
def a2(spark, sf):
    # Repeats don't change a sketch, so both counts read the distinct pairs: beside countDistinct in one aggregate, each pair would carry a sketch of its own.
    n, exact = F.approx_count_distinct("l_partkey", 0.02), F.count("l_partkey")
    pairs = li(spark, sf).select("l_returnflag", "l_partkey").distinct()
    return pairs.groupBy("l_returnflag").agg(exact.alias("exact"), (F.abs(n - exact) <= 0.1 * exact).alias("within_bound"))


@query("a3_median", "SELECT c_nationkey, round(median(c_acctbal), 4) AS median_balance FROM customer GROUP BY c_nationkey")
def a3(spark, sf):
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(F.round(F.median("c_acctbal"), 4).alias("median_balance"))


@query("a4_exact_distinct", "SELECT l_suppkey, count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY l_suppkey")
def a4(spark, sf):
    return li(spark, sf).groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("n_orders"), F.countDistinct("l_partkey").alias("n_parts"))


@query("a5_ratio_of_sums", """
SELECT l_shipdate::DATE AS day, round(p::DOUBLE / q::DOUBLE, 6) AS price, p::DOUBLE AS price_sum, q::DOUBLE AS quantity_sum FROM (
  SELECT l_shipdate, sum(l_extendedprice::DECIMAL(18, 2)) AS p, sum(l_quantity::DECIMAL(18, 2)) AS q FROM lineitem GROUP BY ALL)""")
def a5(spark, sf):
    money = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")  # noqa: E731  exact, whatever the order of the rows
    return li(spark, sf).groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.round(a.ratio(money("l_extendedprice"), money("l_quantity")), 6).alias("price"),
        money("l_extendedprice").alias("price_sum"), money("l_quantity").alias("quantity_sum"))


@query("a6_known_shares", f"""
WITH {RAIN} SELECT cell, round(avg(CASE WHEN mm IS NOT NULL THEN CASE WHEN mm >= 1 THEN 1.0 ELSE 0.0 END END), 9) AS wet_share, count(mm) AS n_known FROM rain GROUP BY cell""")
def a6(spark, sf):
    return rain(spark, sf).groupBy("cell").agg(F.round(a.share(F.col("mm") >= 1), 9).alias("wet_share"), F.count("mm").alias("n_known"))


@query("a7_excess_wait", f"""
WITH {PINGS}, h AS (SELECT route_id, ts - lag(ts) OVER (PARTITION BY route_id, stop_id ORDER BY ts, event_id) AS h, seq * 80 - lag(seq * 80) OVER (PARTITION BY route_id, stop_id ORDER BY ts, event_id) AS s FROM pings)
SELECT route_id, round(CASE WHEN sum(h) > 0 THEN sum(h * h) / (2 * sum(h)) END - CASE WHEN sum(s) > 0 THEN sum(s * s) / (2 * sum(s)) END, 4) AS excess_wait_s FROM h GROUP BY route_id""")
def a7(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("route_id", "stop_id").orderBy("ts", "event_id")
    planned = F.col("seq") * 80
    h = pings(spark, sf).select("route_id", (F.col("ts") - F.lag("ts").over(w)).alias("h"), (planned - F.lag(planned).over(w)).alias("s"))
    return h.groupBy("route_id").agg(F.round(a.renewal_wait(F.col("h")) - a.renewal_wait(F.col("s")), 4).alias("excess_wait_s"))


@query("a8_guarded_weighted_mean", """
SELECT l_orderkey, round(CASE WHEN sum(CASE WHEN l_returnflag <> 'R' THEN w END) >= 1 - 1e-6 THEN sum(CASE WHEN l_returnflag <> 'R' THEN w * l_discount END) / sum(CASE WHEN l_returnflag <> 'R' THEN w END) END, 10) AS mean_discount
FROM (SELECT *, l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey) AS w FROM lineitem) GROUP BY l_orderkey""")
def a8(spark, sf):
    from pyspark.sql import Window

    w = F.col("l_quantity") / F.sum("l_quantity").over(Window.partitionBy("l_orderkey"))
    value = F.when(F.col("l_returnflag") != "R", F.col("l_discount"))
    return li(spark, sf).select("l_orderkey", w.alias("w"), value.alias("v")).groupBy("l_orderkey").agg(
        F.round(a.weighted_mean(F.col("v"), F.col("w")), 10).alias("mean_discount"))


@query("a9_value_at_extreme", """
SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS dearest, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS cheapest FROM orders GROUP BY o_custkey""")
def a9(spark, sf):
    by = F.struct("o_totalprice", "o_orderkey")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", by).alias("dearest"), F.min_by("o_orderkey", by).alias("cheapest"))


@query("a10_mask_and_support", """
SELECT l_orderkey, bit_or(CAST(1 << (l_linenumber % 8) AS SMALLINT)) AS mask, array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS support, max(l_quantity) AS top FROM lineitem GROUP BY l_orderkey""")
def a10(spark, sf):
    return li(spark, sf).groupBy("l_orderkey").agg(
        F.bit_or(F.expr("CAST(shiftleft(1, l_linenumber % 8) AS SMALLINT)")).alias("mask"),
        F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("support"), F.max("l_quantity").alias("top"))


@query("a11_distinct_set_size", "SELECT user_id, len(list_distinct(list(event_type)))::INTEGER AS n_types FROM events GROUP BY user_id")
def a11(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.size(F.collect_set("event_type")).alias("n_types"))


@query("a12_nearest_rank", "SELECT c_mktsegment, quantile_disc(c_acctbal, 0.99) AS p99, quantile_disc(c_acctbal, 0.5) AS p50 FROM customer GROUP BY c_mktsegment")
def a12(spark, sf):
    return table(spark, sf, "customer").groupBy("c_mktsegment").agg(a.nearest_rank("c_acctbal", 0.99).alias("p99"), a.nearest_rank("c_acctbal", 0.5).alias("p50"))


@query("a13_trigger_days", """
WITH d AS (SELECT (ts - INTERVAL 5 HOUR)::DATE AS day, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL),
t AS (SELECT quantile_disc(n, 0.8) AS q FROM d) SELECT day, n FROM d, t WHERE n >= q""")
def a13(spark, sf):
    from stormline.plans.spine import daily_counts, trigger_days

    e = table(spark, sf, "events").where("event_type = 'error'").select((F.col("ts") - F.expr("INTERVAL 5 HOURS")).alias("t"))
    return trigger_days(daily_counts(e, F.to_date("t")), 0.8)


@query("a14_cluster_interval", """
WITH b AS (SELECT l_returnflag, l_suppkey, sum(l_discount * l_quantity) AS sv, sum(l_quantity) AS sw FROM lineitem GROUP BY ALL),
t AS (SELECT l_returnflag, sum(sv) / sum(sw) AS mean, sum(sw) AS w, count(*) AS g FROM b GROUP BY ALL)
SELECT l_returnflag, round(mean, 9) AS mean, g AS n_clusters, round(sqrt(sum((sv - mean * sw) ** 2) * g / (g - 1)) / w, 9) AS se FROM b JOIN t USING (l_returnflag) GROUP BY l_returnflag, mean, w, g""")
def a14(spark, sf):
    r = a.cluster_mean(li(spark, sf), ["l_returnflag"], "l_suppkey", "l_discount", "l_quantity")
    return r.select("l_returnflag", F.round("mean", 9).alias("mean"), "n_clusters", F.round("se", 9).alias("se"))


@query("a15_ratio_interval", """
WITH b AS (SELECT l_returnflag, l_shipdate::DATE AS d, sum(l_extendedprice) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY ALL),
t AS (SELECT l_returnflag, sum(n) / sum(q) AS r, avg(q) AS mq, count(*) AS k FROM b GROUP BY ALL),
v AS (SELECT l_returnflag, r, k, mq, sum((n - r * q) ** 2) / (k - 1) AS s2 FROM b JOIN t USING (l_returnflag) GROUP BY l_returnflag, r, k, mq)
SELECT l_returnflag, round(r, 6) AS ratio, round(r - 1.96 * sqrt(s2 / k) / mq, 4) AS lo, round(r + 1.96 * sqrt(s2 / k) / mq, 4) AS hi FROM v""")
def a15(spark, sf):
    from stormline.plans.contrast import ratio_interval

    day = li(spark, sf).groupBy("l_returnflag", F.to_date("l_shipdate").alias("d")).agg(F.sum("l_extendedprice").alias("n"), F.sum("l_quantity").alias("q"))
    return ratio_interval(day, ["l_returnflag"], "n", "q").select("l_returnflag", F.round("ratio", 6).alias("ratio"), F.round("lo", 4).alias("lo"), F.round("hi", 4).alias("hi"))


@query("a16_ranked_codes", """
SELECT day, event_type, n, row_number() OVER (PARTITION BY day ORDER BY n DESC, event_type) AS rank FROM (SELECT ts::DATE AS day, event_type, count(*) AS n FROM events GROUP BY ALL)""")
def a16(spark, sf):
    from stormline.plans.versions import ranked_codes

    e = table(spark, sf, "events").select(F.to_date("ts").alias("day"), "event_type")
    return ranked_codes(e, ["day"], "event_type").withColumn("rank", F.col("rank").cast("long"))


@query("a17_children_extremes", "SELECT c_nationkey, max(c_acctbal) AS top, min(c_acctbal) AS low FROM customer GROUP BY c_nationkey")
def a17(spark, sf):
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(F.max("c_acctbal").alias("top"), F.min("c_acctbal").alias("low"))


CONF = """WITH c AS (SELECT source, count(*) FILTER (WHERE p AND t) AS tp, count(*) FILTER (WHERE p AND NOT t) AS fp, count(*) FILTER (WHERE NOT p AND t) AS fn, count(*) FILTER (WHERE NOT p AND NOT t) AS tn
FROM (SELECT source, n_chars >= 1500 AS p, quality = 1 AS t FROM documents JOIN labels USING (doc_id)) GROUP BY source)"""


@query("a18_confusion_skill", CONF + """
SELECT source, tp, fp, fn, tn, round(tp / nullif(tp + fp + fn, 0), 9) AS csi, round(tp / nullif(tp + fn, 0), 9) AS pod, round(fp / nullif(tp + fp, 0), 9) AS far,
  round((tp / nullif(tp + fp, 0)) / nullif((tp + fn) / (tp + fp + fn + tn), 0), 9) AS lift FROM c""")
def a18(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    c = d.groupBy("source").agg(*a.confusion(F.col("n_chars") >= 1500, F.col("quality") == 1))
    r = a.skill(c)
    return r.select("source", "tp", "fp", "fn", "tn", *[F.round(x, 9).alias(x) for x in ("csi", "pod", "far", "lift")])


SCORED = "s AS (SELECT n_chars // 100 AS score, quality AS y FROM documents JOIN labels USING (doc_id))"
CURVE = f"""WITH {SCORED}, g AS (SELECT score, sum(y) AS p, count(*) AS n FROM s GROUP BY score),
c AS (SELECT score, p, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS alerts, sum(p) OVER () AS pos, sum(n) OVER () AS total FROM g)"""


def scored(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(F.expr("n_chars div 100").alias("score"), F.col("quality").alias("y"))


@query("a19_average_precision", CURVE + " SELECT round(sum(p / pos * tp / alerts), 9) AS average_precision FROM c")
def a19(spark, sf):
    return a.average_precision(scored(spark, sf), "score", "y").select(F.round("average_precision", 9).alias("average_precision"))


@query("a20_best_threshold", CURVE + """
SELECT score AS threshold, round(tp / (alerts - tp + pos), 9) AS csi, round(alerts / total, 9) AS alert_rate FROM c ORDER BY tp / (alerts - tp + pos) DESC, score DESC LIMIT 1""")
def a20(spark, sf):
    return a.best_threshold(scored(spark, sf), "score", "y").select("threshold", F.round("csi", 9).alias("csi"), F.round("alert_rate", 9).alias("alert_rate"))


@query("a21_cluster_bootstrap")
def a21(spark, sf):
    return a.bootstrap_ratio(li(spark, sf), "l_suppkey", "l_extendedprice", "l_quantity", 200, 5)


@query("a22_median_of_medians", """
WITH m AS (SELECT n_regionkey, c_nationkey, median(c_acctbal) AS m FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT n_regionkey, round(median(m), 4) AS peer_level, count(*) AS n_peers FROM m GROUP BY n_regionkey""")
def a22(spark, sf):
    from stormline.plans.impact import peer_level

    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return peer_level(c, ["n_regionkey"], "c_nationkey", "c_acctbal").select("n_regionkey", F.round("peer_level", 4).alias("peer_level"), "n_peers")


@query("a23_expected_by_mix", """
WITH r AS (SELECT l_partkey, sum(l_extendedprice) / sum(l_quantity) / 100 AS ratio FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey)
SELECT l_suppkey, round(sum(l_quantity * ratio), 4) AS expected, round(count(ratio) / count(*), 9) AS known FROM lineitem LEFT JOIN r USING (l_partkey) GROUP BY l_suppkey""")
def a23(spark, sf):
    from stormline.plans.impact import expected_by_mix

    ratios = li(spark, sf).where("l_returnflag = 'R'").groupBy("l_partkey").agg((F.sum("l_extendedprice") / F.sum("l_quantity") / 100).alias("ratio"))
    r = expected_by_mix(li(spark, sf), ratios, ["l_suppkey"], "l_partkey", "l_quantity", "ratio")
    return r.select("l_suppkey", F.round("expected", 4).alias("expected"), F.round("known", 9).alias("known"))


@query("a24_drop_census", """
SELECT count(*) AS n, count(*) FILTER (WHERE l_quantity < 5) AS too_small, count(*) FILTER (WHERE l_quantity >= 5 AND l_returnflag = 'R') AS returned, count(*) FILTER (WHERE l_quantity >= 5 AND l_returnflag <> 'R') AS kept FROM lineitem""")
def a24(spark, sf):
    small, back = F.col("l_quantity") < 5, F.col("l_returnflag") == "R"
    return li(spark, sf).agg(F.count("*").alias("n"), a.count_if(small).alias("too_small"), a.count_if(~small & back).alias("returned"), a.count_if(~small & ~back).alias("kept"))


@query("a25_static_violations", """
SELECT l_suppkey, count(DISTINCT (l_returnflag, l_linestatus)) AS n_variants FROM lineitem GROUP BY l_suppkey HAVING count(DISTINCT (l_returnflag, l_linestatus)) > 1""")
def a25(spark, sf):
    return a.static_violations(li(spark, sf), ["l_suppkey"], ["l_returnflag", "l_linestatus"])


@query("a26_set_digest", """
SELECT n_regionkey, count(*) AS n, sum(('0x' || substr(h, 1, 13))::BIGINT)::VARCHAR AS lo, sum(('0x' || substr(h, 14, 13))::BIGINT)::VARCHAR AS hi
FROM (SELECT n_regionkey, sha256('n_name=' || n_name || chr(31) || 'n_nationkey=' || n_nationkey || chr(31) || 'n_regionkey=' || n_regionkey) AS h FROM nation) GROUP BY n_regionkey""")
def a26(spark, sf):
    return a.set_digest(table(spark, sf, "nation"), ["n_regionkey"]).select("n_regionkey", "n", F.col("lo").cast("string").alias("lo"), F.col("hi").cast("string").alias("hi"))


@query("a27_quantile_knots", """
SELECT c_mktsegment, round(quantile_cont(c_acctbal, 0.25), 4) AS q25, round(quantile_cont(c_acctbal, 0.5), 4) AS q50, round(quantile_cont(c_acctbal, 0.9), 4) AS q90 FROM customer GROUP BY c_mktsegment""")
def a27(spark, sf):
    k = table(spark, sf, "customer").groupBy("c_mktsegment").agg(a.knots("c_acctbal").alias("k"))
    return k.select("c_mktsegment", *[F.round(F.get("k", F.lit(i)), 4).alias(f"q{i}") for i in (25, 50, 90)])


@query("a28_rank_correlation", """
WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS ra, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS rb FROM lineitem)
SELECT round(corr(ra, rb), 8) AS spearman FROM r""")
def a28(spark, sf):
    return a.rank_correlation(li(spark, sf), "l_quantity", "l_extendedprice").select(F.round("spearman", 8).alias("spearman"))


@query("a29_least_squares", """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept, round(corr(l_extendedprice, l_quantity), 8) AS r FROM lineitem GROUP BY l_returnflag""")
def a29(spark, sf):
    y, x = "l_extendedprice", "l_quantity"
    return li(spark, sf).groupBy("l_returnflag").agg(
        F.round(F.regr_slope(y, x), 4).alias("slope"), F.round(F.regr_intercept(y, x), 2).alias("intercept"), F.round(F.corr(y, x), 8).alias("r"))


@query("a30_lagged_correlation", f"""
WITH {RAIN}, s AS (SELECT unnest([-1, 0, 1]) AS lag_h)
SELECT lag_h, round(corr(x.mm, y.mm), 8) AS r, count(*) AS n FROM s JOIN rain x ON true JOIN rain y ON y.cell = (x.cell + 1) % 25 AND y.h = x.h + lag_h WHERE x.mm IS NOT NULL AND y.mm IS NOT NULL GROUP BY lag_h""")
def a30(spark, sf):
    from stormline.plans.rainfall import lagged_correlation

    r = rain(spark, sf).where("mm IS NOT NULL")
    other = r.select(((F.col("cell") + 24) % 25).alias("cell"), "h", F.col("mm").alias("other"))
    return lagged_correlation(r, other, ["cell"], "h", "mm", "other", [-1, 0, 1]).select("lag_h", F.round("r", 8).alias("r"), "n")
