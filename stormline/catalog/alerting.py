"""D20 on whole tables: alert texts about stations, one captured row a line item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.plans import alerts
from stormline.registry import query, table

TEMPLATES = (
    "We are removing water from the tracks at {x}.",
    "Trains are bypassing {x} as crews are removing water from the tracks.",
    "No trains run to {x} or {y} after we removed water from the tracks.",
    "After we removed water from the tracks between {x} and {y}, expect delays.",
    "Flood mitigation work: we are removing water from the tracks at {x}.",
    "Reminder: we remove water from the tracks at {x}. Trains stop at {y}.",
)
EDITED = "What happened? We removed water from the tracks near the {x}."


def stations(spark, sf) -> DataFrame:
    """Suppliers as stations: streets, avenues that a nation shares, and two-part names whose parts are aliases too."""
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    k, street = F.col("s_suppkey"), F.concat((F.col("s_suppkey") % 40 + 1).cast("string"), F.lit("th Street"))
    name = F.when(k % 3 == 0, street).when(k % 3 == 1, F.concat("n_name", F.lit(" Avenue"))).otherwise(F.concat(F.col("n_name"), F.lit(" Blvd-"), street))
    letter = lambda n: F.char(F.lit(65) + n % 5)
    return s.select(k.alias("asset_id"), name.alias("name"), F.expr("s_suppkey div 2").alias("complex_id"), F.array(letter(k), letter(F.expr("s_suppkey div 5"))).alias("routes"))


def captured(spark, sf) -> DataFrame:
    """Line items as captured rows of their order's alert; some texts are edited in place."""
    li = table(spark, sf, "lineitem")
    ends = li.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("x"), F.max("l_suppkey").alias("y"))
    names = stations(spark, sf).select("asset_id", "name")
    said = li.join(ends, "l_orderkey").join(names.toDF("x", "nx"), "x").join(names.toDF("y", "ny"), "y")
    t = F.col("l_orderkey") % 6
    text = F.when((t == 0) & (F.col("l_linenumber") > 4), F.lit(EDITED))
    for i, template in enumerate(TEMPLATES):
        text = text.when(t == i, F.lit(template))
    header = F.replace(F.replace(text, F.lit("{x}"), F.col("nx")), F.lit("{y}"), F.col("ny"))
    return said.select(
        F.concat(F.lit("lmm:alert:"), F.expr("l_orderkey div 2").cast("string"), F.lit(":"), (F.col("l_orderkey") % 2).cast("string")).alias("alert_id"), header.alias("header"),
        F.when(F.col("l_orderkey") % 5 == 0, "Allow more time.").alias("description"), F.char(F.lit(65) + F.col("l_linenumber") % 5).alias("route_id"),
        F.expr("l_orderkey div 10 * 10 + l_linenumber").alias("fetched_at"),
    )


#: The SQL knows which stations each template blames, and only resolves their names; it searches no text.
STATIONS = """st AS (
  SELECT s_suppkey AS asset_id, s_suppkey // 2 AS complex_id, [chr((65 + s_suppkey % 5)::INTEGER), chr((65 + s_suppkey // 5 % 5)::INTEGER)] AS routes,
         CASE s_suppkey % 3 WHEN 0 THEN (s_suppkey % 40 + 1) || 'th Street' WHEN 1 THEN n_name || ' Avenue' ELSE n_name || ' Blvd-' || (s_suppkey % 40 + 1) || 'th Street' END AS name,
         replace(n_name, '_', ' ') AS nn, (s_suppkey % 40 + 1) || ' ST' AS street FROM supplier JOIN nation ON s_nationkey = n_nationkey
), full_names AS (
  SELECT *, CASE asset_id % 3 WHEN 0 THEN street WHEN 1 THEN nn || ' AV' ELSE nn || ' BLVD ' || street END AS alias FROM st
), aliases AS (
  SELECT alias, asset_id, complex_id, routes, name FROM full_names
  UNION ALL SELECT nn || ' BLVD', asset_id, complex_id, routes, name FROM full_names WHERE asset_id % 3 = 2
  UNION ALL SELECT street, asset_id, complex_id, routes, name FROM full_names WHERE asset_id % 3 = 2
), texts AS (
  SELECT l_orderkey AS o, l_orderkey % 6 AS t, l_orderkey % 6 = 0 AND l_linenumber > 4 AS edited, min(l_orderkey // 10 * 10 + l_linenumber) AS first_seen,
         max(l_orderkey // 10 * 10 + l_linenumber) AS last_seen, count(*) AS n_rows FROM lineitem GROUP BY ALL
), ends AS (
  SELECT l_orderkey AS o, min(l_suppkey) AS x, max(l_suppkey) AS y, list(DISTINCT chr((65 + l_linenumber % 5)::INTEGER)) AS routes FROM lineitem GROUP BY ALL
), blamed AS (
  SELECT DISTINCT t.o, t.edited, alias, e.routes FROM texts t JOIN ends e USING (o) JOIN full_names f ON f.asset_id = e.x WHERE t.t IN (0, 1, 3)
  UNION SELECT DISTINCT t.o, t.edited, alias, e.routes FROM texts t JOIN ends e USING (o) JOIN full_names f ON f.asset_id = e.y WHERE t.t = 3
), may AS (
  SELECT b.o, b.edited, b.alias, a.complex_id, a.name, list_has_any(a.routes, b.routes) AS fits FROM blamed b JOIN aliases a USING (alias)
), one AS (
  SELECT o, edited, alias, min(complex_id) AS complex_id, min(name) AS name
  FROM (SELECT *, bool_or(fits) OVER (PARTITION BY o, edited, alias) AS any_fits FROM may) WHERE fits OR NOT any_fits GROUP BY ALL HAVING count(DISTINCT complex_id) = 1
), hit AS (SELECT o, edited, complex_id, min(name) AS name FROM one GROUP BY ALL)
"""


@query("d20_alert_extraction", f"""
WITH {STATIONS}
SELECT (h.o // 2)::VARCHAR AS event_id, complex_id, min(name) AS name, min(first_seen) AS first_seen, max(last_seen) AS last_seen,
       arg_max(CASE WHEN t = 3 OR h.edited THEN 'cleared' ELSE 'active' END, last_seen * 2 + h.o % 2) AS state,
       array_to_string(list_sort(list(DISTINCT 'lmm:alert:' || (h.o // 2) || ':' || h.o % 2)), ',') AS alert_ids, count(*) AS n_revisions, sum(n_rows)::BIGINT AS n_rows
FROM hit h JOIN texts USING (o, edited) GROUP BY ALL""")
def d20_extraction(spark, sf):
    out = alerts.alert_observations(captured(spark, sf), alerts.station_aliases(stations(spark, sf)))
    return out.withColumn("alert_ids", F.array_join("alert_ids", ","))
