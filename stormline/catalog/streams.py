"""S and X: sources, sinks and streams. Each writes to a folder of its own and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormline.catalog.joins import cell_sql, crosswalk, pixels  # noqa: F401
from stormline.catalog.roles import PINGS, RAIN, pings, rain
from stormline.operators import joins
from stormline.operators.scratch import shared_dir
from stormline.plans import live
from stormline.registry import query, table
from stormline.sources import archives, lake
from stormline.streaming import drain


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the folder that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def dated(spark, sf) -> DataFrame:
    p = pings(spark, sf)
    return p.withColumn("date", F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd")).withColumn("hour", F.date_format(F.timestamp_seconds("ts"), "HH"))


@query("s1_service_day_read", f"WITH {PINGS} SELECT count(*) AS n, count(DISTINCT vehicle_id) AS n_vehicles, count(CASE WHEN ts % 86400 >= 21600 AND event_id % 2 = 0 THEN 1 END) AS n_relation FROM pings WHERE ts < 1704067200 + 172800")
def s1(spark, sf):
    path = folder(spark, "bronze")
    d = dated(spark, sf)
    d.where("hour < '06'").write.partitionBy("date", "hour").parquet(path)
    # A later era has one column more.
    d.where("hour >= '06'").withColumn("relation", F.when(F.col("event_id") % 2 == 0, F.col("event_id"))).write.mode("append").partitionBy("date", "hour").parquet(path)
    day = lake.service_day(spark, path, "2024-01-01", ["relation"], {"relation": "bigint"})
    return day.agg(F.count("*").alias("n"), F.countDistinct("vehicle_id").alias("n_vehicles"), F.count("relation").alias("n_relation"))


@query("s3_pick_partitions", "SELECT pick_id, count(*) AS n FROM (SELECT 'P' || (o_orderkey % 6) AS pick_id FROM orders) WHERE pick_id IN ('P1', 'P4') GROUP BY pick_id")
def s3(spark, sf):
    path = folder(spark, "picks")
    table(spark, sf, "orders").withColumn("pick_id", F.expr("concat('P', o_orderkey % 6)")).write.partitionBy("pick_id").parquet(path)
    return lake.read_picks(spark, path, ["P1", "P4"]).groupBy("pick_id").agg(F.count("*").alias("n"))


@query("s4_string_partition_keys", "SELECT DISTINCT '0' || (o_orderkey % 4) AS k FROM orders")
def s4(spark, sf):
    path = folder(spark, "keys")
    table(spark, sf, "orders").select("o_orderkey", F.expr("concat('0', o_orderkey % 4)").alias("k")).write.partitionBy("k").parquet(path)
    df = spark.read.schema("o_orderkey long, k string").parquet(path)
    return df.select("k").distinct()


@query("s5_era_columns", "SELECT count(*) AS n, count(CAST(NULL AS VARCHAR)) AS n_relation FROM events")
def s5(spark, sf):
    e = lake.with_columns(table(spark, sf, "events"), {"relation": "string", "header_ts": "long"})
    return e.agg(F.count("*").alias("n"), F.count("relation").alias("n_relation"))


@query("s6_csv_to_bronze", f"WITH {PINGS} SELECT vehicle_id, count(*) AS n, min(ts) AS first_ts, count(trip_id) AS n_trip, 0::BIGINT AS n_direction FROM pings WHERE ts >= 1704067200 + 3600 AND ts < 1704067200 + 36000 GROUP BY vehicle_id")
def s6(spark, sf):
    path = folder(spark, "csv")
    p = pings(spark, sf).select(F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "vehicle_id", "trip_id", "route_id", "start_date", "stop_id", "lat", "lon", F.lit(0).alias("direction_id"))
    p.write.option("header", "true").csv(path)
    bronze = archives.to_bronze(archives.read_capture(spark, path), 1704067200 + 3600, 1704067200 + 36000, ["direction_id"])
    return bronze.groupBy("vehicle_id").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.count("trip_id").alias("n_trip"), F.count("direction_id").alias("n_direction"))


@query("s7_csv_schedule", f"WITH {PINGS} SELECT trip_id, count(*) AS n, max(seq * 80)::INTEGER AS last_arrival_s FROM pings WHERE trip_id IS NOT NULL GROUP BY trip_id")
def s7(spark, sf):
    path = folder(spark, "stop_times")
    s = F.col("seq") * 80
    hms = F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
    pings(spark, sf).where("trip_id IS NOT NULL").select("trip_id", hms.alias("arrival_time"), hms.alias("departure_time"), "stop_id", F.col("seq").alias("stop_sequence")).write.option("header", "true").csv(path)
    raw = spark.read.option("header", "true").schema("trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int").csv(path)
    return archives.stop_times(raw, "P1").groupBy("trip_id").agg(F.count("*").alias("n"), F.max("arrival_s").alias("last_arrival_s"))


@query("s8_json_reports", "SELECT event_type AS kind, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS k FROM events GROUP BY event_type")
def s8(spark, sf):
    path = folder(spark, "json")
    table(spark, sf, "events").select(F.to_json(F.struct("event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))).alias("value")).write.text(path)
    return spark.read.schema("event_type string, k long").json(path).groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("n"), F.sum("k").alias("k"))


@query("s10_snapshot_slice", f"WITH {PINGS} SELECT count(*) AS n FROM pings WHERE fetched_at IN (SELECT max(fetched_at) FROM pings GROUP BY fetched_at // 3600)")
def s10(spark, sf):
    p = pings(spark, sf)
    chosen = p.select("fetched_at").groupBy(F.expr("fetched_at div 3600").alias("h")).agg(F.max("fetched_at").alias("fetched_at"))
    return p.join(chosen.select("fetched_at"), "fetched_at", "left_semi").agg(F.count("*").alias("n"))


@query("s11_partition_rebuild", "SELECT o_orderstatus, count(*) AS n, round(sum(CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END * o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus")
def s11(spark, sf):
    path = folder(spark, "rebuild")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    lake.rebuild(o, path, ["o_orderstatus"], ["o_orderkey"])
    for _ in range(2):  # again changes nothing, and the neighbours stay
        lake.rebuild(o.where("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") * 2), path, ["o_orderstatus"], ["o_orderkey"])
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s14_json_payload", "SELECT n_regionkey, '{\"key\":' || max(n_nationkey) || ',\"name\":\"' || max(n_name) || '\"}' AS payload FROM nation GROUP BY n_regionkey")
def s14(spark, sf):
    from stormline.operators.aggregates import grouped_pairs

    g = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.max("n_nationkey").alias("k"), F.max("n_name").alias("v"))
    return g.select("n_regionkey", grouped_pairs({"name": F.col("v"), "key": F.col("k"), "absent": F.lit(None).cast("string")}).alias("payload"))


@query("s16_asset_registry", """
SELECT kind, count(*) AS n, count(DISTINCT asset_id) AS n_ids FROM (SELECT 'stop' AS kind, 'stop:' || c_custkey AS asset_id FROM customer UNION ALL SELECT 'station', 'station:' || s_suppkey FROM supplier UNION ALL SELECT 'cell', 'cell:' || n_nationkey FROM nation) GROUP BY kind""")
def s16(spark, sf):
    from stormline.sources.registry import assets

    stop = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    station = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    cell = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    r = assets({"stop": stop, "station": station, "cell": cell})
    return r.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("asset_id").alias("n_ids"))


def landed(spark, sf, name: str, df: DataFrame, parts: int = 4) -> DataFrame:
    """`df` as files that a stream reads."""
    path = folder(spark, name)
    df.repartition(parts).write.parquet(path)
    return live.stream_table(spark, path, df.schema)


@query("x2_stream_append", f"""
WITH {PINGS} SELECT strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y-%m-%d') AS date, strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%H') AS hour, count(*) AS n FROM (SELECT DISTINCT vehicle_id, ts FROM pings) GROUP BY ALL""")
def x2(spark, sf):
    from stormline.operators.windows import latest_by

    stream, out = landed(spark, sf, "landing", pings(spark, sf)), folder(spark, "live")
    one = lambda b: latest_by(b, ["vehicle_id", "ts"], [F.desc("fetched_at")])
    drain.drain(drain.append_stream(stream, out, folder(spark, "state"), "ts", one))
    seen = latest_by(spark.read.schema("vehicle_id string, ts long, fetched_at long, date string, hour string").parquet(out), ["vehicle_id", "ts"], [F.desc("fetched_at")])
    return seen.groupBy("date", "hour").agg(F.count("*").alias("n"))


@query("x3_next_stop", """
WITH p AS (SELECT l_orderkey AS trip_id, l_suppkey % 3 AS vehicle_id, l_partkey % 2 AS fetched_at, l_linenumber AS stop_sequence, l_linenumber * 100 + l_partkey % 50 AS arrival_time, 's' || l_linenumber AS stop_id, 350 AS header_ts, l_partkey, l_suppkey FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY trip_id, vehicle_id, fetched_at ORDER BY CASE WHEN arrival_time >= header_ts THEN arrival_time END NULLS LAST, stop_sequence) AS k FROM p)
SELECT trip_id, vehicle_id, fetched_at, CASE WHEN arrival_time >= header_ts THEN stop_id END AS next_stop_id, CASE WHEN arrival_time >= header_ts THEN arrival_time END AS next_arrival FROM r WHERE k = 1""")
def x3(spark, sf):
    p = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("trip_id"), (F.col("l_suppkey") % 3).alias("vehicle_id"), (F.col("l_partkey") % 2).alias("fetched_at"), F.col("l_linenumber").alias("stop_sequence"), (F.col("l_linenumber") * 100 + F.col("l_partkey") % 50).alias("arrival_time"), F.concat(F.lit("s"), F.col("l_linenumber").cast("string")).alias("stop_id"), F.lit(350).alias("header_ts"))
    return live.next_stop(p)


@query("x4_enriched_positions", f"""
WITH {RAIN}, {PINGS}, {cell_sql('pings')}, k AS (SELECT DISTINCT cell FROM g), newest AS (SELECT max(h) AS h FROM rain WHERE h <= 100),
z AS (SELECT cell, cell % 7 AS zone FROM k WHERE cell % 5 <> 0), fell AS (SELECT k.cell, rain.mm FROM k JOIN rain ON rain.cell = k.cell % 25 JOIN newest USING (h))
SELECT zone, count(*) AS n, count(mm) AS n_rain, round(sum(mm), 6) AS mm, max(newest.h) AS rain_hour FROM g LEFT JOIN z USING (cell) LEFT JOIN fell USING (cell), newest GROUP BY zone""")
def x4(spark, sf):
    p = pings(spark, sf)
    cells = joins.with_cell(p).select("cell").distinct()
    falls = rain(spark, sf).withColumnRenamed("cell", "area").join(cells, F.col("area") == F.col("cell") % 25)
    zones = cells.where("cell % 5 <> 0").withColumn("zone", F.expr("cell % 7"))
    e = live.enriched(p, zones, falls.withColumn("fetched_at", F.lit(1)), 100)
    return e.groupBy("zone").agg(F.count("*").alias("n"), F.count("mm_1h").alias("n_rain"), F.round(F.sum("mm_1h"), 6).alias("mm"), F.max("rain_hour").alias("rain_hour"))


@query("x5_json_stream", f"WITH {PINGS} SELECT vehicle_id, count(*) AS n FROM pings WHERE event_id % 50 <> 0 GROUP BY vehicle_id")
def x5(spark, sf):
    msg = F.when(F.col("event_id") % 50 != 0, F.to_json(F.struct("vehicle_id", "ts", "fetched_at"))).otherwise("{broken")
    stream = live.parsed(landed(spark, sf, "messages", pings(spark, sf).select(msg.alias("value"))), "vehicle_id string, ts long, fetched_at long")
    out, heard = folder(spark, "json-live"), []
    drain.drain(drain.append_stream(stream, out, folder(spark, "state"), "ts", lambda b: b, lambda b, n: heard.append((b, n))))
    return spark.read.parquet(out).groupBy("vehicle_id").agg(F.count("*").alias("n"))


@query("x7_live_view", f"""
WITH {PINGS}, c AS (SELECT * FROM pings WHERE ts BETWEEN 1704067200 + 19100 AND 1704067200 + 20000), l AS (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC, fetched_at DESC, direction_id, event_id) AS r FROM c)
SELECT vehicle_id, event_id, 1704067200 + 20000 - ts AS age_s FROM l WHERE r = 1""")
def x7(spark, sf):
    none = spark.createDataFrame([], "trip_id string, vehicle_id string, fetched_at long, next_stop_id string, next_arrival long")
    return live.live_view(pings(spark, sf), none, 1704067200 + 20000).select("vehicle_id", "event_id", "age_s")


@query("x9_snapshot_thinning")
def x9(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("feed"), F.to_date("ts").alias("day"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("fetched_at"), F.expr("event_id div 3").alias("header_ts"))
    return archives.chosen_snapshots(e, "header_ts", 1800)


@query("x10_dead_hours", """
WITH p AS (SELECT event_type AS feed, epoch(ts)::BIGINT // 3600 AS hour, floor(epoch(ts))::BIGINT AS fetched_at, (floor(epoch(ts))::BIGINT // 7200) AS header_ts FROM events), g AS (SELECT *, fetched_at - lag(fetched_at) OVER (PARTITION BY feed, hour ORDER BY fetched_at) AS gap FROM p)
SELECT feed, hour, count(*) AS n_polls, count(DISTINCT header_ts) AS n_headers, max(gap) AS longest_gap FROM g GROUP BY ALL HAVING count(*) >= 3 AND count(DISTINCT header_ts) = 1 AND coalesce(max(gap), 0) <= 1500""".replace("epoch(ts)::BIGINT // 3600", "floor(epoch(ts))::BIGINT // 3600"))
def x10(spark, sf):
    s = F.unix_timestamp(F.col("ts").cast("timestamp"))
    p = table(spark, sf, "events").select(F.col("event_type").alias("feed"), F.floor(s / 3600).alias("hour"), s.alias("fetched_at"), F.floor(s / 7200).alias("header_ts"))
    return live.dead_hours(p, ["feed"], 1500, 3)


@query("x11_stateful_latch", f"""
WITH {RAIN} SELECT cell::VARCHAR AS unit, h // 24 * 24 AS anchor, h, max(CASE WHEN mm >= 2 THEN 2 WHEN mm >= 1 THEN 1 ELSE 0 END) OVER (PARTITION BY cell, h // 24 ORDER BY h) AS latched FROM rain""")
def x11(spark, sf):
    r = rain(spark, sf).select(F.col("cell").cast("string").alias("unit"), "h", F.expr("CASE WHEN mm >= 2 THEN 2 WHEN mm >= 1 THEN 1 ELSE 0 END").alias("level"))
    out = folder(spark, "latched")
    stream = drain.latch_levels(landed(spark, sf, "levels", r, 1), 24)
    drain.drain(stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", folder(spark, "state")))
    return spark.read.schema(drain.LATCH).parquet(out).select("unit", "anchor", "h", "latched")


@query("x12_hourly_windows", """
SELECT epoch(date_trunc('hour', ts) + INTERVAL 1 HOUR)::BIGINT AS hour_end_s, event_type, count(*) AS n FROM events WHERE date_trunc('hour', ts) < (SELECT date_trunc('hour', max(ts)) FROM events) GROUP BY ALL""")
def x12(spark, sf):
    e = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("t"), "event_type")
    out = folder(spark, "hours")
    hours = drain.hourly(landed(spark, sf, "hourly", e, 1), "t", "0 seconds", F.count("*").alias("n"), keys=("event_type",))
    drain.drain(hours.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", folder(spark, "state")))
    return spark.read.schema("hour_end timestamp, event_type string, n long").parquet(out).select(F.unix_timestamp("hour_end").alias("hour_end_s"), "event_type", "n")


@query("s9_json_source", f"WITH {PINGS} SELECT count(*) AS n, count(DISTINCT vehicle_id) AS n_vehicles FROM pings WHERE event_id % 40 <> 0")
def s9(spark, sf):
    msg = F.when(F.col("event_id") % 40 != 0, F.to_json(F.struct("vehicle_id", "ts", "fetched_at"))).otherwise("not json")
    p = live.parsed(pings(spark, sf).select(msg.alias("value")), "vehicle_id string, ts long, fetched_at long")
    return p.agg(F.count("*").alias("n"), F.countDistinct("vehicle_id").alias("n_vehicles"))


@query("s12_event_time_append", f"""
WITH {PINGS} SELECT strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%H') AS hour, count(*) AS n, min(ts) AS first_ts FROM pings GROUP BY ALL""")
def s12(spark, sf):
    out = folder(spark, "by-time")
    p = pings(spark, sf).drop("hour", "date")
    lake.append_by_event_time(p.where("event_id % 2 = 0"), out, "ts")
    lake.append_by_event_time(p.where("event_id % 2 = 1"), out, "ts")
    df = spark.read.schema("event_id long, ts long, date string, hour string").parquet(out)
    return df.groupBy("hour").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"))


@query("x1_two_streams", f"WITH {PINGS} SELECT 'positions' AS topic, count(*) AS n FROM pings UNION ALL SELECT 'predictions', count(*) FROM pings WHERE trip_id IS NOT NULL")
def x1(spark, sf):
    p = pings(spark, sf).select("vehicle_id", "trip_id", "ts", "fetched_at")
    topics = {"positions": p, "predictions": p.where("trip_id IS NOT NULL")}
    out = {name: folder(spark, name) for name in topics}
    drain.drain_all([drain.append_stream(landed(spark, sf, f"{name}-in", df), out[name], folder(spark, "state"), "ts", lambda b: b) for name, df in topics.items()])
    counts = [spark.read.parquet(path).agg(F.lit(name).alias("topic"), F.count("*").alias("n")) for name, path in out.items()]
    return counts[0].union(counts[1])


@query("x8_replayed_rows", f"""
WITH {PINGS} SELECT strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%H') AS hour, count(*) AS n FROM (SELECT DISTINCT vehicle_id, ts FROM pings) GROUP BY ALL""")
def x8(spark, sf):
    from stormline.operators.windows import latest_by

    out = folder(spark, "replay")
    p = pings(spark, sf).select("vehicle_id", "ts", "fetched_at")
    for late in (0, 7200):  # the same rows again, two hours later, land where they belong
        again = p.withColumn("fetched_at", F.col("fetched_at") + late)
        drain.drain(drain.append_stream(landed(spark, sf, "again", again), out, folder(spark, "state"), "ts", lambda b: b))
    rows = spark.read.schema("vehicle_id string, ts long, fetched_at long, date string, hour string").parquet(out)
    return latest_by(rows, ["vehicle_id", "ts"], [F.desc("fetched_at")]).groupBy("hour").agg(F.count("*").alias("n"))
