"""S9, X5, X11 and X12 as streams of many files: caps, late rows, rolling state, sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.catalog.roles import DAY0, PINGS, RAIN, pings, rain
from stormline.catalog.streams import folder
from stormline.plans import live
from stormline.registry import query, table
from stormline.streaming import drain

SLICES, FILES = 5, 4


def land(df: DataFrame, path: str, slice_of: str, k: int) -> None:
    """The rows of one slice as FILES more files of a folder."""
    df.where(F.col(slice_of) == k).drop(slice_of).repartition(FILES).write.mode("append").parquet(path)


MESSAGE = "vehicle_id string, ts long, fetched_at long"


@query("s9_capped_stream", f"""
WITH {PINGS} SELECT event_id % {SLICES} AS batch, count(*) AS n_in, count(CASE WHEN event_id % 40 = 0 THEN 1 END) AS n_broken, count(CASE WHEN event_id % 40 <> 0 THEN 1 END) AS n_out FROM pings GROUP BY ALL""")
def s9_capped(spark, sf):
    """Messages under a cap of FILES files a batch; the rows are each batch's own progress."""
    path, out = folder(spark, "messages"), folder(spark, "parsed")
    msg = F.when(F.col("event_id") % 40 != 0, F.to_json(F.struct("vehicle_id", "ts", "fetched_at"))).otherwise("{not json")
    p = pings(spark, sf).select(msg.alias("value"), (F.col("event_id") % SLICES).alias("k"))
    for k in range(SLICES):
        land(p, path, "k", k)
    stream = drain.watched_messages(live.stream_table(spark, path, p.drop("k").schema, FILES), MESSAGE)
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", folder(spark, "state"))
    return spark.createDataFrame(drain.drain_with_progress(writer), drain.PROGRESS)


@query("x12_session_windows", """
WITH e AS (SELECT user_id, floor(epoch(ts))::BIGINT AS s FROM events),
m AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s) <= 25200 THEN 0 ELSE 1 END AS new FROM e),
n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY s) AS session FROM m)
SELECT user_id, min(s) AS first_s, max(s) AS last_s, count(*) AS n FROM n GROUP BY user_id, session""")
def x12_sessions(spark, sf):
    """Sessions of events that come in slices of time; one event in ten comes a slice too late, none beyond the watermark."""
    path, out = folder(spark, "visits"), folder(spark, "sessions")
    at = F.date_trunc("second", F.col("ts").cast("timestamp"))
    e = table(spark, sf, "events").select(at.alias("t"), "user_id", F.least(F.floor((F.dayofmonth("ts") - 1) / 6) + (F.col("event_id") % 10 == 0).cast("long"), F.lit(SLICES)).alias("k"))
    last = spark.range(FILES).select(F.timestamp_seconds(F.lit(DAY0 + 400 * 86400)).alias("t"), F.lit(-1).cast("long").alias("user_id"), F.lit(SLICES + 1).cast("long").alias("k"))  # moves the watermark past all sessions
    both = e.unionByName(last)
    for k in range(SLICES + 2):
        land(both, path, "k", k)
    stream = live.stream_table(spark, path, both.drop("k").schema, FILES)
    found = drain.sessions(stream, "t", "20 days", "7 hours", F.max(F.unix_timestamp("t")).alias("last_s"), F.count("*").alias("n"), keys=("user_id",))
    drain.drain(found.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", folder(spark, "state")))
    rows = spark.read.schema("start timestamp, end timestamp, user_id long, last_s long, n long").parquet(out)
    return rows.where("user_id >= 0").select("user_id", F.unix_timestamp("start").alias("first_s"), "last_s", "n")


LATE = "(cell * 7 + h) % 13 = 0"


@query("x11_rolling_latch", f"""
WITH {RAIN}, r AS (SELECT cell::VARCHAR AS unit, h, h // (24 + 12 * (cell % 2)) * (24 + 12 * (cell % 2)) AS anchor, CASE WHEN mm >= 2 THEN 2 WHEN mm >= 1 THEN 1 ELSE 0 END AS level,
  least(h // 48 + CASE WHEN {LATE} THEN 1 ELSE 0 END, {SLICES - 1}) AS k, cell FROM rain WHERE cell % 5 <> 4 OR h < 48),
s AS (SELECT unit, k, max(anchor) AS top FROM r GROUP BY ALL), b AS (SELECT r.*, coalesce((SELECT max(top) FROM s WHERE s.unit = r.unit AND s.k < r.k), -1) AS before FROM r)
SELECT unit, anchor, count(CASE WHEN anchor >= before THEN 1 END) AS n_live, count(CASE WHEN anchor < before THEN 1 END) AS n_late, max(CASE WHEN anchor >= before THEN level END)::INTEGER AS latched,
       cell % 5 = 4 AND anchor = max(anchor) OVER (PARTITION BY unit) AS closed FROM b GROUP BY unit, anchor, cell""")
def x11_rolling(spark, sf):
    """Levels in five cycles; one in thirteen comes a cycle late, and every fifth unit falls silent."""
    path, out, state = folder(spark, "levels"), folder(spark, "latched"), folder(spark, "state")
    span = "(24 + 12 * (cell % 2))"
    r = rain(spark, sf).where("cell % 5 <> 4 OR h < 48").select(
        F.col("cell").cast("string").alias("unit"), F.expr(f"h div {span} * {span}").alias("anchor"), "h", F.expr("CASE WHEN mm >= 2 THEN 2 WHEN mm >= 1 THEN 1 ELSE 0 END").alias("level"),
        F.expr(f"least(h div 48 + CASE WHEN {LATE} THEN 1 ELSE 0 END, {SLICES - 1})").alias("k"),
    ).withColumn("arrived", F.timestamp_seconds(F.lit(DAY0) + F.col("k") * 86400))
    for k in range(SLICES):  # each cycle finds what has landed since the last one
        land(r, path, "k", k)
        rolled = drain.roll_latches(live.stream_table(spark, path, r.drop("k").schema), "arrived", "0 seconds", 129_600)
        drain.drain(rolled.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", state))
    kind = lambda name: F.col("kind") == name
    return spark.read.schema(drain.ROLLED).parquet(out).groupBy("unit", "anchor").agg(
        F.count(F.when(kind("live"), 1)).alias("n_live"), F.count(F.when(kind("late"), 1)).alias("n_late"), F.max(F.when(kind("live"), F.col("latched"))).alias("latched"), F.bool_or(kind("closed")).alias("closed"),
    )
