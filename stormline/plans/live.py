"""Live tables: enrichment of micro-batches, the next-stop reduction and views of the last hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stormline.operators.joins import with_cell
from stormline.operators.windows import latest_by


def parsed(messages: DataFrame, schema: str | StructType) -> DataFrame:
    """JSON messages as rows; what can't be parsed has no fetched_at and is dropped."""
    return messages.select(F.from_json("value", schema).alias("m")).select("m.*").where(F.col("fetched_at").isNotNull())


def next_stop(predictions: DataFrame, at: str = "header_ts") -> DataFrame:
    """One row a (trip, vehicle, fetch): the first stop that lies ahead by the feed's own clock.

    A trip whose stops all lie behind keeps its row without a stop.
    """
    ahead = F.when(F.col("arrival_time") >= F.col(at), F.col("arrival_time"))
    df = predictions.withColumn("_ahead", ahead)
    one = latest_by(df, ["trip_id", "vehicle_id", "fetched_at"], [F.col("_ahead").asc_nulls_last(), F.col("stop_sequence").asc_nulls_last()])
    known = F.col("_ahead").isNotNull()
    return one.select("trip_id", "vehicle_id", "fetched_at", F.when(known, F.col("stop_id")).alias("next_stop_id"), F.col("_ahead").alias("next_arrival"))


def enriched(batch: DataFrame, zones: DataFrame | None, rain: DataFrame | None, now_hour: int | None = None) -> DataFrame:
    """Cell, zone and the rain of the newest whole hour beside each position; a missing table gives nulls.

    Zones have a row a cell, and rain is cut to one hour with a row a cell; the planner sends them out or deals them by cell as their sizes ask.
    """
    df = with_cell(batch)
    df = df.join(zones.select("cell", "zone"), "cell", "left") if zones is not None else df.withColumn("zone", F.lit(None).cast("int"))
    if rain is None:
        return df.withColumn("mm_1h", F.lit(None).cast("double")).withColumn("rain_hour", F.lit(None).cast("long"))
    known = rain if now_hour is None else rain.where(F.col("h") <= now_hour)
    newest = known.agg(F.max("h").alias("h"))
    hour = latest_by(known.join(F.broadcast(newest), "h"), ["cell"], [F.desc("fetched_at")])  # one row
    return df.join(hour.select("cell", F.col("mm").alias("mm_1h")), "cell", "left").crossJoin(F.broadcast(newest.withColumnRenamed("h", "rain_hour")))


def live_view(positions: DataFrame, predictions: DataFrame, now_s: int, most_age_s: int = 900) -> DataFrame:
    """The last position of each vehicle that is recent enough, its age, and its next stop by the newest fetch."""
    last = latest_by(positions.where(F.col("ts").between(now_s - most_age_s, now_s)), ["vehicle_id"], [F.desc("ts"), F.desc("fetched_at")])
    newest = latest_by(predictions, ["trip_id", "vehicle_id"], [F.desc("fetched_at")])
    return last.withColumn("age_s", F.lit(now_s) - F.col("ts")).join(newest.select("trip_id", "vehicle_id", "next_stop_id", "next_arrival"), ["trip_id", "vehicle_id"], "left")


def dead_hours(polls: DataFrame, keys: list[str], cadence_s: int, need: int) -> DataFrame:
    """Hours that were polled throughout, had one header only and no gap longer than the cadence."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys, "hour").orderBy("fetched_at")
    gaps = polls.withColumn("_gap", F.col("fetched_at") - F.lag("fetched_at").over(w))
    by = gaps.groupBy(*keys, "hour").agg(F.count("*").alias("n_polls"), F.countDistinct("header_ts").alias("n_headers"), F.max("_gap").alias("longest_gap"))
    return by.where((F.col("n_polls") >= need) & (F.col("n_headers") == 1) & (F.coalesce("longest_gap", F.lit(0)) <= cadence_s))


def stream_table(spark: SparkSession, path: str, schema: StructType, most_files: int | None = None) -> DataFrame:
    """A stream of the Parquet files that land in a folder, at most `most_files` a batch."""
    reader = spark.readStream.schema(schema)
    return (reader if most_files is None else reader.option("maxFilesPerTrigger", most_files)).parquet(path)
