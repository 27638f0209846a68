"""Archives and reports: CSV captures, schedules and incident sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormline.functions.texts import or_null
from stormline.functions.times import hms_seconds

PING_CSV = "timestamp string, vehicle_id string, trip_id string, route_id string, start_date string, stop_id string, lat double, lon double, direction_id long"


def read_capture(spark: SparkSession, path: str, schema: str = PING_CSV) -> DataFrame:
    return spark.read.option("header", "true").schema(schema).csv(path)


def to_bronze(raw: DataFrame, lo_s: int, hi_s: int, placeholders: Sequence[str] = ()) -> DataFrame:
    """Captured rows as Bronze rows: empty is null, times are seconds within [lo_s, hi_s), constants go.

    A placeholder column that holds at most one value in the whole capture carries nothing and becomes null.
    """
    df = raw.select(*[or_null(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in raw.dtypes])
    ts = F.unix_timestamp(F.try_to_timestamp(F.col("timestamp")))
    df = df.withColumn("ts", ts).where((F.col("ts") >= lo_s) & (F.col("ts") < hi_s)).drop("timestamp")
    if placeholders:
        n = df.agg(*[F.countDistinct(c).alias(c) for c in placeholders]).first()
        for c in placeholders:
            if n[c] <= 1:
                df = df.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
    t = F.timestamp_seconds("ts")
    return df.withColumn("date", F.date_format(t, "yyyy-MM-dd")).withColumn("hour", F.date_format(t, "HH"))


def stop_times(raw: DataFrame, pick_id: str) -> DataFrame:
    """stop_times rows with seconds past noon less twelve hours instead of H:MM:SS."""
    return raw.select(
        "trip_id", "stop_id", F.col("stop_sequence").cast("int").alias("stop_sequence"), hms_seconds(F.col("arrival_time")).alias("arrival_s"),
        hms_seconds(F.col("departure_time")).alias("departure_s"), F.lit(pick_id).alias("pick_id"))


OBSERVATION = ("source", "source_id", "ts_s", "lon", "lat", "depth_mm", "text")


def observation(df: DataFrame, source: str, **values: Column) -> DataFrame:
    """A source's rows in the one schema of observations; what it doesn't have is null."""
    types = {"source_id": "string", "ts_s": "long", "lon": "double", "lat": "double", "depth_mm": "double", "text": "string"}
    return df.select(F.lit(source).alias("source"), *[values.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()])


def keyword_rows(df: DataFrame, texts: Sequence[str], pattern: str) -> DataFrame:
    """Rows whose joined texts hold a keyword; missing texts are skipped."""
    return df.where(F.upper(F.concat_ws(" ", *texts)).rlike(pattern))


def chosen_snapshots(df: DataFrame, header: str, cadence_s: int, keys: Sequence[str] = ("feed",)) -> DataFrame:
    """Of each feed the snapshots at least `cadence_s` apart whose header is new: a rule in order of time.

    Whether one is kept depends on the one kept before, so each feed's times run through one small loop; feeds and days
    run in parallel. `df` has keys, day, fetched_at and the header.
    """
    import pandas as pd

    by = [*keys, "day"]

    def thin(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["fetched_at", header])
        keep, last, seen = [], None, None
        for at, head in zip(g["fetched_at"], g[header], strict=True):
            ok = (last is None or at - last >= cadence_s) and head != seen
            keep.append(ok)
            if ok:
                last, seen = at, head
        return g[keep]

    heads = df.select(*by, "fetched_at", header).distinct()
    return heads.groupBy(*by).applyInPandas(thin, heads.schema)
