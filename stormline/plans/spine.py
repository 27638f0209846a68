"""The spine of dated events: triggers, runs of days, windows and classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormline.functions.scores import event_class
from stormline.functions.times import LOCAL
from stormline.operators.aggregates import nearest_rank
from stormline.operators.windows import consecutive_hits, day_runs


def daily_counts(df: DataFrame, day: Column) -> DataFrame:
    return df.groupBy(day.alias("day")).agg(F.count("*").alias("n"))


def trigger_days(counts: DataFrame, q: float) -> DataFrame:
    """Days whose count reaches the nearest-rank quantile q of all days' counts."""
    limit = counts.agg(nearest_rank("n", q).alias("limit"))
    return counts.crossJoin(F.broadcast(limit)).where("n >= limit").drop("limit")  # one row on the right


def triggered(days: Mapping[str, DataFrame]) -> DataFrame:
    """(day, one flag a trigger): the union of the triggers' days."""
    every = None
    for name, df in days.items():
        tagged = df.select("day", F.lit(name).alias("trigger"))
        every = tagged if every is None else every.union(tagged)
    return every.groupBy("day").agg(*[F.bool_or(F.col("trigger") == name).alias(name) for name in days])


def events(days: DataFrame, rain: str, tide: str, snow: str) -> DataFrame:
    """Runs of triggered days with what triggered them and their class."""
    runs = day_runs(days, "day")
    span = days.join(runs, F.col("day").between(F.col("first_day"), F.col("last_day")))
    by = span.groupBy("first_day", "last_day", "n_days").agg(*[F.bool_or(c).alias(c) for c in (rain, tide, snow)])
    return by.withColumn("event_id", F.date_format("first_day", "yyyyMMdd")).withColumn("event_class", event_class(F.col(rain), F.col(tide), F.col(snow)))


# The window's margin, tide readings that must follow one another, and what makes a snowmelt.
MARGIN_S, READINGS, SNOW_MONTHS, FREEZING_C = 3 * 3600, 2, (12, 1, 2, 3), 0.0
RAIN_SOURCES = ("reports", "alerts", "storms")


def report_days(reports: DataFrame, q: float = 0.99) -> DataFrame:
    """(day) on which a dataset's daily count reaches its own nearest-rank quantile. `reports`: dataset, day; counts have a row a dataset and day."""
    counts = reports.groupBy("dataset", "day").agg(F.count("*").alias("n"))
    limit = counts.groupBy("dataset").agg(nearest_rank("n", q).alias("limit"))
    return counts.join(limit, "dataset").where("n >= limit").select("day").distinct()


def tide_days(readings: DataFrame, stage: float, step_s: int) -> DataFrame:
    """(day) of local days with tide readings at or above the stage that follow one another, two at least. `readings`: station, ts, level."""
    high = consecutive_hits(readings, ["station"], "ts", step_s, F.col("level") >= stage, READINGS)
    at = high.select(F.explode(F.sequence(F.col("first"), F.col("last"), F.lit(step_s).cast("long"))).alias("at"))
    return at.select(F.to_date(F.from_utc_timestamp(F.timestamp_seconds("at"), LOCAL)).alias("day")).distinct()


def storm_days(storms: DataFrame, counties: Sequence[str], zones: Sequence[str]) -> DataFrame:
    """(day) of every day that a storm row for one of the counties or zones spans. `storms`: kind (C or Z), place, first_day, last_day."""
    ours = ((F.col("kind") == "C") & F.col("place").isin(*counties)) | ((F.col("kind") == "Z") & F.col("place").isin(*zones))
    return storms.where(ours).select(F.explode(F.sequence("first_day", "last_day")).alias("day")).distinct()


def dated_events(days: Mapping[str, DataFrame], spans: DataFrame, highs: DataFrame, tide: str = "tides") -> DataFrame:
    """One row a run of triggered days: its days, window, sources, which sources could have seen it, and its class.

    `days`: by source, the triggered days. `spans`: source, first_day, last_day of what each source covers. `highs`: day and tmax_c.
    The window opens three hours before the first local midnight and closes three hours after the last one, whatever the clocks do. A source covers an event if its
    span holds all the event's days. Snowmelt: some day from December to March with a known high of 0 degrees or less. Days and spans have a row a day and source.
    """
    names = list(days)
    flagged = triggered(days).join(highs.groupBy("day").agg(F.min("tmax_c").alias("tmax_c")), "day", "left")
    snow = F.coalesce(F.month("day").isin(*SNOW_MONTHS) & (F.col("tmax_c") <= FREEZING_C), F.lit(False))
    runs = day_runs(flagged.select("day"), "day")
    inside = runs.withColumn("day", F.explode(F.sequence("first_day", "last_day"))).join(flagged.withColumn("snow", snow), "day")
    by = inside.groupBy("first_day", "last_day", "n_days").agg(*[F.bool_or(n).alias(n) for n in names], F.bool_or("snow").alias("snow"))
    covered = by.select("first_day", "last_day").crossJoin(F.broadcast(spans.select("source", F.col("first_day").alias("_a"), F.col("last_day").alias("_b"))))  # a row a source
    seen = covered.where((F.col("_a") <= F.col("first_day")) & (F.col("last_day") <= F.col("_b"))).groupBy("first_day").agg(F.sort_array(F.collect_set("source")).alias("covered_by"))
    midnight = lambda d: F.unix_timestamp(F.to_utc_timestamp(d.cast("timestamp_ntz").cast("string"), LOCAL))
    rain = F.lit(False)
    for n in names:
        if n in RAIN_SOURCES:
            rain = rain | F.col(n)
    return by.join(seen, "first_day", "left").select(
        F.date_format("first_day", "yyyyMMdd").alias("event_id"), "first_day", "last_day", "n_days", *names, (midnight(F.col("first_day")) - MARGIN_S).alias("window_start"),
        (midnight(F.date_add("last_day", 1)) + MARGIN_S).alias("window_end"), F.coalesce("covered_by", F.array().cast("array<string>")).alias("covered_by"), event_class(rain, F.col(tide), F.col("snow")).alias("event_class"),
    )
