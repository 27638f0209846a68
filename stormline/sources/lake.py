"""Reading and writing partitioned Parquet: eras, pruned days, picks, idempotent rebuilds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormline.functions.scores import need_columns


def read_days(spark: SparkSession, base: str, days: Sequence[str], need: Sequence[str] = (), eras: Mapping[str, str] | None = None) -> DataFrame:
    """The partitions date= of the days, columns united by name over eras; `need` columns must be there.

    Only the folders of these days are listed and opened. `eras` declares the columns (name to type) that later eras
    added: where no file of the days has them, as on a day without rows of that era, they are typed nulls. At least one of the days must have
    a folder.
    """
    df = spark.read.option("mergeSchema", "true").option("basePath", base).parquet(f"{base}/date={{{','.join(days)}}}")
    return need_columns(with_columns(df, eras or {}), need)


def service_day(spark: SparkSession, base: str, day: str, need: Sequence[str] = (), eras: Mapping[str, str] | None = None) -> DataFrame:
    """A service day's rows are captured on that date and, past midnight, on the next."""
    d = date.fromisoformat(day)
    return read_days(spark, base, [d.isoformat(), (d + timedelta(days=1)).isoformat()], need, eras)


def read_picks(spark: SparkSession, base: str, picks: Sequence[str]) -> DataFrame:
    """Only the listed pick_id= partitions."""
    return spark.read.parquet(base).where(F.col("pick_id").isin(*picks))


def with_columns(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Columns of a later era that are missing come in as typed nulls."""
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in schema.items() if c not in df.columns])


def sorted_by(df: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows dealt out by partition key and put in order inside, ready to write one sorted file a partition."""
    return df.repartition(*[F.col(c) for c in partition]).sortWithinPartitions(*partition, *order)


def rebuild(df: DataFrame, path: str, partition: Sequence[str], order: Sequence[str]) -> None:
    """Replaces just the partitions that `df` has; running it again changes nothing."""
    writer = sorted_by(df, partition, order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition).parquet(path)


def append_by_event_time(df: DataFrame, path: str, ts: str) -> None:
    """Appends rows to date= and hour= of their own time, so that replayed rows land where they belong."""
    t = F.timestamp_seconds(F.col(ts))
    df.withColumn("date", F.date_format(t, "yyyy-MM-dd")).withColumn("hour", F.date_format(t, "HH")).write.mode("append").partitionBy("date", "hour").parquet(path)


def month_span(month: str) -> tuple[date, date]:
    """[day before the month, last day]: night rows of the first day belong to the day before."""
    first = date.fromisoformat(month + "-01")
    following = (first.replace(day=28) + timedelta(days=4)).replace(day=1)
    return first - timedelta(days=1), following - timedelta(days=1)


def two_hours(now_s: int) -> list[tuple[str, str]]:
    """(date, hour) of this wall-clock hour and the one before, over midnight too."""
    from datetime import datetime, timezone

    stamps = [datetime.fromtimestamp(now_s - back, timezone.utc) for back in (0, 3600)]
    return [(t.strftime("%Y-%m-%d"), t.strftime("%H")) for t in stamps]


def prune_two_hours(df: DataFrame, now_s: int) -> DataFrame:
    """Only the partitions that a two-hour view can need."""
    cond = F.lit(False)
    for day, hour in two_hours(now_s):
        cond = cond | ((F.col("date") == day) & (F.col("hour") == hour))
    return df.where(cond)


def read_optional(spark: SparkSession, base: str, need: Sequence[str] = ()) -> DataFrame | None:
    """A table that some eras don't have: None where nothing was written."""
    from pyspark.errors import AnalysisException

    try:
        df = spark.read.option("mergeSchema", "true").parquet(base)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return need_columns(df, need)
