"""Schedules: service days, versions in effect and distances along shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def cumulative_max(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """A running maximum that leaves missing values missing."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(name, F.when(F.col(value).isNotNull(), F.max(value).over(w)))


def service_days(calendar: DataFrame, exceptions: DataFrame) -> DataFrame:
    """(service_id, service_date): the weekdays of each span, with dates added (1) and removed (2)."""
    runs = F.element_at(F.array(*[F.col(d) for d in WEEKDAYS]), F.weekday("service_date") + 1)
    spans = calendar.withColumn("service_date", F.explode(F.sequence("start_date", "end_date"))).where(runs == 1).select("service_id", "service_date")
    of = lambda kind: exceptions.where(F.col("exception_type") == kind).select("service_id", F.col("date").alias("service_date"))
    return spans.union(of(1)).distinct().join(of(2), ["service_id", "service_date"], "left_anti")


def in_effect(trips: DataFrame, keys: Sequence[str], published: str, service_date: str, tie: str) -> DataFrame:
    """Of each key and date the newest version published by the day after."""
    ok = trips.where(F.col(published) <= F.date_add(F.col(service_date), 1))
    w = Window.partitionBy(*keys, service_date).orderBy(F.desc(published), tie)
    return ok.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def headway_family(df: DataFrame, keys: Sequence[str], headway: str, most_s: int = 600) -> DataFrame:
    """'headway' where the median planned headway of the keys is short, else 'schedule'."""
    return df.groupBy(*keys).agg(F.median(headway).alias("median_s")).withColumn("family", F.when(F.col("median_s") <= most_s, "headway").otherwise("schedule"))
