"""Monthly rollups of leg hours and passages, and the dry-hour norm."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormline.operators.aggregates import count_if, ratio, renewal_wait, share


def cell_hour_speed(leg_hours: DataFrame, month: Column | None = None) -> DataFrame:
    """Sums by cell, hour and class over routes; the speed is the ratio of the sums."""
    df = leg_hours if month is None else leg_hours.where(month)
    sums = ["n_legs", "dist_m_sum", "dt_s_sum"]
    out = df.groupBy("cell", "hour_end_s", "route_class").agg(*[F.sum(c).alias(c) for c in sums])
    return out.withColumn("speed_mps", ratio(F.col("dist_m_sum"), F.col("dt_s_sum")))


def cell_hour_route(passages: DataFrame, keys: Sequence[str], late_s: int = 300, early_s: int = -60) -> DataFrame:
    """Shares of late and early passages over those with a known delay, excess wait, bunching and coverage."""
    return passages.groupBy(*keys).agg(
        F.count("*").alias("n"), share(F.col("delay_s") > late_s).alias("late_share"), share(F.col("delay_s") < early_s).alias("early_share"),
        (renewal_wait(F.col("headway_s")) - renewal_wait(F.col("headway_sched_s"))).alias("excess_wait_s"),
        share(F.col("headway_s") <= F.col("headway_sched_s") / 4).alias("bunched_share"), F.count("delay_s").alias("n_known"),
    )


def hour_of_week_norm(speed: DataFrame, rain: DataFrame, is_dry: Column, keys: Sequence[str]) -> DataFrame:
    """(keys, norm, n_hours, n_legs): speed over dry hours of each cell and hour of the week."""
    return speed.join(rain, ["cell", "hour_end_s"]).where(is_dry).groupBy(*keys).agg(
        ratio(F.sum("dist_m_sum"), F.sum("dt_s_sum")).alias("norm"), F.countDistinct("hour_end_s").alias("n_hours"), F.sum("n_legs").alias("n_legs"))


def agreement(predictions: DataFrame, passages: DataFrame, keys: Sequence[str], within_s: int) -> DataFrame:
    """How many passages a prediction exists for, and how many of these it met within `within_s`."""
    both = passages.join(predictions, list(keys), "left")
    return both.agg(F.count("*").alias("n"), count_if(F.col("pred").isNotNull()).alias("n_predicted"), count_if(F.abs(F.col("pred") - F.col("arr")) <= within_s).alias("n_met"))
