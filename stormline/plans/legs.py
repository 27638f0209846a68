"""Legs between pings and their sums by cell and hour."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.functions.geo import cell_of, geodesic_m
from stormline.functions.texts import route_class
from stormline.functions.times import ceil_hour_s
from stormline.operators.aggregates import count_if, sum_if
from stormline.operators.windows import latest_by, with_flips, with_next, with_runs


@dataclass(frozen=True)
class LegRules:
    """dark_s: a longer gap isn't a leg; jump_mps: faster is an error; still_m: shorter is standing."""

    dark_s: int = 300
    jump_mps: float = 30.0
    still_m: float = 25.0
    drop_terminal: bool = True


def legs(pings: DataFrame, rules: LegRules = LegRules()) -> DataFrame:  # noqa: B008
    """One row a pair of pings that follow one another in a run of one vehicle on one trip.

    `dropped` is null for legs that count, 'dark' for long gaps, 'terminal' for standing before the run's
    first change of stop, after its last or in a run without one. Jumps and trips without id give no row.
    """
    p = latest_by(pings, ["vehicle_id", "ts"], [F.col("fetched_at").asc_nulls_first()])
    p = with_runs(p, ["vehicle_id"], ["ts"], ["trip_id", "start_date"]).where(F.col("trip_id").isNotNull())
    run = ["vehicle_id", "run_id"]
    p = with_next(p, run, ["ts"], ["ts", "lat", "lon", "stop_id"]).where(F.col("ts_next").isNotNull())
    changes = ~F.col("stop_id").eqNullSafe(F.col("stop_id_next"))
    # Distances come before the window of flips: filters on them aren't pushed through it, so each is computed once.
    p = p.withColumn("dist_m", geodesic_m(F.col("lon"), F.col("lat"), F.col("lon_next"), F.col("lat_next")))
    p = with_flips(p.withColumn("flip", changes), run, ["ts"], F.col("flip"))
    p = p.withColumn("dt_s", (F.col("ts_next") - F.col("ts")).cast("long"))
    at_end = (F.col("flips_so_far") == 0) | (~F.col("flip") & (F.col("flips_so_far") == F.col("flips_total")))
    terminal = F.lit(rules.drop_terminal) & (F.col("dist_m") < rules.still_m) & at_end
    dark = F.col("dt_s") > rules.dark_s
    jump = ~dark & (F.col("dist_m") > F.col("dt_s") * rules.jump_mps)
    return p.where(~jump).select(
        "vehicle_id", "trip_id", "route_id", "start_date", route_class(F.col("route_id")).alias("route_class"),
        cell_of((F.col("lon") + F.col("lon_next")) / 2, (F.col("lat") + F.col("lat_next")) / 2).alias("cell"),
        ceil_hour_s((F.col("ts") + F.col("ts_next")) / 2).alias("hour_end_s"),
        "dist_m", "dt_s", F.when(dark, "dark").when(terminal, "terminal").alias("dropped"),
    )


def leg_hours(pings: DataFrame, rules: LegRules = LegRules(), accuracy: int = 10000) -> DataFrame:  # noqa: B008
    """Sums by cell, hour, route and class; speeds are ratios of these sums, never means of ratios."""
    kept = F.col("dropped").isNull()
    return legs(pings, rules).groupBy("cell", "hour_end_s", "route_id", "route_class").agg(
        count_if(kept).alias("n_legs"), F.approx_count_distinct(F.when(kept, F.col("vehicle_id"))).alias("n_vehicles"),
        sum_if(kept, F.col("dist_m")).alias("dist_m_sum"), sum_if(kept, F.col("dt_s")).alias("dt_s_sum"),
        F.percentile_approx(F.when(kept, F.col("dist_m") / F.col("dt_s")), 0.5, accuracy).alias("leg_speed_p50"),
        count_if(F.col("dropped") == "terminal").alias("n_terminal"), count_if(F.col("dropped") == "dark").alias("n_dark"),
    )
