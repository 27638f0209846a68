"""Training matrices: rain in windows, density before events, terrain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormline.operators.ranks import range_counts
from stormline.operators.scratch import stored


def trailing_density(df: DataFrame, keys: Sequence[str], day: str, days: int) -> DataFrame:
    """How many rows of the keys lie in [day - days, day), by a range frame in whole days."""
    w = Window.partitionBy(*keys).orderBy(day).rangeBetween(-days, -1)
    return df.withColumn("n_before", F.count("*").over(w))


def window_rain(windows: DataFrame, rain: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Rain of each window [start, end): windows are dealt out to their hours, which join as equals."""
    hours = windows.where(F.col(end) > F.col(start)).withColumn("h", F.explode(F.sequence(F.col(start), F.col(end) - 1)))
    got = hours.join(rain, [*keys, "h"])
    return got.groupBy(*windows.columns).agg(F.count("mm").alias("n_known"), F.max("mm").alias("mm_max"), F.sum("mm").alias("mm_sum"))


def elevation(own: Column, ring_median: Column, fallback: Column) -> Column:
    """The unit's own sample, else its ring's, else its cell's."""
    return F.coalesce(own, ring_median, fallback)


def relief(own: Column, ring_min: Column) -> Column:
    """Height above the lowest point of the ring; null if either is missing."""
    return own - ring_min


FEET_PER_METRE = 3937 / 1200
DENSITY_H = 3 * 365 * 24


def graded_elevation(own: Column, grade_ok: Column, ring_median: Column) -> Column:
    """A unit's own sample where its grade passed, else its ring's median; never anything wider."""
    return F.when(grade_ok, own).otherwise(ring_median)


def training_matrix(
    pairs: DataFrame, events: DataFrame, rain: DataFrame, reports: DataFrame, terrain: DataFrame, shares: DataFrame, density_h: int = DENSITY_H
) -> tuple[DataFrame, DataFrame]:
    """The matrix of (unit, event) pairs that a fit can use, and a census (reason, n) of all pairs.

    `pairs`: asset_id, role (point or cell), cell, event_id, flooded, pairable. `events`: event_id, open_h, close_h. `rain`: cell, h, mm, mm_24h, by hour's
    end. `reports`: cell, h. `terrain`: asset_id, elev_m, grade_ok, ring_m, category. `shares`: cell, share_deep, share_nuisance.
    Rain is log(1 + mm) of the highest hour and of the total over (open, close], and of the 24 hours before as they stood at open: an hour stamped at open lies
    before it. Density counts a cell's reports in the hours `density_h` before open, open itself not counted, by prefix sums. Points carry elevation, relief and category,
    cells their shares and density. Pairs that no pair may be, points outside the terrain and pairs without rain are left out and counted; nothing is filled in.
    """
    hours = events.select("event_id", F.col("open_h").alias("h"), F.lit(True).alias("at_open")).unionByName(
        events.where("close_h > open_h").select("event_id", F.explode(F.sequence(F.col("open_h") + 1, F.col("close_h"))).alias("h"), F.lit(False).alias("at_open"))
    )
    inside, log = ~F.col("at_open"), lambda c: F.log1p(c)
    wet = rain.join(hours, "h").groupBy("cell", "event_id").agg(
        log(F.max(F.when(inside, F.col("mm")))).alias("log_max"), log(F.sum(F.when(inside, F.col("mm")))).alias("log_total"), log(F.max(F.when(~inside, F.col("mm_24h")))).alias("log_before")
    )
    cells = pairs.where("role = 'cell'").select("cell", "event_id").distinct().join(events, "event_id").select("cell", "event_id", (F.col("open_h") - density_h).alias("_from"), F.col("open_h").alias("_to"))
    density = range_counts(reports, cells, "h", "_from", "_to", ["cell"], "density").select("cell", "event_id", "density")
    elev = graded_elevation(F.col("elev_m"), F.col("grade_ok"), F.col("ring_m"))
    ground = terrain.select("asset_id", (elev * FEET_PER_METRE).alias("elev_ft"), ((elev - F.col("ring_m")) * FEET_PER_METRE).alias("relief_ft"), "category")
    point, cell = F.col("role") == "point", F.col("role") == "cell"
    rows = pairs.join(ground, "asset_id", "left").join(wet, ["cell", "event_id"], "left").join(shares, "cell", "left").join(density, ["cell", "event_id"], "left")
    known = F.col("log_max").isNotNull() & F.col("log_total").isNotNull() & F.col("log_before").isNotNull()
    reason = (
        F.when(~F.col("pairable"), "unpairable").when(point & (F.col("elev_ft").isNull() | F.col("relief_ft").isNull()), "out_of_footprint").when(~known, "no_rain")
        .when(F.col("flooded"), "positive").otherwise("negative")
    )
    rows = stored(rows.select(
        "asset_id", "role", "cell", "event_id", "flooded", "log_max", "log_total", "log_before", F.when(point, F.col("elev_ft")).alias("elev_ft"), F.when(point, F.col("relief_ft")).alias("relief_ft"),
        F.when(point, F.col("category")).alias("category"), F.when(cell, F.col("share_deep")).alias("share_deep"), F.when(cell, F.col("share_nuisance")).alias("share_nuisance"),
        F.when(cell, F.coalesce("density", F.lit(0))).alias("density"), reason.alias("reason"),
    ), "matrix")
    return rows.where(F.col("reason").isin("positive", "negative")).drop("reason"), rows.groupBy("role", "reason").agg(F.count("*").alias("n"))
