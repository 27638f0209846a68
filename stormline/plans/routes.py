"""Routes on maps: distances along shapes, stops on them, lengths in areas and event exhibits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormline.functions.geo import geodesic_m, segment_in_box
from stormline.functions.shapes import along_segment
from stormline.operators.aggregates import ratio


def with_distance(points: DataFrame, keys: Sequence[str], order: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Metres from the shape's first point to each of its points."""
    w = Window.partitionBy(*keys).orderBy(order)
    step = F.coalesce(geodesic_m(F.lag(lon).over(w), F.lag(lat).over(w), F.col(lon), F.col(lat)), F.lit(0.0))
    return points.withColumn("_step", step).withColumn("dist_m", F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_step")


def segments(points: DataFrame, keys: Sequence[str], order: str, carry: Sequence[str] = ("lon", "lat", "dist_m")) -> DataFrame:
    """Each point with its next one, as the ends of a segment."""
    w = Window.partitionBy(*keys).orderBy(order)
    return points.select("*", *[F.lead(c).over(w).alias(f"{c}_b") for c in carry]).where(F.col(f"{carry[0]}_b").isNotNull())


def stop_distances(stops: DataFrame, segs: DataFrame, shape: str, stop: str) -> DataFrame:
    """(shape, stop, dist_m, off2): where along its shape a stop lies, at the nearest segment (ties: the first)."""
    t, off = along_segment(F.col("stop_x"), F.col("stop_y"), F.col("lon"), F.col("lat"), F.col("lon_b"), F.col("lat_b"))
    near = stops.join(segs, shape).withColumn("_off", off).withColumn("_d", F.col("dist_m") + t * (F.col("dist_m_b") - F.col("dist_m")))
    return near.groupBy(shape, stop).agg(F.min(F.struct("_off", "_d")).alias("m")).select(shape, stop, F.col("m._d").alias("dist_m"), F.col("m._off").alias("off2"))


def length_in_boxes(segs: DataFrame, boxes: DataFrame, keys: Sequence[str], step: float) -> DataFrame:
    """(keys, box_id, length): positive lengths of lines in boxes; segments meet boxes by grid cells.

    A pair that shares several cells counts once.
    """
    grid = lambda c: F.floor(c / step)
    lo = lambda a, b: F.least(F.col(a), F.col(b))
    hi = lambda a, b: F.greatest(F.col(a), F.col(b))
    s = segs.withColumn("_gx", F.explode(F.sequence(grid(lo("lon", "lon_b")), grid(hi("lon", "lon_b"))))).withColumn("_gy", F.explode(F.sequence(grid(lo("lat", "lat_b")), grid(hi("lat", "lat_b")))))
    b = boxes.withColumn("_gx", F.explode(F.sequence(grid(F.col("x0")), grid(F.col("x1"))))).withColumn("_gy", F.explode(F.sequence(grid(F.col("y0")), grid(F.col("y1")))))
    box = tuple(F.col(c) for c in ("x0", "y0", "x1", "y1"))
    part = segment_in_box(F.col("lon"), F.col("lat"), F.col("lon_b"), F.col("lat_b"), box)
    both = s.join(b, ["_gx", "_gy"]).withColumn("_part", part).where("_part > 0")
    both = both.dropDuplicates([*keys, "seg_id", "box_id"])
    return both.groupBy(*keys, "box_id").agg(F.sum(F.col("_part") * (F.col("dist_m_b") - F.col("dist_m"))).alias("length"))


def exhibit(hours: DataFrame, keys: Sequence[str], is_event: Column, value: str, weight: str) -> DataFrame:
    """Weighted value in event hours beside its level in all other hours."""
    mean = lambda c: ratio(F.sum(F.when(c, F.col(value) * F.col(weight))), F.sum(F.when(c, F.col(weight))))
    return hours.groupBy(*keys).agg(mean(is_event).alias("event_value"), mean(~is_event).alias("other_value"), F.count(F.when(is_event, 1)).alias("n_event"))
