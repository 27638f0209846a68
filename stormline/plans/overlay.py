"""Polygons and lines over hexagonal cells: exact shares and lengths, without pairs that can't meet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.functions.geo import CELL_AREA, area_inside, cell_ring, cells_over, share_inside

SLACK = 1e-6


def cell_shares(polygons: DataFrame, ring: str, keys: Sequence[str]) -> DataFrame:
    """(keys, cell, share): the part of each cell that a polygon's closed ring covers, where it covers any.

    Each polygon is dealt out to the cells of its own box, so the work grows with the cells that polygons touch.
    """
    x, y = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    box = [F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)]
    boxed = polygons.where(F.size(ring) > 3).withColumn("_box", F.array(*box))
    spread = boxed.withColumn("cell", F.explode(F.flatten(F.transform(F.array("_box"), lambda b: cells_over(*[F.get(b, i) for i in range(4)])))))
    return spread.select(*keys, "cell", (area_inside(F.col(ring), cell_ring(F.col("cell"))) / CELL_AREA).alias("share")).where("share > 0")


def category_shares(polygons: DataFrame, ring: str, category: str) -> DataFrame:
    """(cell, category, share): summed shares; polygons of a category that overlap (beyond a millionth) raise, lesser excess is cut to 1."""
    total = cell_shares(polygons, ring, [category]).groupBy("cell", category).agg(F.sum("share").alias("share"))
    told = F.raise_error(F.concat(F.lit("shares of cell "), F.col("cell").cast("string"), F.lit(" sum to more than 1")))
    return total.withColumn("share", F.when(F.col("share") > 1 + SLACK, told.cast("double")).otherwise(F.least("share", F.lit(1.0))))


def cell_lengths(segments: DataFrame, start: str, end: str, keys: Sequence[str]) -> DataFrame:
    """(keys, cell, length): metres of straight segments (points x, y of the local plane) inside each cell, where there are any."""
    a, b = F.col(start), F.col(end)
    whole = F.hypot(b["x"] - a["x"], b["y"] - a["y"])
    box = [F.least(a["x"], b["x"]), F.least(a["y"], b["y"]), F.greatest(a["x"], b["x"]), F.greatest(a["y"], b["y"])]
    spread = segments.where(a.isNotNull() & b.isNotNull()).withColumn("cell", F.explode(cells_over(*box)))
    inside = spread.select(*keys, "cell", (share_inside(a, b, cell_ring(F.col("cell"))) * whole).alias("length")).where("length > 0")
    return inside.groupBy(*keys, "cell").agg(F.sum("length").alias("length"))
