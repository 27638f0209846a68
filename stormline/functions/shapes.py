"""Points along lines and parts of intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormline.functions.geo import overlap


def along_segment(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> tuple[Column, Column]:
    """Where on a segment (0 to 1) a point is nearest, and the square of its distance."""
    dx, dy = bx - ax, by - ay
    long2 = dx * dx + dy * dy
    t = F.when(long2 == 0, 0.0).otherwise(F.least(F.greatest(((px - ax) * dx + (py - ay) * dy) / long2, F.lit(0.0)), F.lit(1.0)))
    return t, F.pow(ax + t * dx - px, 2) + F.pow(ay + t * dy - py, 2)


def interval_share(lo: Column, hi: Column, a: Column, b: Column) -> Column:
    """The part of [lo, hi] inside [a, b]."""
    return F.when(hi > lo, overlap(lo, hi, a, b) / (hi - lo)).otherwise(0.0)
