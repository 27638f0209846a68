"""Small rules over short fixed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(value: Column, floors: Sequence[tuple[float, float]]) -> Column:
    """The factor of the highest floor that the value reaches; null below the lowest."""
    listed = F.array(*[F.struct(F.lit(float(a)).alias("floor"), F.lit(float(b)).alias("factor")) for a, b in floors])
    return F.array_max(F.filter(listed, lambda x: x["floor"] <= value))["factor"]


def datum_margin(elevation_m: Column, threshold_m: Column) -> Column:
    """How far a unit stands above its site's threshold."""
    return elevation_m - threshold_m


def not_cancelled(relation: Column, word: str = "CANCELED") -> Column:
    """A missing relation isn't a cancellation."""
    return ~relation.eqNullSafe(F.lit(word))


def in_box(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    x0, y0, x1, y1 = box
    return lon.between(x0, x1) & lat.between(y0, y1)


def interpolated(d: Column, lo: Column, hi: Column, i: Column, i_lo: Column, i_hi: Column) -> Column:
    """Where i lies between its ends: by distance if it lies strictly inside, else by number."""
    return F.when((d > lo) & (d < hi), (d - lo) / (hi - lo)).otherwise((i - i_lo) / (i_hi - i_lo))
