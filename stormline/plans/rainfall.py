"""Rain on cells: remapping pixels, dense hours and trailing amounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.operators.aggregates import weighted_mean
from stormline.operators.joins import spine
from stormline.operators.windows import latest_by, with_trailing


def cell_hourly(pixels: DataFrame, crosswalk: DataFrame, first: int, last: int, frames: Sequence[int] = (3, 6, 24)) -> DataFrame:
    """Dense (cell, h) rain from pixels (i, j, h, mm) by area weights (cell, i, j, weight).

    An hour whose known weights fall short is missing, and so is a trailing amount with such an hour in it.
    """
    means = pixels.join(crosswalk, ["i", "j"]).groupBy("cell", "h").agg(weighted_mean(F.col("mm"), F.col("weight")).alias("mm"))
    dense = spine(crosswalk.select("cell"), "h", first, last).join(means, ["cell", "h"], "left")
    return with_trailing(dense, ["cell"], "h", "mm", list(frames))


def live_cells(pixels: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Cell rain of the newest hour, of each pixel the last fetch."""
    newest = pixels.agg(F.max("h").alias("h"))
    last = latest_by(pixels.join(F.broadcast(newest), "h"), ["i", "j", "h"], [F.desc("fetched_at")])  # one row
    return last.join(crosswalk, ["i", "j"]).groupBy("cell", "h").agg(weighted_mean(F.col("mm"), F.col("weight")).alias("mm"))


def lagged_correlation(left: DataFrame, right: DataFrame, keys: Sequence[str], hour: str, a: str, b: str, lags: Sequence[int]) -> DataFrame:
    """(lag_h, r, n): correlation of left now with right `lag` hours later, each lag by equal hours."""
    shifted = left.withColumn("lag_h", F.explode(F.array(*[F.lit(x) for x in lags]))).withColumn(hour, F.col(hour) + F.col("lag_h"))
    return shifted.join(right, [*keys, hour]).groupBy("lag_h").agg(F.corr(a, b).alias("r"), F.count("*").alias("n"))


def wet_census(rain: DataFrame, month: str, frozen_below: float = 273.15) -> DataFrame:
    """Shares of wet, dry and frozen hours by month."""
    known = F.col("mm").isNotNull()
    part = lambda c: F.avg(F.when(known, c.cast("double")))
    return rain.groupBy(month).agg(part(F.col("mm") >= 1).alias("wet"), part(F.col("mm") < 0.1).alias("dry"), part((F.col("mm") >= 0.1) & (F.col("t2m_k") < frozen_below)).alias("frozen"), F.count("mm").alias("n"))
