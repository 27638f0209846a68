"""Wet against dry: matched norms, ratios and their intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormline.operators.aggregates import cluster_mean, ratio, t_975
from stormline.operators.scratch import stored
from stormline.operators.windows import with_sessions


def ratio_interval(df: DataFrame, keys: Sequence[str], num: str, den: str, z: float = 1.96) -> DataFrame:
    """(keys, ratio, lo, hi): a ratio of sums over independent bins, its interval by the delta method."""
    by = list(keys)
    total = df.groupBy(*by).agg(ratio(F.sum(num), F.sum(den)).alias("ratio"), F.avg(den).alias("_m"), F.count("*").alias("_k"))
    joined = df.join(total, by) if by else df.crossJoin(F.broadcast(total))
    s2 = F.sum(F.pow(F.col(num) - F.col("ratio") * F.col(den), 2))
    out = joined.groupBy(*by, "ratio", "_m", "_k").agg(s2.alias("_s"))
    half = F.when(F.col("_k") > 1, z * F.sqrt(F.col("_s") / (F.col("_k") - 1) / F.col("_k")) / F.col("_m"))
    return out.select(*by, "ratio", (F.col("ratio") - half).alias("lo"), (F.col("ratio") + half).alias("hi"))


def dry(mm_1h: Column, mm_before: Column, mm_6h: Column) -> Column:
    """Hours with next to no rain now, before and in six hours; an unknown amount isn't dry."""
    return F.coalesce((mm_1h < 0.1) & (mm_before < 0.1) & (mm_6h < 0.5), F.lit(False))


def wet(mm_1h: Column, least: float = 1.0) -> Column:
    return F.coalesce(mm_1h >= least, F.lit(False))


def dry_norm(hours: DataFrame, keys: Sequence[str], is_dry: Column, num: str, den: str) -> DataFrame:
    """(keys, norm, n_dry): the ratio of sums over dry hours."""
    return hours.where(is_dry).groupBy(*keys).agg(ratio(F.sum(num), F.sum(den)).alias("norm"), F.count("*").alias("n_dry"))


def wet_contrast(hours: DataFrame, norms: DataFrame, keys: Sequence[str], by: Sequence[str], is_wet: Column, num: str, den: str, cluster: str) -> DataFrame:
    """(by, mean, n_clusters, se, lo, hi) of wet hours' ratio to their own norm, weighted by `den`."""
    both = hours.where(is_wet).join(norms, list(keys)).where(F.col("norm") > 0)
    return cluster_mean(both.withColumn("_r", F.col(num) / F.col(den) / F.col("norm")), by, cluster, "_r", den)


# Wet hours, lags, the gate's width, and polyline over chord by speed class (lower bound in m/s).
WET_MM, HEAVY_MM, MOST_LAG_H, LOOKBACK_H, EVENT_GAP_H, GATE_WIDTH = 1.0, 10.0, 12, 48, 7, 0.30
CHORD = ((0.0, 1.164), (3.0, 1.025), (6.0, 1.015), (10.0, 1.016))


def scored_hours(hours: DataFrame) -> DataFrame:
    """Hours with legs: cell, h, hw, n_legs, dist, dt, mm_1h, mm_prev, mm_6h, and their speed `d`."""
    return hours.where((F.col("dt") > 0) & (F.col("n_legs") > 0)).withColumn("d", F.col("dist") / F.col("dt"))


def dry_bins(hours: DataFrame) -> DataFrame:
    """(cell, hw, norm, se, n_dry): the space-mean speed of a cell's dry hours of one hour of the week, and its standard error; two hours at least."""
    rows = scored_hours(hours).where(dry(F.col("mm_1h"), F.col("mm_prev"), F.col("mm_6h")))
    mean = rows.groupBy("cell", "hw").agg((F.sum("dist") / F.sum("dt")).alias("norm"), F.sum("dt").alias("_w"), F.count("*").alias("n_dry"))
    off = rows.join(mean, ["cell", "hw"]).groupBy("cell", "hw", "norm", "_w", "n_dry").agg(F.sum(F.pow(F.col("dt") * (F.col("d") - F.col("norm")), 2)).alias("_s"))
    n = F.col("n_dry")
    return off.where((n >= 2) & (F.col("norm") > 0)).select("cell", "hw", "norm", (F.sqrt(F.col("_s") * n / (n - 1)) / F.col("_w")).alias("se"), "n_dry")


def storm_cells(hours: DataFrame, bins: DataFrame, storm: DataFrame, width: float = GATE_WIDTH) -> DataFrame:
    """(h, cell, ratio, half, rel_half, n_legs, n_dry, published) of each cell in each storm hour (`storm`: h) against its dry bin.

    The interval is the baseline's alone: a storm hour is one draw. So it grows with the ratio, and a gate on its width would censor by the answer; a cell
    is published by the relative width of its baseline, and only with an interval.
    """
    both = scored_hours(hours).join(storm.select("h"), "h").join(bins, ["cell", "hw"])
    r = F.col("d") / F.col("norm")
    rel = t_975(F.col("n_dry") - 1) * F.col("se") / F.col("norm")
    return both.select("h", "cell", r.alias("ratio"), (rel * r).alias("half"), rel.alias("rel_half"), "n_legs", "n_dry", ((2 * rel < width) & (rel * r > 0)).alias("published"))


def storm_city(hours: DataFrame, storm: DataFrame) -> DataFrame:
    """(h, v_wet, v_dry, ratio, half, n_legs, n_draws): the city's speed in each storm hour over the pooled dry bins of the same cells; each dry hour of the city is one draw."""
    rows = scored_hours(hours)
    now = rows.join(storm.select("h"), "h")
    wet_ = now.groupBy("h").agg((F.sum("dist") / F.sum("dt")).alias("v_wet"), F.sum("n_legs").alias("n_legs"))
    base = rows.where(dry(F.col("mm_1h"), F.col("mm_prev"), F.col("mm_6h"))).select("cell", "hw", F.col("h").alias("draw"), "d", "dt")
    met = now.select("h", "cell", "hw").join(base, ["cell", "hw"])
    m = cluster_mean(met, ["h"], "draw", "d", "dt").where("n_clusters >= 2")
    half = t_975(F.col("n_clusters") - 1) * F.col("se") / F.col("mean")
    out = wet_.join(m, "h").withColumn("ratio", F.col("v_wet") / F.col("mean"))
    return out.select("h", "v_wet", F.col("mean").alias("v_dry"), "ratio", (F.col("ratio") * half).alias("half"), "n_legs", F.col("n_clusters").alias("n_draws"))


def wet_hours(hours: DataFrame, bins: DataFrame) -> DataFrame:
    """Wet cell hours with `a`, the speed over the cell's dry bin, and `event`: wet hours of the city up to seven hours apart are one event."""
    wet_h = hours.where(wet(F.col("mm_1h"), WET_MM)).select("h").distinct()
    events = with_sessions(wet_h, [], "h", EVENT_GAP_H, "event")  # a row an hour
    rows = scored_hours(hours).where(wet(F.col("mm_1h"), WET_MM)).join(events, "h").join(bins.select("cell", "hw", "norm"), ["cell", "hw"])
    return rows.withColumn("a", F.col("d") / F.col("norm"))


def wet_cells(rows: DataFrame, width: float = GATE_WIDTH) -> DataFrame:
    """(cell, ratio, half, n_events, published) of wet hours weighted by bus seconds, clustered by event; two events at least."""
    m = cluster_mean(rows, ["cell"], "event", "a", "dt").where("n_clusters >= 2")
    half = F.col("hi") - F.col("mean")
    return m.select("cell", F.col("mean").alias("ratio"), half.alias("half"), F.col("n_clusters").alias("n_events"), (2 * half < width).alias("published"))


def chord_band(value: Column, v_wet: Column, v_dry: Column) -> Column:
    """The ratio with each arm's own class of polyline over chord: the other edge of the band."""

    def of(v: Column) -> Column:
        out = F.lit(None).cast("double")
        for low, r in CHORD:
            out = F.when(v >= low, r).otherwise(out)
        return out

    return value * of(v_wet) / of(v_dry)


def headline(hours: DataFrame, bins: DataFrame, width: float = GATE_WIDTH) -> DataFrame:
    """One row: the city's wet ratio with its interval by event and by day, the chord band, the median published cell, and how many cells are hidden."""
    rows = stored(wet_hours(hours, bins), "wet")
    city = cluster_mean(rows, [], "event", "a", "dt").select(F.col("mean").alias("ratio"), "lo", "hi", F.col("n_clusters").alias("n_events"))
    days = cluster_mean(rows.withColumn("day", F.floor(F.col("h") / 24)), [], "day", "a", "dt").select(F.col("lo").alias("lo_day"), F.col("hi").alias("hi_day"), F.col("n_clusters").alias("n_days"))
    arms = rows.agg((F.sum("dist") / F.sum("dt")).alias("v_wet"), F.sum("n_legs").alias("n_legs"), F.count("*").alias("n_cell_hours"), F.countDistinct("cell").alias("_seen"))
    base = scored_hours(hours).where(dry(F.col("mm_1h"), F.col("mm_prev"), F.col("mm_6h"))).join(bins.select("cell", "hw"), ["cell", "hw"]).agg((F.sum("dist") / F.sum("dt")).alias("v_dry"))
    cells = wet_cells(rows, width).where("published").agg(F.median("ratio").alias("median_cell"), F.count("*").alias("n_cells"))
    out = city.crossJoin(days).crossJoin(arms).crossJoin(base).crossJoin(cells)  # one row each
    return out.withColumn("band", chord_band(F.col("ratio"), F.col("v_wet"), F.col("v_dry"))).withColumn("n_hidden", F.col("_seen") - F.col("n_cells")).drop("_seen")


def lag_curve(hours: DataFrame, rain: DataFrame, bins: DataFrame) -> DataFrame:
    """(rain, lag_h, ratio, n_legs, n_cells): the city's speed by hours since the cell's last wet hour over its dry bins, after any and after heavy rain.

    `rain`: cell, h, mm_1h, dense. One row is in one lag; a row after heavy rain counts in both series, by a pair of flags and no inequality join.
    """
    back = Window.partitionBy("cell").orderBy("h").rowsBetween(-LOOKBACK_H, 0)
    last = F.max(F.when(wet(F.col("mm_1h"), WET_MM), F.struct("h", "mm_1h"))).over(back)
    lags = rain.select("cell", "h", last.alias("_l")).where(F.col("_l").isNotNull()).select("cell", "h", (F.col("h") - F.col("_l.h")).alias("lag_h"), F.col("_l.mm_1h").alias("last_mm"))
    dry_sums = scored_hours(hours).where(dry(F.col("mm_1h"), F.col("mm_prev"), F.col("mm_6h"))).groupBy("cell", "hw").agg(F.sum("dist").alias("b_dist"), F.sum("dt").alias("b_dt"))
    rows = scored_hours(hours).join(lags, ["cell", "h"]).where(F.col("lag_h") <= MOST_LAG_H).join(dry_sums, ["cell", "hw"]).join(bins.select("cell", "hw"), ["cell", "hw"])
    series = F.when(F.col("last_mm") >= HEAVY_MM, F.array(F.lit("all"), F.lit("heavy"))).otherwise(F.array(F.lit("all")))
    by = rows.withColumn("rain", F.explode(series)).groupBy("rain", "lag_h")
    return by.agg(((F.sum("dist") / F.sum("dt")) / (F.sum("b_dist") / F.sum("b_dt"))).alias("ratio"), F.sum("n_legs").alias("n_legs"), F.countDistinct("cell").alias("n_cells"))
