"""The live detector: windows of rain, dry runs, revisions, scores and states."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormline.functions.scores import linear, logistic
from stormline.operators.aggregates import count_if
from stormline.operators.scratch import stored


def downward_revisions(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Rows whose value is below the one before, with that one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("was", F.lag(value).over(w)).where(F.col("was") > F.col(value)).withColumn("cut", F.col("was") - F.col(value))


def dry_run_hours(rain: DataFrame, hour: str, wet: Column, cells: int) -> DataFrame:
    """Hours since at least `cells` cells were wet, by hour; the window runs over one row an hour."""
    by = rain.groupBy(hour).agg(count_if(wet).alias("n"))
    last = F.max(F.when(F.col("n") >= cells, F.col(hour))).over(Window.orderBy(hour))
    return by.select(hour, last.alias("last_wet"), (F.col(hour) - last).alias("dry_hours"))


def window_features(rain: DataFrame, anchors: DataFrame, hours: int, antecedent: int) -> DataFrame:
    """(cell, anchor): max, total and antecedent rain of the window of `hours` from each anchor, and its coverage.

    Each anchor is dealt out to its hours, so rain joins by equal hours.
    """
    want = anchors.withColumn("k", F.explode(F.sequence(F.lit(-antecedent).cast("long"), F.lit(hours - 1).cast("long")))).withColumn("h", F.col("anchor") + F.col("k"))
    inside = F.col("k") >= 0
    return rain.join(want, "h").groupBy("cell", "anchor").agg(
        F.max(F.when(inside, F.col("mm"))).alias("mm_max"), F.sum(F.when(inside, F.col("mm"))).alias("mm_total"),
        F.sum(F.when(~inside, F.col("mm"))).alias("mm_antecedent"), count_if(inside & F.col("mm").isNotNull()).alias("n_hours"),
    )


def scored_hours(rain: DataFrame, model: Mapping[str, float], intercept: float) -> DataFrame:
    """Live scores; hours without forcing have none and are left out, not scored as dry."""
    return rain.withColumn("score", logistic(linear(model, intercept))).where(F.col("score").isNotNull())


# The window's rules, in hours, cells and millimetres.
ZONE, ANCHOR_LOCAL = "America/New_York", "21:00:00"
PAD_H, CAP_DAYS, ANTECEDENT_H = 3, 6, 24
WET_MM, WET_CELLS, OWN_MM, DIM_AFTER_H, FREEZE_C = 1.0, 5, 2.0, 3, 0.5
WINTER = (12, 1, 2, 3)
TOP_HIGH, TOP_ELEVATED = 0.02, 0.10
NONE, ELEVATED, HIGH = 0, 1, 2
HOUR = 3600
TASK_ROWS = 2_000_000  # units times cycles of one task
FEW = 500_000  # cycles times cells that are sent to the units, not the units to them


def wet_cells(rain: DataFrame) -> DataFrame:
    """(hour_end, n_wet): wet cells of each hour that has rows; an hour without any isn't there. A missing amount isn't wet."""
    return rain.groupBy("hour_end").agg(count_if(F.col("mm") >= WET_MM).alias("n_wet"))


def anchor_walk(cycles: DataFrame, wet: DataFrame, k: int = WET_CELLS, cap_days: int = CAP_DAYS) -> DataFrame:
    """(now, anchor, state, walked_days): the newest local 21:00 before `now` whose three hours before were dry all over the city.

    Each local day is a candidate, judged once: dry (fewer than k wet cells in each hour of its pad), wet, or unknown (an hour of the pad is
    missing). A walk back from any cycle ends at the newest candidate that isn't wet, so all walks are one window over
    a row a day: dry gives OK, unknown INSUFFICIENT_DATA, none within `cap_days` WINDOW_CAPPED. Days follow the local date, so a
    change of the clock moves no anchor off 21:00.
    """
    local = lambda s: F.from_utc_timestamp(F.timestamp_seconds(s), ZONE)
    first = F.when(F.date_format(local(F.col("now")), "HH:mm:ss") >= ANCHOR_LOCAL, F.to_date(local(F.col("now")))).otherwise(F.date_sub(F.to_date(local(F.col("now"))), 1))
    asked = cycles.select("now", first.alias("day"))
    span = asked.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a IS NOT NULL")
    days = span.select(F.explode(F.sequence(F.date_sub("a", cap_days), F.col("b"))).alias("day"))
    at = F.unix_timestamp(F.to_utc_timestamp(F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(" " + ANCHOR_LOCAL)), ZONE))
    pads = days.withColumn("anchor", at).withColumn("hour_end", F.explode(F.array(*[F.col("anchor") - HOUR * i for i in range(PAD_H)])))
    judged = pads.join(wet, "hour_end", "left").groupBy("day", "anchor").agg((F.count("n_wet") < PAD_H).alias("unknown"), F.coalesce(F.bool_or(F.col("n_wet") >= k), F.lit(False)).alias("wet"))
    stop = F.when(F.col("unknown") | ~F.col("wet"), F.struct("day", "anchor", "unknown"))
    back = Window.orderBy("day").rowsBetween(-cap_days, 0)  # a row a day
    ends = judged.select("day", F.last(stop, ignorenulls=True).over(back).alias("s"))
    state = F.when(F.col("s").isNull(), "WINDOW_CAPPED").when(F.col("s.unknown"), "INSUFFICIENT_DATA").otherwise("OK")
    walked = F.when(F.col("s").isNull(), cap_days).otherwise(F.datediff(asked["day"], F.col("s.day")))
    return asked.join(ends, "day").select("now", F.when(state == "OK", F.col("s.anchor")).alias("anchor"), state.alias("state"), walked.alias("walked_days"))


def dry_hours(cycles: DataFrame, wet: DataFrame, k: int = WET_CELLS) -> DataFrame:
    """(now, dry_hours): hours in a row, back from the newest whole hour, with fewer than k wet cells; null if that hour is missing."""
    hour = (F.col("now") - F.col("now") % HOUR).alias("hour_end")
    ends = wet.select("hour_end").unionByName(cycles.select(hour)).agg(F.min("hour_end").alias("a"), F.max("hour_end").alias("b")).where("a IS NOT NULL")
    hours = ends.select(F.explode(F.sequence(F.col("a") - HOUR, F.col("b"), F.lit(HOUR).cast("long"))).alias("hour_end")).join(wet, "hour_end", "left")
    halt = F.max(F.when(F.col("n_wet").isNull() | (F.col("n_wet") >= k), F.col("hour_end"))).over(Window.orderBy("hour_end"))  # a row an hour
    dry = hours.select("hour_end", F.when(F.col("n_wet").isNotNull(), ((F.col("hour_end") - halt) / HOUR).cast("long")).alias("dry_hours"))
    return cycles.select("now", hour).join(dry, "hour_end").select("now", "dry_hours")


def cycle_features(rain: DataFrame, walked: DataFrame) -> DataFrame:
    """(now, anchor, cell, mm_max, mm_total, mm_antecedent, window_hours, antecedent_hours, coverage) of cells with any amount.

    The window is (anchor, now], the antecedent the 24 hours up to the anchor. A missing amount is no zero. Cells without any amount
    are unforced: they have no row and don't count as holes.
    """
    ok = walked.where("state = 'OK'").select("now", "anchor")
    first, last = F.col("anchor") - HOUR * (ANTECEDENT_H - 1), F.col("now") - F.col("now") % HOUR
    hours = ok.withColumn("hour_end", F.explode(F.sequence(first, F.greatest(last, "anchor"), F.lit(HOUR).cast("long"))))
    inside, mm = F.col("hour_end") > F.col("anchor"), F.col("mm")
    known = rain.where(mm.isNotNull()).join(hours, "hour_end")
    by = known.groupBy("now", "anchor", "cell").agg(
        F.coalesce(F.max(F.when(inside, mm)), F.lit(0.0)).alias("mm_max"), F.coalesce(F.sum(F.when(inside, mm)), F.lit(0.0)).alias("mm_total"),
        F.coalesce(F.sum(F.when(~inside, mm)), F.lit(0.0)).alias("mm_antecedent"), count_if(inside).alias("window_hours"), count_if(~inside).alias("antecedent_hours"),
    )
    expected = F.floor((F.col("now") - F.col("anchor")) / HOUR)
    return by.withColumn("coverage", F.when(expected > 0, F.col("window_hours") / expected).otherwise(1.0))


def city_coverage(features: DataFrame) -> DataFrame:
    """(now, anchor, n_cells, coverage, holes): the part of expected cell hours that forced cells have."""
    return features.groupBy("now", "anchor").agg(F.count("*").alias("n_cells"), F.avg("coverage").alias("coverage")).withColumn("holes", F.col("coverage") < 1.0)


def detector_cycles(
    rain: DataFrame, cycles: DataFrame, units: DataFrame, models: Mapping[str, tuple[Mapping[str, float], float]], k: int = WET_CELLS
) -> DataFrame:
    """One row a cycle and scored unit: rank, tier of now, latched tier, what suppressed or dimmed it.

    `rain`: cell, hour_end, mm. `cycles`: now, temp_c (null if absent or stale). `units`: asset_id, kind, cell, complex_id and static
    features; doorways (kind entrance) score but aren't shown, and a complex has the highest score of its doorways, with that doorway's cell.
    `models`: by kind, coefficients and intercept over log_max, log_total, log_antecedent and static features. Rank is the share of units of the
    kind that score no higher. A tier needs its rank, 2 mm in the own cell and a city that is wet this hour.
    Within a window tiers only rise; a new anchor, a cycle without a window or one that winter suppressed, and a cycle in which the unit had no rain data
    start anew. Temperatures up to 0.5 degrees suppress all tiers; without one the month decides. From three dry hours on, flags dim.
    """
    wet = wet_cells(rain)
    walked = anchor_walk(cycles, wet, k)
    order = Window.orderBy("now")  # a row a cycle
    winter = F.when(F.col("temp_c").isNotNull(), F.col("temp_c") <= FREEZE_C).otherwise(F.month(F.from_utc_timestamp(F.timestamp_seconds("now"), ZONE)).isin(*WINTER))
    told = cycles.select("now", winter.alias("winter")).join(walked, "now").join(dry_hours(cycles, wet, k), "now", "left")
    broken = (F.col("state") != "OK") | ~F.col("anchor").eqNullSafe(F.lag("anchor").over(order)) | F.lag("winter").over(order)
    told = told.withColumn("cycle", F.row_number().over(order)).withColumn("segment", F.sum(F.coalesce(broken, F.lit(True)).cast("long")).over(order))
    f = cycle_features(rain, walked)
    f = f.select("now", "cell", "mm_total", F.log1p("mm_max").alias("log_max"), F.log1p("mm_total").alias("log_total"), F.log1p("mm_antecedent").alias("log_antecedent"))
    f = stored(f, "features")
    # each unit comes back in every cycle: units, however few files hold them, are dealt to as many tasks as those rows need
    tasks = max(int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-units.count() * cycles.count() // TASK_ROWS))
    seen = units.where("kind <> 'complex'").repartition(tasks, "asset_id").join(F.broadcast(f) if f.count() <= FEW else f, "cell")
    eta = None
    for kind, (model, intercept) in models.items():
        eta = F.when(F.col("kind") == kind, linear(model, intercept)) if eta is None else eta.when(F.col("kind") == kind, linear(model, intercept))
    scored = seen.withColumn("score", F.round(eta, 9)).select("now", "asset_id", "kind", "complex_id", "cell", "mm_total", "score")
    best = scored.where("kind = 'entrance'").groupBy("now", "complex_id").agg(F.max(F.struct("score", (-F.col("cell")).alias("neg"), "cell", "mm_total")).alias("b"))
    complexes = units.where("kind = 'complex'").select("asset_id", "complex_id").join(best, "complex_id").select("now", "asset_id", F.lit("complex").alias("kind"), "b.cell", "b.mm_total", "b.score")
    shown = scored.where("kind <> 'entrance'").drop("complex_id").unionByName(complexes)
    ranked = shown.withColumn("rank", F.cume_dist().over(Window.partitionBy("now", "kind").orderBy("score"))).join(told, "now")
    open_ = (F.col("dry_hours") == 0) & (F.col("mm_total") >= OWN_MM)
    tier = F.when(open_ & (F.col("rank") >= 1 - TOP_HIGH), HIGH).when(open_ & (F.col("rank") >= 1 - TOP_ELEVATED), ELEVATED).otherwise(NONE)
    island = F.col("cycle") - F.row_number().over(Window.partitionBy("asset_id", "segment").orderBy("now"))
    kept = ranked.withColumn("tier_now", tier).withColumn("_island", island)
    latched = F.max("tier_now").over(Window.partitionBy("asset_id", "segment", "_island").orderBy("now"))
    return kept.select(
        "now", "anchor", "asset_id", "kind", "cell", "rank", "tier_now", F.when(F.col("winter"), NONE).otherwise(latched).alias("tier"),
        F.col("winter").alias("suppressed"), F.coalesce(F.col("dry_hours") >= DIM_AFTER_H, F.lit(False)).alias("dimmed"),
    )
