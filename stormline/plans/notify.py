"""Notification candidates: crossings, subscriptions and caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormline.operators.scratch import stored


def candidates(df: DataFrame, unit: str, order: Sequence[str], group: str, cap: int) -> DataFrame:
    """Rows in which a unit first reaches a higher tier, with the reason why one isn't sent.

    Input has tier and opted_in. Within a group the highest tiers, then the earliest, come first.
    """
    so_far = Window.partitionBy(unit).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    crossed = df.withColumn("_before", F.coalesce(F.max("tier").over(so_far), F.lit(0))).where(F.col("tier") > F.col("_before"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("tier"), *order))
    return crossed.withColumn("_rank", rank).withColumn("dropped", F.when(~F.col("opted_in"), "opted_out").when(F.col("_rank") > cap, "over_cap"))


# Tiers that notify, quiet local hours, and caps.
ELEVATED, HIGH = 1, 2
WATCH_TOP = {"stop": 25, "complex": 5}
QUIET, ZONE = (22, 7), "America/New_York"
HANDLE_CAP, CYCLE_FUSE = 10, 500
OWN_MM = 2.0
KINDS = ("stop", "complex")


def in_quiet_hours(now: Column) -> Column:
    """Local hours from 22 to 7."""
    hour = F.hour(F.from_utc_timestamp(F.timestamp_seconds(now), ZONE))
    return (hour >= QUIET[0]) | (hour < QUIET[1])


def tier_entries(units: DataFrame) -> DataFrame:
    """Rows in which a unit's latched tier rose above what it was in the evaluated cycle before of the same window.

    `units`: now, anchor, asset_id, kind, tier, rank, silent. Silent cycles decide nothing and are stepped over; a unit that the cycle before didn't list starts at none.
    """
    heard = stored(units.where(~F.col("silent")), "heard")  # a replay of all cycles: read twice, worked out once
    cycles = heard.select("anchor", "now").distinct().withColumn("_i", F.row_number().over(Window.partitionBy("anchor").orderBy("now")))
    seen = heard.join(cycles, ["anchor", "now"])
    w = Window.partitionBy("anchor", "asset_id").orderBy("now")
    was = F.when(F.lag("_i").over(w) == F.col("_i") - 1, F.lag("tier").over(w))
    return seen.withColumn("_was", F.coalesce(was, F.lit(0))).where((F.col("tier") >= ELEVATED) & (F.col("tier") > F.col("_was"))).drop("_was", "_i")


def watch_entries(units: DataFrame, top: dict[str, int] | None = None) -> DataFrame:
    """Rows in which a unit first enters the top of its kind in a window: the highest ranks among units with 2 mm in their cell in a wet city, ties by id.

    `units` also has own_mm and active. A kind that isn't listed never enters.
    """
    top = WATCH_TOP if top is None else top
    limit = F.coalesce(*[F.when(F.col("kind") == k, n) for k, n in top.items()], F.lit(0))
    gated = units.where(~F.col("silent") & F.col("active") & (F.col("own_mm") >= OWN_MM))
    place = F.row_number().over(Window.partitionBy("now", "kind").orderBy(F.desc("rank"), "asset_id"))
    inside = gated.withColumn("_place", place).where(F.col("_place") <= limit).drop("_place")
    return inside.withColumn("_n", F.row_number().over(Window.partitionBy("anchor", "asset_id").orderBy("now"))).where("_n = 1").drop("_n")


def decisions(entries: DataFrame, subscriptions: DataFrame, tiers: bool = True, handle_cap: int = HANDLE_CAP, cycle_fuse: int = CYCLE_FUSE) -> DataFrame:
    """One row an entry and subscription: now, anchor, handle, asset_id, kind, tier, and `dropped` (quiet, handle_cap, cycle_fuse; null: sent).

    `subscriptions`: handle, asset_id, elevated_optin; another kind than stop or complex raises. HIGH is always sent for; ELEVATED only where opted in, and neither it nor the watch
    branch (`tiers` false) in quiet hours. A handle gets `handle_cap` messages a window, a cycle sends `cycle_fuse`; both take entries by asset, then handle.
    What is dropped isn't kept for later. The cap counts what was sent and the fuse what the cap let through, so a fuse that trips leaves room under later caps.
    A round finds the first cycle of each window that trips next, where all cycles before are settled, and settles it: from a handle's first row beyond the fuse on,
    none of its rows is sent in that cycle, none reaches the cap, and none counts. Rounds are one more than the cycles that trip in a window.
    """
    entries = stored(entries.select("now", "anchor", "asset_id", "kind", "tier"), "entries")
    wrong = entries.where(~F.col("kind").isin(*KINDS)).select("kind").limit(1).collect()
    if wrong:
        raise ValueError(f"no one can subscribe to {wrong[0]['kind']}")
    urgent = (F.col("tier") == HIGH) if tiers else F.lit(False)
    heard = (urgent | F.col("elevated_optin")) if tiers else F.lit(True)
    both = entries.join(subscriptions.select("handle", "asset_id", "elevated_optin"), "asset_id").where(heard)
    rows = stored(both.withColumn("quiet", ~urgent & in_quiet_hours(F.col("now"))).withColumn("fused", F.lit(False)), "wanted")
    before = Window.partitionBy("handle", "anchor").orderBy("now", "asset_id").rowsBetween(Window.unboundedPreceding, -1)
    cycle = Window.partitionBy("now").orderBy("asset_id", "handle").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    so_far = Window.partitionBy("now", "handle").orderBy("asset_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    while True:
        open_ = ~F.col("quiet") & ~F.col("fused")
        counted = F.coalesce(F.sum(open_.cast("int")).over(before), F.lit(0))
        capped = rows.withColumn("capped", open_ & (counted >= handle_cap))
        passing = open_ & ~F.col("capped")
        told = stored(capped.withColumn("over", passing & (F.sum(passing.cast("int")).over(cycle) > cycle_fuse)), "told")
        trips = told.where("over").groupBy("anchor").agg(F.min("now").alias("now")).select("now").distinct().collect()  # a row a window
        if not trips:
            break
        blown = F.col("now").isin([t["now"] for t in trips]) & ~F.col("quiet") & F.max("over").over(so_far)
        rows = told.withColumn("fused", F.col("fused") | blown).drop("capped", "over")
    reason = F.when(F.col("quiet"), "quiet").when(F.col("capped"), "handle_cap").when(F.col("fused"), "cycle_fuse")
    return told.select("now", "anchor", "handle", "asset_id", "kind", "tier", reason.alias("dropped"))
