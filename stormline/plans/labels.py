"""Labels: attaching observations to units, negatives and their census."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormline.operators.aggregates import count_if
from stormline.operators.joins import at_places, near_places, tasks


def negatives(units: DataFrame, events: DataFrame, positives: DataFrame, keys: Sequence[str], valid: Column | None = None) -> DataFrame:
    """Unit and event pairs that are valid and not positive.

    Every unit meets every event, so events are the short side: they go out with the units' tasks.
    """
    pairs = units.crossJoin(F.broadcast(events)) if valid is None else units.crossJoin(F.broadcast(events)).where(valid)
    return pairs.join(positives.select(*keys).distinct(), list(keys), "left_anti")


def in_radius(observed: DataFrame, units: DataFrame, xy: tuple[str, str], radius_m: float, unit: str, event: str, depth: str) -> DataFrame:
    """(unit, event, depth): events observed within radius_m of a unit and the greatest depth there.

    The units' places take their events first, so a unit costs as many rows as it has events, not observations.
    """
    seen = at_places(near_places(observed, units, xy, xy, radius_m), observed.select(event, depth, *xy), xy, ("_x1", "_y1"))
    held = seen.groupBy("_x2", "_y2", event).agg(F.max(depth).alias(depth))
    return at_places(held, units.select(unit, *xy), xy, ("_x2", "_y2")).select(unit, event, depth)


def in_zone(observed: DataFrame, units: DataFrame, zone: str, unit: str, event: str) -> DataFrame:
    """(unit, event): events observed in a unit's zone; the zones take their events first."""
    return observed.select(zone, event).distinct().join(units.select(zone, unit).repartition(tasks(units), unit), zone).select(unit, event)


def attached(pairs: DataFrame, unit: str, event: str) -> DataFrame:
    """One row a (unit, event): bits of the sources, the ways it was attached, the greatest depth."""
    return pairs.groupBy(unit, event).agg(
        F.bit_or("source_bit").alias("source_mix"), F.array_sort(F.collect_set("support")).alias("label_support"), F.max("depth").alias("depth"))


def pairable(covered: Column, built: Column, opened: Column, in_universe: Column) -> Column:
    """A unit that stands in the event's universe, was covered and was there before the event."""
    return F.coalesce(covered, F.lit(False)) & in_universe & (built.isNull() | (built <= opened))


def drop_census(pairs: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """How many pairs each rule drops first, and how many are left."""
    open_, out = F.lit(True), [F.count("*").alias("n")]
    for name, drops in rules:
        out.append(count_if(open_ & drops).alias(name))
        open_ = open_ & ~drops
    return pairs.agg(*out, count_if(open_).alias("kept"))
