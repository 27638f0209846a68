"""The query surface: whole sets of keys answered in one job, with a reason instead of an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormline.operators.joins import members, nearest_in_radius

PRIVATE = ("text", "lon", "lat")


def redacted(df: DataFrame, mode: str) -> DataFrame:
    """In public mode private columns are gone, not blank."""
    if mode not in ("public", "local"):
        raise ValueError("mode is public or local")
    return df if mode == "local" else df.drop(*PRIVATE)


def events_for_assets(asked: DataFrame, units: DataFrame, labels: DataFrame) -> DataFrame:
    """(asset_id, reason, n_events, last_event): each asset's history, its children's included."""
    edges = members(units, "asset_id", "parent_asset_id")
    got = asked.join(edges, asked["asset_id"] == edges["unit"], "left").join(labels.select(F.col("asset_id").alias("member"), "event_id"), "member", "left")
    known = units.select(F.col("asset_id"), F.lit(True).alias("_known"))
    out = got.groupBy(asked["asset_id"]).agg(F.countDistinct("event_id").alias("n_events"), F.max("event_id").alias("last_event"))
    return out.join(known, "asset_id", "left").select(
        "asset_id", F.when(F.col("_known").isNull(), "unknown_asset").when(F.col("n_events") == 0, "no_events").alias("reason"), "n_events", "last_event")


def exposure_of(asked: DataFrame, scored: DataFrame, units: DataFrame) -> DataFrame:
    """(asset_id, reason, score): a typed refusal for what isn't a scored unit."""
    kinds = units.select("asset_id", F.col("kind").alias("_kind"))
    out = asked.join(kinds, "asset_id", "left").join(scored.select("asset_id", "score"), "asset_id", "left")
    reason = F.when(F.col("_kind").isNull(), "unknown_asset").when(F.col("score").isNull(), "not_a_unit")
    return out.select("asset_id", reason.alias("reason"), "score")


def assets_in_box(units: DataFrame, box: tuple[float, float, float, float], most_cells: int = 64) -> DataFrame:
    """Assets in a box with their cell, or one row with a reason if the box spans too many cells."""
    x0, y0, x1, y1 = box
    inside = units.where(F.col("lon").between(x0, x1) & F.col("lat").between(y0, y1))
    n = inside.agg(F.countDistinct("cell").alias("n_cells"))
    wide = n.where(F.col("n_cells") > most_cells).select(F.lit(None).cast("long").alias("asset_id"), F.lit(None).cast("long").alias("cell"), F.lit("too_many_cells").alias("reason"))
    fits = inside.crossJoin(F.broadcast(n)).where(F.col("n_cells") <= most_cells)  # one row
    return fits.select("asset_id", "cell", F.lit(None).cast("string").alias("reason")).union(wide)


def observations_near(points: DataFrame, observed: DataFrame, radius_m: float, k: int) -> DataFrame:
    """(point_id, obs_id, dist_m, rank): up to k observations within radius_m, 2000 at most."""
    if not 0 < radius_m <= 2000:
        raise ValueError("radius_m is at most 2000")
    return nearest_in_radius(points, observed, ["point_id"], ("lon1", "lat1"), ("lon2", "lat2"), "obs_id", radius_m, k).select("point_id", "obs_id", "dist_m", "rank")


def recent(df: DataFrame, day: str, days: int, keys: list[str], value: Column) -> DataFrame:
    """Sums over the last `days` days that the table has."""
    last = df.agg(F.max(day).alias("_last"))
    return df.crossJoin(F.broadcast(last)).where(F.col(day) > F.date_sub(F.col("_last"), days)).groupBy(*keys).agg(F.count("*").alias("n"), value)  # one row


def one_version(df: DataFrame, stamp: str) -> DataFrame:
    """(n_versions, version, reason): a table must carry exactly one stamp."""
    return df.agg(F.countDistinct(stamp).alias("n_versions"), F.max(stamp).alias("version")).withColumn("reason", F.when(F.col("n_versions") != 1, "mixed_versions"))
