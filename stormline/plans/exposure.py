"""Exposure: scores of units at reference forcings, and margins to surge thresholds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormline.functions.lookups import datum_margin
from stormline.functions.scores import linear, logistic, need_columns
from stormline.operators.joins import nearest


def scored(units: DataFrame, kind: str, model: Mapping[str, float], intercept: float) -> DataFrame:
    """`filled`, `score` and `rank_index` (equal scores share it) of each unit; missing features take the kind's median."""
    need_columns(units, list(model))
    medians = units.groupBy(kind).agg(*[F.median(c).alias(f"_{c}") for c in model])
    filled = F.lit(False)
    for c in model:
        filled = filled | F.col(c).isNull()
    df = units.withColumn("filled", filled).join(F.broadcast(medians), kind)  # a row a kind
    for c in model:
        df = df.withColumn(c, F.coalesce(c, f"_{c}"))
    df = df.drop(*[f"_{c}" for c in model]).withColumn("score", logistic(linear(model, intercept)))
    w = Window.partitionBy(kind).orderBy(F.round("score", 12))
    return df.withColumn("rank_index", F.cume_dist().over(w))


def surge_margins(units: DataFrame, sites: DataFrame, key: str) -> DataFrame:
    """Each unit's nearest site and how far it stands above that site's threshold."""
    near = nearest(units.select(key, "lon", "lat"), sites, [key], ("lon", "lat"), ("lon2", "lat2"), "site")
    both = units.join(near, key).join(sites.select("site", "threshold"), "site")
    return both.withColumn("margin", datum_margin(F.col("elevation"), F.col("threshold")))
