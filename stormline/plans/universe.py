"""Alternate universes: the spine, labels and fits rebuilt at other thresholds and radii, all in one plan."""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormline.operators.aggregates import average_precision
from stormline.operators.joins import at_places, near_places, radius_join, tasks  # noqa: F401 (tests reach radius_join from here)
from stormline.operators.scratch import stored
from stormline.operators.windows import day_runs
from stormline.plans.selection import Spec, fit_many

#: universe: its number; q: the nearest-rank quantile of daily counts that triggers a day; radius_m: how far a report labels.
PARAMETERS = "universe int, q double, radius_m double"


def universe_events(reports: DataFrame, universes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(universe, day) of trigger days and (universe, event_id, first_day, last_day, n_days) of their runs.

    `reports`: day and spot_id, a row a report. Counts have a row a day, so a universe costs a row a day too.
    """
    counts = reports.groupBy("day").agg(F.count("*").alias("n"))
    spread = counts.crossJoin(F.broadcast(universes))  # universes are a short list of parameters
    all_ = Window.partitionBy("universe")
    ranked = spread.withColumn("rank", F.row_number().over(all_.orderBy("n", "day"))).withColumn("of", F.count("*").over(all_))
    cut = ranked.where(F.col("rank") == F.greatest(F.ceil(F.col("q") * F.col("of")), F.lit(1))).select("universe", F.col("n").alias("cut"))
    days = spread.join(cut, "universe").where(F.col("n") >= F.col("cut")).select("universe", "day")
    runs = day_runs(days, "day", ["universe"]).withColumn("event_id", F.date_format("first_day", "yyyyMMdd").cast("long"))
    return days, runs.select("universe", "event_id", "first_day", "last_day", "n_days")


def universe_labels(reports: DataFrame, days: DataFrame, runs: DataFrame, spots: DataFrame, assets: DataFrame, universes: DataFrame) -> DataFrame:
    """(universe, event_id, asset_id): assets within a universe's radius of a report on one of its events' days.

    Places of spots meet places of assets once, at the largest radius; each universe then keeps what is near enough for it, and only then do assets join.
    `spots`: spot_id, lon, lat; `assets`: asset_id, x, y.
    """
    widest = universes.agg(F.max("radius_m")).first()[0]
    near = near_places(spots, assets, ("lon", "lat"), ("x", "y"), widest)
    event = runs.select(F.col("universe"), "event_id", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    wet = reports.select("day", "spot_id").distinct().join(event, "day").select("universe", "event_id", "spot_id").distinct()
    at = wet.join(spots.select("spot_id", F.col("lon").alias("_x1"), F.col("lat").alias("_y1")), "spot_id").select("universe", "event_id", "_x1", "_y1").distinct()
    met = at.join(near, ["_x1", "_y1"]).join(F.broadcast(universes.select("universe", "radius_m")), "universe").where(F.col("dist_m") <= F.col("radius_m"))
    held = met.select("universe", "event_id", "_x2", "_y2").distinct()
    return at_places(held, assets.select("asset_id", "x", "y"), ("x", "y"), ("_x2", "_y2")).select("universe", "event_id", "asset_id").distinct()


def universe_table(reports: DataFrame, spots: DataFrame, assets: DataFrame, features: Sequence[str], universes: DataFrame, base: int, l2: float = 1.0) -> DataFrame:
    """One row a universe: what it holds, its fit's average precision and coefficients, and each difference from the base universe.

    A universe's rows are all its events with all assets; an asset's rows differ in their labels alone, so they are two rows with weights, whatever the
    number of events. Fits of all universes share each scan. Every universe carries a stamp of its parameters and
    of the labels that came out (see `check_stamps`).
    """
    days, runs = universe_events(reports, universes)
    runs = stored(runs, "runs")
    labels = stored(universe_labels(reports, days, runs, spots, assets, universes), "labels")
    columns = [F.col(c).cast("double").alias(c) for c in features]
    told = runs.groupBy("universe").agg(F.count("*").alias("_of"))
    hits = labels.groupBy("universe", "asset_id").agg(F.count("*").alias("_hits"))
    grid = assets.select("asset_id", *columns).repartition(tasks(assets), "asset_id").crossJoin(F.broadcast(told))  # a row a universe
    some = grid.join(hits, ["universe", "asset_id"], "left").fillna(0, ["_hits"])
    sides = F.array(F.struct(F.lit(1.0).alias("y"), F.col("_hits").alias("weight")), F.struct(F.lit(0.0).alias("y"), (F.col("_of") - F.col("_hits")).alias("weight")))
    rows = some.withColumn("_s", F.explode(sides)).where("_s.weight > 0").select("universe", "asset_id", *features, "_s.y", F.col("_s.weight").cast("double").alias("weight"))
    rows = stored(rows.withColumn("outer", F.col("universe").cast("int")).withColumn("inner", F.lit(0)), "matrix")
    numbers = sorted(r["universe"] for r in universes.select("universe").collect())
    coef = fit_many(rows, features, "y", [Spec(f"universe {u}", None, None, l2, (), u) for u in numbers], weight="weight")
    known = {u: c for u, c in zip(numbers, coef, strict=True) if not np.isnan(c).any()}
    fits = universes.sparkSession.createDataFrame([(u, c.tolist()) for u, c in known.items()], "universe int, coef array<double>")
    eta = F.get("coef", len(features))
    for i, c in enumerate(features):
        eta = eta + F.get("coef", i) * F.col(c)
    scored = rows.join(F.broadcast(fits), "universe").withColumn("score", 1 / (1 + F.exp(-eta)))
    skill = average_precision(scored, "score", "y", ["universe"], "weight")
    held = runs.groupBy("universe").agg(F.sum("n_days").alias("n_days"), F.count("*").alias("n_events"))
    told = labels.groupBy("universe").agg(F.count("*").alias("n_labels"), F.sum(F.xxhash64("event_id", "asset_id").cast("decimal(38,0)")).cast("string").alias("digest"))
    out = universes.join(held, "universe", "left").join(told, "universe", "left").join(skill, "universe", "left").join(fits, "universe", "left").fillna(0, ["n_days", "n_events", "n_labels"])
    out = stored(out.withColumn("stamp", F.sha2(F.to_json(F.struct("q", "radius_m", "n_days", "n_events", "digest")), 256)), "universes")
    one = out.where(F.col("universe") == base).select(F.col("n_events").alias("_e"), F.col("n_labels").alias("_l"), F.col("average_precision").alias("_a"))
    both = out.crossJoin(one)  # one row
    return both.select(
        "universe", "q", "radius_m", "n_days", "n_events", "n_labels", "digest", "average_precision", "coef", "stamp",
        (F.col("n_events") - F.col("_e")).alias("delta_events"), (F.col("n_labels") - F.col("_l")).alias("delta_labels"), (F.col("average_precision") - F.col("_a")).alias("delta_precision"),
    )


def check_stamps(table: DataFrame) -> None:
    """Raises if two universes of a `universe_table` hold the same days, events and labels: then a parameter had no effect on what was rebuilt."""
    same = table.groupBy("n_days", "n_events", "digest").agg(F.sort_array(F.collect_list("universe")).alias("universes"), F.count("*").alias("n")).where("n > 1")
    found = [list(r["universes"]) for r in same.collect()]
    if found:
        raise ValueError(f"universes rebuilt alike: {json.dumps(sorted(found))}")
