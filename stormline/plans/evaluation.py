"""Held-out skill: baselines, operating points carried over as alert rates, intervals, events and the gate to ship."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.operators.aggregates import average_precision, best_threshold, bootstrap_ratio, confusion, skill
from stormline.operators.ranks import quantiles_at
from stormline.operators.scratch import stored
from stormline.plans.selection import FOLDS, Validation, folded, nested_cv

BOOTSTRAPS, SEED = 200, 7


@dataclass(frozen=True)
class Scored:
    """A model's out-of-fold rows (`outer`, `score`, the label) and each fold's alert rate on its training rows."""

    rows: DataFrame
    rates: dict[int, float]


def of_validation(v: Validation) -> Scored:
    return Scored(v.rows, {fold: rate for fold, (_, rate) in v.points.items()})


def climatology(rows: DataFrame, label: str, unit: Sequence[str], folds: int = FOLDS) -> Scored:
    """(p + prior) / (n + 1) of each row's unit over the other folds; the prior is those folds' base rate. Without unit columns: the base rate.

    Counts by unit and fold are enough: a fold's training counts are the total less its own. A unit that only this fold has gets the prior.
    """
    by = rows.groupBy(*unit, "outer").agg(F.sum(label).alias("p"), F.count("*").alias("n"))
    base = by.groupBy("outer").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).collect()  # a row a fold
    p, n = sum(r["p"] for r in base), sum(r["n"] for r in base)
    prior = {r["outer"]: ((p - r["p"]) / (n - r["n"]) if n > r["n"] else None) for r in base}
    priors = rows.sparkSession.createDataFrame([(k, prior.get(k, p / n if n else None)) for k in range(folds)], "fit int, prior double")
    if not unit:
        table = priors.select("fit", F.col("prior").alias("score"))
        spread = rows.crossJoin(F.broadcast(table))  # a row a fold
    else:
        names = [F.col(c).alias(f"_{c}") for c in unit]
        total = by.groupBy(*names).agg(F.sum("p").alias("tp"), F.sum("n").alias("tn")).crossJoin(F.broadcast(priors))
        own = by.select(*[F.col(c).alias(f"_o_{c}") for c in unit], F.col("outer").alias("_fit"), "p", "n")
        joined = total.join(own, [F.col(f"_{c}").eqNullSafe(F.col(f"_o_{c}")) for c in unit] + [F.col("fit") == F.col("_fit")], "left")
        score = (F.col("tp") - F.coalesce("p", F.lit(0.0)) + F.col("prior")) / (F.col("tn") - F.coalesce("n", F.lit(0)) + 1)
        table = joined.select(*[f"_{c}" for c in unit], "fit", score.alias("score"))
        spread = rows.join(table, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in unit]).drop(*[f"_{c}" for c in unit])
    points = best_threshold(spread.where(F.col("fit") != F.col("outer")), "score", label, ["fit"]).collect()
    return Scored(spread.where(F.col("fit") == F.col("outer")).drop("fit"), {r["fit"]: r["alert_rate"] for r in points})


def decided(s: Scored) -> DataFrame:
    """`s.rows` with `alarm`: whether the score reaches the fold's cut, the quantile of held-out scores that leaves the training rows' alert rate above it.

    No held-out label is read. A fold without a rate, or with rate 0, alarms nothing.
    """
    spark = s.rows.sparkSession
    wanted = spark.createDataFrame([(f, 1.0 - r) for f, r in s.rates.items() if r and r > 0], "outer int, q double")
    cuts = quantiles_at(s.rows, ["outer"], "score", wanted, "q").select("outer", F.col("quantile").alias("cut"))
    return s.rows.join(F.broadcast(cuts), "outer", "left").withColumn("alarm", F.coalesce(F.col("score") >= F.col("cut"), F.lit(False))).drop("cut")


def skill_row(rows: DataFrame, label: str, cluster: str, name: str, bootstraps: int = BOOTSTRAPS) -> DataFrame:
    """One row: counts, CSI with an interval over whole clusters, POD, FAR, lift, average precision."""
    y = F.col(label) == 1
    counted = skill(rows.agg(*confusion(F.col("alarm"), y)))
    hits = rows.select(F.col(cluster), (F.col("alarm") & y).cast("double").alias("_hit"), (F.col("alarm") | y).cast("double").alias("_any"))
    ci = bootstrap_ratio(hits, cluster, "_hit", "_any", bootstraps, SEED)
    ap = average_precision(rows, "score", label)
    return counted.crossJoin(ci).crossJoin(ap).withColumn("model", F.lit(name))  # one row each


def event_rows(rows: DataFrame, label: str, event: str) -> DataFrame:
    """Hits, false alarms and misses of each event, and its CSI."""
    return skill(rows.groupBy(event).agg(*confusion(F.col("alarm"), F.col(label) == 1))).select(event, "tp", "fp", "fn", "csi")


def parent_rows(rows: DataFrame, truth: DataFrame, parent: str, event: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Parents never fitted: the highest child score, an alarm if any child alarms; and the count of pairs in `truth` (parent, event, label) without a child."""
    by = rows.groupBy(parent, event).agg(F.max("score").alias("score"), F.bool_or("alarm").alias("alarm"))
    both = truth.select(parent, event, label).join(by, [parent, event], "left")
    return both.where(F.col("score").isNotNull()), both.agg(F.count(F.when(F.col("score").isNull(), 1)).alias("n_without_child"))


def evaluation_table(
    df: DataFrame, features: Sequence[str], label: str, group: str, split: str, rain: Sequence[str], density: str, unit: Sequence[str], cluster: str, bootstraps: int = BOOTSTRAPS
) -> tuple[DataFrame, DataFrame]:
    """One row a model with its skill, and the decided rows of the model itself.

    B0 base rate, B1 rain alone, B2 each unit's own past, B3 density alone; all on the same folds, operating points and rows. `ship` holds for the model if
    its CSI beats those of B2 and B3.
    """
    rows = folded(df, features, label, group, split)
    fitted = {"model": list(features), "B1": list(rain), "B3": [density]}
    scored = {name: of_validation(nested_cv(df.dropna(subset=[*features, label]), f, label, group, split)) for name, f in fitted.items()}
    scored |= {"B0": climatology(rows, label, []), "B2": climatology(rows, label, unit)}
    made = {name: stored(decided(s), name) for name, s in scored.items()}
    table = None
    for name, d in made.items():
        row = skill_row(d, label, cluster, name, bootstraps)
        table = row if table is None else table.unionByName(row)
    table = stored(table, "skill")
    bar = table.where(F.col("model").isin("B2", "B3")).agg(F.max(F.coalesce("csi", F.lit(0.0))).alias("_bar"))
    return table.crossJoin(bar).withColumn("ship", (F.col("model") == "model") & (F.col("csi") > F.col("_bar"))).drop("_bar"), made["model"]
