"""Grouped cross-validation: many penalised fits at once, each round one scan of the rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.functions.scores import fold_of
from stormline.operators.aggregates import average_precision, best_threshold
from stormline.operators.scratch import stored

# Folds, and penalties from the weakest.
FOLDS = 5
PENALTIES = (0.01, 0.1, 1.0, 10.0, 100.0)


@dataclass(frozen=True)
class Spec:
    """One fit: rows outside an outer and an inner fold (None: all) or of one part alone, the features left out, the penalty on standardised coefficients."""

    name: str
    outer: int | None
    inner: int | None
    l2: float
    drop: tuple[str, ...] = field(default=())
    only: int | None = None


def folded(df: DataFrame, features: Sequence[str], label: str, group: str, split: str, folds: int = FOLDS) -> DataFrame:
    """Features, label and both folds as numbers, stored. Rows of a group share their folds; rows with a missing value go."""
    key = F.col(group).cast("string")
    kept = [F.col(c) for c in df.columns if c not in features and c != label]
    x = [F.col(c).cast("double").alias(c) for c in features]
    rows = df.select(*kept, *x, F.col(label).cast("double").alias(label), fold_of(key, folds, split).alias("outer"), fold_of(key, folds, f"inner:{split}").alias("inner"))
    return stored(rows.dropna(subset=[*features, label]), "folded")


def training_rows(spec: Spec, outer: np.ndarray, inner: np.ndarray) -> np.ndarray:
    used = np.ones(len(outer), bool)
    if spec.outer is not None:
        used &= outer != spec.outer
    if spec.inner is not None:
        used &= inner != spec.inner
    if spec.only is not None:
        used &= outer == spec.only
    return used


def fit_many(rows: DataFrame, features: Sequence[str], label: str, specs: Sequence[Spec], rounds: int = 25, tol: float = 1e-8, weight: str | None = None) -> np.ndarray:
    """One line a spec: coefficients of the raw features, then the intercept; NaN where a spec has no rows of both classes.

    Each round every task adds up its rows' gradients and curvatures for all fits by a few matrix products; what
    moves is a row of (p + 1)(p + 4) / 2 sums a task and fit. Penalties count on coefficients of features standardised over each fit's own rows, the
    intercept is free. Fits that have settled take no further part. A row counts `weight` times, once without it.
    """
    p = len(features)
    names = [*features, label, "outer", "inner", *([weight] if weight else [])]
    w = F.col(weight) if weight else F.lit(1.0)
    # moments by pair of folds: a fit's mean and deviation come from those it may see
    moments = rows.groupBy("outer", "inner").agg(
        F.sum(w).alias("n"), F.sum(F.col(label) * w).alias("pos"), *[F.sum(F.col(c) * w).alias(f"s_{i}") for i, c in enumerate(features)], *[F.sum(F.col(c) * F.col(c) * w).alias(f"q_{i}") for i, c in enumerate(features)]
    ).collect()
    outer, inner = np.array([m["outer"] for m in moments]), np.array([m["inner"] for m in moments])
    table = np.array([[m["n"], m["pos"], *[m[f"s_{i}"] for i in range(p)], *[m[f"q_{i}"] for i in range(p)]] for m in moments], float).reshape(len(moments), 2 + 2 * p)
    all_ = table.sum(0)
    if not len(moments) or all_[0] == 0:
        return np.full((len(specs), p + 1), np.nan)
    center = all_[2 : 2 + p] / all_[0]
    unit = np.sqrt(np.maximum(all_[2 + p :] / all_[0] - center**2, 0))
    unit = np.where(unit > 0, unit, 1.0)
    penalty, free, usable = np.zeros((len(specs), p + 1)), np.ones((len(specs), p + 1), bool), np.zeros(len(specs), bool)
    for k, s in enumerate(specs):
        t = table[training_rows(s, outer, inner)].sum(0)
        usable[k] = t[0] > t[1] > 0
        if usable[k]:
            sd = np.sqrt(np.maximum(t[2 + p :] / t[0] - (t[2 : 2 + p] / t[0]) ** 2, 0))
            penalty[k, :p] = s.l2 * (np.where(sd > 1e-12, sd, 1.0) / unit) ** 2
        free[k, :p] = [c not in s.drop for c in features]
    beta = np.zeros((len(specs), p + 1))
    live = np.flatnonzero(usable)
    upper = np.triu_indices(p + 1)
    for _ in range(rounds):
        if not len(live):
            break
        some, at = [specs[k] for k in live], beta[live].copy()

        def sums(batches: Iterator[pa.RecordBatch], some: Sequence[Spec] = some, at: np.ndarray = at) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(some), p + 1 + len(upper[0])))
            for batch in batches:
                cols = [np.asarray(batch.column(n)) for n in names]
                x = np.column_stack([*[(c - m) / u for c, m, u in zip(cols[:p], center, unit, strict=True)], np.ones(batch.num_rows)])
                used = np.column_stack([training_rows(s, cols[p + 1], cols[p + 2]) for s in some])
                used = used * cols[p + 3][:, None] if weight else used
                q = 1 / (1 + np.exp(-np.clip(x @ at.T, -700, 700)))
                total[:, : p + 1] += (used * (cols[p][:, None] - q)).T @ x
                total[:, p + 1 :] += (used * q * (1 - q)).T @ (x[:, upper[0]] * x[:, upper[1]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(some)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["k", "s"])

        width = p + 1 + len(upper[0])
        parts = rows.select(*names).mapInArrow(sums, "k int, s array<double>").groupBy("k").agg(F.array(*[F.sum(F.get("s", i)) for i in range(width)]).alias("s"))
        settled = []
        for r in parts.collect():  # a row a fit
            k = live[r["k"]]
            s = np.array(r["s"])
            hess = np.zeros((p + 1, p + 1))
            hess[upper] = s[p + 1 :]
            hess = hess + np.triu(hess, 1).T + np.diag(penalty[k]) + 1e-12 * np.eye(p + 1)
            grad = s[: p + 1] - penalty[k] * beta[k]
            f = free[k]
            step = np.zeros(p + 1)
            step[f] = np.linalg.solve(hess[np.ix_(f, f)], grad[f])
            beta[k] += step
            if np.abs(step).max() < tol:
                settled.append(k)
        live = np.setdiff1d(live, settled)
    raw = beta[:, :p] / unit
    out = np.column_stack([raw, beta[:, p] - raw @ center])
    out[~usable] = np.nan
    return out


def scored_by(rows: DataFrame, features: Sequence[str], specs: Sequence[Spec], coef: np.ndarray, held_out: bool = True) -> DataFrame:
    """`rows` once for each fit that didn't see them (or, with `held_out` false, that did): columns `fit` and `score`."""
    known = [k for k in range(len(specs)) if not np.isnan(coef[k]).any()]
    places = F.array(*[F.struct(
        F.lit(k).alias("fit"), F.lit(-1 if specs[k].outer is None else specs[k].outer).alias("o"), F.lit(-1 if specs[k].inner is None else specs[k].inner).alias("i"), F.lit(coef[k].tolist()).alias("b")
    ) for k in known]) if known else F.array().cast("array<struct<fit:int,o:int,i:int,b:array<double>>>")

    def wanted(f):
        out_outer, out_inner = f["o"] == F.col("outer"), f["i"] == F.col("inner")
        if not held_out:
            return ~out_outer & ~out_inner
        return F.when(f["i"] >= 0, out_inner & ~out_outer).otherwise(out_outer)

    spread = rows.withColumn("_f", F.explode(F.filter(places, wanted)))
    eta = F.get("_f.b", len(features))
    for j, c in enumerate(features):
        eta = eta + F.get("_f.b", j) * F.col(c)
    return spread.select(*rows.columns, F.col("_f.fit").alias("fit"), (1 / (1 + F.exp(-eta))).alias("score"))


def chosen_penalties(rows: DataFrame, features: Sequence[str], label: str, penalties: Sequence[float] = PENALTIES, folds: int = FOLDS) -> dict[int, float]:
    """The penalty of each outer fold: the one of highest mean average precision over its inner folds (ties: the first listed).

    Inner folds without positives in either part don't count; without any, the first listed penalty is taken.
    """
    specs = [Spec(f"{o}/{i}/{l2}", o, i, l2) for o in range(folds) for i in range(folds) for l2 in penalties]
    coef = fit_many(rows, features, label, specs)
    found = average_precision(scored_by(rows, features, specs, coef), "score", label, ["fit"]).collect()
    got: dict[tuple[int, float], list[float]] = {}
    for r in sorted(found, key=lambda r: r["fit"]):
        if r["average_precision"] is not None:
            s = specs[r["fit"]]
            got.setdefault((s.outer, s.l2), []).append(r["average_precision"])
    out = {}
    for o in range(folds):
        means = [(float(np.mean(got[o, l2])) if (o, l2) in got else -np.inf) for l2 in penalties]
        out[o] = penalties[int(np.argmax(means))]
    return out


def shipped_penalty(chosen: Sequence[float]) -> float:
    """The penalty that most outer folds chose; ties go to the stronger."""
    votes = Counter(chosen)
    return max(x for x, n in votes.items() if n == max(votes.values())) if votes else 1.0


@dataclass(frozen=True)
class Validation:
    """Out-of-fold rows (`outer`, `score`), each outer fold's penalty, and its operating point from training rows: {fold: (threshold, alert rate)}."""

    rows: DataFrame
    penalties: dict[int, float]
    points: dict[int, tuple[float, float]]


def _outer_pass(rows: DataFrame, features: Sequence[str], label: str, specs: Sequence[Spec]) -> tuple[DataFrame, dict[int, tuple[float, float]]]:
    coef = fit_many(rows, features, label, specs)
    points = best_threshold(scored_by(rows, features, specs, coef, held_out=False), "score", label, ["fit"]).collect()
    return scored_by(rows, features, specs, coef), {r["fit"]: (r["threshold"], r["alert_rate"]) for r in points}


def nested_cv(df: DataFrame, features: Sequence[str], label: str, group: str, split: str, penalties: Sequence[float] = PENALTIES, folds: int = FOLDS) -> Validation:
    """Every row scored by a fit that never saw its group, with a penalty chosen without it."""
    rows = folded(df, features, label, group, split, folds)
    chosen = chosen_penalties(rows, features, label, penalties, folds)
    out, points = _outer_pass(rows, features, label, [Spec(f"outer {o}", o, None, chosen[o]) for o in range(folds)])
    return Validation(out.drop("fit"), chosen, points)


def sweep(df: DataFrame, features: Sequence[str], label: str, group: str, split: str, l2: float, drops: dict[str, Sequence[str]], penalties: Sequence[float] = PENALTIES, folds: int = FOLDS) -> DataFrame:
    """(config, average_precision, delta): one change at a time against the reference at the frozen penalty.

    Configs: each penalty, one rung beyond the list, and each group of features left out. All their fits run together.
    """
    rows = folded(df, features, label, group, split, folds)
    configs = [("reference", l2, ())] + [(f"penalty {x:g}", x, ()) for x in [*penalties, 10 * max(penalties)]] + [(f"without {n}", l2, tuple(c)) for n, c in drops.items()]
    specs = [Spec(name, o, None, x, drop) for name, x, drop in configs for o in range(folds)]
    coef = fit_many(rows, features, label, specs)
    named = F.element_at(F.array(*[F.lit(s.name) for s in specs]), F.col("fit") + 1)
    by = average_precision(scored_by(rows, features, specs, coef).withColumn("config", named), "score", label, ["config"])
    base = by.where("config = 'reference'").select(F.col("average_precision").alias("_base"))
    return by.crossJoin(base).select("config", "average_precision", (F.col("average_precision") - F.col("_base")).alias("delta"))  # one row
