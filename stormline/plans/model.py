"""Models: distributed logistic fits, folds, baselines and evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormline.functions.scores import fold_of, linear, logistic


@dataclass(frozen=True)
class Fit:
    """Coefficients by feature, the intercept, and how many rounds they took."""

    coef: dict[str, float]
    intercept: float
    rounds: int

    def score(self) -> Column:
        return logistic(linear(self.coef, self.intercept))


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, l2: float = 1.0, weight: str | None = None, rounds: int = 25, tol: float = 1e-8) -> Fit:
    """Minimises sum of losses + l2 / 2 |coef|^2, the intercept free, by Newton rounds.

    A round is one aggregate of (p + 1)(p + 4) / 2 sums over all rows, wherever they are; only those sums
    come to the driver, which solves a system of p + 1 unknowns. Rows with a missing value take no part.
    """
    names = [*features]
    df = df.select(*[F.col(c).cast("double").alias(c) for c in names], F.col(label).cast("double").alias("_y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w")).dropna()
    x = [*[F.col(c) for c in names], F.lit(1.0)]
    n = len(x)
    beta = np.zeros(n)
    penalty = np.diag([l2] * len(names) + [0.0])
    for k in range(1, rounds + 1):
        eta = F.lit(float(beta[-1]))
        for c, b in zip(names, beta, strict=False):
            eta = eta + F.col(c) * F.lit(float(b))
        row = df.withColumn("_p", logistic(eta)).withColumn("_v", F.col("_w") * F.col("_p") * (1 - F.col("_p"))).withColumn("_r", F.col("_w") * (F.col("_y") - F.col("_p")))
        sums = row.agg(
            *[F.sum(F.col("_r") * x[i]).alias(f"g{i}") for i in range(n)],
            *[F.sum(F.col("_v") * x[i] * x[j]).alias(f"h{i}_{j}") for i in range(n) for j in range(i, n)],
        ).first()
        if sums["g0"] is None:
            break
        grad = np.array([sums[f"g{i}"] for i in range(n)]) - penalty @ beta
        hess = np.array([[sums[f"h{min(i, j)}_{max(i, j)}"] for j in range(n)] for i in range(n)]) + penalty
        step = np.linalg.solve(hess + 1e-12 * np.eye(n), grad)
        beta = beta + step
        if np.abs(step).max() < tol:
            break
    return Fit(dict(zip(names, beta[:-1].tolist(), strict=True)), float(beta[-1]), k)


def cross_validated(df: DataFrame, features: Sequence[str], label: str, group: str, folds: int, l2: float = 1.0, salt: str = "") -> DataFrame:
    """`df` with `fold` and `score`, each row scored by a fit that never saw its group."""
    split = df.withColumn("fold", fold_of(F.col(group).cast("string"), folds, salt))
    out = None
    for k in range(folds):
        fit = fit_logistic(split.where(F.col("fold") != k), features, label, l2)
        part = split.where(F.col("fold") == k).withColumn("score", fit.score())
        out = part if out is None else out.unionByName(part)
    return out


def chosen_l2(df: DataFrame, features: Sequence[str], label: str, group: str, candidates: Sequence[float], folds: int = 3) -> float:
    """The penalty with the least mean log loss over inner folds (ties: the larger)."""
    best = []
    for l2 in candidates:
        cv = cross_validated(df, features, label, group, folds, l2, "inner")
        p = F.least(F.greatest(F.col("score"), F.lit(1e-12)), F.lit(1 - 1e-12))
        y = F.col(label).cast("double")
        loss = cv.agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p)))).first()[0]
        best.append((loss if loss is not None else float("inf"), -l2))
    return -min(best)[1]


def base_rates(df: DataFrame, keys: Sequence[str], label: str, fold: str) -> DataFrame:
    """(fold, keys, rate): the label's mean over rows outside of each fold."""
    by = df.groupBy(*keys, fold).agg(F.sum(F.col(label).cast("double")).alias("_s"), F.count("*").alias("_n"))
    total = by.groupBy(*keys).agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"))
    joined = by.join(total, list(keys)) if keys else by.crossJoin(F.broadcast(total))
    rest = F.col("_tn") - F.col("_n")
    return joined.select(fold, *keys, F.when(rest > 0, (F.col("_ts") - F.col("_s")) / rest).alias("rate"))
