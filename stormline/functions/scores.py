"""Features, classes and scores as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_of(key: Column, k: int, salt: str = "") -> Column:
    """sha1(salt and key) mod k over all 160 bits, folded a hex digit at a time."""
    digits = F.split(F.sha1(F.concat(F.lit(salt), key).cast("binary")), "")
    return F.aggregate(F.filter(digits, lambda d: d != ""), F.lit(0).cast("long"), lambda acc, d: (acc * 16 + F.conv(d, 16, 10).cast("long")) % k).cast("int")


def linear(model: Mapping[str, float], intercept: float = 0.0) -> Column:
    """intercept + sum of coefficient * column, in the model's order; any missing value gives null."""
    out = F.lit(float(intercept))
    for name, w in model.items():
        out = out + F.lit(float(w)) * F.col(name)
    return out


def need_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def bar_columns(df: DataFrame, barred: Sequence[str]) -> DataFrame:
    """Fails if a column that leaks the label is there."""
    leaks = sorted(set(barred) & set(df.columns))
    if leaks:
        raise ValueError(f"barred columns: {', '.join(leaks)}")
    return df


def logistic(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def dummies(value: Column, levels: Sequence[str], prefix: str) -> list[Column]:
    """One 0/1 column a level but the first, the base; a level that isn't listed raises."""
    known = F.when(value.isin(*levels), F.lit(0)).otherwise(F.raise_error(F.concat(F.lit("unknown level "), F.coalesce(value, F.lit("null")))).cast("int"))
    return [(F.when(value == level, 1).otherwise(0) + known).cast("int").alias(f"{prefix}_{level}") for level in levels[1:]]


def log1p_or_null(mm: Column) -> Column:
    """log(1 + mm); negative and missing amounts stay missing."""
    return F.when(mm >= 0, F.log1p(mm))


def csi(tp: Column, fp: Column, fn: Column) -> Column:
    return F.when(tp + fp + fn > 0, tp / (tp + fp + fn))


def bracket(mm: Column, steps: Sequence[tuple[str, float]]) -> Column:
    """The name of the highest step reached; null below the first."""
    out = None
    for name, least in sorted(steps, key=lambda s: -s[1]):
        out = F.when(mm >= least, name) if out is None else out.when(mm >= least, name)
    return out


def freshness(age_s: Column, stale_s: int, down_s: int) -> Column:
    """FRESH, STALE or DOWN by age; no stamp, or one from the future, is DOWN."""
    return F.when(age_s.isNull() | (age_s < 0) | (age_s > down_s), "DOWN").when(age_s > stale_s, "STALE").otherwise("FRESH")


def event_class(rain: Column, tide: Column, snow: Column) -> Column:
    """What drove an event, by its three triggers."""
    return (
        F.when(rain & tide, "mixed").when(tide, "coastal").when(rain & snow, "snowmelt").when(rain, "pluvial").otherwise("unclassified")
    )
