"""Sums along one global order, without putting all values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 64


def running_totals(df: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str], descending: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """`df` with `run_<c>` for each of `sums`: its sum over rows of the keys up to this one in `order`; values of `order` are distinct within keys.

    Approximate quantiles cut `order` (a number) into ranges. A window sums within each key and range, and a second one, over a row a
    key and range, what the ranges before hold. Cuts decide only who works on what; sums are exact. Nulls come first, last if descending.
    """
    cuts = sorted(set(df.approxQuantile(order, [i / buckets for i in range(1, buckets)], 0.005))) if buckets > 1 else []
    at = F.lit(0)
    if cuts:
        listed = F.array(*[F.lit(float(c)) for c in cuts])
        at = F.when(F.col(order).isNull(), -1).otherwise(F.size(F.filter(listed, lambda c: c <= F.col(order))))
    way = (lambda c: F.desc(c)) if descending else (lambda c: F.asc(c))
    parted = df.withColumn("_range", at)
    within = Window.partitionBy(*keys, "_range").orderBy(way(order))
    part = parted.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    before = Window.partitionBy(*keys).orderBy(way("_range")).rowsBetween(Window.unboundedPreceding, -1)  # at most a row a range
    offsets = part.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_range_at"), *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums])
    on = F.col("_range") == F.col("_range_at")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    summed = parted.select("*", *[F.sum(c).over(within).alias(f"_in_{c}") for c in sums])
    return summed.join(offsets, on).select(*df.columns, *[(F.col(f"_in_{c}") + F.col(f"_off_{c}")).alias(f"run_{c}") for c in sums])


def range_counts(points: DataFrame, spans: DataFrame, at: str, start: str, end: str, keys: Sequence[str] = (), name: str = "n") -> DataFrame:
    """`spans` with the number of points of the same keys in [start, end), by prefix sums: no point meets a span.

    Points and both ends of all spans are put in one order, each value once; a span's count is what lies before its end less
    what lies before its start. Work is linear in points and spans, whatever the spans' lengths. Spans without length or with a missing end hold 0.
    """
    marks = points.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_n"))
    for c in (start, end):
        marks = marks.union(spans.select(*keys, F.col(c).alias("_at"), F.lit(0).alias("_n")))
    total = marks.where(F.col("_at").isNotNull()).groupBy(*keys, "_at").agg(F.sum("_n").alias("_n"))
    run = running_totals(total, keys, "_at", ["_n"])
    out = spans
    for c, before in ((start, "_lo"), (end, "_hi")):
        side = run.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_at").alias("_v"), (F.col("run__n") - F.col("_n")).alias(before))
        out = out.join(side, [out[c] == side["_v"], *[out[k].eqNullSafe(side[f"_k_{k}"]) for k in keys]], "left").drop("_v", *[f"_k_{k}" for k in keys])
    held = F.greatest(F.col("_hi") - F.col("_lo"), F.lit(0))
    return out.withColumn(name, F.coalesce(F.when(F.col(end) > F.col(start), held), F.lit(0)).cast("long")).drop("_lo", "_hi")


def quantiles_at(df: DataFrame, keys: Sequence[str], value: str, wanted: DataFrame, q: str) -> DataFrame:
    """(keys, q, quantile): for each row of `wanted` (keys and a quantile from 0 to 1) the interpolated quantile of `value` in its keys.

    From running counts of distinct values, so no task holds all values. Missing values don't count; keys without any give no row.
    """
    at = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    total = at.groupBy(*keys).agg(F.sum("_n").alias("_of"))
    run = running_totals(at, keys, value, ["_n"])
    asked = wanted.select(*keys, q).distinct().join(total, list(keys)).withColumn("_h", F.col(q) * (F.col("_of") - 1))
    low, high = F.floor("_h"), F.ceil("_h")
    holds = lambda rank: (F.col("run__n") - F.col("_n") <= rank) & (rank < F.col("run__n"))
    met = asked.join(run, list(keys)).where(holds(low) | holds(high))
    ends = met.groupBy(*keys, q, "_h").agg(F.max(F.when(holds(low), F.col(value))).alias("_a"), F.max(F.when(holds(high), F.col(value))).alias("_b"))
    return ends.select(*keys, q, (F.col("_a") + (F.col("_h") - F.floor("_h")) * (F.col("_b") - F.col("_a"))).alias("quantile"))
