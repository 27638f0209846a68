"""Data-quality checks: rows of (check, subject, status, measure)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormline.operators.aggregates import set_digest


def result(check: str, subject: Column, ok: Column, measure: Column) -> list[Column]:
    """ok, fail, or inconclusive where it can't be told."""
    status = F.when(ok.isNull(), "inconclusive").when(ok, "ok").otherwise("fail")
    return [F.lit(check).alias("check"), subject.cast("string").alias("subject"), status.alias("status"), measure.cast("double").alias("measure")]


def exit_code(results: DataFrame) -> DataFrame:
    """1 if anything failed, else 2 if anything is inconclusive, else 0."""
    any_of = lambda s: F.coalesce(F.bool_or(F.col("status") == s), F.lit(False))
    return results.agg(F.when(any_of("fail"), 1).when(any_of("inconclusive"), 2).otherwise(0).alias("rc"))


def missing_hours(seen: DataFrame, want: DataFrame, keys: Sequence[str], dead: DataFrame | None = None) -> DataFrame:
    """Wanted (keys) that weren't seen and aren't known to be dead."""
    out = want.join(seen.select(*keys).distinct(), list(keys), "left_anti")
    return out if dead is None else out.join(dead, list(keys), "left_anti")


def stale_dead(seen: DataFrame, dead: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entries of the dead list that have rows after all."""
    return dead.join(seen.select(*keys).distinct(), list(keys), "left_semi")


def fidelity(filled: DataFrame, live: DataFrame, key: str, lo: float = 0.9, hi: float = 1.1) -> DataFrame:
    """Rows and distinct keys of a fill against live capture, by ratio bands."""
    count = lambda df, tag: df.agg(F.count("*").alias(f"rows_{tag}"), F.countDistinct(key).alias(f"keys_{tag}"))
    both = count(filled, "a").crossJoin(F.broadcast(count(live, "b")))  # one row each
    rows, keys = F.col("rows_a") / F.col("rows_b"), F.col("keys_a") / F.col("keys_b")
    return both.select(*result("row_ratio", F.lit("rows"), rows.between(lo, hi), rows)).union(both.select(*result("key_ratio", F.lit("keys"), keys.between(lo, hi), keys)))


def parity(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, verdict) of two builds, partition by partition, by digests that no order changes."""
    pack = lambda df, name: set_digest(df, keys).select(*keys, F.struct("n", "lo", "hi").alias(name))
    both = pack(a, "_a").join(pack(b, "_b"), list(keys), "full_outer")
    verdict = F.when(F.col("_a").isNull(), "only_b").when(F.col("_b").isNull(), "only_a").when(F.col("_a") == F.col("_b"), "equal").otherwise("differs")
    return both.select(*keys, verdict.alias("verdict"))


def gates(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One aggregate for all rules; a rule is a boolean aggregate."""
    got = df.agg(*[c.alias(n) for n, c in rules.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("ok")) for n in rules]))
    status = F.when(F.col("p.ok").isNull(), "inconclusive").when(F.col("p.ok"), "ok").otherwise("fail")
    return got.select(pairs.alias("p")).select("p.check", status.alias("status"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    return child.join(parent, list(on), "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_null) of columns that may not be missing."""
    got = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    return got.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns])).alias("p")).select("p.*")


def expectations(df: DataFrame, table: Sequence[tuple[str, str, float]]) -> DataFrame:
    """(expectation, share, ok) of a table of (name, SQL predicate, least share); a missing value doesn't meet it."""
    got = df.agg(*[F.avg(F.coalesce(F.expr(p), F.lit(False)).cast("double")).alias(n) for n, p, _ in table])
    rows = F.array(*[F.struct(F.lit(n).alias("expectation"), F.col(n).alias("share"), (F.col(n) >= least).alias("ok")) for n, _, least in table])
    return got.select(F.explode(rows).alias("r")).select("r.*")
