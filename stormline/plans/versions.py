"""Schedule versions: codes of a day and the version in effect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked_codes(df: DataFrame, keys: Sequence[str], code: str) -> DataFrame:
    """(keys, code, n, rank): codes by falling count, ties by code."""
    n = df.where(F.col(code).isNotNull()).groupBy(*keys, code).agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), code)))


LEVELS = 23  # spans of up to 2^22 days, more than dates have


def _aligned(first: Column, last: Column) -> Column:
    """The aligned stretches (level, part) of 2^level days that together are the days from `first` to `last`: two a level at most."""

    def at(level: Column) -> Column:
        low, high = -F.floor(-first / F.pow(F.lit(2), level)), F.floor((last + 1) / F.pow(F.lit(2), level))
        odd = lambda c: F.pmod(c, F.lit(2)) == 1
        part = lambda c: F.struct(level.alias("level"), c.cast("long").alias("part"))
        return F.array(F.when((low < high) & odd(low), part(low)), F.when((low < high) & odd(high), part(high - 1)))

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), at)), lambda p: p.isNotNull())


def resolved(days: DataFrame, versions: DataFrame, code: str, day: str) -> DataFrame:
    """Days with the newest version of their code that was published by the day after and covers the day; of equally new ones the smallest.

    A version counts from its first day, or the day before it was published if that is later. Its days are cut into aligned stretches, each of which keeps its
    best version by an aggregate, and a day looks up the few stretches it lies in: no day meets all versions of its code or all that cover it.
    """
    number = F.unix_date
    since = F.greatest(number("valid_from"), number("published") - 1).alias("_from")
    usable = versions.where("published IS NOT NULL AND valid_from IS NOT NULL AND valid_to IS NOT NULL")
    spans = usable.select(F.col(code).alias("_code"), since, number("valid_to").alias("_to"), F.struct((-number("published")).alias("_late"), F.col("version").alias("version")).alias("_v")).where("_from <= _to")
    spans = spans.groupBy("_code", "_from", "_to").agg(F.min("_v").alias("_v"))
    best = spans.select("_code", F.explode(_aligned(F.col("_from"), F.col("_to"))).alias("_p"), "_v").groupBy("_code", "_p").agg(F.min("_v").alias("_v"))
    each = days.distinct()
    met = each.select("*", F.explode(F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda n: F.struct(n.alias("level"), F.floor(number(day) / F.pow(F.lit(2), n)).cast("long").alias("part")))).alias("_at"))
    found = met.join(best, (F.col(code) == F.col("_code")) & (F.col("_at") == F.col("_p")), "left")
    return found.groupBy(*[F.col(f"`{c}`") for c in days.columns]).agg(F.min("_v").alias("_v")).select(*[F.col(f"`{c}`") for c in days.columns], F.col("_v.version").alias("version"))


def match_rate(df: DataFrame, keys: Sequence[str], pattern: str, column: str, least: float = 0.98) -> DataFrame:
    """(keys, rate, ok): how many ids follow the grammar."""
    return df.groupBy(*keys).agg(F.avg(F.col(column).rlike(pattern).cast("double")).alias("rate")).withColumn("ok", F.col("rate") >= least)
