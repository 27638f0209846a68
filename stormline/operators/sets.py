"""Set operators and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each key, with their rank."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


TASK_ROWS = 500_000  # rows of both builds whose counts one task holds
PIECE = 1024  # copies that one array gives


def multiset_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that one build has more often than the other, as 'removed' and 'added'.

    Both builds are counted in one pass, one up and the other down. Rows are mostly distinct, so a task's counts grow with its rows: the number of tasks
    follows the rows, counted first, and isn't coalesced by bytes, which say little of what counts need. Copies of a row meet in one task, as a sum.
    """
    names = before.columns
    both = before.select("*", F.lit(1).cast("long").alias("_n")).union(after.select("*", F.lit(-1).cast("long")))
    tasks = max(int(before.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-both.count() // TASK_ROWS))
    listed = [F.col(f"`{c}`") for c in names]
    more = both.repartition(tasks, *listed).groupBy(*listed).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    side = F.when(F.col("_n") > 0, "removed").otherwise("added").alias("side")
    pieces = more.select(side, *listed, F.abs("_n").alias("_n"), F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(abs(_n) - 1) div {PIECE}"))).alias("_piece"))
    return pieces.select("side", *listed, F.explode(F.array_repeat(F.lit(0), F.least(F.lit(PIECE), F.col("_n") - F.col("_piece") * PIECE).cast("int"))).alias("_copy")).drop("_copy")


def key_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(keys, change): keys that were added, removed, or moved to other values."""
    pack = lambda df, name: df.select(*keys, F.struct(*values).alias(name))
    both = pack(before, "_a").join(pack(after, "_b"), list(keys), "full_outer")
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "moved")
    return both.select(*keys, change.alias("change")).where(F.col("change").isNotNull())
