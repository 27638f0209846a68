"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormline.llm.store import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
RANK_BUCKETS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: int, *cols: Column) -> Column:
    """A number in (0, 1) that depends on the columns and the seed alone."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11).cast("double") + 0.5) / F.lit(2.0**53)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """(source, source_size) with `target`: weights dealt in code point order, null last.

    `share` of all sizes is dealt by weight; a target stops at cap * source_size and the
    excess goes to the others by weight until none is above. The shares are found by passes
    of one aggregate each; every pass caps one source more at least. Ranks are taken by one
    sort of the sources, a row of three numbers each.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = stored(
        sizes.withColumn("_i", (F.row_number().over(order) - 1) % len(weights)).select(
            "source", "source_size", F.element_at(F.lit(list(map(float, weights))), (F.col("_i") + 1).cast("int")).alias("_w")
        ),
        "targets",
    )
    limit = F.col("source_size") * F.lit(float(cap))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    unit, seen = 0.0, -1
    while True:
        full = limit <= F.col("_w") * F.lit(unit)
        n, used, free = ranked.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("_w")))
        ).first()
        if n == seen or not free:
            break
        seen, unit = n, (share * total - (used or 0.0)) / free
    return ranked.select("source", "source_size", F.least(limit, F.col("_w") * F.lit(unit)).alias("target"))


def mix_sources(
    df: DataFrame,
    key: str,
    source: str,
    text: str,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 17,
    rank_buckets: int = RANK_BUCKETS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """`key`, size, source_size, target, taken, copies and the `carry` columns, a row for each row of df.

    Each document is worth target / source_size copies. The whole copies are certain; the
    rest p is the inclusion probability of one copy more, drawn by Pareto order sampling:
    documents are ranked by [U / (1 - U)] / [p / (1 - p)], with U uniform by key, and taken
    in that order while they bring the source's words nearer to its target (a size fixed to
    half a document). The order within a source is found in two steps, so that a source with
    a third of all rows is spread out: words by (source, bucket of rank), then a ranking of
    the one bucket in which the target falls. Rows with one key and text rank alike, in a row.
    A null text has size 0; size 0 is never taken. An empty table gives an empty result.
    """
    rows = df.select(
        F.col(key).alias("_key"), F.col(source).alias("_source"), word_count(F.col(text)).alias("size"),
        F.xxhash64(text).alias("_text"), *[F.col(c).alias(f"_carry_{c}") for c in carry],
    )
    sizes = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, cap)
    worth = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = targets.select(
        "source", "source_size", "target", F.floor(worth).cast("long").alias("_whole"),
        (worth - F.floor(worth)).alias("_p"),
        (F.col("target") - F.floor(worth) * F.col("source_size")).alias("_left"),
    )
    u = uniform(seed, F.col("_key"))
    odds = (u / (1 - u)) / (F.col("_p") / (1 - F.col("_p")))
    ranked = rows.join(plan, F.col("_source").eqNullSafe(F.col("source"))).withColumn(
        "_q", F.when(F.col("_p") > 0, odds).otherwise(F.lit(float("inf")))
    )
    # q / (1 + q) lies in (0, 1); by it the buckets of a source hold about as many documents each.
    even = F.when(F.col("_p") > 0, u).otherwise(F.lit(1.0))
    ranked = ranked.withColumn("_b", F.least(F.floor(even * rank_buckets), F.lit(rank_buckets - 1)).cast("int"))
    words = ranked.groupBy("source", "_left", "_b").agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    words = words.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    cut = words.where((F.col("_before") < F.col("_left")) & (F.col("_before") + F.col("_n") >= F.col("_left"))).groupBy("source").agg(
        F.min(F.struct("_b", "_before")).alias("_cut")
    )
    cut = cut.select(F.col("source").alias("_s"), F.col("_cut._b").alias("_cut_b"), F.col("_cut._before").alias("_cut_before"))
    ranked = ranked.join(cut, F.col("_source").eqNullSafe(F.col("_s")), "left")
    at = F.col("_b") == F.col("_cut_b")
    run = Window.partitionBy("_source").orderBy("_q", "_key", "_text", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranked.where(at).withColumn("_upto", F.col("_cut_before") + F.coalesce(F.sum("size").over(run), F.lit(0)))
    inside = inside.withColumn("_more", (F.col("_upto") + F.col("size") / 2 <= F.col("_left")).cast("long"))
    outside = ranked.where(~F.coalesce(at, F.lit(False))).withColumn("_upto", F.lit(None).cast("long")).withColumn(
        "_more", ((F.col("_b") < F.col("_cut_b")) | (F.col("_cut_b").isNull() & (F.col("_left") > 0) & (F.col("_p") > 0))).cast("long")
    )
    copies = F.col("_whole") + F.coalesce("_more", F.lit(0))
    return inside.unionByName(outside).select(
        F.col("_key").alias(key), "size", "source_size", "target",
        (F.col("size") * copies).alias("taken"), copies.alias("copies"),
        *[F.col(f"_carry_{c}").alias(c) for c in carry],
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs, "doc_id", "source", "text")
