"""Sharding: rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOT_BUCKETS = 256


def rendezvous_shard(key: Column, weights: Sequence[float], seed: str = "shard") -> Column:
    """The shard whose score -weight / ln(u) is highest, u being uniform by (seed, shard, key).

    The weight of other shards never enters a shard's score, so a shard more takes rows
    only into itself. A null key has its own fixed shard; ties go to the lower shard.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must be non-negative, with one above 0")

    def score(i: int) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(i), key), 11)
        return F.lit(float(weights[i])) / -F.log((bits.cast("double") + 0.5) / F.lit(2.0**53))

    best = F.array_max(F.array(*[F.struct(score(i).alias("s"), F.lit(-i).alias("i")) for i in range(len(weights))]))
    return F.abs(best["i"]).cast("int")


def assign_shards(
    df: DataFrame,
    key: str,
    text: str,
    weights: Sequence[float],
    grown_weights: Sequence[float] | None = None,
    slot_buckets: int = SLOT_BUCKETS,
) -> DataFrame:
    """`key`, size, text_crc32, law, shard, slot and grown_shard of each row.

    size is the UTF-8 bytes of the text plus 8; a null text has none and crc32 0. Repeated
    rows stay as they are, in slots of their own. Slots run from 0 without gaps in each
    shard: rows are numbered inside (shard, bucket of the key's hash) and the counts of the
    buckets before are added, so no task holds a whole shard. Other columns are dropped, so
    their names can't clash. An empty table gives an empty result.
    """
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = df.select(
        F.col(key).alias("_key"),
        (F.octet_length(raw).cast("long") + 8).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        rendezvous_shard(F.col(key), weights).alias("shard"),
        (rendezvous_shard(F.col(key), grown_weights) if grown_weights else F.lit(None).cast("int")).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit("slot"), F.col(key)), F.lit(slot_buckets)).cast("int").alias("_bucket"),
    )
    counts = rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("shard", "_bucket").orderBy("_key", "text_crc32", "size")
    # At most shards x slot_buckets rows of 3 numbers, whatever the input: safe to broadcast.
    return (
        rows.withColumn("_rank", F.row_number().over(inner) - 1)
        .join(F.broadcast(offsets), ["shard", "_bucket"])
        .select(
            F.col("_key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("_before") + F.col("_rank")).cast("long").alias("slot"), "grown_shard",
        )
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assign_shards(docs, "doc_id", "text", [1.0] * 24, [1.0] * 25)
