"""Document fingerprints by consistent weighted sampling.

Terms are words and their weights the counts in a text. For each term and sample, a hash gives
r and c, both Gamma(2, 1) as minus the log of a product of two uniform numbers, and b, uniform; with
weight S, t = floor(ln S / r + b) and ln a = ln c - r (t + 1 - b). The sample is the (term, t) of the smallest a, and two texts share a
sample with a probability of the generalised Jaccard similarity of their weights.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SAMPLES = 64
DIGITS = 4
PART = 13  # bits of each of the four uniform numbers behind the two gammas; the other 12 are for b


def gamma(h: Column, shift: int) -> Column:
    """A Gamma(2, 1) value from 26 bits of a hash."""
    part = lambda s: F.shiftrightunsigned(h, s).bitwiseAND(F.lit(2**PART - 1)) + F.lit(0.5)
    return F.lit(2 * PART * math.log(2)) - F.log(part(shift) * part(shift + PART))


def sample(term: Column, log_weight: Column, k: int) -> Column:
    """Sample k of one term as one number: ln a in steps of 2^-25 above 31 bits that name (term, t)."""
    h = F.xxhash64(term, F.lit(k))
    r, b = gamma(h, 0), F.shiftrightunsigned(h, 4 * PART) * F.lit(2.0 ** -(64 - 4 * PART))
    t = F.floor(log_weight / r + b)
    log_a = F.log(gamma(h, 2 * PART)) - r * (t - b + 1.0)
    level = F.shiftleft(((log_a + 64.0) * F.lit(2.0**25)).cast("long"), 31)
    return level.bitwiseOR(F.shiftrightunsigned(h, 20).bitwiseXOR(t * F.lit(0x9E3779B1)).bitwiseAND(F.lit(0x7FFFFFFF)))


def term_hashes(text: Column) -> Column:
    """Hashes of the words of a text, repeats included."""
    spaced = F.split(F.translate(text, "\t\n\x0b\f\r", "     "), " ")
    return F.transform(F.array_remove(spaced, ""), lambda w: F.xxhash64(w))


def low_bits(found: str, samples: int) -> Column:
    low = F.array(*[F.col(f"{found}_{k}").bitwiseAND(F.lit(16**DIGITS - 1)) for k in range(samples)])
    return F.when(F.col(f"{found}_0").isNotNull(), low)


def fingerprints(rows: DataFrame, keys: list[str], texts: list[str], samples: int = SAMPLES) -> DataFrame:
    """`keys` and an array of samples under the name of each of one or two text columns; null for a text without words.

    Words of two texts of a row are counted together, so that a word that both have equally often is sampled once for both:
    the last bit of a word's hash says which text it is from. Where rows are already dealt out by some of the keys, nothing is shuffled.
    """

    def tagged(text: str, tag: int) -> Column:
        return F.transform(term_hashes(F.col(text)), lambda h: F.shiftleft(F.shiftright(h, 1), 1).bitwiseOR(F.lit(tag).cast("long")))

    terms = rows.select(*keys, F.sort_array(F.concat(*[tagged(t, i) for i, t in enumerate(texts)])).alias("_s"))
    last = F.size("_s")
    ends = F.filter(F.sequence(F.lit(1), last), lambda i: (i == last) | (F.element_at("_s", i) != F.get("_s", i)))
    terms = terms.withColumn("_ends", F.when(last > 0, ends))
    terms = terms.select(*keys, "_s", "_ends", F.posexplode_outer("_ends").alias("_i", "_end"))
    end = lambda back: F.when(F.col("_i") >= back, F.get("_ends", F.col("_i") - back)).otherwise(0)
    at = lambda e: F.get("_s", e - 1)
    terms = terms.select(*keys, "_s", "_i", "_end", end(1).alias("_before"), end(2).alias("_earlier"), F.get("_ends", F.col("_i") + 1).alias("_next"))
    word = F.shiftright(at(F.col("_end")), 1)
    # Of a word of both texts, the second run speaks for both.
    terms = terms.where(F.col("_next").isNull() | (F.shiftright(at(F.col("_next")), 1) != word) | F.col("_end").isNull())
    second = at(F.col("_end")).bitwiseAND(F.lit(1)) == 1
    mine, other = F.col("_end") - F.col("_before"), F.when((F.col("_i") > 0) & (F.shiftright(at(F.col("_before")), 1) == word), F.col("_before") - F.col("_earlier"))
    counts = [F.when(second, other).otherwise(mine), F.when(second, mine)]
    # which: 0 and 1 for one text alone, 2 for both.
    weighted = lambda which, n: F.struct(F.lit(which).alias("which"), n.alias("n"))
    a, b = counts
    uses = F.when(a == b, F.array(weighted(2, a))).when(a.isNull(), F.array(weighted(1, b))).when(b.isNull(), F.array(weighted(0, a))).otherwise(F.array(weighted(0, a), weighted(1, b)))
    terms = terms.select(*keys, word.alias("_term"), F.explode(uses).alias("_use")).select(*keys, "_use.which", "_term", F.log(F.col("_use.n").cast("double")).alias("_w"))
    found = terms.groupBy(*keys, "which").agg(*[F.min(sample(F.col("_term"), F.col("_w"), k)).alias(f"_{k}") for k in range(samples)])
    mins = [F.min(F.when(F.col("which") != 1 - i, F.col(f"_{k}"))).alias(f"_{i}_{k}") for i in range(len(texts)) for k in range(samples)]
    found = found.groupBy(*keys).agg(*mins)
    return found.select(*keys, *[low_bits(f"_{i}", samples).alias(t) for i, t in enumerate(texts)])


def as_text(samples: Column, n: int = SAMPLES) -> Column:
    """Fixed-width hex digits of the samples; of a text without words, as many zeros."""
    words = F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x)), DIGITS, "0"))
    return F.coalesce(F.array_join(words, ""), F.lit("0" * (DIGITS * n)))


def likeness(a: Column, b: Column, n: int = SAMPLES) -> Column:
    """The share of equal samples: 1 for two texts without words, 0 if just one has none."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same / F.lit(float(n)))


def with_next(df: DataFrame, doc_id: str, text: str, buckets: int) -> DataFrame:
    """bucket, rank, ghost, id, text, next_text: rows by descending id, the next one beside each, the first after the last.

    Ids are cut into buckets by quantiles and each bucket is put in order by itself; its last row
    meets the first row of the bucket below, which is added to it as a ghost. So one shuffle of the
    rows is enough. Ties go by text; null ids come last.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cuts = sorted(set(rows.approxQuantile("id", [i / buckets for i in range(1, buckets)], 0.25 / buckets))) if buckets > 1 else []
    bucket = F.coalesce(F.size(F.filter(F.lit([float(c) for c in cuts]), lambda c: c <= F.col("id"))), F.lit(0)) if cuts else F.lit(0)
    rows = rows.withColumn("bucket", bucket)
    heads = rows.groupBy("bucket").agg(F.max(F.struct("id", "text")).alias("head"))
    # One row for each bucket: their number is fixed by the setting above.
    order = Window.orderBy("bucket")
    above = F.coalesce(F.lead("bucket").over(order), F.min("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    ghosts = heads.select(above.alias("bucket"), F.col("head.id").alias("id"), F.col("head.text").alias("text"), F.lit(1).alias("ghost"))
    both = rows.withColumn("ghost", F.lit(0)).unionByName(ghosts)
    inside = Window.partitionBy("bucket").orderBy("ghost", F.col("id").desc_nulls_last(), F.desc("text"))
    return both.select("bucket", F.row_number().over(inside).alias("rank"), "ghost", "id", "text", F.lead("text").over(inside).alias("next_text"))


def edited_text(text: Column, other: Column) -> Column:
    """The last third (rounded down) of the code points replaced by the first as many of the other text."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(F.coalesce(other, F.lit("")), F.lit(1), cut))


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each text and its edited text; repeated rows stay, each with its own next row."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ordered = with_next(docs, "doc_id", "text", 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    n, edited = F.length("text"), edited_text(F.col("text"), F.col("next_text"))
    at = ["bucket", "rank"]
    found = fingerprints(ordered.select(*at, "text", edited.alias("edited")), at, ["text", "edited"])
    line = Window.partitionBy("bucket").orderBy("rank")
    found = found.select(*at, "text", "edited", F.lead("text").over(line).alias("next")).toDF(*at, "samples", "own", "next")
    about = ordered.where("ghost = 0").select(*at, "id", n.cast("long").alias("n_chars"), F.sha2(edited.cast("binary"), 256).alias("edited_sha256"))
    return about.join(found, at).select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", as_text(F.col("samples")).alias("fingerprint"), as_text(F.col("own")).alias("edited_fingerprint"),
        likeness(F.col("samples"), F.col("own")).alias("near_edited"), likeness(F.col("samples"), F.col("next")).alias("near_next"),
    )
