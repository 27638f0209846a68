"""Phrases of any length in texts, found by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def leftmost_longest(texts: DataFrame, key: str, words: str, phrases: DataFrame, phrase: str) -> DataFrame:
    """(key, at, n, phrase): phrases in texts, from word `at` (0 first) over n words, none overlapping.

    At each place the longest phrase wins, and the search goes on behind it. `words` is an array
    of words, `phrase` words joined by single spaces. A word that begins no phrase goes in the first join; those
    that do look up runs of just the lengths that phrases beginning with them have. Keys must be distinct.
    Null or empty phrases and texts match nothing.
    """
    known = phrases.where(F.col(phrase) != "").select(F.col(phrase).alias("_phrase")).distinct()
    parts = F.split("_phrase", " ")
    firsts = known.groupBy(F.get(parts, 0).alias("_word")).agg(F.collect_set(F.size(parts)).alias("_sizes"))
    tokens = texts.select(F.col(key).alias("_key"), F.posexplode(words).alias("_at", "_word"))
    starts = tokens.join(firsts, "_word").groupBy("_key").agg(F.collect_list(F.struct("_at", "_sizes")).alias("_starts"))
    whole = texts.select(F.col(key).alias("_key"), F.col(words).alias("_words")).join(starts, "_key")
    start = whole.select("_key", "_words", F.explode("_starts").alias("_s")).select("_key", "_words", F.col("_s._at").alias("at"), F.explode("_s._sizes").alias("n"))
    runs = start.where(F.col("at") + F.col("n") <= F.size("_words")).select("_key", "at", "n", F.array_join(F.slice("_words", F.col("at") + 1, F.col("n")), " ").alias("_phrase"))
    found = runs.join(known, "_phrase").groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("at", (-F.col("n")).alias("less"), "_phrase"))).alias("_all"))
    none = F.filter("_all", lambda m: F.lit(False))
    kept = F.aggregate(
        "_all", F.struct(F.lit(0).alias("free"), none.alias("out")),
        lambda acc, m: F.when(m["at"] >= acc["free"], F.struct((m["at"] - m["less"]).alias("free"), F.concat(acc["out"], F.array(m)).alias("out"))).otherwise(acc),
        lambda acc: acc["out"],
    )
    m = found.select("_key", F.explode(kept).alias("m"))
    return m.select(F.col("_key").alias(key), "m.at", (-F.col("m.less")).alias("n"), F.col("m._phrase").alias(phrase))


def spans_of(text: Column, pattern: str) -> Column:
    """Where a pattern matches: an array of structs (begin, end) of characters from 0, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<begin:int,end:int>>")

    def step(acc: Column, i: Column) -> Column:
        begin = acc["at"] + F.length(F.get(gaps, i))
        end = begin + F.length(F.get(found, i))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(begin.alias("begin"), end.alias("end")))).alias("out"))

    places = F.when(F.size(found) > 0, F.sequence(F.lit(0), F.size(found) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
