"""Window operators: total orders, runs, sessions, trailing frames and latches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormline.operators.scratch import stored


def cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row a key: the first by `order` and then by every remaining column, nulls first.

    The order is total, so the row that stays doesn't depend on how rows were dealt out.
    """
    rest = [F.col(c).asc_nulls_first() for c in sorted(df.columns) if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def with_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], same: Sequence[str], name: str = "run_id") -> DataFrame:
    """Numbers the stretches of equal `same` values of each key; coming back to a value is a new run."""
    w = Window.partitionBy(*keys).orderBy(*order)
    stays = F.lit(True)
    for c in same:
        stays = stays & F.col(c).eqNullSafe(F.lag(c).over(w))
    new = (~stays | (F.row_number().over(w) == 1)).cast("long")
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(w)).drop("_new")


def with_next(df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str], suffix: str = "_next") -> DataFrame:
    """The next row's values beside each row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.select("*", *[F.lead(c).over(w).alias(c + suffix) for c in carry])


def with_flips(df: DataFrame, keys: Sequence[str], order: Sequence[str], flip: Column) -> DataFrame:
    """Flips so far and in all."""
    w = Window.partitionBy(*keys).orderBy(*order)
    n = flip.cast("long")
    return df.select("*", F.sum(n).over(w).alias("flips_so_far"), F.sum(n).over(Window.partitionBy(*keys)).alias("flips_total"))


def with_sessions(df: DataFrame, keys: Sequence[str], ts: str, gap_s: int, name: str = "session") -> DataFrame:
    """Numbers sessions: a row more than gap_s after the one before opens a new one."""
    w = Window.partitionBy(*keys).orderBy(ts)
    new = F.coalesce((F.col(ts) - F.lag(ts).over(w) > gap_s).cast("long"), F.lit(1))
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(w)).drop("_new")


def day_runs(df: DataFrame, day: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, first_day, last_day, n_days) of runs of days that follow one another."""
    w = Window.partitionBy(*keys).orderBy(day)
    days = df.select(*keys, day).distinct()
    island = days.withColumn("_island", F.date_sub(F.col(day), F.row_number().over(w)))
    return island.groupBy(*keys, "_island").agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("n_days")
    ).drop("_island")


def _ruled_out(kept: Column, blank: Column) -> Column:
    """Tuples (at, a, b), newest first, without those that no row can need.

    A row that differs from a tuple in both values is served by the newest such tuple. A tuple is needed if some row shares a value with
    every newer one, but none with it. The ways to share with all so far are kept as partial rows (a, b; null: free), two at most, so at
    most four tuples remain.
    """
    none = F.slice(kept, 1, 0)

    def step(acc: Column, t: Column) -> Column:
        standing = F.filter(acc["ways"], lambda w: (w["a"].isNull() | (w["a"] != t["a"])) & (w["b"].isNull() | (w["b"] != t["b"])))
        rest = F.array_except(acc["ways"], standing)
        more = F.flatten(F.transform(standing, lambda w: F.concat(
            F.when(w["a"].isNull(), F.array(F.struct(t["a"].alias("a"), w["b"].alias("b")))).otherwise(F.slice(standing, 1, 0)),
            F.when(w["b"].isNull(), F.array(F.struct(w["a"].alias("a"), t["b"].alias("b")))).otherwise(F.slice(standing, 1, 0)),
        )))
        return F.when(F.size(standing) > 0, F.struct(F.concat(acc["kept"], F.array(t)).alias("kept"), F.concat(rest, more).alias("ways"))).otherwise(acc)

    return F.aggregate(kept, F.struct(none.alias("kept"), F.array(blank).alias("ways")), step, lambda acc: acc["kept"])


BLOCK = 1024  # tuples that one fold walks


def previous_other(df: DataFrame, keys: Sequence[str], order: str, differ: Sequence[str], name: str, slice_width: float = 86_400) -> DataFrame:
    """The latest earlier `order` value in the group whose row differs in BOTH of the two `differ` columns.

    "Differs in both" isn't transitive, so runs can't give it. But whatever came before, at most four of the newest tuples can
    still matter, and the four of two stretches follow from the four of each. So a group is cut into slices of `slice_width` along `order`, and a slice
    into blocks of a fixed number of tuples, however many rows share a slice or a time: each block gives its few tuples, a fold over blocks gives those before each, and
    a walk along a block's times gives those before each. Rows then join the few of their time; only a group's blocks, four tuples each, are one array.
    Rows without an earlier other one get null, as do rows with a null in `order` or `differ`, which are no one's predecessor either.
    """
    first, second = differ
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    whole = F.col(order).isNotNull() & F.col(first).isNotNull() & F.col(second).isNotNull()
    names = [f"_k{i}" for i in range(len(keys))]
    known = df.where(whole).select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.floor(F.col(order) / slice_width).alias("_slice"), F.col(order).alias("at"), F.col(first).alias("a"), F.col(second).alias("b"))
    blank = F.struct(F.lit(None).cast(kinds[first]).alias("a"), F.lit(None).cast(kinds[second]).alias("b"))
    along = Window.partitionBy(*names, "_slice").orderBy("at", "a", "b")
    opens = F.coalesce(F.col("at") != F.lag("at").over(along), F.lit(True))  # the first tuple of its time, in whatever block
    numbered = known.withColumn("_opens", opens).withColumn("_block", F.floor((F.row_number().over(along) - 1) / BLOCK))
    # a block's tuples of one time don't see each other, so few of them go on as well
    moments = numbered.groupBy(*names, "_slice", "_block", "at").agg(F.bool_or("_opens").alias("_opens"), F.collect_list(F.struct("at", "a", "b")).alias("_t")).withColumn("_t", _ruled_out(F.col("_t"), blank))
    blocks = moments.groupBy(*names, "_slice", "_block").agg(F.sort_array(F.collect_list(F.struct("at", "_opens", "_t"))).alias("_m"))
    tuples = f"array<struct<at:{kinds[order]},a:{kinds[first]},b:{kinds[second]}>>"
    newest = _ruled_out(F.flatten(F.transform(F.reverse("_m"), lambda m: m["_t"])), blank)
    blocks = stored(blocks.select(*names, F.struct("_slice", "_block").alias("_part"), "_m", newest.alias("_newest")), "blocks")
    parted = blocks.groupBy(*names).agg(F.sort_array(F.collect_list(F.struct("_part", "_newest"))).alias("_s"))

    def merged(newer: Column, older: Column) -> Column:
        rest = F.filter(older, lambda t: ~F.exists(newer, lambda u: (u["a"] == t["a"]) & (u["b"] == t["b"])))
        return _ruled_out(F.concat(newer, rest), blank)

    def later(acc: Column, s: Column) -> Column:
        return F.struct(merged(s["_newest"], acc["held"]).alias("held"), F.concat(acc["out"], F.array(F.struct(s["_part"].alias("_part"), acc["held"].alias("_held")))).alias("out"))

    start = F.struct(F.array().cast(tuples).alias("held"), F.array().cast(f"array<struct<_part:struct<_slice:bigint,_block:bigint>,_held:{tuples}>>").alias("out"))
    before = parted.select(*[F.col(n).alias(f"{n}_") for n in names], F.explode(F.aggregate("_s", start, later, lambda acc: acc["out"])).alias("_b")).select(*[f"{n}_" for n in names], "_b._part._slice", "_b._part._block", "_b._held")
    on = [F.col("_part._slice") == F.col("_slice"), F.col("_part._block") == F.col("_block"), *[F.col(n).eqNullSafe(F.col(f"{n}_")) for n in names]]

    def walk(acc: Column, m: Column) -> Column:
        """Where a time opens, it finds what came before it; the held tuples then take in its own."""
        told = F.when(m["_opens"], F.concat(acc["out"], F.array(F.struct(m["at"].alias("at"), acc["held"].alias("held"))))).otherwise(acc["out"])
        return F.struct(merged(m["_t"], acc["held"]).alias("held"), told.alias("out"))

    begin = F.struct(F.col("_held").alias("held"), F.array().cast(f"array<struct<at:{kinds[order]},held:{tuples}>>").alias("out"))
    walked = blocks.join(before, on).select(*names, F.explode(F.aggregate("_m", begin, walk, lambda acc: acc["out"])).alias("_o"))
    times = walked.select(*[F.col(n).alias(f"{n}_") for n in names], F.col("_o.at").alias("_at"), F.col("_o.held").alias("_held")).where(F.size("_held") > 0)
    here = [F.col(order) == F.col("_at"), *[F.col(k).eqNullSafe(F.col(f"{n}_")) for k, n in zip(keys, names, strict=True)]]
    found = F.get(F.filter("_held", lambda t: (t["a"] != F.col(first)) & (t["b"] != F.col(second))), 0)["at"]
    return df.join(times, [whole, *here], "left").select(*[F.col(f"`{c}`") for c in df.columns], found.alias(name))


def with_envelope(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """The running maximum and what it was before this row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("envelope", F.max(value).over(w)).withColumn("envelope_before", F.lag("envelope").over(w))


def with_trailing(df: DataFrame, keys: Sequence[str], order: str, value: str, frames: Sequence[int]) -> DataFrame:
    """Sums over the last n rows of a dense series, null unless all n are there, and the count of the longest."""
    out = df
    for n in frames:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), 0)
        out = out.withColumn(f"{value}_{n}", F.when(F.count(value).over(w) == n, F.sum(value).over(w)))
    longest = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(max(frames) - 1), 0)
    return out.withColumn(f"n_{max(frames)}", F.count(value).over(longest))


def with_rows_since(df: DataFrame, keys: Sequence[str], order: str, hit: Column, back: int) -> DataFrame:
    """Steps of `order` since the last row with `hit` in the last `back` rows, this one included."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-back, 0)
    return df.withColumn("last_hit", F.max(F.when(hit, F.col(order))).over(w)).withColumn("since_hit", F.col(order) - F.col("last_hit"))


def consecutive_hits(df: DataFrame, keys: Sequence[str], order: str, step: int, hit: Column, least: int) -> DataFrame:
    """(keys, first, last, n): runs of at least `least` hits that are exactly `step` apart."""
    hits = df.where(hit).select(*keys, order).distinct()
    w = Window.partitionBy(*keys).orderBy(order)
    runs = hits.withColumn("_island", F.col(order) - F.row_number().over(w) * step)
    return runs.groupBy(*keys, "_island").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).where(F.col("n") >= least).drop("_island")


def merged_spans(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """(keys, first, last, n): spans joined where they overlap or touch."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col(start) > before).cast("long"), F.lit(1))
    marked = df.withColumn("_new", new).withColumn("_span", F.sum("_new").over(w))
    return marked.groupBy(*keys, "_span").agg(F.min(start).alias("first"), F.max(end).alias("last"), F.count("*").alias("n")).drop("_span")


def with_latch(df: DataFrame, keys: Sequence[str], order: Sequence[str], level: str) -> DataFrame:
    """The highest level so far: levels are never taken back inside a window."""
    return df.withColumn("latched", F.max(level).over(Window.partitionBy(*keys).orderBy(*order)))


def top_tiers(df: DataFrame, keys: Sequence[str], score: str, cuts: Sequence[tuple[str, float]]) -> DataFrame:
    """A tier by the share of rows that score at least as high; the cuts are the top shares, smallest first."""
    # Equal scores share the position of the last of them from above.
    above = F.cume_dist().over(Window.partitionBy(*keys).orderBy(F.col(score).desc()))
    tier = None
    for name, share in cuts:
        tier = F.when(F.col("top_share") <= share, name) if tier is None else tier.when(F.col("top_share") <= share, name)
    return df.withColumn("top_share", above).withColumn("tier", tier)
