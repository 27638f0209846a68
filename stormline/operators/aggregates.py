"""Aggregates: guarded means, ranks, skill, intervals and digests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormline.operators.ranks import running_totals

# The 97.5 % points of Student's t for 1 to 30 degrees of freedom; 1.96 beyond.
T_975 = (
    12.706, 4.303, 3.182, 2.776, 2.571, 2.447, 2.365, 2.306, 2.262, 2.228, 2.201, 2.179, 2.160, 2.145, 2.131,
    2.120, 2.110, 2.101, 2.093, 2.086, 2.080, 2.074, 2.069, 2.064, 2.060, 2.056, 2.052, 2.048, 2.045, 2.042,
)


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value))


def ratio(num: Column, den: Column) -> Column:
    """A ratio of sums; null where nothing was summed."""
    return F.when(den != 0, num / den)


def share(cond: Column) -> Column:
    """The part of rows with a known condition for which it holds."""
    return F.avg(cond.cast("double"))


def renewal_wait(h: Column) -> Column:
    """E[h^2] / 2 E[h]: the wait of someone who comes at random."""
    return F.when(F.sum(h) > 0, F.sum(h * h) / (2 * F.sum(h)))


def weighted_mean(value: Column, weight: Column, least: float = 1 - 1e-6) -> Column:
    """Sum of weight * value over the known values; null unless their weights reach `least`."""
    got = F.sum(F.when(value.isNotNull(), weight))
    return F.when(got >= least, F.sum(value * weight) / got)


def nearest_rank(value: str, q: float) -> Column:
    """The ceil(q n)-th smallest value."""
    return F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {value})")


def t_975(df: Column) -> Column:
    return F.when(df.between(1, len(T_975)), F.element_at(F.lit(list(T_975)), df.cast("int"))).when(df > len(T_975), 1.96)


def cluster_mean(df: DataFrame, keys: Sequence[str], cluster: str, value: str, weight: str) -> DataFrame:
    """(keys, mean, n_clusters, se, lo, hi): a weighted mean with its cluster-robust 95 % t interval."""
    by = df.groupBy(*keys, cluster).agg(F.sum(F.col(value) * F.col(weight)).alias("sv"), F.sum(weight).alias("sw"))
    total = by.groupBy(*keys).agg((F.sum("sv") / F.sum("sw")).alias("mean"), F.sum("sw").alias("w"), F.count("*").alias("n_clusters"))
    return _robust(by, total, keys)


def _robust(by: DataFrame, total: DataFrame, keys: Sequence[str]) -> DataFrame:
    joined = by.join(total, list(keys)) if keys else by.crossJoin(F.broadcast(total))
    resid = F.pow(F.col("sv") - F.col("mean") * F.col("sw"), 2)
    g = F.col("n_clusters")
    out = joined.groupBy(*keys, "mean", "w", "n_clusters").agg(F.sum(resid).alias("ss"))
    se = F.when(g > 1, F.sqrt(F.col("ss") * g / (g - 1)) / F.col("w"))
    out = out.withColumn("se", se).withColumn("half", t_975(g - 1) * se)
    return out.select(*keys, "mean", "n_clusters", "se", (F.col("mean") - F.col("half")).alias("lo"), (F.col("mean") + F.col("half")).alias("hi"))


def confusion(pred: Column, truth: Column) -> list[Column]:
    return [count_if(pred & truth).alias("tp"), count_if(pred & ~truth).alias("fp"), count_if(~pred & truth).alias("fn"), count_if(~pred & ~truth).alias("tn")]


def skill(df: DataFrame) -> DataFrame:
    """CSI, POD, FAR and lift from tp, fp, fn, tn."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return df.select(
        "*", ratio(tp, tp + fp + fn).alias("csi"), ratio(tp, tp + fn).alias("pod"), ratio(fp, tp + fp).alias("far"),
        ratio(ratio(tp, tp + fp), ratio(tp + fn, n)).alias("lift"),
    )


def score_curve(df: DataFrame, score: str, truth: str, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """One row a distinct score, highest first: tp, fp at or above it, all positives and all rows of the keys. A row counts `weight` times, once without it."""
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    at = df.groupBy(*keys, score).agg(F.sum(F.col(truth).cast("long") * w).alias("p"), F.sum(w).alias("n"))
    total = at.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.sum("p").alias("positives"), F.sum("n").alias("rows"))
    run = running_totals(at, keys, score, ["p", "n"], descending=True)
    run = run.select(*keys, score, "p", "n", F.col("run_p").alias("tp"), (F.col("run_n") - F.col("run_p")).alias("fp"))
    if not keys:
        return run.crossJoin(total)  # one row
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return run.join(total, on).drop(*[f"_k_{k}" for k in keys])


def average_precision(df: DataFrame, score: str, truth: str, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """The step sum of precision over recall; equal scores are one step."""
    c = score_curve(df, score, truth, keys, weight)
    gain = F.col("p") / F.col("positives") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return c.groupBy(*keys).agg(F.when(F.max("positives") > 0, F.sum(gain)).alias("average_precision"))


def best_threshold(df: DataFrame, score: str, truth: str, keys: Sequence[str] = ()) -> DataFrame:
    """The score with the highest CSI (ties: the higher score), that CSI and the alert rate."""
    c = score_curve(df, score, truth, keys)
    csi = F.col("tp") / (F.col("fp") + F.col("positives"))
    c = c.withColumn("csi", csi).withColumn("alert_rate", (F.col("tp") + F.col("fp")) / F.col("rows"))
    best = c.groupBy(*keys).agg(F.max(F.struct("csi", score, "alert_rate")).alias("b"))
    return best.select(*keys, F.col(f"b.{score}").alias("threshold"), "b.csi", "b.alert_rate")


def bootstrap_ratio(df: DataFrame, cluster: str, num: str, den: str, b: int, seed: int) -> DataFrame:
    """(lo, hi) of sum(num) / sum(den) with whole clusters resampled b times.

    A cluster's Poisson(1) count in a round follows from a hash of round and cluster, so rounds run
    anywhere and always agree.
    """
    by = df.groupBy(cluster).agg(F.sum(num).alias("num"), F.sum(den).alias("den"))
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("round"), F.col(cluster)), 11).cast("double") / F.lit(2.0**53)
    # Cumulative Poisson(1) probabilities up to 6.
    steps, p, total = [], 0.36787944117144233, 0.0
    for i in range(7):
        total += p
        steps.append(total)
        p /= i + 1
    times = sum([(u > s).cast("int") for s in steps[1:]], (u > steps[0]).cast("int"))
    rounds = by.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(b)))).withColumn("times", times)
    stat = rounds.groupBy("round").agg((F.sum(F.col("num") * F.col("times")) / F.sum(F.col("den") * F.col("times"))).alias("r"))
    return stat.agg(F.percentile("r", F.lit(0.025)).alias("lo"), F.percentile("r", F.lit(0.975)).alias("hi"))


def set_digest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n, lo, hi): row count and sums of row hash halves, the same for any order of rows.

    Null and missing columns differ from every value, and column names count.
    """
    cells = [F.concat(F.lit(c + "="), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u001e"))) for c in sorted(df.columns)]
    h = F.sha2(F.concat_ws("\u001f", *cells), 256)
    half = lambda a: F.sum(F.conv(F.substring(h, a, 13), 16, 10).cast("decimal(38,0)"))
    return df.groupBy(*keys).agg(F.count("*").alias("n"), half(1).alias("lo"), half(14).alias("hi"))


def static_violations(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys whose values aren't the same in all their rows."""
    n = F.countDistinct(F.struct(*[F.coalesce(F.col(v).cast("string"), F.lit("\u001e")) for v in values]))
    return df.groupBy(*keys).agg(n.alias("n_variants")).where("n_variants > 1")


def knots(value: str, n: int = 101) -> Column:
    """n evenly spaced quantiles with linear interpolation."""
    return F.percentile(value, F.lit([i / (n - 1) for i in range(n)]))


def rank_correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Spearman's: the correlation of mean ranks, which ties share.

    Ranks come from the counts of distinct values, summed along ranges of them.
    """
    def ranked(c: str) -> DataFrame:
        by = df.groupBy(c).agg(F.count("*").alias("n"))
        run = running_totals(by, [], c, ["n"])
        return run.select(F.col(c), (F.col("run_n") - (F.col("n") - 1) / 2).alias(f"rank_{c}"))

    return df.join(ranked(a), a).join(ranked(b), b).agg(F.corr(f"rank_{a}", f"rank_{b}").alias("spearman"))


def grouped_pairs(values: Mapping[str, Column]) -> Column:
    """JSON of the named values with keys in order and missing ones left out."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in sorted(values.items())]))
