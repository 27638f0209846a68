"""Water sensors and tide gauges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormline.operators.aggregates import count_if


def trailing_runs(df: DataFrame, keys: Sequence[str], order: str, above: Column) -> DataFrame:
    """(keys, run_length, onset): the run of rows above the limit that reaches the series' end."""
    below = F.max(F.when(~above, F.col(order))).over(Window.partitionBy(*keys))
    late = F.col("_below").isNull() | (F.col(order) > F.col("_below"))
    return df.withColumn("_below", below).groupBy(*keys).agg(count_if(late).alias("run_length"), F.min(F.when(late, F.col(order))).alias("onset"))


def tide_residuals(observed: DataFrame, predicted: DataFrame, keys: Sequence[str], at: str, value: str) -> DataFrame:
    """Mean of observed minus predicted over the stamps that both have, and their number."""
    both = observed.join(predicted.withColumnRenamed(value, "_p"), [*keys, at])
    return both.groupBy(*keys).agg(F.avg(F.col(value) - F.col("_p")).alias("residual"), F.count("*").alias("n"))


def water_states(samples: DataFrame, muted: DataFrame, key: str, at: str, value: str, limit: float, least: int) -> DataFrame:
    """(key, rise, run_length, state) of the window that `samples` covers.

    rise: last known sample less the first. wet: the run above the limit that reaches the end is `least` long or
    more. A muted sensor says nothing else; `muted` has a row a muted key.
    """
    runs = trailing_runs(samples, [key], at, F.coalesce(value, F.lit(0.0)) >= limit)
    known = samples.where(F.col(value).isNotNull()).groupBy(key).agg((F.max_by(value, at) - F.min_by(value, at)).alias("rise"))
    out = runs.join(known, key, "left").join(muted.select(key, F.lit(True).alias("_muted")), key, "left")
    state = F.when(F.col("_muted"), "muted").when(F.col("run_length") >= least, "wet").otherwise("dry")
    return out.select(key, "rise", "run_length", state.alias("state"))
