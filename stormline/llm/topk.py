"""Exact top-k search by inner product over vectors in order of falling length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormline.llm.store import stored

BLOCK_ROWS = 4096
QUERY_ROWS = 1024
LEVELS = 256
SCALE = 256


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as long; null if a component is null or not finite; one of 2^62 or more raises."""
    d = vector.cast("array<double>")
    fits = lambda x: F.when(F.abs(x) < F.lit(2.0**62), F.floor(x).cast("long")).otherwise(F.raise_error(F.lit("a scaled component doesn't fit a long")).cast("long"))
    bad = F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(d, lambda x: fits(x * F.lit(float(scale)))))


def rotation(vectors: DataFrame) -> np.ndarray:
    """Right singular vectors of all rows, largest first, from their summed Gram matrix."""

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for b in batches:
            if len(b):
                x = np.stack(b["v"].to_numpy()).astype(float)
                g = x.T @ x
                total = g if total is None else total + g
        if total is not None:
            yield pd.DataFrame({"i": range(len(total)), "row": list(total)})

    parts = vectors.select("v").mapInPandas(gram, "i int, row array<double>")
    sums = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    d = 1 + max((r["i"] for r in sums), default=-1)
    g = np.zeros((d, d))
    for r in sums:
        g[r["i"], r["j"]] = r["x"]
    return np.linalg.eigh(g)[1][:, ::-1]


def search_block(rows: pd.DataFrame, asks: pd.DataFrame, turn: np.ndarray, k: int, head: int) -> pd.DataFrame:
    """The k best of a block of rows for each query, by partial sums on the first rotated axes.

    Products that may not fit a long are taken in whole numbers of any size; a score among the best that doesn't fit one raises.
    """
    out = []
    x, ids = np.stack(rows["v"].to_numpy()), rows["vec_id"].to_numpy()
    z = x.astype(float) @ turn
    tail = np.sqrt(np.maximum((z[:, head:] ** 2).sum(1), 0))
    q = np.stack(asks["v"].to_numpy())
    y = q.astype(float) @ turn
    if np.linalg.norm(z, axis=1).max() * np.linalg.norm(y, axis=1).max() >= 2.0**62:
        x, q = x.astype(object), q.astype(object)
    rest = np.sqrt(np.maximum((y[:, head:] ** 2).sum(1), 0))
    upper = y[:, :head] @ z[:, :head].T + np.outer(rest, tail) + 1e-6 * (1 + np.outer(np.linalg.norm(y, axis=1), np.linalg.norm(z, axis=1)))
    for i, (query, least) in enumerate(zip(asks["query_id"].to_numpy(), asks["least"].to_numpy(), strict=True)):
        may = np.flatnonzero((upper[i] >= least) & (ids != query))
        score = x[may] @ q[i]
        by_id = np.argsort(ids[may], kind="stable")
        best = by_id[np.argsort(-score[by_id], kind="stable")][:k]
        out.append(pd.DataFrame({"query_id": query, "vec_id": ids[may][best], "score": score[best].astype("int64")}))
    return pd.concat(out, ignore_index=True)


def top_inner_products(df: DataFrame, vec_id: str, vector: str, every: int = 50, k: int = 5, block_rows: int = BLOCK_ROWS, head: int = 16) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query row.

    Rows are cut by falling length into at most LEVELS levels, and these into blocks. The
    first level, of the longest rows, is searched by every query and gives each a least
    score; a later level is paired only with the queries for which |query| * |longest row of the level| reaches that score
    (Cauchy-Schwarz), and in it rows only get a full product if their partial sum on the
    leading SVD axes plus the product of the residual lengths does. Both bounds are exact.
    Queries (id divisible by `every`) and rows meet in blocks of fixed size. Rows with a null
    id, vector or component or a component that isn't finite take no part; a shorter vector than the longest one counts
    as followed by zeros, so scores are sums over the components that both have; an id that repeats stands for each of its rows, and rows with the query's
    own id are no candidates. Ties go to the smaller vec_id. A score that would be reported and doesn't fit a long raises.
    """
    spark = df.sparkSession
    base = df.select(F.col(vec_id).cast("long").alias("vec_id"), scaled(F.col(vector)).alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
    )
    base = stored(base.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))), "vectors")
    shape = base.agg(F.max(F.size("v")).alias("d"), F.count("*").alias("count")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if shape["d"] is None:
        return spark.createDataFrame([], schema)
    base = base.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(shape["d"]) - F.size("v"))))
    turn, n = rotation(base), shape["count"]
    head = min(head, shape["d"])
    levels = min(LEVELS, max(1, -(-n // block_rows)))
    cuts = [0.0]
    if levels > 1:
        cuts += sorted(set(base.approxQuantile("norm", [i / levels for i in range(1, levels)], 0.1 / levels)) - {0.0})
    level = F.size(F.filter(F.lit(cuts), lambda c: c <= F.col("norm")))
    # A row for each level: its size and longest row.
    about = {r["l"]: r for r in base.groupBy(level.alias("l")).agg(F.count("*").alias("n"), F.max("norm").alias("top")).collect()}
    top = max(about)
    parts = [max(1, -(-about[i]["n"] // block_rows)) if i in about else 1 for i in range(top + 1)]
    part = F.pmod(F.xxhash64("vec_id"), F.element_at(F.lit(parts), F.col("level") + 1)).cast("int")
    rows = base.withColumn("level", level).withColumn("part", part).select("level", "part", "vec_id", "v")
    groups = max(1, n // every // QUERY_ROWS)
    asks = base.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), "v", "norm", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int").alias("ask")
    )
    asks = stored(asks, "queries")

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return search_block(left, right, turn, k, head)

    def best(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    def searched(wanted: DataFrame, some: DataFrame) -> DataFrame:
        """`wanted`: queries with the array of levels that each has to see."""
        seen = wanted.withColumn("level", F.explode("levels")).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.element_at(F.lit(parts), F.col("level") + 1) - 1))
        )
        pairs = stored(seen.select("level", "part", "ask", "query_id", "v", "least"), "asked")
        groups = pairs.select(F.col("level").alias("_l"), F.col("part").alias("_p"), F.col("ask").alias("_a")).distinct()
        met = some.join(groups, (F.col("level") == F.col("_l")) & (F.col("part") == F.col("_p"))).select(
            F.col("_l").alias("level"), F.col("_p").alias("part"), F.col("_a").alias("ask"), "vec_id", "v"
        )
        by = "level", "part", "ask"
        return met.groupBy(*by).cogroup(pairs.groupBy(*by)).applyInPandas(run, "query_id long, vec_id long, score long")

    none = F.lit(float("-inf"))
    all_first = asks.withColumn("least", none).withColumn("levels", F.array(F.lit(top)))
    first = stored(best(searched(all_first, rows.where(F.col("level") == top))), "first")
    kth = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    least = asks.join(kth, "query_id", "left").withColumn("least", F.coalesce(F.col("kth").cast("double"), none))
    tops = F.lit([float(about[i]["top"]) if i in about else -1.0 for i in range(top)] or [-1.0])
    may = lambda i: F.col("norm") * F.element_at(tops, i + 1) * (1 + 1e-9) + 1e-6 >= F.col("least")
    wanted = least.withColumn("levels", F.filter(F.lit([i for i in range(top) if i in about] or [0]), may))
    found = first.select("query_id", "vec_id", "score")
    if len(about) > 1:
        found = found.unionByName(searched(wanted, rows.where(F.col("level") != top)))
    return best(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_inner_products(vectors, "vec_id", "embedding")
