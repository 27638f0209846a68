"""Names of the registered queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; without `sql` it is one that SQL cannot express and tests cover."""

    def keep(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered already")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
