"""Cutting lineage with tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where it is unset, local sessions (tests) get a temporary folder and clusters an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


class Scratch:
    """Tables written once as Parquet in the shared folder and read back, each under a name of its own.

    A lost executor then costs a re-read, not a recomputation. A table goes as soon as what was made
    of it is stored: it is overwritten with no rows, so that its files no longer take room.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
        self.made: dict[str, str] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """`df` as a stored table; the table that had this name before, which `df` may read, is freed."""
        path = f"{self.base}-{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(path)
        self.drop(name)
        self.made[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Frees tables that nothing reads any more; names that aren't there are fine."""
        for name in names:
            path = self.made.pop(name, None)
            if path:
                self.spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)


MOST_BROADCAST = 1_000_000


def narrowed(big: DataFrame, small: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """A join with a stored table of one or two longs a row: broadcast up to a million rows (16 MB), shuffled beyond."""
    return big.join(F.broadcast(small) if small.count() <= MOST_BROADCAST else small, on, how)


def stored(df: DataFrame, name: str) -> DataFrame:
    """One table that stays: `df` written as Parquet in the shared folder and read back."""
    return Scratch(df.sparkSession).put(df, name)
