"""One registry of assets of all kinds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assets(kinds: Mapping[str, DataFrame]) -> DataFrame:
    """(asset_id, kind, name) of the kinds' (id, name) tables; ids carry their kind, so they can't clash."""
    out = None
    for kind, df in kinds.items():
        part = df.select(F.concat(F.lit(kind + ":"), F.col("id").cast("string")).alias("asset_id"), F.lit(kind).alias("kind"), "name")
        out = part if out is None else out.unionByName(part)
    return out
