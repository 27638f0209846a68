"""Names, ids and labels as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The prefixes of express routes and the mark of select ones.
EXPRESS_PREFIXES = ("X", "BM", "QM", "BXM", "SIM")
SELECT_MARK = "+"


def route_class(route_id: Column) -> Column:
    """express, sbs or local, by the route's name alone; null for no name."""
    upper = F.upper(route_id)
    express = F.lit(False)
    for prefix in EXPRESS_PREFIXES:
        express = express | upper.startswith(prefix)
    return F.when(route_id.isNotNull(), F.when(express, "express").when(F.endswith(route_id, F.lit(SELECT_MARK)), "sbs").otherwise("local"))


def or_null(text: Column) -> Column:
    """An empty string is a missing one."""
    return F.nullif(text, F.lit(""))


def enum_name(code: Column, names: list[str]) -> Column:
    """The name of a code from 0; null for codes outside the list."""
    return F.when(code.between(0, len(names) - 1), F.element_at(F.lit(names), code.cast("int") + 1))


def norm_words(text: Column, canon: dict[str, str], between: bool = False) -> Column:
    """Upper case, no apostrophes, slashes and hyphens as spaces, ordinals without their endings, words in their canonical form.

    `between` also writes out the words B T as BETWEEN.
    """
    bare = F.regexp_replace(F.upper(F.regexp_replace(text, "['’]", "")), r"\b(\d+)(ST|ND|RD|TH)\b", "$1")
    words = F.filter(F.split(F.regexp_replace(bare, "[^A-Z0-9]+", " "), " "), lambda w: w != "")
    pairs = F.create_map(*[F.lit(x) for kv in canon.items() for x in kv])
    joined = F.array_join(F.transform(words, lambda w: F.coalesce(F.get(F.transform(F.array(w), lambda x: pairs[x]), 0), w)), " ")
    return F.regexp_replace(joined, r"\bB T\b", "BETWEEN") if between else joined


def mask_names(mask: Column, names: list[str]) -> Column:
    """The names of the bits that are set, lowest first."""
    listed = F.array(*[F.struct(F.lit(1 << i).alias("bit"), F.lit(n).alias("name")) for i, n in enumerate(names)])
    return F.transform(F.filter(listed, lambda x: mask.bitwiseAND(x["bit"]) != 0), lambda x: x["name"])


def cell_hex(cell: Column) -> Column:
    """Cell ids leave as lower-case hex, which JSON readers can't round."""
    return F.lower(F.hex(cell))


def cell_from_hex(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


def trip_code(trip_id: Column, patterns: list[str]) -> Column:
    """The schedule code in a trip id: the first group of the first grammar that fits."""
    return F.coalesce(*[or_null(F.regexp_extract(trip_id, p, 1)) for p in patterns])
