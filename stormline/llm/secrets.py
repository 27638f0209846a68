"""Secret scans with multipart credential linking."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormline.llm.store import stored

KINDS = ("assign", "access", "hex", "identifier", "key", "endpoint")
REACH = 160

ASSIGN = re.compile(r"""((?:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
BREAK = re.compile("\n\n")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+")
NAMED = re.compile(r"""\b(?i:user(?:_?name)?|login|client_?id|account(?:_?id)?|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})""", re.ASCII)
URL = re.compile(r"""\b[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>]+""")
HOST = re.compile(r"\b(?i:host|endpoint|server|url)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9.-]+(?::[0-9]{1,5})?)", re.ASCII)


def entropy(s: str) -> float:
    """Bits a character, by the counts of its characters."""
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the three base patterns, leftmost and non-overlapping per kind."""
    low = text.lower()
    out = []
    if any(x in low for x in ("passw", "secret", "token", "api")):
        out += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]]]:
    """The base spans, and the weak parts (kind, start, end, scope) that count only together.

    A scope is a stretch of text without an empty line. Weak keys are runs of 16 or more
    with digits and letters and an entropy of 3 bits a character or more.
    """
    base = base_spans(text)
    parts = [(3, s, e) for k, s, e in base if k == 1]
    for run in RUN.finditer(text):
        # A long hex run lies within one of these runs.
        found = [m.span() for m in HEX.finditer(text, run.start(), run.end()) if m.end() - m.start() >= 32] if run.end() - run.start() >= 32 else []
        base += [(2, *x) for x in found]
        s = run[0]
        if not found and any(c.isdigit() for c in s) and any(c.isalpha() for c in s) and not s.startswith("AKIA") and entropy(s) >= 3:
            parts.append((4, *run.span()))
    parts += [(4, s, e) for k, s, e in base if k != 1]
    if "@" in text:
        parts += [(3, *m.span()) for m in EMAIL.finditer(text)]
    low = text.lower()
    if any(x in low for x in ("user", "login", "client", "account", "access")):
        parts += [(3, *m.span()) for m in NAMED.finditer(text)]
    if "://" in text:
        parts += [(5, *m.span()) for m in URL.finditer(text)]
    if any(x in low for x in ("host", "endpoint", "server", "url")):
        parts += [(5, *m.span()) for m in HOST.finditer(text)]
    kinds = {p[0] for p in parts}
    if not {3, 4} <= kinds:
        return sorted(base, key=lambda x: (x[1], x[0])), []
    breaks = [m.end() for m in BREAK.finditer(text)]
    parts = [(*p, bisect_right(breaks, p[1])) for p in parts]
    return sorted(base, key=lambda x: (x[1], x[0])), parts


def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    part = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("scope", pa.int32())])
    for batch in batches:
        both = [scan(x.as_py() or "") for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"), batch.column("id"),
                pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in b] for b, _ in both], pa.list_(span)),
                pa.array([[dict(zip(("kind", "start", "end", "scope"), p, strict=True)) for p in ps] for _, ps in both], pa.list_(part)),
            ],
            ["row", "id", "base", "parts"],
        )


def linked_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """(row, kind, start, end) of the parts whose complement is near: an interval join.

    Identifiers (3) and keys (4) link when they are in one scope of one row, don't overlap and
    lie at most `reach` code points apart; an endpoint (5) is added when it is as near to a
    linked part. Intervals meet by the cells of `reach` code points that they touch, so the join
    is an equi-join, and rows with many parts spread over their cells.
    """
    cells = lambda far: F.explode(F.sequence(F.floor((F.col("start") - far) / reach), F.floor((F.col("end") + far) / reach)))
    one = parts.select("row", "scope", "kind", "start", "end", cells(0).alias("cell"))
    two = parts.select("row", "scope", F.col("kind").alias("k2"), F.col("start").alias("s2"), F.col("end").alias("e2"), F.explode(
        F.sequence(F.floor((F.col("start") - reach) / reach), F.floor((F.col("end") + reach) / reach))).alias("cell"))
    gap = F.greatest(F.col("s2") - F.col("end"), F.col("start") - F.col("e2"))
    near = one.join(two, ["row", "scope", "cell"]).where((gap >= 0) & (gap <= reach))
    strong = near.where((F.col("kind") + F.col("k2") == 7) & (F.col("kind") != 5) & (F.col("k2") != 5)).select("row", "scope", "kind", "start", "end").distinct()
    strong = stored(strong, "linked")
    ends = one.where(F.col("kind") == 5).join(strong.select("row", "scope", F.col("start").alias("s2"), F.col("end").alias("e2"), F.explode(
        F.sequence(F.floor((F.col("start") - reach) / reach), F.floor((F.col("end") + reach) / reach))).alias("cell")), ["row", "scope", "cell"])
    ends = ends.where((gap >= 0) & (gap <= reach)).select("row", "scope", "kind", "start", "end").distinct()
    return strong.unionByName(ends).select("row", "kind", "start", "end")


def find_secrets(df: DataFrame, doc_id: str, text: str, reach: int = REACH) -> DataFrame:
    """doc_id and `found`, an array of (start, rank, kind, end) by start and then kind, for every row.

    Base spans are always there; weak identifiers, keys and endpoints only where an identifier
    and a key stand together (see `linked_parts`). A null or empty text has none. Positions are
    code points, the end exclusive. Repeated rows and rows with a null doc_id are kept, and
    each is scanned by itself.
    """
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    span = "struct<kind:int,start:int,end:int>"
    made = stored(rows.mapInArrow(scanned, f"row long, id {kind}, base array<{span}>, parts array<struct<kind:int,start:int,end:int,scope:int>>"), "scanned")
    parts = made.where(F.size("parts") > 0).select("row", F.explode("parts").alias("p")).select("row", "p.*")
    weak = linked_parts(parts, reach).groupBy("row").agg(F.collect_set(F.struct("kind", "start", "end")).alias("weak"))
    names = F.array(*[F.lit(k) for k in KINDS])
    empty = F.array().cast(f"array<{span}>")
    # A part that is a base span already stays one.
    base_at = F.transform("base", lambda b: F.struct(b["start"].alias("s"), b["end"].alias("e")))
    extra = F.filter(F.coalesce("weak", empty), lambda w: ~F.array_contains(base_at, F.struct(w["start"].alias("s"), w["end"].alias("e"))))
    both = F.concat("base", extra)
    found = F.array_sort(F.transform(both, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("rank"), F.element_at(names, x["kind"] + 1).alias("kind"), x["end"].alias("end"))))
    return made.join(weak, "row", "left").select(F.col("id").alias(doc_id), found.alias("found"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    said = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("found", lambda x: x["rank"] < 3)
    return find_secrets(docs, "doc_id", "text").select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(said(base).cast("binary"), 256).alias("base_sha256"), said(F.col("found")).alias("spans")
    )
