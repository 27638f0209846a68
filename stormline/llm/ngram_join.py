"""N-gram Jaccard join by parity sketches.

Every set of shingles is laid out over m blocks by hash, and a block holds the XOR of the
hashes that fall into it. A shingle in just one of two sets changes one block at most, so the
number of blocks that differ (a Hamming distance) is no more than the symmetric difference.
Sets that are alike enough differ by at most D shingles, hence agree on m - D blocks: by the
pigeonhole principle any D + 1 blocks that both would pick in one fixed order share one. A
second sketch, one parity bit for each of 1024 places, bounds the difference of candidates
in the same way before whole sets are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormline.llm.graph import connected_components
from stormline.llm.store import Scratch
from stormline.llm.tokens import mix, shingles, slices, words

BITS = 1024
PIECE = 500
CELL_SETS, CELL_HASHES, COLUMNS = 2000, 500_000, 4096
U = np.uint64


def block_keys(u: np.ndarray, band: int, blocks: int, keep: int) -> np.ndarray:
    """Keys of the `keep` fullest blocks of a set of hashes in a size band.

    The order (fullest first, then by key) depends on a block's own content alone, so it is
    one order for all sets, as the pigeonhole step needs. Empty blocks come last.
    """
    at = (u >> U(10)) % U(blocks)
    order = np.argsort(at, kind="stable")
    where, begin = np.unique(at[order], return_index=True)
    total = np.bitwise_xor.reduceat(u[order], begin)
    count = np.diff(np.append(begin, len(u)))
    if len(where) < keep:
        empty = np.setdiff1d(np.arange(blocks, dtype=U), where)
        where, total = np.append(where, empty), np.append(total, np.zeros(len(empty), U))
        count = np.append(count, np.zeros(len(empty), count.dtype))
    key = mix(mix(total + U(band)) ^ mix(where * U(65599) + count.astype(U)))
    if len(key) > keep:
        key = key[np.lexsort((key, -count))[:keep]]
    return key


def set_keys(u: np.ndarray, num: int, den: int) -> np.ndarray:
    """The join keys of one set, for links with den * |A and B| >= num * |A or B|.

    Bands hold the sizes from a power of 2 to the next. A set of size a and a partner of
    size b differ by at most (a + b)(den - num) / (den + num) shingles, and b <= a * den / num.
    A set joins the band of its size, and the band below if it is small enough for partners there.
    """
    n = len(u)
    band = n.bit_length() - 1
    out = []

    def most(a: int, b: int) -> int:
        return (a + b) * (den - num) // (den + num)

    for k in (band, band - 1):
        top = 2 ** (k + 1) - 1
        if k < 0 or k < band and n * num > top * den:
            continue
        differ = most(n, n * den // num) if k == band else most(n, top)
        if differ:  # else only equal sets link, and those are one set already
            limit = most(top, top * den // num)
            out.append(block_keys(u, k, limit + max(8, limit // 4), differ + 1))
    return np.concatenate(out) if out else np.zeros(0, U)


def sketches(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int, what: str) -> Iterator[pa.RecordBatch]:
    """Of (row, text): what = "keys" gives size, digest, parity sketch and keys; "sets" size, digest and the hashes themselves."""
    for batch in (piece for whole in batches for piece in slices(whole)):
        h, off = shingles(words(batch.column("text")), k)
        sets = [np.unique(h[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]
        size = pa.array([len(u) for u in sets], pa.int64())
        d1 = [int(np.bitwise_xor.reduce(u).astype(U).view(np.int64)) if len(u) else 0 for u in sets]
        d2 = [int(mix(u).sum(dtype=U).view(np.int64)) if len(u) else 0 for u in sets]
        if what == "sets":
            hashes = pa.array([u.view(np.int64) for u in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), size, pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), hashes], ["id", "n", "d1", "d2", "hashes"])
            continue
        bits = [np.packbits((np.bincount((u & U(BITS - 1)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).view(np.int64) for u in sets]
        keys = [set_keys(u, num, den).view(np.int64) if len(u) else u.view(np.int64) for u in sets]
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), size, pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(bits, longs), pa.array(keys, longs)],
            ["id", "n", "d1", "d2", "bits", "keys"],
        )


def distance(a: Column, b: Column) -> Column:
    """Hamming distance of two sketches held as arrays of long."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x.cast("int"))


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of `a` with each of `b`, some columns of hashes at a time."""
    sets = a if a is b else a + b
    hashes, place, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(seen > 1) - 1  # a hash of one set alone is in no intersection
    row, keep = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), seen[place] > 1
    row, column = row[keep], column[place[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(a), len(b)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        i, j = np.searchsorted(column, [lo, lo + COLUMNS])
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[row[i:j], column[i:j] - lo] = 1
        out += has[: len(a)] @ (has if a is b else has[len(a) :]).T
    return out


def link_counts(members: DataFrame, num: int, den: int) -> DataFrame:
    """(node, n_links) of (node, component, n, hashes): the other sets of its component that each set links with.

    A component is dealt over pieces of bounded size, and each two pieces meet in a cell of their own, which gives
    counts and no pairs: so rows stay linear in the sets, and no task holds a component.
    """
    sizes = members.groupBy("component").agg(F.greatest(F.ceil(F.sum("n") / CELL_HASHES), F.ceil(F.count("*") / CELL_SETS)).cast("int").alias("pieces"), F.count("*").alias("size"))
    dealt = members.join(sizes.where("size > 1").select("component", "pieces"), "component")
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("node", "component"), "pieces").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, pieces - 1)")))
    cells = dealt.select("component", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), (F.col("mine") <= F.col("other")).alias("left"), "node", "hashes")

    def counted(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        one, two = rows[rows["left"]], rows[~rows["left"]]
        a = list(one["hashes"])
        same = key[1] == key[2]
        b = a if same else list(two["hashes"])
        if not a or not b:
            return pd.DataFrame({"node": [], "links": []}).astype("int64")
        both = overlaps(a, b)
        n, m = np.array([len(x) for x in a], np.float64), np.array([len(x) for x in b], np.float64)
        linked = both * float(den) >= (n[:, None] + m - both) * num
        if same:
            np.fill_diagonal(linked, False)
            return pd.DataFrame({"node": one["node"], "links": linked.sum(1)})
        return pd.DataFrame({"node": np.concatenate([one["node"], two["node"]]), "links": np.concatenate([linked.sum(1), linked.sum(0)])})

    found = cells.groupBy("component", "p", "q").applyInPandas(counted, "node long, links long")
    return found.groupBy("node").agg(F.sum("links").alias("n_links"))


def ngram_jaccard_components(df: DataFrame, doc_id: str, text: str, k: int = 5, num: int = 80, den: int = 100, count_links: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links and n_copies for every row of df.

    Rows link when den * |A and B| >= num * |A or B| for their sets of k-word shingles (A-Z
    lower-cased; a shorter text is one shingle). component_id is the smallest doc_id that
    links reach. A null, empty or wordless text has no shingles and links with nothing; so
    does a row with a null doc_id, whose component_id is null. Rows with equal sets are one
    node, named by the set's digest and compared once; repeated rows are all returned, and rows that share a doc_id but not a
    text belong to the component of both texts. n_links (unless not wanted) counts the different
    sets that a row's set links with, n_copies the rows with the same set. Other columns are dropped; an empty table gives no
    rows. A text is held whole, with some 20 times its size in memory.
    """
    scratch = Scratch(df.sparkSession)
    longs = "array<bigint>"
    rows = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    made = rows.mapInArrow(lambda it: sketches(it, k, num, den, "keys"), f"id long, n long, d1 long, d2 long, bits {longs}, keys {longs}")
    made = scratch.put(made.withColumn("node", F.xxhash64("n", "d1", "d2")), "sketches")
    linkable = made.where((F.col("n") > 0) & F.col("id").isNotNull())
    nodes = scratch.put(linkable.groupBy("node").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n_copies")), "nodes")
    # Of equal sets one row brings the keys; exact repeats of that row bring them again, which `distinct` undoes where it matters.
    own = linkable.join(nodes.select("node", F.col("first").alias("id")), ["node", "id"], "left_semi")
    keyed = own.select(F.explode("keys").alias("key"), "node")
    several = scratch.put(keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "several")
    shared = scratch.put(keyed.join(several, "key").distinct(), "shared")
    # The hub of a key is its member with the most company; every member is compared with the hub first.
    company = shared.groupBy("node").agg(F.sum("members").alias("company"))
    ranked = shared.join(company, "node")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("company", "node")).alias("h")).select("key", F.col("h.node").alias("hub"))
    pairs = shared.join(hubs, "key").where(F.col("node") != F.col("hub")).select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    pairs = scratch.put(pairs, "pairs")
    wanted = scratch.put(shared.select("node").distinct(), "wanted")
    about = scratch.put(own.select("node", "n", "bits").join(wanted, "node", "left_semi").groupBy("node").agg(F.any_value("n").alias("n"), F.any_value("bits").alias("bits")), "about")
    # Of equal sets one text is read: the smallest of those with the smallest id.
    ids = scratch.put(nodes.join(wanted, "node", "left_semi").select(F.col("first").alias("id")).distinct(), "ids")
    sets = rows.join(ids, "id", "left_semi").mapInArrow(lambda it: sketches(it, k, num, den, "sets"), f"id long, n long, d1 long, d2 long, hashes {longs}")
    sets = sets.withColumn("node", F.xxhash64("n", "d1", "d2")).join(wanted, "node", "left_semi").select("node", "n", "hashes").distinct()
    sets = scratch.put(sets, "sets")

    def near(na: Column, nb: Column, a: Column, b: Column) -> Column:
        """What sizes and sketches allow."""
        fits = (F.least(na, nb) * den >= F.greatest(na, nb) * num)
        return fits & (distance(a, b) * (den + num) <= (na + nb) * (den - num))

    def verified(found: DataFrame) -> DataFrame:
        one, two = about.toDF("a", "na", "bits_a"), about.toDF("b", "nb", "bits_b")
        close = found.join(one, "a").join(two, "b").where(near(F.col("na"), F.col("nb"), F.col("bits_a"), F.col("bits_b"))).select("a", "b")
        left, right = sets.toDF("a", "na", "ha"), sets.toDF("b", "nb", "hb")
        both = F.size(F.array_intersect("ha", "hb"))
        return close.join(left, "a").join(right, "b").where(both * den >= (F.col("na") + F.col("nb") - both) * num).select(
            F.col("a").alias("src"), F.col("b").alias("dst")
        )

    links = scratch.put(verified(pairs), "links")
    # Sets of rows that share a doc_id are in one component too.
    twins = linkable.groupBy("id").agg(F.min("node").alias("src"), F.max("node").alias("other")).where("src < other").select("id", "src")
    tied = linkable.join(twins, "id").select("src", F.col("node").alias("dst")).where("src < dst")
    links = scratch.put(links.union(tied), "ties")
    parts = connected_components(links)
    # The members of a key that are still in different components meet each other, in pieces of some PIECE, each two pieces in a cell of their own.
    at = shared.select("key", "node").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    still_open = at.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.ceil(F.count("*") / PIECE).cast("int").alias("pieces")).where("lo < hi")
    dealt = at.join(still_open.select("key", "pieces"), "key").join(about, "node").withColumn("piece", F.pmod(F.xxhash64("node", "key"), "pieces").cast("int"))
    dealt = scratch.put(dealt.select("key", "pieces", "piece", "node", "component", "n", "bits"), "dealt")
    fields = ("node", "component", "n", "bits")
    one = dealt.withColumn("other", F.explode(F.expr("sequence(piece, pieces - 1)"))).select("key", "piece", "other", *[F.col(c).alias(f"{c}_a") for c in fields])
    two = dealt.withColumn("other", F.explode(F.expr("sequence(0, piece)"))).select("key", F.col("other").alias("piece"), F.col("piece").alias("other"), *[F.col(c).alias(f"{c}_b") for c in fields])
    once = (F.col("piece") != F.col("other")) | (F.col("node_a") < F.col("node_b"))
    apart = F.col("component_a") != F.col("component_b")
    met = one.join(two, ["key", "piece", "other"]).where(once & apart & near(F.col("n_a"), F.col("n_b"), F.col("bits_a"), F.col("bits_b")))
    rest = met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()
    more = scratch.put(verified(rest.join(pairs, ["a", "b"], "left_anti")), "more")
    if not more.isEmpty():
        parts = connected_components(links.union(more))
    scratch.drop("several", "shared", "pairs", "wanted", "about", "ids", "dealt")
    known = nodes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = known.groupBy("component").agg(F.min("first").alias("component_id"))
    known = known.join(least, "component").select("node", "component_id", "n_copies")
    if count_links:
        known = known.join(link_counts(parts.join(sets, "node"), num, den), "node", "left")
    else:
        known = known.withColumn("n_links", F.lit(None).cast("long"))
    known = scratch.put(known, "known")
    scratch.drop("nodes", "links", "ties", "more", "sets")
    mine = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("node"))
    out = made.select("id", "n", mine.alias("mine")).join(known, F.col("mine") == F.col("node"), "left")
    return out.select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"),
        *([F.coalesce("n_links", F.lit(0)).alias("n_links")] if count_links else []), F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
    )


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the near copies: of each component the row with the smallest doc_id stays.

    Rows without words link with nothing and stay, as do rows with a null doc_id. Rows that share a
    doc_id stay or go together, and equal ones of them are one row.
    """
    found = ngram_jaccard_components(docs, doc_id, text, count_links=False)
    keep = found.where(F.col(doc_id) == F.col("component_id")).select(F.col(doc_id).alias("_id")).distinct()
    kept = docs.join(keep, F.col(doc_id) == F.col("_id"), "left_semi")
    return kept.dropDuplicates([doc_id, text]).unionByName(docs.where(F.col(doc_id).isNull()))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return ngram_jaccard_components(docs, "doc_id", "text")
