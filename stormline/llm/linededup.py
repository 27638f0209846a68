"""Line dedup: fuzzy lines by MinHash, exact verification and a distributed union-find.

Why a band takes six minima: runs of five characters of unrelated prose have a Jaccard similarity of some 0.01
to 0.1 (common word parts), so three minima alone put twenty million unrelated pairs of 0.4 million
lines into common bands, and the number grows with the square of the lines. Six leave some 0.02 million.
Minima are shared between bands, so twelve bands of six need no more than thirty of them.

A shingle's first five bits say which of the minima it can lower (its bin), so it is put to one of them, not to
thirty; a minimum whose bin is empty is the one of the nearest bin that isn't, which is the minimum of XOR all the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormline.llm.graph import connected_components
from stormline.llm.store import Scratch, narrowed

MINIMA = 30
ROWS = 6
BINS = 32
WIDEST = 1_000_000_000  # partitions
BANDS = 12
GRAM = 5
STEP = 8
HUBS = 3
PIECE = 500
PARITIES = 8  # numbers of 64 parities
MOST_UNLIKE = 12  # of 30 minima; a pair at the limit is over it with a probability of 0.002


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\f"))


def normal(line: Column) -> Column:
    """What two lines are compared by: lower case, without white space around."""
    return F.lower(trimmed(line))


def wide(line: Column) -> Column:
    """Four bytes for each character, so that the n-th is found at once."""
    return F.encode(line, "UTF-32")


def last_start(chars: Column) -> Column:
    """Where the last run of GRAM characters begins; 0 for a shorter line, which is one run."""
    return F.greatest(F.floor(F.octet_length(chars) / 4).cast("int") - GRAM, F.lit(0))


def gram(chars: Column, at: Column) -> Column:
    return F.xxhash64(F.substring(chars, at * 4 + 1, F.lit(4 * GRAM)))


def grams(line: Column) -> Column:
    """Hashes of the distinct runs of GRAM characters; of the whole line if it is shorter. The line is encoded once."""
    runs = lambda chars: F.transform(F.sequence(F.lit(0), last_start(chars)), lambda at: gram(chars, at))
    return F.array_distinct(F.get(F.transform(F.array(wide(line)), runs), 0))


def all_lines(rows: DataFrame) -> DataFrame:
    """(doc, pos, line, node) of the lines that aren't blank, of rows with a key."""
    # The outer form, as Spark filters the inner one by the size of the array, which splits each text again.
    out = rows.where(F.col("doc").isNotNull()).select("doc", F.posexplode_outer(F.split("text", "\n", -1)).alias("pos", "line"))
    out = out.where(trimmed(F.col("line")) != "")  # before the lower case, which a filter behind it would take twice
    return out.select("doc", "pos", normal(F.col("line")).alias("line")).withColumn("node", F.xxhash64("line"))


def bins() -> list[int]:
    """The bin of each of the minima.

    Where a bin is empty its neighbour (the other last bit) takes its place, so that these two minima are one. Neighbours are in
    columns next to each other and in one row of a band, one pair a band: apart they would cost short lines links, and more
    pairs in a band would let unrelated short lines meet.
    """
    out = [0] * MINIMA
    for pair in range(ROWS // 2):
        for j in range(5):
            for x in (2 * pair, 2 * pair + 1):
                out[5 * x + (pair * x + j) % 5] = 2 * (5 * pair + j) + x % 2
    return out


def salts() -> list[int]:
    """A 64-bit number for each of the minima: a shingle with the first five bits of its bin then gets the smallest numbers there are."""
    return [signed(k ^ BINS // 2, 59) for k in bins()]


def signed(x: int, by: int = 0) -> int:
    """x shifted to the left, as a long."""
    return (x << by) - (2**64 if x << by >= 2**63 else 0)


def band_members() -> list[list[int]]:
    """The minima of each band: lines over a table of six columns and five rows.

    Bands of one slope share nothing, two of different slopes two minima at most.
    """
    return [[5 * x + (j // 5 * x + j) % 5 for x in range(ROWS)] for j in range(BANDS)]


def signatures(lines: DataFrame) -> DataFrame:
    """(node, n, bands, near1, near2): of each distinct line how often it occurs, a number for each band and four bits of each minimum.

    The minima are over the very shingles that `grams` compares. STEP shingles are hashed in one row, which is put to
    the minima of their bins only, and merged for each line before anything is shuffled.
    """
    chars = lines.select("node", wide(F.col("line")).alias("chars")).withColumn("last", last_start(F.col("chars")))
    pieces = chars.select("node", "chars", "last", F.explode_outer(F.sequence(F.lit(0), F.col("last"), F.lit(STEP))).alias("at"))
    hashed = pieces.select("node", "at", *[gram(F.col("chars"), F.least(F.col("at") + i, F.col("last"))).alias(f"h{i}") for i in range(STEP)])
    has = " | ".join(f"shiftleft(1L, CAST(shiftrightunsigned(h{i}, 59) AS INT))" for i in range(STEP))
    hashed = hashed.withColumn("has", F.expr(has))
    least = lambda k: ", ".join(f"h{i} ^ {signed(k ^ BINS // 2, 59)}L" for i in range(STEP))
    found = hashed.groupBy("node").agg(
        F.count_if(F.col("at") == 0).alias("n"),
        *[F.expr(f"min(least({least(k)})) FILTER (WHERE (has & {1 << k}L) != 0)").alias(f"b{k}") for k in range(BINS)],
    )
    found = found.select("node", "n", *[F.coalesce(F.col(f"b{k}"), F.lit(0).cast("long")).alias(f"b{k}") for k in range(BINS)])
    for level in range(5):  # an empty bin, which isn't below 0, takes the minimum of the nearest one, in blocks of 2, 4, .. 32 bins
        near = lambda k, bit=1 << level: F.col(f"b{k ^ bit}").bitwiseXOR(F.lit(signed(bit, 59)))
        found = found.select("node", "n", *[F.when(F.col(f"b{k}") < 0, F.col(f"b{k}")).otherwise(near(k)).alias(f"b{k}") for k in range(BINS)])
        if level in (1, 4):
            found = found.coalesce(WIDEST)  # joins no partitions, but ends a method of generated code: one of over 8000 bytes isn't compiled
    least = found.select("node", "n", *[F.col(f"b{b}").alias(f"m{k}") for k, b in enumerate(bins())])
    bands = F.array(*[F.xxhash64(F.lit(j), *[F.col(f"m{k}") for k in ks]) for j, ks in enumerate(band_members())])

    def bits(ks: range) -> Column:
        out = F.lit(0).cast("long")
        for i, k in enumerate(ks):
            out = out.bitwiseOR(F.shiftleft(F.col(f"m{k}").bitwiseAND(F.lit(15)), 4 * i))
        return out

    return least.select("node", "n", bands.alias("bands"), bits(range(MINIMA // 2)).alias("near1"), bits(range(MINIMA // 2, MINIMA)).alias("near2"))


def unlike(a: str, b: str) -> Column:
    """In how many of the minima two lines differ, by four bits of each."""

    def differ(x: Column) -> Column:
        x = x.bitwiseOR(F.shiftright(x, 1))
        return F.bit_count(x.bitwiseOR(F.shiftright(x, 2)).bitwiseAND(F.lit(0x0111111111111111)))

    return differ(F.col(f"near1{a}").bitwiseXOR(F.col(f"near1{b}"))) + differ(F.col(f"near2{a}").bitwiseXOR(F.col(f"near2{b}")))


def ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def named(df: DataFrame, suffix: str, keep: tuple[str, ...]) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(c + suffix) for c in df.columns])


def hub_pairs(members: DataFrame) -> DataFrame:
    """(a, b) of the members of each key with the key's hubs, if their minima allow a link.

    Members are dealt into HUBS groups, and a hub is the one of a group with the most company over all its
    keys: the text that others were copied from, if it is there. A key gives at most HUBS pairs for each member.
    """
    best = members.groupBy("key", F.pmod("node", F.lit(HUBS)).alias("_group")).agg(F.max(F.struct("company", "node", "near1", "near2")).alias("h"))
    hubs = best.select("key", F.col("h.node").alias("node_b"), F.col("h.near1").alias("near1_b"), F.col("h.near2").alias("near2_b"))
    met = named(members.select("key", "node", "near1", "near2"), "_a", ("key",)).join(hubs, "key")
    return met.where((F.col("node_a") != F.col("node_b")) & (unlike("_a", "_b") <= MOST_UNLIKE)).select(*ordered("node_a", "node_b"))


def parities(texts: DataFrame) -> DataFrame:
    """(node, n, p0..p7): the number of distinct runs of each line, and for each of 512 places the parity of those that hash there."""
    runs = texts.select("node", F.explode_outer(grams(F.col("line"))).alias("h"))  # outer: see all_lines
    place, bit = F.col("h").bitwiseAND(F.lit(PARITIES - 1)), F.expr(f"shiftleft(1L, cast(shiftright(h, {PARITIES.bit_length() - 1}) & 63 AS INT))")
    sketch = [F.bit_xor(F.when(place == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"p{k}") for k in range(PARITIES)]
    return runs.groupBy("node").agg(F.count("*").alias("n"), *sketch)


def may_link(a: str, b: str, similarity: float) -> Column:
    """What sizes and parities allow; never false for two lines that are alike.

    A run in just one of two lines flips one parity, so no more parities differ than the symmetric difference
    has runs, and at a similarity of s that has (n + m)(1 - s) / (1 + s) at most.
    """
    n, m = F.col(f"n{a}"), F.col(f"n{b}")
    differ = sum((F.bit_count(F.col(f"p{k}{a}").bitwiseXOR(F.col(f"p{k}{b}"))) for k in range(1, PARITIES)), F.bit_count(F.col(f"p0{a}").bitwiseXOR(F.col(f"p0{b}"))))
    slack = F.lit(1e-6)
    return (F.least(n, m) + slack >= F.greatest(n, m) * F.lit(similarity)) & (differ * F.lit(1 + similarity) <= (n + m) * F.lit(1 - similarity) + slack)


def open_members(at: DataFrame) -> DataFrame:
    """The members (key, node, component, ..) of keys with several components: `minor`, the members outside the key's largest
    component, get true; `pieces` and `minor_pieces` say in how many pieces of some PIECE all of a key and the minor ones are dealt.

    Keys of two members are left out: one of the two is a hub, so `hub_pairs` holds their only pair."""
    parts = at.groupBy("key", "component").agg(F.count("*").alias("size"))
    keys = parts.groupBy("key").agg(F.max(F.struct("size", "component")).alias("main"), F.sum("size").alias("all"), F.count("*").alias("components"))
    keys = keys.where("components > 1 AND all > 2").select(
        "key", F.col("main.component").alias("main"), F.ceil(F.col("all") / PIECE).cast("int").alias("pieces"),
        F.ceil((F.col("all") - F.col("main.size")) / PIECE).cast("int").alias("minor_pieces"),
    )
    return at.join(keys, "key").withColumn("minor", F.col("component") != F.col("main")).drop("main")


def open_pairs(members: DataFrame, similarity: float) -> DataFrame:
    """(a, b), once each, of the `open_members` of a key that are in different components, if minima, sizes and parities allow a link.

    One of such a pair is outside the key's largest component, so just those meet all others: in cells, each of
    a piece of the one and a piece of the other, so no task holds all pairs of a key.
    """
    piece = F.xxhash64("node", "key")
    one = members.where("minor").withColumn("p", F.pmod(piece, "minor_pieces").cast("int")).withColumn("q", F.explode(F.expr("sequence(0, pieces - 1)")))
    two = members.withColumn("q", F.pmod(piece, "pieces").cast("int")).withColumn("p", F.explode(F.expr("sequence(0, minor_pieces - 1)")))
    one, two = (named(side.drop("pieces", "minor_pieces"), suffix, ("key", "p", "q")) for side, suffix in ((one, "_a"), (two, "_b")))
    once = ~F.col("minor_b") | (F.col("node_a") < F.col("node_b"))
    allowed = (unlike("_a", "_b") <= MOST_UNLIKE) & may_link("_a", "_b", similarity)
    first = F.array_min(F.array_intersect("keys_a", "keys_b")) == F.col("key")  # a pair is made in one of the keys it shares
    return one.join(two, ["key", "p", "q"]).where((F.col("component_a") != F.col("component_b")) & once & allowed & first).select(*ordered("node_a", "node_b"))


def merged(parts: DataFrame, more: DataFrame) -> DataFrame:
    """(node, component) after further links (src, dst): the components they connect are joined, by rounds over those alone."""
    ends = more.join(parts.toDF("src", "c"), "src", "left").join(parts.toDF("dst", "d"), "dst", "left")
    roots = connected_components(ends.select(F.coalesce("c", "src").alias("src"), F.coalesce("d", "dst").alias("dst")))
    moved = narrowed(parts, roots.toDF("component", "root"), "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return moved.unionByName(roots.join(parts.select("node"), "node", "left_anti"))


def alike_lines(rows: DataFrame, similarity: float = 0.8) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(node, component) of the lines that are like another one, the nodes of lines that occur more than once, and where all these are.

    The third table, (doc, pos, node), has each place of a repeated line or of one that shares a band. The texts of the
    latter are read with it, in one pass.

    All members of a band key are compared with the key's hubs first, which is linear in the members and joins
    what was copied from one text. Then the members of a key that are still in different components are
    all compared with each other, by parity sketches before whole texts. So any two lines that share a band and are alike end in one component.
    """
    scratch = Scratch(rows.sparkSession)
    lines = all_lines(rows)
    signed = scratch.put(signatures(lines), "signatures")
    keys = signed.select("node", F.explode("bands").alias("key"))
    several = scratch.put(keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "keys")
    shared = narrowed(keys, several, "key", "inner").join(signed.select("node", "near1", "near2"), "node")
    company = F.sum("members").over(Window.partitionBy("node"))  # a node has BANDS keys at most
    members = scratch.put(shared.withColumn("company", company).drop("members"), "members")
    repeated = scratch.put(signed.where("n > 1").select("node"), "repeated")
    wanted = members.select("node", F.lit(True).alias("shares")).unionByName(repeated.select("node", F.lit(False).alias("shares")))
    wanted = scratch.put(wanted.groupBy("node").agg(F.max("shares").alias("shares")), "wanted")
    scratch.drop("signatures", "keys")
    seen = scratch.put(narrowed(lines, wanted, "node", "inner").select("doc", "pos", "node", F.when(F.col("shares"), F.col("line")).alias("line")), "seen")
    texts = scratch.put(seen.where(F.col("line").isNotNull()).select("node", "line").distinct(), "texts")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs whose exact similarity is enough."""
        both = pairs.join(texts.toDF("a", "line_a"), "a")
        both = both.join(texts.toDF("b", "line_b"), "b")
        sets = both.select("a", "b", grams(F.col("line_a")).alias("x"), grams(F.col("line_b")).alias("y"))
        counted = sets.select("a", "b", F.size("x").alias("n"), F.size("y").alias("m"), F.size(F.array_intersect("x", "y")).alias("common"))
        counted = scratch.put(counted, name)  # a filter before it is stored would make the sets again
        alike = F.col("common") >= (F.col("n") + F.col("m") - F.col("common")) * F.lit(similarity)
        return counted.where(alike).select(F.col("a").alias("src"), F.col("b").alias("dst"))

    tried = scratch.put(hub_pairs(members).distinct(), "tried")
    links = verified(tried, "links")
    parts = connected_components(links)
    at = members.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    still = scratch.put(open_members(at.drop("company")), "open")
    scratch.drop("members", "wanted")
    sketched = scratch.put(parities(texts.join(still.select("node").distinct(), "node", "left_semi")), "parities")
    known = sketched.join(still.groupBy("node").agg(F.collect_set("key").alias("keys")), "node")
    rest = scratch.put(open_pairs(still.join(known, "node"), similarity).join(tried, ["a", "b"], "left_anti"), "rest")
    more = verified(rest, "more")
    if not more.isEmpty():
        parts = merged(parts, more)
    scratch.drop("open", "parities", "rest", "tried", "texts", "links", "more")
    return parts, repeated, seen.drop("line")


def dedup_lines(df: DataFrame, doc_id: str, text: str, similarity: float = 0.8) -> DataFrame:
    """`row` (all columns of df as one struct), n_lines, n_removed and `kept` for each row of df.

    Two lines are alike if they are equal (in lower case, trimmed) or if the exact Jaccard similarity of
    their runs of 5 characters is `similarity` or more; lines linked so form a component, of
    which the first line stays, by doc_id and then place; the others go from the text `kept`.
    Pairs are found by MinHash: one at the limit of 0.8 is found with a probability of 0.94, at 0.85 of
    0.98, at 0.9 of 0.998; equal lines always are.
    Blank lines stay and a text never becomes null by this: one whose lines all go is left
    with its blank lines or empty. A null text stays null, a row with a null doc_id as it is; an empty
    table gives no rows. Rows with one doc_id count as one document: the same line at the same place stays
    in each. Lines are named by 64-bit hashes: of a billion different lines, a pair meets by chance
    with a probability of 0.03. A line may be as long as a text; its shingles spread over rows.
    """
    scratch = Scratch(df.sparkSession)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    parts, repeated, seen = alike_lines(rows, similarity)
    named_nodes = repeated.join(parts.select("node"), "node", "left_anti").select("node", F.col("node").alias("component")).unionByName(parts)
    named_nodes = scratch.put(named_nodes, "nodes")
    known = scratch.put(narrowed(seen, named_nodes, "node", "inner"), "known")
    first = known.groupBy("component").agg(F.min(F.struct("doc", "pos")).alias("first"))
    # By all three columns, so that a component with a great part of all lines is spread over the tasks.
    gone = known.join(first.select("component", "first.doc", "first.pos"), ["component", "doc", "pos"], "left_anti")
    # One long a line: its place above, half of its hash below, so that a document's lines are told apart by one set operation.
    packed = lambda pos, node: F.shiftleft(pos.cast("long"), 32).bitwiseOR(node.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))
    gone = scratch.put(gone.groupBy("doc").agg(F.collect_set(packed(F.col("pos"), F.col("node"))).alias("gone")), "gone")
    scratch.drop("nodes", "known")
    lines = F.split("text", "\n", -1)
    keys = lambda ls: F.transform(ls, lambda x, i: packed(i, F.xxhash64(normal(x))))
    kept = lambda ls: F.transform(F.array_except(keys(ls), "gone"), lambda k: F.get(ls, F.shiftrightunsigned(k, 32).cast("int")))
    stays = F.get(F.transform(F.array(lines), kept), 0)  # the text is split once
    edited = rows.join(gone, "doc", "left").select("row", "text", F.size(lines).cast("long").alias("n_lines"), F.when(F.col("gone").isNotNull(), stays).alias("stays"))
    return edited.select(
        "row", F.coalesce(F.greatest("n_lines", F.lit(0)), F.lit(0)).alias("n_lines"),
        F.when(F.col("stays").isNotNull(), F.col("n_lines") - F.size("stays")).otherwise(F.lit(0)).alias("n_removed"),
        F.when(F.col("stays").isNotNull(), F.array_join("stays", "\n")).otherwise(F.col("text")).alias("kept"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_lines(docs, "doc_id", "text").select("row.doc_id", "n_lines", "n_removed", F.col("kept").alias("text"))
