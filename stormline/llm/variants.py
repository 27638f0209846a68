"""Operator 12: spelling variants by a dictionary of pairs of trie nodes.

The nodes of the trie of all words are numbered, and so are those of the trie of the reversed words. A
word of m letters passes m + 1 nodes of either. The pair (node of the first i letters, node of the
letters from j on) says as two integers what is left of the word without the letters i..j-1: with
j = i + 1 a letter is skipped, with j = i nothing is. Two words differ by one replaced letter just if
they share a pair with one skipped at the same place, by one inserted letter just if a pair of the
longer with one skipped is a pair of the shorter with none. So exact neighbours come from one
grouping by two integers. A pair has at most one word that skips nothing and a word a letter of the
alphabet that skips one, so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormline.llm.store import Scratch
from stormline.registry import table

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted words get the numbers of the nodes that they pass, as this part alone would number them.

    The first word of a part takes 1, 2, ...; each later one takes over the nodes it shares with the word before.
    """
    part, last, path, nodes = TaskContext.get().partitionId(), "", [0], 0
    for batch in batches:
        paths, counts = [], []
        for word in batch.column("word_").to_pylist():
            shared = common(last, word)
            path = [*path[: shared + 1], *range(nodes + 1, nodes + 1 + len(word) - shared)]
            nodes += len(word) - shared
            last = word
            paths.append(path)
            counts.append(nodes)
        added = [pa.array([part] * len(paths), pa.int32()), pa.array(paths, pa.list_(pa.int64())), pa.array(counts, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "part_", "path_", "nodes_"])


def numbered(words: DataFrame, by: Column, name: str, scratch: Scratch) -> DataFrame:
    """`words` with a column `name`: the numbers of the trie nodes on the way of the string `by`, the root 0 first.

    Strings must be distinct. Parts of the sorted strings are numbered apart. A part shares with those
    before it only the nodes on the way of its first string; the driver carries them from part to part,
    as one path a part. Ends of ways ascend as the strings do.
    """
    kept = words.columns
    local = words.withColumn("word_", by).repartitionByRange("word_").sortWithinPartitions("word_")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in local.schema.fields)
    local = scratch.put(local.mapInArrow(_numbered, f"{schema}, part_ int, path_ array<bigint>, nodes_ bigint"), name)
    ends = local.groupBy("part_").agg(F.min("word_").alias("first"), F.max("word_").alias("last"), F.max_by("path_", "word_").alias("path"), F.max("nodes_").alias("nodes"))
    base, before, carry, rows = 0, "", [0], []
    for e in ends.orderBy("part_").collect():
        shared = common(before, e["first"])
        rows.append((e["part_"], base, carry[: shared + 1]))
        carry = [x if d == 0 else carry[d] if x == d <= shared else base + x for d, x in enumerate(e["path"])]
        before, base = e["last"], base + e["nodes"]
    known = words.sparkSession.createDataFrame(rows, "part_ int, base_ long, carry_ array<long>")
    # the node at depth d is the first string's just if its local number is d
    path = F.transform("path_", lambda x, d: F.when((x == d) & (d < F.size("carry_")), F.get("carry_", d)).otherwise(F.col("base_") + x))
    return local.join(F.broadcast(known), "part_").select(*kept, path.alias(name))


def words_of(docs: DataFrame, text: str, run: str = RUN) -> DataFrame:
    """(id, word): every run of letters with only A-Z lower-cased; null texts have none."""
    found = docs.select("id", F.explode(F.regexp_extract_all(F.col(text), F.lit(run), F.lit(0))).alias("word"))
    return found.select("id", F.translate("word", UPPER, LOWER).alias("word"))


def neighbours(words: DataFrame, scratch: Scratch) -> DataFrame:
    """id, word, n, n_near and the near word of largest n, ties to the smallest: near (n, id negated); for distinct (word, n)."""
    ahead = scratch.put(numbered(words, F.col("word"), "ahead", scratch), "both")
    both = scratch.put(numbered(ahead, F.reverse("word"), "back", scratch), "both").withColumn("id", F.element_at("ahead", -1))
    scratch.drop("ahead", "back")
    size = F.size("ahead") - 1  # letters

    def skipped(i: Column) -> Column:
        # words of one letter run lose the same string wherever in the run: its first place stands for all
        first = (i == 0) | (F.col("word").substr(i + 1, F.lit(1)) != F.col("word").substr(i, F.lit(1)))
        return F.struct(F.get("ahead", i).alias("p"), F.get("back", size - 1 - i).alias("s"), F.lit(True).alias("skip"), first.alias("first"))

    def whole(i: Column) -> Column:
        return F.struct(F.get("ahead", i).alias("p"), F.get("back", size - i).alias("s"), F.lit(False).alias("skip"), F.lit(False).alias("first"))

    pairs = F.concat(F.transform(F.sequence(F.lit(0), size - 1), skipped), F.transform(F.sequence(F.lit(0), size), whole))
    keys = both.select("id", "n", F.explode(pairs).alias("k")).select("id", "n", "k.*")
    group = Window.partitionBy("p", "s")
    me = F.struct("n", (-F.col("id")).alias("neg"))
    ranked = group.orderBy(F.desc("skip"), F.desc("n"), "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = keys.select(
        "id", "n", "skip", "first", F.count("*").over(group).alias("of"),
        F.sum(F.col("skip").cast("long")).over(group).alias("skips"), F.sum(F.col("first").cast("long")).over(group).alias("firsts"),
        F.first(me).over(ranked).alias("one"), F.nth_value(me, 2).over(ranked).alias("two"),
        F.max(F.when(~F.col("skip"), me)).over(group).alias("shorter"), F.max(F.when(F.col("first"), me)).over(group).alias("longer"),
    ).where("of > 1")
    other = F.when(F.col("skips") > 1, F.when(F.col("one.neg") == -F.col("id"), F.col("two")).otherwise(F.col("one")))
    best = F.when(F.col("skip"), F.greatest(other, F.when(F.col("first"), F.col("shorter")))).otherwise(F.col("longer"))
    count = F.when(F.col("skip"), F.col("skips") - 1 + F.when(F.col("first") & F.col("shorter").isNotNull(), 1).otherwise(0)).otherwise(F.col("firsts"))
    near = seen.select("id", best.alias("near"), count.alias("count")).where("count > 0").groupBy("id").agg(F.sum("count").alias("n_near"), F.max("near").alias("near"))
    return both.select("id", "word", "n").join(near, "id", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)).cast("long"))


def ends_of(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root): where the links (id, to) lead in the end; each round doubles the steps, so chains of k take log2 k rounds."""
    now = scratch.put(links.select("id", "to"), "links")
    while True:
        ahead = now.select(F.col("id").alias("to"), F.col("to").alias("far"))
        step = scratch.put(now.join(ahead, "to", "left").select("id", F.coalesce("far", "to").alias("to"), F.col("far").isNotNull().alias("moved")), "links")
        now = step.select("id", "to")
        if step.where("moved").isEmpty():
            return now.withColumnRenamed("to", "root")


def variant_groups(counted: DataFrame, factor: int = 2) -> DataFrame:
    """Each word's form (its near word of largest n, if that n is at least `factor` times its own), and the last of its forms.

    `counted` has distinct words (`word` string, `n` long); a null word is dropped. Near words differ by just one
    inserted, deleted or replaced code point; ties of n go to the smallest word by code points. A word without a form
    is its own root. No words give no rows.
    """
    scratch = Scratch(counted.sparkSession)
    words = scratch.put(counted.where(F.col("word").isNotNull() & (F.col("word") != "")).select("word", "n"), "words")
    near = neighbours(words, scratch)
    near = scratch.put(near.select("id", "word", "n", "n_near", F.when(F.col("near.n") >= factor * F.col("n"), F.col("near")).alias("near")), "near")
    scratch.drop("both", "words")
    links = near.where(F.col("near").isNotNull()).select("id", (-F.col("near.neg")).alias("to"))
    led = near.select("id", "word", "n", "n_near", F.col("near.n").alias("form_n"), (-F.col("near.neg")).alias("form_id")).join(ends_of(links, scratch), "id", "left")
    names = near.select(F.col("id").alias("at"), F.col("word").alias("name"))
    led = led.join(names.toDF("form_id", "form"), "form_id", "left").join(names.toDF("root", "root_name"), "root", "left")
    return led.select("word", "form", F.coalesce("root_name", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str, text_col: str, least_length: int = 5, least_count: int = 3, drop_every: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of whole texts that are long and frequent enough.

    With `drop_every` = m, a run whose h = crc32 of `<id>:<run>` is a multiple of m loses the code point h % length:
    planted misspellings that make the result checkable. Null texts have no words; a null id counts as an empty
    string there; repeated rows count as often as they occur; other columns aren't read; no rows give no rows. Counts are
    summed before the shuffle, so a frequent word is no hot key. A text is split by one task, whatever its length.
    """
    runs = words_of(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text")
    word = F.col("word")
    if drop_every is not None:
        h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
        at = (h % F.length("word")).cast("int")
        word = F.when(h % drop_every == 0, F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.length("word")))).otherwise(word)
    counted = runs.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return variant_groups(counted.where(F.col("n") >= least_count))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), "doc_id", "text", drop_every=97)
