"""Operator 12 against all pairs of words in plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from stormline.llm import variants as V
from stormline.llm.store import Scratch

SCHEMA = "doc_id long, text string"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts):
    out, forms = {}, {}
    for w, n in counts.items():
        found = [v for v in counts if near(w, v)]
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * n else None
        out[w] = [n, len(found)]
    rows = set()
    for w, (n, k) in out.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.add((w, forms[w], root, n, k, None if forms[w] is None else counts[forms[w]]))
    return rows


def plain_counts(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def variants(spark, rows, schema=SCHEMA):
    return [tuple(r) for r in V.spelling_variants(spark.createDataFrame(rows, schema), "doc_id", "text", drop_every=97).collect()]


def random_texts(rng, docs):
    words = ["".join(rng.choice("aabé") for _ in range(rng.randrange(4, 8))) for _ in range(80)]
    return [(i, " ".join(rng.choice(words[: rng.randrange(1, 80)]) for _ in range(60))) for i in range(docs)]


def test_texts_match_all_pairs(spark):
    rows = random_texts(random.Random(4), 150)
    rows += [(None, "Hello hello HELLO hellos hellos hellos"), (5, None), (6, ""), (7, "ÉCOLE École école ×÷×÷× ×÷×÷× ×÷×÷×"), *rows[:4]]
    got = variants(spark, rows)
    assert len(got) == len(set(got)) and set(got) == plain_groups(plain_counts(rows))
    assert any(r[1] is not None and r[1] != r[2] for r in got)


def test_very_long_words(spark):
    long = "ab" * 4_000
    rows = [(i, f"{long} {long}b {long[:4000]}c{long[4001:]} {'é' * 3000}") for i in range(6)]
    got = {(r[0], r[4]) for r in variants(spark, rows)}
    assert got == {(r[0], r[4]) for r in plain_groups(plain_counts(rows))}


@pytest.mark.parametrize("parts", [1, 7])
def test_nodes_are_numbered_alike_over_parts(spark, parts):
    """Equal prefixes have equal numbers, others don't, whatever part their words are in."""
    rng = random.Random(parts)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 9))) for _ in range(200)})
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = V.numbered(spark.createDataFrame([(w,) for w in words], "word string"), V.F.col("word"), "way", Scratch(spark)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    seen = {}
    for r in got:
        assert len(r["way"]) == len(r["word"]) + 1
        for d, node in enumerate(r["way"]):
            assert seen.setdefault(r["word"][:d], node) == node
    assert len(set(seen.values())) == len(seen)
    ends = [r["way"][-1] for r in sorted(got)]
    assert ends == sorted(ends)


def test_empty_and_extra_columns(spark):
    assert variants(spark, []) == [] and variants(spark, [(1, "a b c")]) == []
    rows = [(1, "cloud cloud cloud cloud cloud cloud clouds clouds clouds", 3, "x", [1], "y")]
    got = V.spelling_variants(spark.createDataFrame(rows, f"{SCHEMA}, n int, word string, path_ array<int>, part_ string"), "doc_id", "text").collect()
    assert {(r["word"], r["form"], r["n_near"]) for r in got} == {("cloud", None, 1), ("clouds", "cloud", 1)}


def test_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in V.op12_spelling_variants(spark, sf_dir).collect()} == plain_groups(plain_counts(rows))
