"""Operator 11 against a table of all 50-byte strings in plain Python."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from stormline.llm import passages as P

SCHEMA = "doc_id long, text string"
LAST = 2**63 - 1


def plain(rows):
    first = {}
    rows = [(LAST if d is None else d, (t or "").encode()) for d, t in rows]
    for d, t in rows:
        for i in range(len(t) - 49):
            first[t[i : i + 50]] = min(d, first.get(t[i : i + 50], LAST))
    out = []
    for d, t in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((None if d == LAST else d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def deduped(spark, rows, schema=SCHEMA, parts=3, **more):
    frame = spark.createDataFrame(rows, schema).repartition(parts) if rows else spark.createDataFrame(rows, schema)
    got = P.dedup_passages(frame, "doc_id", "text", **more)
    return sorted((tuple(r) for r in got.select("id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def random_rows(rng, n):
    """Texts that share passages of lengths about 50, overlapping and shifted, over few letters."""
    letters = "ab é"
    stock = ["".join(rng.choice(letters) for _ in range(rng.randrange(30, 140))) for _ in range(12)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(0, 6)):
            s = rng.choice(stock)
            a = rng.randrange(0, 20)
            parts.append(s[a : a + rng.randrange(30, 130)] if rng.random() < 0.7 else "".join(rng.choice(letters) for _ in range(rng.randrange(80))))
        rows.append((rng.choice([None, *range(n)]), rng.choice(["", " "]).join(parts)))
    return rows


ODD = [(1, None), (2, ""), (3, "x" * 49), (4, "x" * 50), (5, "x" * 51), (6, "x" * 3000), (7, "ab" * 700), (8, "ba" * 700), (9, "é" * 40_000), (10, "y " * 9000 + "é" * 30_000), (10, "é" * 30_000), (None, "é" * 90), (None, "q" * 200)]


@pytest.mark.parametrize("more", [{}, {"pack_bytes": 2_000, "part_strings": 40}, {"pack_bytes": 5_000, "part_strings": 300, "hot_contexts": 6}])
def test_random_texts_match_all_strings(spark, more):
    rows = random_rows(random.Random(3), 120) + ODD
    rows += rows[:10]
    assert deduped(spark, rows, **more) == plain(rows)


def test_anchors_with_many_surroundings_are_split(spark):
    """One passage in many documents, each time between texts of its own."""
    rng = random.Random(8)
    own = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    shared = own(90)
    rows = [(i, own(60) + shared[: rng.randrange(55, 90)] + own(60)) for i in range(200)]
    assert deduped(spark, rows, pack_bytes=4_000, part_strings=100, hot_contexts=20) == plain(rows)


def test_equal_passages_have_equal_anchors():
    rng = np.random.RandomState(4)
    for letters in (1, 2, 40):
        shared = rng.randint(0, letters, 70).astype(np.uint8)
        raw = np.concatenate([rng.randint(0, letters, 33).astype(np.uint8), shared, rng.randint(0, letters, 81).astype(np.uint8), shared])
        off = np.array([0, 103, len(raw)])
        at, value = P.anchors(raw, off)
        one, two = dict(zip(at - 33, value, strict=True)), dict(zip(at - 184, value, strict=True))
        for start in range(21):
            a = {(k, v) for k, v in one.items() if start <= k <= start + P.BEFORE}
            b = {(k, v) for k, v in two.items() if start <= k <= start + P.BEFORE}
            assert a & b


def test_merge_of_sorted_runs():
    rng = random.Random(1)
    for k in (1, 2, 3, 7, 16, 33):
        runs = []
        for _ in range(k):
            strings = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(0 if k > 1 else 1, 20)))
            runs.append((strings, [0] + [len(lcp(a, b)) for a, b in zip(strings, strings[1:], strict=False)]))
        order, shared = P.merged(runs)
        at, out = [0] * k, []
        for r in order:
            out.append(runs[r][0][at[r]])
            at[r] += 1
        assert out == sorted(x for s, _ in runs for x in s)
        assert shared[1:] == [len(lcp(a, b)) for a, b in zip(out, out[1:], strict=False)]


def lcp(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return a[:n]


def test_texts_and_spans(spark):
    shared = "The quick brown fox jumps over the lazy dog and runs far away."
    rows = [(2, f"Start {shared} end", "k"), (1, f"{shared}", "k")]
    frame = spark.createDataFrame(rows, f"{SCHEMA}, kept string")
    got = {r["id"]: r for r in P.dedup_passages(frame, "doc_id", "text", texts=True).collect()}
    assert bytes(got[1]["kept"]).decode() == shared and bytes(got[2]["kept"]) == b"Start  end"
    assert [tuple(s) for s in got[2]["spans"]] == [(6, 6 + len(shared))]


def test_empty_and_extra_columns(spark):
    assert deduped(spark, []) == []
    rows = [(1, "x" * 60, 4, "a", None), (2, "x" * 60, 5, "b", 3)]
    assert [r[2] for r in deduped(spark, rows, f"{SCHEMA}, pack int, data string, id int")] == [0, 60]


def test_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = P.op11_passage_dedup(spark, sf_dir).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)
