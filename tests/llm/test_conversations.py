"""Operator 13 against plain searches over all edits, on odd conversations and on the given table."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from stormline.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def plain_repair(rows):
    """(cost, audit, lines) by Dijkstra over (row, last initial), whole audits as ties; rows: (role, text, fault)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, lines = heapq.heappop(heap)
        if at == len(rows) and state in ("", "a"):
            return cost, audit, lines
        if (at, state) in seen:
            continue
        seen.add((at, state))
        for role in ("user", "assistant"):
            if role[0] in NEXT[state]:
                heapq.heappush(heap, (cost + 3, audit + "I", at, role[0], (*lines, f"{role}:")))
        if at == len(rows):
            continue
        role, text, fault = rows[at]
        heapq.heappush(heap, (cost + 4, audit + "D", at + 1, state, lines))
        if fault in ("blank", "duplicate"):
            continue
        more = 3 if fault == "truncated" else 0
        if role[:1] and role[:1] in NEXT[state]:
            heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[:1], (*lines, f"{role}:{text}")))
        for name in ("user", "assistant"):
            if name[0] in NEXT[state]:
                heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, name[0], (*lines, f"{name}:{text}")))
    raise AssertionError


def plain(rows):
    """The contract's rows in plain Python; rows: (conv_id, turn, role, text)."""
    out, by = [], {}
    for conv, turn, role, text in rows:
        kept = by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, kept in by.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, marked = set(), [], []
        for _, role, text in kept:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
            marked.append((role, text, fault))
        turns = [t for t, _, _ in kept if t is not None]
        cost, audit, lines = plain_repair(marked)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(spark, rows, schema=SCHEMA):
    got = C.repair_conversations(C.damaged(spark.createDataFrame(rows, schema)), "conv_id", "turn", "role", "text", C.F.col("copies"))
    return sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str)


def random_rows(rng, conv, n):
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool"]
    texts = ["Fine.", "Fine.", "Cut", "", None, " \t", "What? ", "a ", "Yes!\n", "Long " * 50 + "."]
    return [(conv, rng.choice([None, i, i, i, i // 2]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"Text {i}.") for i in range(n)]


def test_random_conversations_match_the_plain_search(spark):
    rng = random.Random(5)
    rows = [r for conv in range(300) for r in random_rows(rng, conv, rng.randrange(1, 12))]
    rows += random_rows(rng, None, 9) + random_rows(rng, 900, 400) + rows[:30]
    assert repaired(spark, rows) == plain(rows)


def test_walk_of_all_short_sequences():
    """Every sequence of up to four rows of seven kinds."""
    import itertools

    kinds = [("user", None), ("assistant", None), ("system", None), ("user", "truncated"), ("assistant", "truncated"), ("x", None), ("user", "blank")]
    for n in range(5):
        for some in itertools.product(kinds, repeat=n):
            rows = [(role, f"t{i}", fault) for i, (role, fault) in enumerate(some)]
            walk = C.Walk()
            for r in rows:
                walk.row(*r)
            cost, audit, lines = plain_repair(rows)
            assert walk.end() == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), rows


def test_long_conversations_need_little_memory():
    rng = random.Random(2)
    walk, rows = C.Walk(), []
    for i in range(20_000):
        rows.append((rng.choice(["user", "assistant", "system"]), f"t{i}", rng.choice([None, "truncated", "blank", "duplicate"])))
        walk.row(*rows[-1])
    assert walk.most_open < 500
    assert len(walk.end()[1]) >= 20_000
    blank = C.Walk()
    for _ in range(5_000):
        blank.row("user", "", "blank")
    assert blank.end()[:2] == (20_000, "D" * 5_000) and blank.most_open < 500


def test_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = C.op13_conversation_repair(spark, sf_dir)
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)], [(1, 0, "user", "x" * 300_000)]])
def test_odd_tables(spark, rows):
    assert repaired(spark, rows) == plain(rows)


def test_columns_with_other_meanings_are_ignored(spark):
    rows = [(1, 0, "user", "Hi.", "f", 5, True), (1, 1, "assistant", "Ho.", "g", 6, False)]
    frame = spark.createDataFrame(rows, f"{SCHEMA}, fault string, _conv int, first boolean")
    got = C.repair_conversations(frame, "conv_id", "turn", "role", "text").collect()
    assert [r["audit"] for r in got] == ["KK"]
