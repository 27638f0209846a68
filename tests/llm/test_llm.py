"""Operators of the llm subpackage on small tables: plain versions, odd rows and empty tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormline.llm import fingerprint, graph, langid, linededup, lm, mixing, ngram_join, pieces, secrets, sharding, topk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOC)


LONG = "word%d " * 40
ODD = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "é" * 70000, "b"), (5, "one two", "b"), (5, "one two", "b"), (None, "no id here", None), (6, "x " * 30000, "b")]


def test_ngram_components_match_a_plain_version(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(10, " ".join(base), "a"), (3, " ".join(base), "a"), (7, " ".join(base[:-2] + ["q"]), "a"), (8, " ".join(f"z{i}" for i in range(60)), "a"), (20, " ".join(base[:58]), "b"), (1, "Short text", "a"), (2, "short TEXT", "a")] + ODD
    got = ngram_join.ngram_jaccard_components(docs(spark, rows), "doc_id", "text").collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got}
    assert by[(10, 56)] == by[(3, 56)] == by[(20, 54)] == 3
    assert by[(8, 56)] == 8 and by[(1, 0)] == 1 and by[(None, 1)] is None


def test_ngram_links_are_all_counted(spark, monkeypatch):
    """Near copies of one text link with each other too, not with their hub alone; keys are cut into pieces."""
    monkeypatch.setattr(ngram_join, "PIECE", 4, raising=False)
    monkeypatch.setattr(ngram_join, "CELL_SETS", 5)
    monkeypatch.setattr(ngram_join, "COLUMNS", 64)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base)] + [" ".join([*base[: 6 * k], f"new{k}", *base[6 * k + 1 :]]) for k in range(1, 19)] + [" ".join(base[:m]) for m in (100, 108, 112)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    want = {i: sum(x is not y and 100 * len(x & y) >= 80 * len(x | y) for y in sets) for i, x in enumerate(sets)}
    got = ngram_join.ngram_jaccard_components(docs(spark, [(i, t, "a") for i, t in enumerate(texts)]), "doc_id", "text").collect()
    assert {r["doc_id"]: r["n_links"] for r in got} == want and {r["component_id"] for r in got} == {0}


def plain_components(rows):
    """component_id and set size by brute force: rows are tied by links and by shared ids."""
    words = [WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)})) for _, t in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    at = list(range(len(rows)))
    for i, (x, (a, _)) in enumerate(zip(sets, rows, strict=True)):
        for j, (y, (b, _)) in enumerate(zip(sets[:i], rows[:i], strict=True)):
            if x and y and a is not None and b is not None and (a == b or 100 * len(x & y) >= 80 * len(x | y)):
                at = [at[j] if c == at[i] else c for c in at]
    return Counter((r[0], len(s), min((q[0] for q, d in zip(rows, at, strict=True) if d == c), default=None) if s and r[0] is not None else r[0]) for r, s, c in zip(rows, sets, at, strict=True))


def test_ngram_components_match_brute_force(spark):
    """Random near copies, repeated rows, ids with several texts, short and odd texts."""
    rng = np.random.RandomState(9)
    rows = []
    for family in range(12):
        base = [f"v{family}_{x}" for x in rng.randint(0, 40, rng.randint(3, 90))]
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randint(len(w))] = f"e{rng.randint(1000)}"
            rows.append((int(rng.randint(10, 80)), " ".join(w)))
    rows += rows[:5] + [(i, t) for i, t, _ in ODD if t is None or len(t) < 1000]
    got = ngram_join.ngram_jaccard_components(docs(spark, [(i, t, "a") for i, t in rows]), "doc_id", "text").collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == plain_components(rows)
    assert ngram_join.ngram_jaccard_components(docs(spark, []), "doc_id", "text").count() == 0


def test_ngram_blocks_never_lose_a_link():
    """Sets just as alike as the limit share a key, whatever their sizes."""
    rng = np.random.RandomState(1)
    for n in [4, 5, 7, 8, 9, 15, 16, 31, 33, 63, 64, 100, 127, 128, 129, 400, 1023, 1025]:
        for _ in range(20):
            a = np.unique(rng.randint(0, 2**63, n).astype(np.uint64))
            same = math.ceil(8 * len(a) / 9)
            b = np.unique(np.concatenate([a[:same], rng.randint(0, 2**63, len(a) - same).astype(np.uint64)]))
            small = a[: math.ceil(0.8 * len(a))]
            for x in (b, small):
                both = len(np.intersect1d(a, x))
                if 100 * both >= 80 * (len(a) + len(x) - both) and len(np.setxor1d(a, x)):
                    assert np.intersect1d(ngram_join.set_keys(a, 80, 100), ngram_join.set_keys(x, 80, 100)).size


def test_keep_one_of_each(spark):
    t = LONG % tuple(range(40))
    kept = ngram_join.keep_one_of_each(docs(spark, [(25, t, "a"), (12, t + "more", "a"), (9, "else", "b"), *ODD]))
    assert sorted(x for x in (r["doc_id"] for r in kept.collect()) if x is not None) == [1, 2, 3, 4, 5, 6, 9, 12]


def test_components_of_chains_and_loops(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 50), (60, 61), (61, 60), (None, 3)], "src long, dst long")
    got = {r["node"]: r["component"] for r in graph.connected_components(e).collect()}
    assert {got[i] for i in range(31)} == {0} and got[61] == 60
    assert graph.connected_components(e.limit(0)).count() == 0


def plain_samples(text):
    """Samples of the fingerprint in plain Python, from the same hashes."""
    return Counter(w for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w)


def jaccard(a, b):
    a, b = plain_samples(a), plain_samples(b)
    return sum(min(a[w], b[w]) for w in a | b) / sum(max(a[w], b[w]) for w in a | b)


def test_fingerprints_estimate_the_weighted_jaccard(spark):
    """Over twenty vocabularies, each with hashes of its own, the mean error is near 0."""
    rng, errors = np.random.RandomState(2), []
    texts = [" ".join(f"{v}_{x}" for x in rng.zipf(1.6, 300) % 80) for v in range(20) for _ in range(6)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    got = {r["id"]: r["text"] for r in fingerprint.fingerprints(df, ["id"], ["text"]).collect()}
    for i in range(len(texts)):
        for j in range(i - i % 6, i):
            errors.append(np.mean([x == y for x, y in zip(got[i], got[j], strict=True)]) - jaccard(texts[i], texts[j]))
    assert abs(np.mean(errors)) < 0.04 and np.std(errors) < 0.09


def test_fingerprint_of_odd_texts(spark):
    df = spark.createDataFrame([(1, ""), (2, "a b"), (3, "a b"), (4, " \t")], "id long, text string")
    got = {r["id"]: r["text"] for r in fingerprint.fingerprints(df, ["id"], ["text"]).collect()}
    assert got[1] is None and got[4] is None and got[2] == got[3] and len(got[2]) == fingerprint.SAMPLES


def test_fingerprints_of_two_texts_at_once(spark):
    """Counted together, texts get the samples that each gets alone, whatever words they share; null counts as no words."""
    rng = np.random.RandomState(4)
    texts = [None, "", "a", "a b a", "b b b"] + [" ".join(f"w{x}" for x in rng.zipf(1.5, 60) % 30) for _ in range(20)]
    df = spark.createDataFrame([(100 * i + j, a, b) for i, a in enumerate(texts) for j, b in enumerate(texts[: 1 + i])], "id long, a string, b string")
    df = df.fillna("", ["a", "b"])
    one = spark.createDataFrame([(i, t or "") for i, t in enumerate(texts)], "id long, t string")
    alone = {r["id"]: r["t"] for r in fingerprint.fingerprints(one, ["id"], ["t"]).collect()}
    for r in fingerprint.fingerprints(df, ["id"], ["a", "b"]).collect():
        assert r["a"] == alone[r["id"] // 100] and r["b"] == alone[r["id"] % 100]


def test_next_document_goes_down_and_around(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(37)], "doc_id long, text string")
    for buckets in (1, 5, 40):
        got = {r["id"]: r["next_text"] for r in fingerprint.with_next(df, "doc_id", "text", buckets).where("ghost = 0").collect()}
        assert got == {i: f"t{(i - 1) % 37}" for i in range(37)}


def test_secrets_and_links(spark):
    key = "Zx8Qp2Lm9Vt4Kd7Rw1Yb6Nc3"
    rows = [
        (101, f"user: bob.smith\nkey {key} at https://api.example.com/v1", "a"), (102, f"lonely {key} here", "a"), (103, "write to bob@example.com", "a"),
        (104, 'token = "0123456789abcdef0123456789abcdef"', "a"), (105, f"user: bob.smith\n\n{key}", "a"), (106, "PASSWORD=abc", "a"), *ODD,
    ]
    got = {}
    for r in secrets.find_secrets(docs(spark, rows), "doc_id", "text").collect():
        got[r["doc_id"]] = [(x["kind"], x["start"], x["end"]) for x in r["found"]]
    assert [k for k, _, _ in got[101]] == ["identifier", "key", "endpoint"]
    assert got[102] == [] and got[103] == [] and got[105] == [] and got[106] == []
    assert got[104] == [("assign", 0, 41), ("hex", 9, 41)]
    assert got[None] == []


def test_mix_meets_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), f"s{i % 4}" if i % 9 else None) for i in range(900)]
    df = docs(spark, rows)
    got = mixing.mix_sources(df, "doc_id", "source", "text").collect()
    again = mixing.mix_sources(df.repartition(7), "doc_id", "source", "text").collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == 900
    by = {}
    for r in got:
        t = by.setdefault(r["source_size"], [r["target"], 0])
        t[1] += r["taken"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert all(abs(taken - target) <= 40 for target, taken in by.values())
    assert math.isclose(sum(t for t, _ in by.values()), 1.5 * sum(r["size"] for r in got))


def test_mix_of_odd_rows(spark):
    got = mixing.mix_sources(docs(spark, ODD), "doc_id", "source", "text").collect()
    assert len(got) == len(ODD) and all(r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.mix_sources(docs(spark, []), "doc_id", "source", "text").count() == 0


def test_shards_move_only_into_the_new_one(spark):
    df = docs(spark, [(i, f"t{i}", "a") for i in range(2000)] + ODD)
    got = sharding.assign_shards(df, "doc_id", "text", [1.0] * 8, [1.0] * 9).collect()
    assert all(r["shard"] == r["grown_shard"] or r["grown_shard"] == 8 for r in got)
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert all(r["text_crc32"] == zlib.crc32(f"t{r['doc_id']}".encode()) for r in got if r["size"] < 20 and r["doc_id"] and r["doc_id"] > 6)
    moved = sum(r["shard"] != r["grown_shard"] for r in got) / len(got)
    assert 0.06 < moved < 0.17


def test_weights_of_shards(spark):
    df = spark.range(6000).select(sharding.rendezvous_shard(F.col("id"), [1.0, 2.0, 0.0]).alias("s"))
    n = {r["s"]: r["count"] for r in df.groupBy("s").count().collect()}
    assert 2 not in n and 1.8 < n[1] / n[0] < 2.2


def test_top_k_matches_brute_force(spark):
    rng = np.random.RandomState(4)
    x = rng.standard_normal((700, 16)) * rng.lognormal(0, 1, (700, 1))
    x[5] = x[6] = x[7]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(1000, None), (1050, [1.0, None] * 8), (1100, [float("nan")] * 16), (None, [1.0] * 16)]
    got = topk.top_inner_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", block_rows=64).collect()
    z = np.floor(256 * x).astype(np.int64)
    for q in range(0, 700, 50):
        s = z @ z[q]
        order = [j for j in np.lexsort((np.arange(700), -s)) if j != q][:5]
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == [(j, s[j]) for j in order]
    assert {r["query_id"] for r in got} == set(range(0, 700, 50))


def test_top_k_of_an_empty_table(spark):
    assert topk.top_inner_products(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding").count() == 0


VOCAB = pieces.load_vocab()


def test_samples_follow_the_lattice_without_replacement():
    from sentencepiece import SentencePieceProcessor

    v = pieces.load_vocab(alpha=0.3)
    model = SentencePieceProcessor(model_file=pieces.MODEL)
    weight = {model.id_to_piece(int(i)): (int(i), w) for i, w in zip(v.ids, v.weights, strict=True)}

    def every(s):
        return [((weight[s[:n]][0], *rest), weight[s[:n]][1] + w) for n in range(1, len(s) + 1) if s[:n] in weight for rest, w in every(s[n:])] if s else [((), 0.0)]

    found = every("▁the▁in")
    total = math.log(sum(math.exp(w) for _, w in found))
    p = {ids: math.exp(w - total) for ids, w in found}
    n = 20000
    got = {r: [tuple(x) for x in ids] for r, _, ids, *_ in pieces.sample_texts(["the in"] * n, pieces.mix(np.arange(n, dtype=np.uint64)), v, 2)}
    first, pairs = Counter(got[1]), Counter(zip(got[1], got[2], strict=True))
    a, b = sorted(p, key=lambda x: -p[x])[:2]
    assert abs(first[a] / n - p[a]) < 0.02 and abs(pairs[(a, b)] / n - p[a] * p[b] / (1 - p[a])) < 0.02
    assert all(x != y for x, y in zip(got[1], got[2], strict=True))


def test_pieces_round_trip(spark):
    rows = [(101, "Hello  wörld\n日本 🙂 ", "a"), (102, "a" * 3000, "a"), *ODD[:4], (8, "  lead", "a")]
    df = docs(spark, rows)
    got = pieces.decode_ids(pieces.encode_samples(df, "doc_id", "text", k=2)).collect()
    want = {i: t or "" for i, t, _ in rows}
    assert all(r["text"] == want[r["doc_id"]] for r in got)
    assert Counter(r["doc_id"] for r in got)[101] == 2
    assert pieces.encode_samples(docs(spark, []), "doc_id", "text").count() == 0


def test_lines_are_kept_once(spark):
    line = "The quick brown fox jumps over the lazy dog near the river bank today"
    near = line.replace("today", "todays")
    rows = [(105, f"{line}\nown five", "a"), (102, f"own two\n{near}\n\n{near}", "a"), (109, line.upper(), "a"), *ODD]
    got = {r["row"]["doc_id"]: r for r in linededup.dedup_lines(docs(spark, rows), "doc_id", "text").collect()}
    assert got[102]["kept"] == f"own two\n{near}\n" and got[102]["n_removed"] == 1
    assert got[105]["kept"] == "own five" and got[109]["kept"] == "" and got[1]["kept"] is None and got[None]["kept"] == "no id here"


def test_lines_are_made_once_and_lowered_once(spark, monkeypatch):
    """The texts are split into lines by one call, and the filter of blank lines takes no second lower case; blank lines of any white space stay."""
    calls, made = [], linededup.all_lines
    monkeypatch.setattr(linededup, "all_lines", lambda rows: calls.append(made(rows)) or calls[-1])
    line = "The quick brown fox jumps over the lazy dog near the river bank today"
    rows = [(1, f" \t\r\n{line}\n\x0b\f \nÉtÉ {line}", "a"), (2, f"{line.upper()} \r\n\n \t{line}s", "a"), (3, "日本語の文章\nabcd\nABCD ", "a")]
    got = {r["row"]["doc_id"]: (r["n_lines"], r["n_removed"], r["kept"]) for r in linededup.dedup_lines(docs(spark, rows), "doc_id", "text").collect()}
    assert got == {1: (4, 1, f" \t\r\n{line}\n\x0b\f "), 2: (3, 2, ""), 3: (3, 1, "日本語の文章\nabcd")}
    assert len(calls) == 1 and calls[0]._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1


def test_texts_and_sets_are_made_once(spark):
    """No filter that Spark puts below an explode splits a text or makes a line's runs again."""
    lines = linededup.all_lines(docs(spark, [(1, "a line\nanother", "a"), (2, None, "a"), (3, "", "a")]).select(F.col("doc_id").alias("doc"), "text"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(lines).count("split(") == 1 and sorted(r["line"] for r in lines.collect()) == ["a line", "another"]
    assert plan(linededup.parities(lines.select("node", "line").distinct())).count("array_distinct(") == 1
    assert plan(linededup.signatures(lines)).count("sequence(") == 1


def test_bins_take_the_minimum_of_the_nearest(spark):
    """A line of one run up to one of many: each minimum is that of XOR over all runs, and neighbours share a band just once."""
    rng = np.random.RandomState(10)
    lines = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n)) for n in (1, 5, 6, 7, 9, 13, 14, 30, 90, 700)]
    frame = spark.createDataFrame([(t,) for t in lines], "line string").withColumn("node", F.xxhash64("line"))
    got = {r["line"]: r for r in frame.join(linededup.signatures(frame), "node").collect()}
    runs = sorted({t[i : i + 5] for t in lines for i in range(max(1, len(t) - 4))})
    h = {r["s"]: r["h"] for r in spark.createDataFrame([(s,) for s in runs], "s string").select("s", F.xxhash64(F.encode("s", "UTF-32")).alias("h")).collect()}
    for t in lines:
        m = [min(h[t[i : i + 5]] ^ c for i in range(max(1, len(t) - 4))) for c in linededup.salts()]
        assert got[t]["near1"] == sum((x & 15) << 4 * i for i, x in enumerate(m[:15])) and got[t]["near2"] == sum((x & 15) << 4 * i for i, x in enumerate(m[15:]))
        assert got[t]["n"] == 1
    assert sorted(linededup.bins()) == list(range(linededup.MINIMA))
    for ks in linededup.band_members():
        at = [linededup.bins()[k] for k in ks]
        assert sum(a ^ 1 in at for a in at) == 2


def test_short_lines_share_bands(spark):
    """Pairs of lines of 12 characters, 8 runs each of which 7 are common (7 of 9 in all): 0.77 or more share a band (some 0.66 before neighbours stood in one band)."""
    rng = np.random.RandomState(11)
    pairs = []
    for _ in range(600):
        a = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 12))
        pairs.append((a, a[:-1] + "0"))
    lines = spark.createDataFrame([(t,) for p in pairs for t in p], "line string").distinct().withColumn("node", F.xxhash64("line"))
    bands = {r["line"]: r["bands"] for r in lines.join(linededup.signatures(lines), "node").collect()}
    assert sum(any(x == y for x, y in zip(bands[a], bands[b], strict=True)) for a, b in pairs) > 0.77 * 600


def test_lines_far_apart_stay(spark):
    a, b = "alpha beta gamma delta epsilon zeta", "alpha beta gamma delta lambda kappa"
    got = linededup.dedup_lines(docs(spark, [(1, a, "a"), (2, b, "a")]), "doc_id", "text").collect()
    assert sorted(r["kept"] for r in got) == sorted([a, b])


def line_components(lines, similarity=0.8):
    """The sets of lines that links by brute force join."""
    grams = [{t[i : i + 5] for i in range(len(t) - 4)} or {t} for t in lines]
    at = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            both = len(grams[i] & grams[j])
            if both >= similarity * (len(grams[i]) + len(grams[j]) - both) and at[i] != at[j]:
                at = [at[j] if x == at[i] else x for x in at]
    return sorted(sorted(t for t, x in zip(lines, at, strict=True) if x == c) for c in set(at))


def test_lines_of_one_frame_meet_each_other(spark, monkeypatch):
    """Many families in one key, each of two near copies: no hub is like most of them."""
    rng = np.random.RandomState(5)
    frame = "Subscribe to our weekly newsletter and get all of the latest updates from "
    ends = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 30)) for _ in range(60)]
    lines = [x for e in ends for x in (frame + e, frame + e + "s")]
    monkeypatch.setattr(linededup, "signatures", lambda rows: rows.groupBy("node").agg(F.count("*").alias("n")).select("node", "n", F.array(F.lit(7).cast("long"), F.lit(8).cast("long")).alias("bands"), F.lit(0).cast("long").alias("near1"), F.lit(0).cast("long").alias("near2")))
    monkeypatch.setattr(linededup, "PIECE", 50, raising=False)
    df = docs(spark, [(i, t, "a") for i, t in enumerate(lines)]).select(F.col("doc_id").alias("doc"), "text")
    by = {}
    seen = linededup.all_lines(df).join(linededup.alike_lines(df)[0], "node", "left")
    for r in seen.collect():
        by.setdefault(r["node"] if r["component"] is None else r["component"], []).append(r["line"])
    want = line_components([t.lower() for t in lines])
    assert len(want) == 60 and sorted(map(sorted, by.values())) == want


def test_parities_never_rule_out_a_link(spark):
    """Differing parities are no more than the symmetric difference, and pairs down to the limit are allowed."""
    rng = np.random.RandomState(9)
    a = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 300))
    lines = ["abcd", "abcd ", "q" * 50, "日本語の文章" * 30]
    for n in (6, 12, 30, 80, 300):
        b = list(a[:n])
        lines.append(a[:n])
        for _ in range(12):
            b[rng.randint(n)] = "Q"
            lines.append("".join(b))
    lines = list(dict.fromkeys(lines))
    sketched = linededup.parities(spark.createDataFrame(list(enumerate(lines)), "node long, line string"))
    one, two = (linededup.named(sketched, x, ()) for x in ("_a", "_b"))
    allowed = {(r["node_a"], r["node_b"]) for r in one.join(two, linededup.may_link("_a", "_b", 0.8)).select("node_a", "node_b").collect()}
    gram = [{t[i : i + 5] for i in range(len(t) - 4)} or {t} for t in lines]
    like = {(i, j): len(gram[i] & gram[j]) / len(gram[i] | gram[j]) for i in range(len(lines)) for j in range(len(lines))}
    assert {r["node"]: r["n"] for r in sketched.collect()} == {i: len(g) for i, g in enumerate(gram)}
    assert {p for p, x in like.items() if x >= 0.8} <= allowed and sum(p in allowed for p, x in like.items() if x < 0.5) < 20


def test_further_links_join_components(spark):
    parts = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)], "node long, component long")
    more = spark.createDataFrame([(6, 2), (4, 9), (3, 7)], "src long, dst long")
    got = {tuple(r) for r in linededup.merged(parts, more).collect()}
    assert got == {(1, 1), (2, 1), (5, 1), (6, 1), (4, 4), (8, 4), (9, 4), (3, 3), (7, 3)}
    assert {tuple(r) for r in linededup.merged(parts, more.limit(0)).collect()} == {tuple(r) for r in parts.collect()}


def test_open_pairs_are_all_pairs_between_components(spark, monkeypatch):
    """One large component, some small ones and lone lines share two keys: each pair between components is made, once."""
    monkeypatch.setattr(linededup, "PIECE", 7)
    at = [(key, n, 0 if n < 40 else n // 3) for key in (1, 2) for n in range(60 if key == 1 else 50)] + [(3, n, 1) for n in range(5)]
    zeros = [F.lit(0).cast("long").alias(c) for c in ("near1", "near2", *(f"p{k}" for k in range(linededup.PARITIES)))]
    df = spark.createDataFrame(at, "key long, node long, component long").select("*", F.lit(9).alias("n"), *zeros)
    still = linededup.open_members(df)
    keys = still.groupBy("node").agg(F.collect_set("key").alias("keys"))
    got = [(r["a"], r["b"]) for r in linededup.open_pairs(still.join(keys, "node"), 0.8).collect()]
    component = {n: c for key, n, c in at if key == 1}
    want = [(a, b) for a in range(60) for b in range(a + 1, 60) if component[a] != component[b]]
    assert sorted(got) == want


def test_signatures_are_of_the_shingles_compared(spark):
    """Lines without white space, short ones and long ones share bands as their exact similarity says."""
    rng = np.random.RandomState(6)
    char = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), n))
    lines = []
    for n in (30, 60, 200, 203, 204, 205, 401, 900):
        t = char(n)
        lines += [t, t[:3] + "é" + t[4:]]
    lines += [f"https://www.example.org/{char(40)}" for _ in range(20)] + ["abcd", "abcde", "日本語の文章" * 50, "日本x語の文章" + "日本語の文章" * 49]
    df = docs(spark, [(i, t, "a") for i, t in enumerate(lines)]).select(F.col("doc_id").alias("doc"), "text")
    signed = {r["line"]: r for r in linededup.all_lines(df).join(linededup.signatures(linededup.all_lines(df)), "node").collect()}
    s64 = lambda x: x - 2**64 if x >= 2**63 else x
    shingles = {s for t in lines for s in (t[i : i + 5] for i in range(max(1, len(t) - 4)))}
    hashed = {r["s"]: r["h"] % 2**64 for r in spark.createDataFrame([(s,) for s in shingles], "s string").select("s", F.xxhash64(F.encode("s", "UTF-32")).alias("h")).collect()}
    salts = [c % 2**64 for c in linededup.salts()]
    minima = {t: [min(s64(hashed[t[i : i + 5]] ^ c) for i in range(max(1, len(t) - 4))) for c in salts] for t in lines}
    half = linededup.MINIMA // 2
    for t, m in minima.items():
        assert signed[t]["near1"] == sum((x & 15) << 4 * i for i, x in enumerate(m[:half])) and signed[t]["near2"] == sum((x & 15) << 4 * i for i, x in enumerate(m[half:]))
    for t in lines:
        for u in lines:
            same = [all(minima[t][k] == minima[u][k] for k in ks) for ks in linededup.band_members()]
            assert same == [a == b for a, b in zip(signed[t]["bands"], signed[u]["bands"], strict=True)]
    parts = {r["line"]: r["component"] for r in linededup.all_lines(df).join(linededup.alike_lines(df)[0], "node", "left").collect()}
    found = Counter(c for c in parts.values() if c is not None)
    want = [x for x in line_components(lines) if len(x) > 1]
    assert sorted(sorted(t for t in lines if parts[t] == c) for c in found) == want and len(want) >= 7


def test_bands_find_nearly_all_pairs_at_the_limit(spark):
    """Pairs of an exact similarity from 0.8 to 0.87, of prose, text without spaces, Chinese characters and changed starts: 0.9 of each kind share a band."""
    rng = np.random.RandomState(8)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.randint(2, 10)))
    kinds = {
        "prose": lambda: " ".join(word() for _ in range(rng.randint(8, 60))), "plain": lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), rng.randint(50, 300))),
        "chinese": lambda: "".join(chr(x) for x in rng.randint(0x4E00, 0x9000, rng.randint(50, 300))), "start": lambda: "https://www.example.org/" + "".join(word() for _ in range(12)),
    }
    gram = lambda t: {t[i : i + 5] for i in range(len(t) - 4)}
    pairs = []
    for kind, make in kinds.items():
        n = 0
        while n < 150:
            a = make()
            b = list(a)
            for at in [0] if kind == "start" else []:
                b[at] = "X"
            while True:
                x, y = gram(a), gram("".join(b))
                like = len(x & y) / len(x | y)
                if like < 0.87:
                    break
                b[rng.randint(len(b))] = "q"
            if like >= 0.8:
                pairs.append((kind, a, "".join(b)))
                n += 1
    lines = spark.createDataFrame([(t,) for _, a, b in pairs for t in (a, b)], "line string").distinct().withColumn("node", F.xxhash64("line"))
    bands = {r["line"]: r["bands"] for r in lines.join(linededup.signatures(lines), "node").collect()}
    found = Counter(kind for kind, a, b in pairs if any(x == y for x, y in zip(bands[a], bands[b], strict=True)))
    assert all(found[kind] >= 0.9 * 150 for kind in kinds), found


def test_topk_of_mixed_lengths_and_large_components(spark):
    rng = np.random.RandomState(3)
    rows = [(i, [float(x) for x in rng.randint(-9, 9, 3 if i % 5 == 0 else 4)]) for i in range(120)] + [(500, [2e7, 2e7, 2e7, 2e7]), (501, [float("inf")] * 4), (502, None), (None, [1.0])]
    got = topk.top_inner_products(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v").collect()
    v = {i: [math.floor(256 * x) for x in x] for i, x in rows if x is not None and i is not None and all(map(math.isfinite, x))}
    want = set()
    for q in v:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q)[:5]
            want |= {(q, n, c, -score) for n, (score, c) in enumerate(best, 1)}
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == want


def test_clashing_columns(spark):
    df = docs(spark, [(1, "x y", "a"), (2, "x y", "a")]).withColumns({c: F.lit(1) for c in ("node", "key", "line", "pos", "gone", "row", "n", "id", "component")})
    assert linededup.dedup_lines(df, "doc_id", "text").count() == 2
    assert ngram_join.keep_one_of_each(df).count() == 1
    assert secrets.find_secrets(df, "doc_id", "text").count() == 2
    assert mixing.mix_sources(df, "doc_id", "source", "text").count() == 2
    assert lm.score_texts(df, "doc_id", "text").count() == 2
    assert sharding.assign_shards(df, "doc_id", "text", [1.0]).count() == 2


def test_lm_matches_a_plain_version(spark):
    rows = [(i, " ".join(f"w{(i * j) % (5 + j % 11)}" for j in range(30)), "a") for i in range(60)] + ODD
    got = lm.score_texts(docs(spark, rows), "doc_id", "text", ranges=5, slice_bytes=900).collect()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    toks = [(i, WORD.findall(low(t))) for i, t, _ in rows]
    uni, bi = Counter(), Counter()
    for i, t in toks:
        if not out(i):
            uni.update([*t, "</s>"])
            bi.update(zip(["<s>", *t], [*t, "</s>"], strict=True))
    n, v = sum(uni.values()), len(uni)
    ones = [list(uni.values())[k] for k, w in enumerate(uni) if w != "</s>"]
    d1 = lm.discount(ones.count(1), ones.count(2))
    d2 = lm.discount(list(bi.values()).count(1), list(bi.values()).count(2))
    state, fan = Counter(), Counter()
    for (a, _), c in bi.items():
        state[a] += c
        fan[a] += 1
    root = lambda w: (uni[w] - d1) / n if w in uni else d1 * v / n
    p = lambda a, w: max(bi[(a, w)] - d2, 0) / state[a] + d2 * fan[a] / state[a] * root(w) if state[a] else root(w)
    want = []
    for i, t in toks:
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in [*t, "</s>"])
        score = sum(math.log10(p(a, w)) for a, w in zip(["<s>", *t], [*t, "</s>"], strict=True))
        want.append((i is None, i or 0, out(i), len(t) + 1, round(base, 6), round(score, 6)))
    assert sorted(want) == sorted((r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in got)
    assert {r["train_tokens"] for r in got} == {n}


def test_forward_backward_is_exact():
    """Chunked probabilities equal those by summing over all label sequences of a short text."""
    import itertools

    rng = np.random.RandomState(0)
    e, moves = rng.standard_normal((6, 3)), rng.standard_normal((3, 3))
    whole = {s: math.exp(sum(e[t, k] for t, k in enumerate(s)) + sum(moves[a, b] for a, b in zip(s, s[1:]))) for s in itertools.product(range(3), repeat=6)}
    z = sum(whole.values())
    want = np.array([[sum(w for s, w in whole.items() if s[t] == k) / z for k in range(3)] for t in range(6)])
    chunk, langid.CHUNK = langid.CHUNK, 2
    try:
        got, pair = langid.posteriors(e, np.array([0, 6]), moves)
    finally:
        langid.CHUNK = chunk
    assert np.allclose(got, want) and math.isclose(pair.sum(), 5)


def test_language_of_held_out_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = langid.identify_languages(df, "doc_id", "text", "lang", per_lang=20).join(df.select("doc_id", "lang"), "doc_id").where("held_out")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a"), F.count("*").alias("n")).first()
    assert right["n"] > 20 and right["a"] >= 0.95


def test_language_of_odd_rows(spark):
    df = docs(spark, [(i, "the cat and the dog", "a") for i in range(8)] + ODD)
    got = langid.identify_languages(df, "doc_id", "text", "lang").collect()
    assert len(got) == 8 + len(ODD)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} <= {"und", "en"}
    assert [r["score"] for r in got if r["lang_pred"] == "und"].count(0.0) == sum(r["lang_pred"] == "und" for r in got)
    none = langid.identify_languages(docs(spark, []), "doc_id", "text", "lang")
    assert none.count() == 0


def test_pipeline_stages_keep_columns_and_clean_documents(spark, sf_dir):
    import corpus_pipeline as cp

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cols = rows.columns
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, rows, sf_dir)
        assert out.columns == cols, name
        assert out.count() > 0
    kept = cp.language_id(spark, rows, sf_dir).count()
    assert kept >= 0.9 * rows.count()


def test_pipeline_samples_as_the_operator_does(spark):
    """Two different segmentations of each text, as the operator's own default gives them."""
    import corpus_pipeline as cp

    df = spark.createDataFrame([(1, "some words of prose", "en", "s", 19), (2, "other words, also prose", "en", "s", 23)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {(r["doc_id"], r["rank"]): r["ids"] for r in cp.sentencepiece(spark, df, "").collect()}
    assert sorted(got) == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert all(got[i, 1] != got[i, 2] for i in (1, 2))


def test_queries_are_registered_once():
    from stormline.llm.registry import QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("text", ["", "a", "aé日🙂" * 9])
def test_edited_text(spark, text):
    n = len(text)
    df = spark.createDataFrame([(2, text), (1, "0123456789" * 5)], "doc_id long, text string")
    r = fingerprint.with_next(df, "doc_id", "text", 1).where("id = 2").first()
    want = text[: n - n // 3] + r["next_text"][: n // 3]
    got = spark.createDataFrame([(text, r["next_text"])], "t string, x string").select(fingerprint.edited_text(F.col("t"), F.col("x")).alias("e")).first()["e"]
    assert got == want
    assert hashlib.sha256(got.encode()).hexdigest() == spark.createDataFrame([(got,)], "t string").select(F.sha2(F.col("t").cast("binary"), 256)).first()[0]
