"""LM scoring by a weighted backoff automaton.

States are words (and the start of a text), arcs the bigrams seen in training, each with its
smoothed probability; a failure arc leads from a state to the root with the weight that
absolute discounting leaves, and the root holds the unigrams. Texts are scored a slice at a
time: a slice asks for the counts of just the states and arcs it meets. Requests and replies
are packed arrays by (slice, range of state hashes); each range counts its states and arcs over
all slices. So the model is never in one place, and a frequent bigram is one entry a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormline.llm.store import stored
from stormline.llm.tokens import slices, words

SLICE_BYTES = 8 << 20
START, END = np.uint64(1), np.uint64(2)  # hashes that stand for the start and the end of a text
U = np.uint64


def unpack(b: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(b, kind)


def tokenized(batches: Iterator[pa.RecordBatch], ranges: int, slice_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices: `own` rows with the texts' tokens as places in the slice's sorted hashes, `ask` rows by range of hashes."""

    def made(rows: list[pa.RecordBatch]) -> Iterator[dict]:
        parts = [(words(r.column("text")), r) for r in rows]
        train = np.concatenate([np.asarray(r.column("train")) for _, r in parts]).astype(bool)
        count = np.concatenate([np.diff(w.first) for w, _ in parts])
        first = np.concatenate([[0], np.cumsum(count + 2)])
        # start, words, end of each text in turn
        hashes = np.empty(first[-1], U)
        hashes[first[:-1]], hashes[first[1:] - 1] = START, END
        inner = np.ones(len(hashes), bool)
        inner[first[:-1]] = inner[first[1:] - 1] = False
        hashes[inner] = np.concatenate([w.hash for w, _ in parts])
        types, place = np.unique(hashes, return_inverse=True)
        name = rows[0].column("row")[0].as_py()
        yield {"slice": name, "range": -1, "docs": pa.concat_arrays([r.column("id") for r in rows]), "ids": b"", "count": count.astype(np.int32).tobytes(), "train": train.tobytes(), "tokens": narrow(place)}
        entry, at = arcs(place, first)
        seen = np.bincount(at, np.repeat(train, count + 1), minlength=len(entry)).astype(np.int64)
        a, b = types[entry >> 32], types[entry & 0xFFFFFFFF]
        span = ((a >> U(32)) * U(ranges) >> U(32)).astype(np.int64)
        cut = np.searchsorted(span, np.arange(ranges + 1))
        for i in range(ranges):
            lo, hi = cut[i], cut[i + 1]
            if hi > lo:
                states, runs = np.unique(a[lo:hi], return_counts=True)
                # 48 bits of the second word are enough beside the whole first one.
                yield {"slice": name, "range": i, "docs": None, "ids": states.tobytes(), "count": packed(runs), "train": packed(seen[lo:hi]), "tokens": (b[lo:hi] >> U(16) & U(0xFFFFFFFF)).astype(np.uint32).tobytes() + (b[lo:hi] >> U(48)).astype(np.uint16).tobytes()}

    def flushed(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = rows[0].schema.field("id").type
        for d in made(rows):
            docs = d.pop("docs")
            listed = pa.array([None], pa.list_(kind)) if docs is None else pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)
            types = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            arrays = [pa.array([v], t) for v, t in zip(d.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays([listed, *arrays], ["docs", *d])

    held, size = [], 0
    for piece in (p for whole in batches for p in slices(whole)):
        held.append(piece)
        size += pc.sum(pc.binary_length(piece.column("text").cast(pa.large_string()).fill_null(""))).as_py() or 0
        if size >= slice_bytes:
            yield from flushed(held)
            held, size = [], 0
    if held:
        yield from flushed(held)


def arcs(place: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (previous, next) pairs of the texts as one number each, and the pair of each token after a start."""
    prev, nxt = np.delete(place, first[1:] - 1), np.delete(place, first[:-1])
    return np.unique(prev.astype(np.int64) << 32 | nxt, return_inverse=True)


def packed(counts: np.ndarray) -> bytes:
    """Small counts in one byte, the others behind: bytes with 255 for those."""
    big = counts[counts >= 255].astype(np.int64)
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + big.tobytes()


def narrow(places: np.ndarray) -> bytes:
    """Places in three bytes each, if they fit."""
    wide = places.astype("<i4")
    return wide.tobytes() if len(wide) and wide.max() >= 1 << 24 else wide.view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def widened(b: bytes, n: int) -> np.ndarray:
    if len(b) == 4 * n:
        return np.frombuffer(b, "<i4")
    out = np.zeros((n, 4), np.uint8)
    out[:, :3] = np.frombuffer(b, np.uint8).reshape(n, 3)
    return out.view("<i4").ravel()


def unpacked(b: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(b, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(b, np.int64, offset=n)
    return out


def counted(key: tuple, asks: pd.DataFrame) -> pd.DataFrame:
    """All requests of one range: the training counts of its states and arcs, told to each slice.

    The row of slice -1 holds sums for the whole range: states, those seen once and twice,
    tokens, and arcs seen once and twice.
    """
    states = [unpack(x, U) for x in asks["ids"]]
    runs = [unpacked(x, len(s)) for x, s in zip(asks["count"], states, strict=True)]
    sizes = [int(r.sum()) for r in runs]
    seen = np.concatenate([unpacked(x, n) for x, n in zip(asks["train"], sizes, strict=True)])
    nxt = np.concatenate([unpack(x[: 4 * n], np.uint32).astype(np.int64) | unpack(x[4 * n :], np.uint16).astype(np.int64) << 32 for x, n in zip(asks["tokens"], sizes, strict=True)])
    types, at = np.unique(np.concatenate(states), return_inverse=True)
    state = np.repeat(at, np.concatenate(runs))
    order = np.lexsort((nxt, state))
    new = np.ones(len(order), bool)
    new[1:] = (state[order][1:] != state[order][:-1]) | (nxt[order][1:] != nxt[order][:-1])
    arc = np.empty(len(order), np.int64)
    arc[order] = np.cumsum(new) - 1
    total = np.bincount(arc, seen, minlength=int(new.sum())).astype(np.int64)
    owner = state[order][new]
    visits = np.bincount(owner, total, minlength=len(types)).astype(np.int64)
    fan = np.bincount(owner, total > 0, minlength=len(types)).astype(np.int64)
    real = types != START
    sums = np.array([(real & (visits > 0)).sum(), (real & (visits == 1)).sum(), (real & (visits == 2)).sum(), visits.sum(), (total == 1).sum(), (total == 2).sum(), visits[~real].sum()])
    out = [{"slice": -1, "range": key[0], "states": 0, "visits": sums.astype(np.int64).tobytes(), "fan": b"", "arcs": b""}]
    lo_s = lo_a = 0
    for name, s, n in zip(asks["slice"], states, sizes, strict=True):
        mine = at[lo_s : lo_s + len(s)]
        out.append({"slice": name, "range": key[0], "states": len(s), "visits": packed(visits[mine]), "fan": packed(fan[mine]), "arcs": packed(total[arc[lo_a : lo_a + n]])})
        lo_s, lo_a = lo_s + len(s), lo_a + n
    return pd.DataFrame(out)


def discount(once: int, twice: int) -> float:
    return min(0.95, once / (once + 2 * twice)) if once else 0.5


def traverse(own: pd.Series, told: pd.DataFrame, stats: dict) -> pd.DataFrame:
    """Scores of a slice's texts: every token takes its arc from the state before, or the failure arc and the root."""
    count = unpack(own["count"], np.int32).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(count + 2)])
    place = widened(own["tokens"], int(first[-1]))
    entry, at = arcs(place, first)
    told = told.sort_values("range")
    visits = np.concatenate([unpacked(x, k) for x, k in zip(told["visits"], told["states"], strict=True)])
    fan = np.concatenate([unpacked(x, k) for x, k in zip(told["fan"], told["states"], strict=True)])
    prev, nxt = entry >> 32, entry & 0xFFFFFFFF
    # Every type but the end is a state of the slice; START sorts first and END next.
    known = np.insert(visits, 1, stats["texts"])
    fans = np.insert(fan, 1, 0)
    states = np.delete(np.bincount(prev, minlength=len(known)), 1)
    at_state, hits = 0, []
    for x, k in zip(told["arcs"], told["states"], strict=True):
        n = int(states[at_state : at_state + k].sum())
        hits.append(unpacked(x, n))
        at_state += k
    seen = np.concatenate(hits)
    n, v, d1, d2 = stats["tokens"], stats["types"], stats["d1"], stats["d2"]
    root = np.where(known > 0, (known - d1) / max(n, 1), d1 * v / max(n, 1) if n else 1.0)
    from_state = known[prev]
    fail = np.where(from_state > 0, d2 * fans[prev] / np.maximum(from_state, 1), 1.0)
    p = np.where(from_state > 0, np.maximum(seen - d2, 0) / np.maximum(from_state, 1), 0.0) + fail * root[nxt]
    base = np.log10((known + 1) / (n + 1 * (v + 1)))
    begin = np.cumsum(count + 1) - (count + 1)
    follow = nxt[at]
    return pd.DataFrame({
        "id": pd.Series(list(own["docs"]), dtype=object), "n_tokens": count + 1, "n_known": np.add.reduceat((known[follow] > 0).astype(np.int64), begin),
        "train_tokens": n, "base_score": np.add.reduceat(base[follow], begin), "score": np.add.reduceat(np.log10(p)[at], begin),
    })


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2


def score_texts(df: DataFrame, doc_id: str, text: str, ranges: int | None = None, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Counts come from all rows that aren't held out. With c, N and V for the training tokens,
    the root gives a known word (c - D1) / N and all unknown words together D1 V / N; a state
    gives max(c(ab) - D2, 0) / c(a) + D2 fan(a) / c(a) * root(b), its failure arc being the second
    factor; D = n1 / (n1 + 2 n2), 0.95 at most, by the counts of counts. A null text is empty: its end is its only
    token. A null doc_id is not held out. Repeated rows count each time. Without any training
    text N is 0, words are all unknown and the root gives probability 1.
    """
    spark = df.sparkSession
    ranges = ranges or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    out = F.coalesce(held_out(F.col(doc_id)), F.lit(False))
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), (~out).alias("train"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    packed_rows = f"docs array<{kind}>, slice long, range int, ids binary, count binary, train binary, tokens binary"
    made = rows.mapInArrow(lambda it: tokenized(it, ranges, slice_bytes), packed_rows)
    made = stored(made, "slices")
    reply = "slice long, range int, states int, visits binary, fan binary, arcs binary"
    told = stored(made.where("range >= 0").groupBy("range").applyInPandas(counted, reply), "counts")
    sums = np.zeros(7, np.int64)
    for r in told.where("slice = -1").select("visits").toLocalIterator():  # seven numbers a range
        sums += unpack(bytes(r["visits"]), np.int64)
    words_seen, once, twice, follows, arcs_once, arcs_twice, texts = (int(x) for x in sums)
    stats = {
        "types": words_seen + (texts > 0), "tokens": follows, "texts": texts,
        "d1": discount(once, twice), "d2": discount(arcs_once, arcs_twice),
    }

    def score(key: tuple, own: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        return traverse(own.iloc[0], replies, stats)

    result = f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = made.where("range < 0").groupBy("slice").cogroup(told.where("slice >= 0").groupBy("slice")).applyInPandas(score, result)
    return scored.select(F.col("id").alias(doc_id), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_texts(docs, "doc_id", "text")
