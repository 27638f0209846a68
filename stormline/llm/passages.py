"""Operator 11: removal of repeated passages by a distributed merge sort that knows common prefixes.

A passage is a string of 50 bytes. Each is owned by an anchor inside it: the 26 bytes of least hash
among its 25 runs of 26 bytes, so equal passages have equal anchors at equal places. Anchors found in
one document alone own no repeated passage; a first exchange of their hashes sets them aside, and no
match is lost by it. The other anchors' suffixes (50 bytes, with the 24 before) are sorted within
packs of whole documents; the sorted runs travel front-coded: each string as the length that it shares
with the one before it, and the rest. Tasks that own a range of strings merge the runs with a loser
tree that keeps, for each run's head, the length it shares with the last winner, and compares only
what lies beyond. The shared lengths that come out bound the groups of equal passages; each group's
least document keeps the passage, and the packs hear which of their strings have an earlier owner.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormline.llm.store import Scratch
from stormline.llm.tokens import mix, utf8
from stormline.registry import table

LENGTH = 50  # bytes of a passage
GRAM = 26  # bytes of an anchor
BEFORE = LENGTH - GRAM  # most bytes of a passage before its anchor
PACK_BYTES = 4 << 20  # text of a pack; a longer document is one by itself
BUCKET_BYTES = 64 << 20  # text that one task of a join over packs holds
SLICE = 1 << 20  # passages looked at together
RANGE_BYTES = 8 << 20  # text whose anchors' hashes meet in one group
PART_STRINGS = 100_000  # strings that one merge takes
HOT_CONTEXTS = 50_000  # anchors with more different surroundings are split by passage
SEVERAL = 4  # surroundings of an anchor in one pack from which it is counted
LAST = 2**63 - 1  # stands for a null id: after all others
WINDOW_BIT = 1 << 31

_BYTE = np.random.RandomState(71).randint(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M = 0x9E3779B97F4A7C15


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_M, n, 2**64))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hashes of all runs of 26 bytes, from those of 2, 4, 8 and 16."""
    h = {1: _BYTE[raw]}
    for n in (1, 2, 4, 8):
        h[2 * n] = h[n][:-n] * _power(n) + h[n][n:]
    n = len(raw) - GRAM + 1
    return mix((h[16][:n] * _power(8) + h[8][16 : 16 + n]) * _power(2) + h[2][24 : 24 + n])


def anchors(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all passages of the texts raw[off[i]:off[i + 1]], and their hashes.

    All places of a passage that have its least hash count, so ties can't part equal passages.
    """
    width = LENGTH - GRAM + 1
    places, values = [], []
    for a in range(0, len(raw) - LENGTH + 1, SLICE):
        piece = raw[a : a + SLICE + LENGTH - 1]
        n = len(piece) - LENGTH + 1
        h = gram_hashes(piece)
        least, size = h, 1
        while size < width:
            step = min(size, width - size)
            least = np.minimum(least[:-step], least[step:])
            size += step
        valid = np.ones(n, bool)
        for i in range(int(np.searchsorted(off, a, "right")), int(np.searchsorted(off, a + n + LENGTH, "left")) + 1):
            if i < len(off):  # passages that begin in the last 49 bytes of a text would leave it
                valid[max(0, int(off[i]) - LENGTH + 1 - a) : max(0, int(off[i]) - a)] = False
        fresh = valid.copy()
        fresh[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
        first = np.flatnonzero(fresh)
        chosen = np.zeros(len(h), bool)
        entering = np.flatnonzero(valid & (h[width - 1 :] == least))
        chosen[entering + width - 1] = True
        around = first[:, None] + np.arange(width)
        chosen[around[h[around] == least[first][:, None]]] = True
        at = np.flatnonzero(chosen)
        places.append(at + a)
        values.append(h[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, value = np.concatenate(places), np.concatenate(values)
    at, once = np.unique(at, return_index=True)
    return at, mix(value[once] * np.uint64(0xD6E8FEB86659FD93))  # least hashes are small: spread them again


def _zip(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed blob."""
    head = b"".join(np.int64(x.nbytes).tobytes() for x in arrays)
    body = head + b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)
    return np.int64(len(body)).tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def _unzip(blob: bytes, *kinds: type) -> list[np.ndarray]:
    body = pa.decompress(blob[8:], decompressed_size=int(np.frombuffer(blob, np.int64, 1)[0]), codec="zstd", asbytes=True)
    at, out = 8 * len(kinds), []
    for size, kind in zip(np.frombuffer(body, np.int64, len(kinds)), kinds, strict=True):
        out.append(np.frombuffer(body, np.uint8, int(size), at).view(kind))
        at += int(size)
    return out


# -- packs ---------------------------------------------------------------------------------------------------------

PACK = "pack long, ids array<long>, sizes array<long>, data binary"


def _packed(batches: Iterator[pa.RecordBatch], pack_bytes: int) -> Iterator[pa.RecordBatch]:
    """Whole documents in packs of about `pack_bytes`."""
    base, number = TaskContext.get().partitionId() << 33, 0
    ids: list[int | None] = []
    texts: list[bytes] = []
    held = 0

    def pack() -> pa.RecordBatch:
        data = b"".join(texts)
        row = [[base + number], [list(ids)], [[len(t) for t in texts]], [_zip(np.frombuffer(data, np.uint8))]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()], strict=True)], names=["pack", "ids", "sizes", "data"])

    for batch in batches:
        raw, off = utf8(batch.column("text"))
        for i, doc in enumerate(batch.column("id").to_pylist()):
            ids.append(doc)
            texts.append(raw[off[i] : off[i + 1]].tobytes())
            held += len(texts[-1])
            if held >= pack_bytes:
                yield pack()
                ids, texts, held, number = [], [], 0, number + 1
    if ids:
        yield pack()


class Pack:
    """One pack in a task: bytes, where texts begin, each text's id as a number."""

    def __init__(self, ids: list, sizes: list, data: bytes) -> None:
        self.raw = _unzip(data, np.uint8)[0]
        self.off = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))]).astype(np.int64)
        self.ids = np.array([LAST if x is None else x for x in ids], np.int64)


def _column(batch: pa.RecordBatch, i: int, *names: str) -> list:
    return [batch.column(n)[i].as_py() for n in names]


def _spread(value: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes as (range, 32 bits within it), ascending."""
    value = np.unique(value)
    return ((value >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32), (value & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _hash_rows(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            pack, *rest = _column(batch, i, "pack", "ids", "sizes", "data")
            p = Pack(*rest)
            where, key = _spread(anchors(p.raw, p.off)[1], ranges)
            cut = np.searchsorted(where, np.arange(ranges + 1, dtype=np.uint64))
            has = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_arrays(
                [pa.array(has, pa.int32()), pa.array([pack] * len(has), pa.int64()), pa.array([key[cut[r] : cut[r + 1]].tobytes() for r in has], pa.binary())], names=["r", "pack", "keys"]
            )


def _shared_bits(group: pa.Table) -> pa.Table:
    """For each pack, which of its hashes in this range other packs have too; packs that share none are left out."""
    packs, r = group.column("pack").to_pylist(), group.column("r")[0].as_py()
    keys = [np.frombuffer(x, np.uint32) for x in group.column("keys").to_pylist()]
    every = np.sort(np.concatenate(keys))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    out = []
    for pack, own in zip(packs, keys, strict=True):
        at = np.searchsorted(twice, own)
        hit = at < len(twice)
        hit[hit] = twice[at[hit]] == own[hit]
        if hit.any():
            out.append((pack, r, np.packbits(hit).tobytes()))
    return pa.table({"pack": pa.array([x[0] for x in out], pa.int64()), "r": pa.array([x[1] for x in out], pa.int32()), "bits": pa.array([x[2] for x in out], pa.binary())})


# -- sorted runs ---------------------------------------------------------------------------------------------------


def _narrow(n: int) -> type:
    """The type that numbers n things."""
    return np.uint16 if n < 1 << 16 else np.uint32


class Run:
    """Sorted distinct strings `right` (padded with 0 to 50 columns) of `rlen` bytes, what stands before (`left`, last byte first), least id, number."""

    def __init__(self, right: np.ndarray, rlen: np.ndarray, left: np.ndarray, llen: np.ndarray, low: np.ndarray, number: np.ndarray) -> None:
        self.right, self.rlen, self.left, self.llen, self.low, self.number = right, rlen, left, llen, low, number

    def take(self, which: np.ndarray) -> Run:
        return Run(*(x[which] for x in (self.right, self.rlen, self.left, self.llen, self.low, self.number)))

    def coded(self) -> bytes:
        """Front-coded."""
        shared = np.zeros(len(self.rlen), np.uint8)
        if len(shared) > 1:
            shared[1:] = np.minimum(first_difference(self.right[1:], self.right[:-1]), np.minimum(self.rlen[1:], self.rlen[:-1]))
        at, before = np.arange(LENGTH), np.arange(BEFORE)
        tails = self.right[(at >= shared[:, None]) & (at < self.rlen[:, None])]
        ids, low = np.unique(self.low, return_inverse=True)
        steps = np.diff(self.number, prepend=np.uint32(0))
        return _zip(shared, self.rlen, self.llen, ids, low.astype(_narrow(len(ids))), steps, tails, self.left[before < self.llen[:, None]])

    @staticmethod
    def decoded(blob: bytes) -> tuple[Run, list[bytes], np.ndarray]:
        """The run, its strings as bytes, and the length each shares with the one before it."""
        shared, rlen, llen, ids, low, steps, tails, lefts = _unzip(blob, np.uint8, np.uint8, np.uint8, np.int64, np.uint8, np.uint32, np.uint8, np.uint8)
        low, number = ids[low.view(_narrow(len(ids)))], np.cumsum(steps, dtype=np.uint32)
        tails, at, last, strings = tails.tobytes(), 0, b"", []
        for s, n in zip(shared.tolist(), rlen.tolist(), strict=True):
            last = last[:s] + tails[at : at + n - s]
            at += n - s
            strings.append(last)
        right = np.frombuffer(b"".join(x.ljust(LENGTH, b"\0") for x in strings), np.uint8).reshape(-1, LENGTH)
        left = np.zeros((len(rlen), BEFORE), np.uint8)
        left[np.arange(BEFORE) < llen[:, None]] = lefts
        return Run(right, rlen, left, llen, low, number), strings, shared


def first_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row the first column that differs; the width where none does."""
    apart = a != b
    return np.where(apart.any(1), apart.argmax(1), a.shape[1]).astype(np.uint8)


def sorted_run(right: np.ndarray, rlen: np.ndarray, left: np.ndarray, llen: np.ndarray, ids: np.ndarray) -> tuple[Run, np.ndarray]:
    """Equal strings with equal surroundings become one entry with their least id; also each row's entry."""
    rows = np.concatenate([right, rlen[:, None], left, llen[:, None]], axis=1)
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel(), kind="stable")
    ordered = rows[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (ordered[1:] != ordered[:-1]).any(1)
    first = np.flatnonzero(fresh)
    entry = np.empty(len(rows), np.int64)
    entry[order] = np.cumsum(fresh) - 1
    low = np.minimum.reduceat(ids[order], first) if len(first) else ids[:0]
    pick = order[first]
    return Run(right[pick], rlen[pick], left[pick], llen[pick], low, np.arange(len(pick), dtype=np.uint32)), entry


def contexts(pack: Pack, at: np.ndarray) -> tuple[Run, np.ndarray]:
    """The sorted run of the suffixes at the anchors `at`, and each anchor's entry in it."""
    doc = np.searchsorted(pack.off, at, "right") - 1
    rlen = np.minimum(LENGTH, pack.off[doc + 1] - at).astype(np.uint8)
    llen = np.minimum(BEFORE, at - pack.off[doc]).astype(np.uint8)
    padded = np.concatenate([np.zeros(BEFORE, np.uint8), pack.raw, np.zeros(LENGTH, np.uint8)])
    right = np.lib.stride_tricks.sliding_window_view(padded, LENGTH)[at + BEFORE].copy()
    left = np.lib.stride_tricks.sliding_window_view(padded, BEFORE)[at][:, ::-1].copy()
    right[np.arange(LENGTH) >= rlen[:, None]] = 0
    left[np.arange(BEFORE) >= llen[:, None]] = 0
    return sorted_run(right, rlen, left, llen, pack.ids[doc])


def gram_ids(right: np.ndarray) -> np.ndarray:
    """A signed 64-bit hash of each string's first 26 bytes."""
    with np.errstate(over="ignore"):
        h = np.zeros(len(right), np.uint64)
        for j in range(GRAM):
            h = h * np.uint64(_M) + _BYTE[right[:, j]]
    return mix(h).view(np.int64) if len(h) else np.zeros(0, np.int64)


RUN = "pack long, n long, places binary, run binary, sample array<binary>, heavy array<struct<gram: bigint, n: bigint>>"


def _runs(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    """Each pack's sorted run of the suffixes at anchors that two documents or more have."""
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            number, ids, sizes, data, bits = _column(batch, i, "pack", "ids", "sizes", "data", "shared")
            pack = Pack(ids, sizes, data)
            at, value = anchors(pack.raw, pack.off)
            if not len(at):
                continue
            distinct, inverse = np.unique(value, return_inverse=True)
            where, _ = _spread(distinct, ranges)
            wanted = np.zeros(len(distinct), bool)
            for x in bits or ():
                a, b = np.searchsorted(where, [x["r"], x["r"] + 1])
                wanted[a:b] = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=int(b - a)).astype(bool)
            doc = pack.ids[np.searchsorted(pack.off, at, "right") - 1]  # several documents of this pack
            order = np.argsort(inverse, kind="stable")
            first = np.searchsorted(inverse[order], np.arange(len(distinct)))
            wanted |= np.minimum.reduceat(doc[order], first) < np.maximum.reduceat(doc[order], first)
            at = at[wanted[inverse]]
            if not len(at):
                continue
            run, entry = contexts(pack, at)
            gram, count = np.unique(gram_ids(run.right), return_counts=True)
            many = count >= SEVERAL
            step = run.right[number % 64 :: 64, :GRAM]
            out.append({
                "pack": number, "n": len(run.rlen), "places": _zip(at.astype(np.int64), entry.astype(np.uint32)), "run": run.coded(),
                "sample": [x.tobytes() for x in step], "heavy": [{"gram": int(g), "n": int(n)} for g, n in zip(gram[many], count[many], strict=True)],
            })
        if out:
            kinds = [("pack", pa.int64()), ("n", pa.int64()), ("places", pa.binary()), ("run", pa.binary()), ("sample", pa.list_(pa.binary())), ("heavy", pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())])))]
            yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))


def passages_of(run: Run, hot: np.ndarray) -> tuple[Run, np.ndarray, np.ndarray, np.ndarray]:
    """All passages owned by the `hot` entries, as a sorted run of their own; of each (entry, bytes before the anchor) its passage."""
    rows, entries, before, ids = [np.zeros((0, LENGTH), np.uint8)], [], [], []
    which = np.flatnonzero(hot)
    for n in range(BEFORE + 1):
        e = which[(run.llen[which] >= n) & (run.rlen[which] >= LENGTH - n)]
        rows.append(np.concatenate([run.left[e, :n][:, ::-1], run.right[e, : LENGTH - n]], axis=1))
        entries.append(e)
        before.append(np.full(len(e), n))
        ids.append(run.low[e])
    right, entries = np.concatenate(rows), np.concatenate(entries)
    full, none = np.full(len(right), LENGTH, np.uint8), np.zeros(len(right), np.uint8)
    own, at = sorted_run(right, full, np.zeros((len(right), BEFORE), np.uint8), none, np.concatenate(ids))
    own.number = own.number | np.uint32(WINDOW_BIT)
    return own, entries, np.concatenate(before), at


def _as_text(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def _pieces(batches: Iterator[pa.RecordBatch], cuts: list[bytes], hot: list[int], hot_cuts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Runs cut at the borders of the ranges; hot anchors' entries go as single passages to ranges of their own."""
    borders, hot_borders, hot_grams = np.array(cuts, f"S{GRAM}"), np.array(hot_cuts, f"S{LENGTH}"), np.array(hot, np.int64)
    for batch in batches:
        for i in range(batch.num_rows):
            pack, blob = _column(batch, i, "pack", "run")
            run, _, _ = Run.decoded(blob)
            parts, blobs = [], []
            is_hot = np.isin(gram_ids(run.right), hot_grams) if len(hot) else np.zeros(len(run.rlen), bool)
            some = [(run.take(~is_hot), borders, GRAM, 0)]
            if is_hot.any():
                some.append((passages_of(run, is_hot)[0], hot_borders, LENGTH, len(cuts) + 1))
            for own, limits, width, base in some:
                part = np.searchsorted(limits, _as_text(own.right[:, :width]), "right")
                for p in np.unique(part):
                    parts.append(base + int(p))
                    blobs.append(own.take(np.arange(*np.searchsorted(part, [p, p + 1]))).coded())
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([pack] * len(parts), pa.int64()), pa.array(blobs, pa.binary())], names=["part", "pack", "run"])


# -- the merge -----------------------------------------------------------------------------------------------------


def merged(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """Sorted order of several sorted runs (strings, length each shares with the one before it): runs' numbers, and the length each string shares with the one before it in the result.

    A loser tree; `known` is the length that a run's head shares with the last string that went out by
    its place in the tree. Of two heads the one that shares more is the smaller; only with equal
    lengths are strings compared, from that length on.
    """
    size = 1 << max(0, len(runs) - 1).bit_length()
    known = [0 if i < len(runs) and runs[i][0] else -1 for i in range(size)]
    head = [runs[i][0][0] if known[i] == 0 else b"" for i in range(size)]
    at, losers = [0] * size, [0] * size

    def beats(a: int, b: int) -> bool:
        """Whether the head of b goes before that of a; the loser learns what it shares with the winner."""
        n = known[a]
        if n != known[b]:
            return known[b] > n
        if n < 0:
            return False
        x, y = head[a], head[b]
        end = min(len(x), len(y))
        if x[n:end] == y[n:end]:
            n, later = end, len(y) < len(x)
        else:
            while x[n] == y[n]:
                n += 1
            later = y[n] < x[n]
        known[a if later else b] = n
        return later

    winners = list(range(size))
    while len(winners) > 1:
        level = len(winners) // 2
        above = []
        for i in range(level):
            a, b = winners[2 * i], winners[2 * i + 1]
            if beats(a, b):
                a, b = b, a
            above.append(a)
            losers[level + i] = b
        winners = above
    now, order, shared = winners[0], [], []
    while known[now] >= 0:
        order.append(now)
        shared.append(known[now])
        strings, lengths = runs[now]
        k = at[now] = at[now] + 1
        if k < len(strings):
            head[now], known[now] = strings[k], lengths[k]
        else:
            known[now] = -1
        node = (now + size) >> 1
        while node:
            other = losers[node]
            if beats(now, other):
                losers[node], now = now, other
            node >>= 1
    return order, shared


def earlier_owners(shared: np.ndarray, run: Run) -> np.ndarray:
    """For strings in merged order: bit n set if the passage with n bytes before the anchor is in a document of smaller id."""
    out = np.zeros(len(shared), np.uint32)
    group = np.cumsum(shared < GRAM)
    first = np.flatnonzero(np.diff(group, prepend=group[:1] - 1))
    of = group - group[0] if len(group) else group
    live = (np.minimum.reduceat(run.low, first) < np.maximum.reduceat(run.low, first))[of]
    which = np.flatnonzero(live)
    if not len(which):
        return out
    left, low, llen, rlen = run.left[which], run.low[which], run.llen[which], run.rlen[which]
    # what stands before, sorted once: with the shared lengths it tells equal last n bytes for every n
    order = np.argsort(_as_text(np.concatenate([left, llen[:, None]], axis=1)), kind="stable")
    sorted_left, sorted_len = left[order], llen[order]
    same = np.zeros(len(order), np.uint8)
    same[1:] = np.minimum(first_difference(sorted_left[1:], sorted_left[:-1]), np.minimum(sorted_len[1:], sorted_len[:-1]))
    mask = np.zeros(len(which), np.uint32)
    for n in range(BEFORE + 1):
        can = np.flatnonzero((llen >= n) & (rlen >= LENGTH - n))
        if len(can) < 2:
            continue
        before = np.empty(len(order), np.int64)
        before[order] = np.cumsum(same < n)
        # groups of strings that share 50 - n bytes; dropped strings only ever part groups of their own
        after = np.cumsum(shared < LENGTH - n)[which]
        key = (after * (len(order) + 1) + before)[can]
        o = np.argsort(key, kind="stable")
        k = key[o]
        begin = np.flatnonzero(np.diff(k, prepend=k[:1] - 1))
        least = np.repeat(np.minimum.reduceat(low[can][o], begin), np.diff(np.append(begin, len(k))))
        late = can[o[least < low[can][o]]]
        mask[late] |= np.uint32(1 << n)
    out[which] = mask
    return out


def _merged_part(group: pa.Table) -> pa.Table:
    """One range of strings: all packs' pieces merged, and told to each pack which of its strings have an earlier owner."""
    decoded = [Run.decoded(x) for x in group.column("run").to_pylist()]
    order, shared = merged([(strings, lengths.tolist()) for _, strings, lengths in decoded])
    source = np.array(order, np.int64)
    whole = Run(*(np.concatenate([getattr(r, f) for r, _, _ in decoded]) for f in ("right", "rlen", "left", "llen", "low", "number")))
    base = np.concatenate([[0], np.cumsum([len(s) for _, s, _ in decoded])])
    by_source = np.argsort(source, kind="stable")  # each run's strings keep their order
    place = np.empty(len(source), np.int64)
    place[by_source] = np.arange(len(source))
    mask = earlier_owners(np.array(shared, np.int64), whole.take(place))
    back = np.zeros(len(source), np.uint32)
    back[place] = mask
    out = []
    for i, pack in enumerate(group.column("pack").to_pylist()):
        own = back[base[i] : base[i + 1]]
        hit = np.flatnonzero(own)
        if len(hit):
            out.append((pack, _zip(whole.number[base[i] : base[i + 1]][hit], own[hit])))
    return pa.table({"pack": pa.array([x[0] for x in out], pa.int64()), "told": pa.array([x[1] for x in out], pa.binary())})


# -- what goes -----------------------------------------------------------------------------------------------------


def _removed(pack: Pack, places: bytes | None, run: bytes | None, told: list[bytes], hot: np.ndarray) -> np.ndarray:
    """For each byte of the pack, whether a repeated passage covers it."""
    change = np.zeros(len(pack.raw) + 1, np.int64)
    if places is None:
        return change[1:] > 0
    at, entry = _unzip(places, np.int64, np.uint32)
    doc = np.searchsorted(pack.off, at, "right") - 1
    owner = pack.ids[doc]
    n = int(entry.max()) + 1
    low = np.full(n, LAST, np.int64)
    np.minimum.at(low, entry, owner)
    mask, own = np.zeros(n, np.uint32), None
    if len(hot):
        r = Run.decoded(run)[0]
        is_hot = np.isin(gram_ids(r.right), hot)
        if is_hot.any():
            own = passages_of(r, is_hot)
            single = np.zeros(len(own[0].rlen), bool)
    for blob in told:
        number, bits = _unzip(blob, np.uint32, np.uint32)
        of_passage = number >= WINDOW_BIT
        mask[number[~of_passage]] |= bits[~of_passage]
        if own is not None:
            single[number[of_passage] - np.uint32(WINDOW_BIT)] = True
    if own is not None:
        passages, e, before, which = own
        late = single[which] | (passages.low[which] < low[e])
        np.bitwise_or.at(mask, e[late], (np.uint32(1) << before[late].astype(np.uint32)))
    # an entry's first document hears from other packs; its later documents repeat that one
    begin, end = pack.off[doc], pack.off[doc + 1]
    bits, repeated = mask[entry], owner > low[entry]
    for b in range(BEFORE + 1):
        fits = (at - b >= begin) & (at - b + LENGTH <= end)
        start = at[fits & (repeated | (bits >> np.uint32(b) & np.uint32(1) == 1))] - b
        np.add.at(change, start, 1)
        np.add.at(change, start + LENGTH, -1)
    return np.cumsum(change)[:-1] > 0


def _results(batches: Iterator[pa.RecordBatch], hot: list[int], texts: bool) -> Iterator[pa.RecordBatch]:
    grams = np.array(hot, np.int64)
    kinds = [("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    kinds += [("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))] if texts else []
    for batch in batches:
        for i in range(batch.num_rows):
            ids, sizes, data, places, run, told = _column(batch, i, "ids", "sizes", "data", "places", "run", "told")
            pack = Pack(ids, sizes, data)
            gone = _removed(pack, places, run, told or [], grams)
            out = []
            for k, doc in enumerate(ids):
                a, b = pack.off[k], pack.off[k + 1]
                raw, off = pack.raw[a:b], gone[a:b]
                edge = np.diff(off.astype(np.int8), prepend=0, append=0)
                start = np.flatnonzero(edge == 1)
                kept = (raw[~off] if len(start) else raw).tobytes()
                row = {"id": doc, "n_bytes": int(b - a), "n_removed": int(b - a) - len(kept), "n_spans": len(start), "kept_sha256": hashlib.sha256(kept).hexdigest()}
                if texts:
                    row |= {"kept": kept, "spans": [{"start": int(x), "end": int(y)} for x, y in zip(start, np.flatnonzero(edge == -1), strict=True)]}
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))


def bucketed(df: DataFrame, scratch: Scratch, column: str, buckets: int) -> DataFrame:
    """`df` stored in buckets of `column` in the shared folder, so that joins on it don't move these rows again."""
    spark, name = df.sparkSession, f"packs_{uuid.uuid4().hex}"
    df.write.format("parquet").option("compression", "uncompressed").option("path", f"{scratch.base}-{name}").bucketBy(buckets, column).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the catalog's entry only: the files stay


def _cuts(strings: list[bytes], parts: int) -> list[bytes]:
    """At most parts - 1 different borders, evenly spread over the strings."""
    ordered = sorted(strings)
    return sorted({ordered[len(ordered) * k // parts] for k in range(1, parts)}) if ordered else []


def dedup_passages(
    docs: DataFrame, id_col: str, text_col: str, texts: bool = False, pack_bytes: int = PACK_BYTES, part_strings: int = PART_STRINGS, hot_contexts: int = HOT_CONTEXTS
) -> DataFrame:
    """Removes every byte that a 50-byte string covers which also starts in a document with a smaller id.

    One row a row of `docs`: id, n_bytes, n_removed, n_spans (maximal runs removed), kept_sha256; with `texts` also
    `kept` (binary, as a cut may fall inside a character) and `spans` of bytes. Ids are integers; a null id comes after
    all others; rows of one id never remove from each other. Null and short texts keep all they have. Other columns
    aren't read; no rows give no rows. A text is one task's work, whatever its length: some 80 bytes of memory a byte
    of it beyond a slice's. Strings are compared as bytes; hashes only rule strings out.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET_BYTES))
    packs = bucketed(chosen.mapInArrow(lambda it: _packed(it, pack_bytes), PACK), scratch, "pack", buckets)
    ranges = max(1, math.ceil(total / RANGE_BYTES))
    hashes = packs.select("pack", "ids", "sizes", "data").mapInArrow(lambda it: _hash_rows(it, ranges), "r int, pack long, keys binary")
    shared = hashes.groupBy("r").applyInArrow(_shared_bits, "pack long, r int, bits binary")
    bits = shared.groupBy(F.col("pack").alias("_pack")).agg(F.collect_list(F.struct("r", "bits")).alias("shared"))
    runs = scratch.put(packs.join(bits, F.col("pack") == F.col("_pack"), "left").drop("_pack").mapInArrow(lambda it: _runs(it, ranges), RUN), "runs")
    strings = runs.agg(F.sum("n")).first()[0] or 0
    parts = max(1, math.ceil(strings / part_strings))
    # borders and hot anchors are as many as merges, so the driver holds a bounded number for each task
    sample = runs.select(F.explode("sample").alias("s")).where(F.rand(11) < min(1.0, 64 * 64 * parts / max(strings, 1)))
    cuts = _cuts([bytes(r["s"]) for r in sample.collect()], parts)
    heavy = runs.select(F.explode("heavy").alias("h")).groupBy("h.gram").agg(F.sum("h.n").alias("n")).where(F.col("n") > hot_contexts).collect()
    hot, hot_cuts = [r["gram"] for r in heavy], []
    if hot:
        hot_parts = math.ceil(sum(r["n"] for r in heavy) * (BEFORE + 1) / part_strings)
        some = runs.select("run").mapInArrow(lambda it: _hot_sample(it, hot), "s binary")
        hot_cuts = _cuts([bytes(r["s"]) for r in some.where(F.rand(12) < min(1.0, 64 * 64 / part_strings)).collect()], hot_parts)
    pieces = runs.select("pack", "run").mapInArrow(lambda it: _pieces(it, cuts, hot, hot_cuts), "part int, pack long, run binary")
    told = pieces.groupBy("part").applyInArrow(_merged_part, "pack long, told binary")
    heard = told.groupBy(F.col("pack").alias("_told")).agg(F.collect_list("told").alias("told"))
    found = runs.select(F.col("pack").alias("_run"), "places", *(["run"] if hot else [F.lit(None).cast("binary").alias("run")]))
    whole = packs.join(found, F.col("pack") == F.col("_run"), "left").join(heard, F.col("pack") == F.col("_told"), "left")
    more = ", kept binary, spans array<struct<start: bigint, end: bigint>>" if texts else ""
    columns = whole.select("ids", "sizes", "data", "places", "run", "told")
    return columns.mapInArrow(lambda it: _results(it, hot, texts), f"id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string{more}")


def _hot_sample(batches: Iterator[pa.RecordBatch], hot: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            run = Run.decoded(batch.column("run")[i].as_py())[0]
            is_hot = np.isin(gram_ids(run.right), np.array(hot, np.int64))
            if is_hot.any():
                rows = passages_of(run, is_hot)[0].right[::64]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in rows], pa.binary())], names=["s"])


def op11_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_passages(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")
