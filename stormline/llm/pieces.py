"""SentencePiece encoding by sampling without replacement, and decoding.

A text's lattice has an edge for every vocabulary piece that fits and, for a character outside the
vocabulary, one of its UTF-8 bytes. With the sums of all completions known for each place,
an A* search over prefixes perturbed by Gumbel noise is exact: the best child of a prefix has
the prefix's own value, and the other children together a Gumbel value cut off there. So the
first sample is one walk, and each next one leaves an earlier walk where the best value waits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormline.llm.tokens import mix, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
BASE = np.uint64(0x9E3779B97F4A7C15)
OCCUR_BITS = 20
SLICE_BYTES = 1 << 20
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
U = np.uint64


class Vocab(NamedTuple):
    """Hashes of the pieces in order, with their ids and log weights; the first piece whose hash begins
    with some bits, or -1; how many pieces share those bits at most; ids of the bytes; the bytes of each id."""

    hashes: np.ndarray
    begins: np.ndarray
    crowd: int
    ids: np.ndarray
    weights: np.ndarray
    longest: int
    bytes: np.ndarray
    byte_weight: float
    spelled: list[bytes]


def _sums(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums for hashes of runs of code points: run [i, j) is (S[j] - S[i]) * inverse power i."""
    power = np.full(len(codes) + 1, BASE, U)
    power[0] = 1
    power = np.cumprod(power, dtype=U)
    sums = np.zeros(len(codes) + 1, U)
    np.cumsum(mix(codes.astype(U) + U(1)) * power[:-1], dtype=U, out=sums[1:])
    inverse = np.full(len(codes) + 1, INVERSE, U)
    inverse[0] = 1
    return sums, np.cumprod(inverse, dtype=U)


def load_vocab(path: str = MODEL, alpha: float = 0.5) -> Vocab:
    """The pieces of a SentencePiece model; a piece of merge rank r weighs -alpha log(r + 2)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    spelled = [p.replace(MARK, " ").encode() for p in pieces]
    byte_ids = np.zeros(256, np.int32)
    for i in range(n):
        if model.is_byte(i):
            byte_ids[int(pieces[i][3:5], 16)] = i
            spelled[i] = bytes([int(pieces[i][3:5], 16)])
        elif model.is_control(i) or model.is_unknown(i):
            spelled[i] = b""
    size = np.array([len(pieces[i]) for i in plain])
    first = np.concatenate([[0], np.cumsum(size)])
    sums, inverse = _sums(np.frombuffer("".join(pieces[i] for i in plain).encode("utf-32-le"), np.uint32))
    hashes = (sums[first[1:]] - sums[first[:-1]]) * inverse[first[:-1]] + size.astype(U)
    order = np.argsort(hashes)
    lead, first_of, crowd = np.unique(hashes[order] >> U(64 - OCCUR_BITS), return_index=True, return_counts=True)
    begins = np.full(1 << OCCUR_BITS, -1, np.int32)
    begins[lead] = first_of
    ids = np.array(plain, np.int32)[order]
    rank = np.array([-model.get_score(int(i)) for i in ids])
    return Vocab(hashes[order], begins, int(crowd.max()), ids, -alpha * np.log(rank + 2), int(size.max()), byte_ids, -alpha * float(np.log(4 * n)), spelled)


class Lattice(NamedTuple):
    """Places are characters of the joined units; edges are ordered by place and length.

    begin: first edge by place. Of an edge: place, length, piece id (-2: the character's bytes),
    probability among those of its place, and place plus cumulative probability.
    """

    codes: np.ndarray
    begin: np.ndarray
    place: np.ndarray
    length: np.ndarray
    piece: np.ndarray
    chance: np.ndarray
    upto: np.ndarray
    first: np.ndarray


def utf8_width(codes: np.ndarray) -> np.ndarray:
    return 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)


def lattice(units: list[str], v: Vocab) -> Lattice:
    codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, units), np.int64, len(units))
    first = np.concatenate([[0], np.cumsum(size)])
    left = np.repeat(first[1:], size) - np.arange(len(codes))
    sums, inverse = _sums(codes)
    places, lengths, pieces, weights = [], [], [], []
    at = np.arange(len(codes))
    for n in range(1, min(v.longest, int(size.max(initial=1))) + 1):
        at = at[left[at] >= n]
        h = (sums[at + n] - sums[at]) * inverse[at] + U(n)
        spot = v.begins[h >> U(64 - OCCUR_BITS)]
        may = np.flatnonzero(spot >= 0)
        on, h, spot = at[may], h[may], spot[may]
        for _ in range(v.crowd - 1):
            spot += (v.hashes[spot] != h) & (spot < len(v.hashes) - 1)
        hit = v.hashes[spot] == h
        on, spot = on[hit], spot[hit]
        if n == 1:
            bare = np.ones(len(codes), bool)
            bare[on] = False
            bare = np.flatnonzero(bare)
            places, lengths = [bare], [np.ones(len(bare), np.int64)]
            pieces, weights = [np.full(len(bare), -2, np.int32)], [v.byte_weight * utf8_width(codes[bare])]
        places.append(on)
        lengths.append(np.full(len(on), n))
        pieces.append(v.ids[spot])
        weights.append(v.weights[spot])
    place, length, piece, weight = map(np.concatenate, (places, lengths, pieces, weights))
    order = np.argsort(place, kind="stable")
    place, length, piece, weight = place[order], length[order], piece[order], weight[order]
    # Sums of all completions, from the units' ends backward: edges by how far from the end they start.
    rest, chance = np.zeros(len(codes) + 1), np.empty(len(place))
    away = left[place]
    away = away.astype(np.uint16) if len(codes) < 1 << 16 or away.max(initial=0) < 1 << 16 else away  # two bytes sort fast
    order = np.argsort(away, kind="stable")
    cut = np.searchsorted(away[order], np.arange(1, int(away.max(initial=0)) + 2))
    for r in range(1, len(cut)):
        e = order[cut[r - 1] : cut[r]]
        if not len(e):
            continue
        mine, step = place[e], length[e]
        # The place after an edge to the unit's end is the end itself, whose sum is 0.
        w = weight[e] + np.where(step == r, 0.0, rest[mine + step])
        head = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        count = np.diff(np.append(head, len(e)))
        top = np.maximum.reduceat(w, head)
        x = np.exp(w - np.repeat(top, count))
        total = np.add.reduceat(x, head)
        rest[mine[head]] = top + np.log(total)
        chance[e] = x / np.repeat(total, count)
    begin = np.searchsorted(place, np.arange(len(codes) + 1))
    run = np.cumsum(chance)
    upto = place + run - np.repeat(np.concatenate([[0.0], run])[begin[:-1]], np.diff(begin))
    upto[begin[1:] - 1] = place[begin[1:] - 1] + 1
    return Lattice(codes, begin, place, length, piece, chance, upto, first)


def uniform(key: np.ndarray, *salt: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) by hashed keys."""
    h = key
    for s in salt:
        h = mix(h ^ mix(np.asarray(s).astype(U) + U(0x632BE59BD9B4E019)))
    return ((h >> U(11)).astype(float) + 0.5) / 2.0**53


class Walk(NamedTuple):
    """One sample for each of the texts `docs`: the units and edges of all its steps, in order."""

    docs: np.ndarray
    first: np.ndarray
    unit: np.ndarray
    edge: np.ndarray
    barred: np.ndarray
    value: np.ndarray
    waits: np.ndarray
    log_prob: np.ndarray


def open_edges(lat: Lattice, place: int, barred: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a place that aren't shut (a bit for each length), with their probabilities."""
    e = np.arange(lat.begin[place], lat.begin[place + 1])
    e = e[(barred >> (lat.length[e] - 1)) & 1 == 0]
    return e, lat.chance[e]


def descend(lat: Lattice, kinds: np.ndarray, unit: np.ndarray, place: np.ndarray, barred: np.ndarray, key: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Steps (unit, edge) from the given places to the ends of their units; `barred` lengths are shut at the first."""
    units, edges = [], []
    starts, ends = lat.first[:-1][kinds], lat.first[1:][kinds]
    fresh = True
    while len(unit):
        u = uniform(key[unit], salt, place - starts[unit])
        aim, edge = place + u, lat.begin[place]
        late = np.flatnonzero(lat.upto[edge] < aim)
        while len(late):
            edge[late] += 1
            late = late[lat.upto[edge[late]] < aim[late]]
        if fresh:
            for i in np.flatnonzero(barred):
                e, p = open_edges(lat, place[i], barred[i])
                edge[i] = e[min(np.searchsorted(np.cumsum(p), u[i] * p.sum()), len(e) - 1)]
        fresh = False
        units.append(unit)
        edges.append(edge)
        place = place + lat.length[edge]
        on = place < ends[unit]
        unit, place = unit[on], place[on]
    if not units:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A unit's steps come in the order of the rounds.
    unit, edge = np.concatenate(units), np.concatenate(edges)
    order = np.argsort(unit, kind="stable")
    return unit[order], edge[order]


def gumbel_below(mu: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values at location mu that are no more than `top`."""
    with np.errstate(all="ignore"):
        out = mu - np.log(np.exp(np.minimum(mu - top, 700)) - np.log(u))
    return np.where(np.isfinite(mu), np.minimum(out, top), -np.inf)


def walk_values(lat: Lattice, kinds: np.ndarray, docs, first, unit, edge, barred, value, own: np.ndarray, key: np.ndarray, salt: int) -> Walk:
    """Adds what waits at each step: the value of the children not taken, for steps that this walk owns."""
    p, place = lat.chance[edge], lat.place[edge]
    logp = np.log(p)
    total = np.concatenate([[0.0], np.cumsum(logp)])
    text = np.repeat(np.arange(len(docs)), np.diff(first))
    before = total[:-1] - total[first[:-1]][text]
    shut = barred | np.int64(1) << (lat.length[edge] - 1)
    left = 1 - p
    for i in np.flatnonzero(barred):
        left[i] = open_edges(lat, place[i], shut[i])[1].sum()
    with np.errstate(divide="ignore"):
        mu = np.where(own & (left > 1e-15), before + np.log(np.maximum(left, 1e-300)), -np.inf)
    waits = gumbel_below(mu, value[text], uniform(key[unit], salt + 1000, place - lat.first[:-1][kinds[unit]]))
    return Walk(docs, first, unit, edge, shut, value, waits, total[first[1:]] - total[first[:-1]])


def sample_texts(texts: list[str], seeds: np.ndarray, v: Vocab, k: int) -> Iterator[tuple[int, np.ndarray, list, np.ndarray, np.ndarray, np.ndarray]]:
    """(rank, texts, token ids, log probability, perturbed value, inclusion probability) of up to k distinct segmentations each."""
    found, count = [], []
    for t in texts:
        units = UNIT.findall(MARK + t.replace(" ", MARK)) if t else []
        count.append(len(units))
        found += units
    coded = pa.array(found, pa.large_string()).dictionary_encode()
    kinds_of, kinds = coded.dictionary.to_pylist(), np.asarray(coded.indices).astype(np.int64)
    del found, coded
    count = np.array(count, np.int64)
    unit_first = np.concatenate([[0], np.cumsum(count)])
    if not len(kinds):
        yield 1, np.arange(len(texts)), [np.zeros(0, np.int32)] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts))
        return
    lat = lattice(kinds_of, v)
    # A unit's seed: its text's, and its own place in the text.
    inside = np.arange(len(kinds)) - np.repeat(unit_first[:-1], count)
    key = mix(np.repeat(seeds, count) ^ mix(inside.astype(U)))
    docs = np.arange(len(texts))
    zero = np.zeros(len(kinds), np.int64)
    unit, edge = descend(lat, kinds, np.arange(len(kinds)), lat.first[kinds], zero, key, 0)
    owner = np.repeat(docs, count)
    first = np.searchsorted(owner[unit], np.arange(len(docs) + 1))
    root = -np.log(-np.log(uniform(seeds, 7)))
    walks = [walk_values(lat, kinds, docs, first, unit, edge, np.zeros(len(unit), np.int64), root, np.ones(len(unit), bool), key, 0)]
    for rank in range(1, k):
        best, whose, where = np.full(len(docs), -np.inf), np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
        for j, w in enumerate(walks):
            full = np.flatnonzero(np.diff(w.first) > 0)
            if not len(full):
                continue
            top = np.maximum.reduceat(w.waits, w.first[:-1][full])
            text = np.repeat(np.arange(len(w.docs)), np.diff(w.first))
            hit = np.flatnonzero(w.waits == top[np.searchsorted(full, text)])
            spot = np.zeros(len(w.docs), np.int64)
            spot[text[hit][::-1]] = hit[::-1]
            better = top > best[w.docs[full]]
            d = w.docs[full][better]
            best[d], whose[d], where[d] = top[better], j, spot[full][better]
        live = np.flatnonzero(np.isfinite(best))
        if not len(live):
            break
        parts = []
        for j, w in enumerate(walks):
            mine = live[whose[live] == j]
            if not len(mine):
                continue
            row = np.searchsorted(w.docs, mine)
            lo, at = w.first[row], where[mine]
            n = at - lo
            keep = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
            # Where the walk leaves: the rest of that unit, then all later units of the text afresh.
            here = w.unit[at]
            later_n = unit_first[mine + 1] - here - 1
            later = np.repeat(here + 1 - np.concatenate([[0], np.cumsum(later_n)[:-1]]), later_n) + np.arange(int(later_n.sum()))
            from_unit = np.concatenate([here, later])
            from_place = np.concatenate([lat.place[w.edge[at]], lat.first[kinds[later]]])
            shut = np.concatenate([w.barred[at], np.zeros(len(later), np.int64)])
            u2, e2 = descend(lat, kinds, from_unit, from_place, shut, key, rank)
            at_leave = np.zeros(len(u2), np.int64)
            # The first new step of a text carries what was shut before it.
            head = np.searchsorted(owner[u2], mine)
            at_leave[head] = w.barred[at]
            parts.append((np.concatenate([w.unit[keep], u2]), np.concatenate([w.edge[keep], e2]), np.concatenate([np.zeros(len(keep), np.int64), at_leave]),
                          np.concatenate([np.zeros(len(keep), bool), np.ones(len(u2), bool)])))
            # The new walk owns what is still shut out where it left; nothing waits there any more.
            w.waits[at] = -np.inf
        unit, edge, barred, own = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(unit, kind="stable")
        unit, edge, barred, own = unit[order], edge[order], barred[order], own[order]
        first = np.append(np.searchsorted(owner[unit], live), len(unit))
        walks.append(walk_values(lat, kinds, live, first, unit, edge, barred, best[live], own, key, rank))
    # The best value that still waits is the threshold of inclusion.
    least = np.full(len(docs), -np.inf)
    for w in walks:
        full = np.flatnonzero(np.diff(w.first) > 0)
        if len(full):
            least[w.docs[full]] = np.maximum(least[w.docs[full]], np.maximum.reduceat(w.waits, w.first[:-1][full]))
    for rank, w in enumerate(walks, 1):
        lp = w.log_prob
        inclusion = -np.expm1(-np.exp(np.minimum(lp - least[w.docs], 700)))
        yield rank, w.docs, token_ids(lat, w, v), lp, w.value, inclusion


def token_ids(lat: Lattice, w: Walk, v: Vocab) -> list[np.ndarray]:
    """The ids along the steps; a character outside the vocabulary gives the ids of its bytes."""
    piece = lat.piece[w.edge]
    bare = piece == -2
    code = np.where(bare, lat.codes[lat.place[w.edge]], 0).astype(np.int64)
    width = np.where(bare, utf8_width(code), 1)
    begin = np.cumsum(width) - width
    out = np.repeat(piece, width)
    for c in np.unique(code[bare]):
        at = begin[bare & (code == c)]
        for j, byte in enumerate(chr(c).encode("utf-8", "surrogatepass")):
            out[at + j] = v.bytes[byte]
    edge = np.append(begin, len(out))[w.first]
    return np.split(out, edge[1:-1]) if len(edge) > 2 else [out]


def encoded(batches: Iterator[pa.RecordBatch], v: Vocab, k: int, spelled: bool = False) -> Iterator[pa.RecordBatch]:
    sp = spelling(v.spelled)
    for piece in (p for whole in batches for p in slices(whole, most_bytes=SLICE_BYTES)):
        texts = piece.column("text").fill_null("").to_pylist()
        seeds = np.asarray(piece.column("seed")).astype(np.int64).view(U)
        for rank, docs, ids, lp, value, inclusion in sample_texts(texts, mix(seeds), v, k):
            off = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(off, pa.array(np.concatenate(ids) if len(ids) else np.zeros(0, np.int32), pa.int32()))
            taken = pa.array(docs)
            out = {
                "id": piece.column("id").take(taken), "rank": pa.array(np.full(len(docs), rank, np.int32)), "ids": lists,
                "log_prob": pa.array(lp), "value": pa.array(value), "inclusion": pa.array(inclusion),
            }
            yield pa.RecordBatch.from_pydict(out | ({"text": spell(lists, sp)} if spelled else {}))


class Spelling(NamedTuple):
    """The bytes of all pieces in one pool, and where each id's bytes begin."""

    pool: np.ndarray
    begin: np.ndarray


def spelling(spelled: list[bytes]) -> Spelling:
    return Spelling(np.frombuffer(b"".join(spelled), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in spelled])]))


def spell(lists: pa.ListArray, sp: Spelling) -> pa.Array:
    """The texts of lists of ids, without the space before the first word."""
    ids = np.asarray(lists.flatten())
    off = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    size = sp.begin[ids + 1] - sp.begin[ids]
    end = np.concatenate([[0], np.cumsum(size)])
    raw = sp.pool[np.repeat(sp.begin[ids] - end[:-1], size) + np.arange(end[-1])]
    edge = end[off]
    keep = np.ones(len(raw), bool)
    led = np.zeros(len(lists), bool)
    has = np.diff(edge) > 0
    led[has] = raw[edge[:-1][has]] == 32
    keep[edge[:-1][led]] = False
    full = edge - np.concatenate([[0], np.cumsum(led)])
    texts = pa.Array.from_buffers(pa.large_string(), len(lists), [None, pa.py_buffer(full.astype(np.int64).tobytes()), pa.py_buffer(raw[keep].tobytes())])
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:  # ids that no text gave: bytes that are no UTF-8
        whole = raw[keep].tobytes()
        texts = pa.array([whole[a:b].decode("utf-8", "replace") for a, b in zip(full[:-1], full[1:], strict=True)], pa.large_string())
    return texts.cast(pa.string())


def decoded(batches: Iterator[pa.RecordBatch], sp: Spelling, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            batch = whole.slice(at, rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, spell(batch.column("ids"), sp)], [*batch.schema.names, "text"])


def encode_samples(df: DataFrame, key: str, text: str, k: int = 2, model: str = MODEL, alpha: float = 0.5, spelled: bool = False) -> DataFrame:
    """key, rank (from 1), ids, log_prob, value and inclusion: k distinct sampled segmentations of every text.

    With `spelled`, also `text`: what the ids spell, as `decode_ids` gives it, in the same pass.

    Samples are drawn without replacement with probabilities of the lattice's weights, the same
    in each run for the same key and text. `value` is the perturbed log probability,
    falling with rank; `inclusion` the probability of being among the k, given the next value.
    Texts with fewer segmentations give fewer rows; a null or empty text gives one without
    ids. Spaces become the mark of a word's start, and one is put before the text, as
    the model was made; a mark in the text itself decodes to a space. Repeated rows stay.
    """
    spark = df.sparkSession
    vocab = spark.sparkContext.broadcast(load_vocab(model, alpha))  # as large as the vocabulary, whatever the input
    rows = df.select(F.col(key).alias("id"), F.xxhash64(F.lit("pieces"), F.col(key)).alias("seed"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, rank int, ids array<int>, log_prob double, value double, inclusion double" + (", text string" if spelled else "")
    out = rows.mapInArrow(lambda it: encoded(it, vocab.value, k, spelled), schema)
    return out.withColumnRenamed("id", key)


def decode_ids(df: DataFrame, model: str = MODEL) -> DataFrame:
    """`df` with a column `text` that its column `ids` spells; bytes that are no UTF-8 become U+FFFD. A null list gives an empty text."""
    sent = df.sparkSession.sparkContext.broadcast(spelling(load_vocab(model).spelled))  # as large as the vocabulary
    rest = [c for c in df.columns if c != "text"]
    schema = ", ".join(f"`{c}` {t}" for c, t in df.select(*rest).dtypes) + ", text string"
    return df.select(*rest).mapInArrow(lambda it: decoded(it, sent.value), schema)


def op7_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two segmentations of each text as digests, with the decoded text's hash beside the text's own."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    samples = encode_samples(docs, "doc_id", "text", spelled=True)
    return samples.select(
        "doc_id", "rank", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "log_prob", "value", "inclusion",
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
