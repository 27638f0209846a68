"""Language identification by a linear-chain conditional random field over words.

Word features are byte n-grams of 2 to 4 letters with the word's borders (so affixes too) and
the word itself (a lexicon), hashed into one table of weights. Transitions between languages
are learned as well. Forward-backward gives each word its probabilities, in code-switched
text too; a document takes the language with the largest share of its letters.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormline.llm.tokens import mix, powers, slices, utf8, words

TABLE_BITS = 17
SAMPLE_DOCS = 150
CHUNK = 64

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


class Model(NamedTuple):
    """weights: row of the table x language; moves: log weights from language to language."""

    langs: list[str]
    weights: np.ndarray
    moves: np.ndarray


def features(column: pa.Array, bits: int = TABLE_BITS) -> tuple[np.ndarray, ...]:
    """(rows of the weight table, begin of each word's rows, letters by word, first word by text, row of the word itself).

    Row 0 is kept at weight 0 and stands for windows that cross a border.
    """
    raw, off = utf8(column)
    w = words(column)
    n = len(w.start)
    low = raw.copy()
    low[(raw >= 65) & (raw <= 90)] += 32
    # Capitals of the block that UTF-8 leads with C3.
    lead = np.zeros(len(raw), bool)
    lead[1:] = raw[:-1] == 0xC3
    low[lead & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)] += 32
    size = w.end - w.start
    at = np.cumsum(size) - size
    inside = np.repeat(w.start - at, size) + np.arange(int(size.sum()))
    chars = low[inside]
    keep = _LETTER[chars]
    owner = np.repeat(np.arange(n), size)[keep]
    letters = np.bincount(owner, minlength=n)
    chars = chars[keep]
    # A border, then each word's letters and a border.
    begin = np.cumsum(letters + 1) - letters
    z = np.zeros(int(letters.sum()) + n + 1, np.uint64)
    z[np.arange(len(chars)) + owner + 1] = chars
    mask = np.uint64((1 << bits) - 1)

    def back(k: int) -> np.ndarray:
        return np.concatenate([np.zeros(k, np.uint64), z[: len(z) - k]])[: len(z)]

    # Windows of 2 to 4 bytes by their last byte; one with a border inside is no n-gram of a word.
    z1, z2, z3 = back(1), back(2), back(3)
    two = z | z1 << np.uint64(8)
    three = two | z2 << np.uint64(16)
    four = three | z3 << np.uint64(24)
    inner = z1 > 0
    grams = [
        np.where(ok, mix(code + np.uint64(k << 40)) & mask, np.uint64(0)).astype(np.int32)
        for k, code, ok in ((2, two, two > 0), (3, three, inner), (4, four, inner & (z2 > 0)))
    ]
    place = np.arange(len(chars)) - np.repeat(np.cumsum(letters) - letters, letters)
    value = (chars.astype(np.uint64) + np.uint64(257)) * powers(int(letters.max()) + 1 if n else 1)[place + 1] if len(chars) else np.zeros(0, np.uint64)
    whole = np.zeros(n, np.uint64)
    if len(chars):
        has = letters > 0
        whole[has] = np.add.reduceat(value, (np.cumsum(letters) - letters)[has])
    lexicon = np.where(letters > 0, mix(whole) & mask, np.uint64(0)).astype(np.int32)
    return np.stack([g[1:] for g in grams]), begin - 1, letters, w.first, lexicon


def emissions(found: tuple, weights: np.ndarray) -> np.ndarray:
    rows, begin, letters, _, lexicon = found
    if not len(letters):
        return np.zeros((0, weights.shape[1]), np.float32)
    total = weights[rows[0]] + weights[rows[1]] + weights[rows[2]]
    return np.add.reduceat(total, begin, axis=0) + weights[lexicon]


def posteriors(e: np.ndarray, first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities by word of texts with words first[i]:first[i+1], and the summed pair expectations.

    Exact forward-backward, without a move before a text's first word. Texts are cut into chunks: each chunk's transfer matrix is built
    for all chunks at once, then chained along the text, then the chunks are filled in.
    """
    n, lang = e.shape
    size = np.diff(first)
    pieces = -(-size // CHUNK)
    text = np.repeat(np.arange(len(size)), pieces)
    rank = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start, opens = first[:-1][text] + rank * CHUNK, rank == 0
    width = np.minimum(CHUNK, first[1:][text] - start)
    c = len(text)
    p = np.zeros((CHUNK, c, lang))
    t = np.arange(CHUNK)[:, None]
    live = t < width[None, :]
    spot = np.where(live, start[None, :] + t, 0)
    scale = e.max(1, keepdims=True) if n else e
    f = np.exp(np.clip(e - scale, -60, 0)).astype(float)
    p[live] = f[spot[live]]
    step = np.exp(moves - moves.max())
    # Transfer matrices: row state before the chunk, column state at its end.
    m = np.repeat(np.eye(lang)[None], c, 0)
    for i in range(CHUNK):
        on = live[i]
        if not on.any():
            break
        x = (m @ step if i else np.where(opens[:, None, None], m, m @ step)) * p[i][:, None, :]
        x /= x.sum((1, 2), keepdims=True) + 1e-300
        m[on] = x[on]
    head = np.cumsum(pieces) - pieces
    before, after = np.full((c, lang), 1.0 / lang), np.full((c, lang), 1.0)
    for r in range(1, int(pieces.max(initial=0))):
        on = head[pieces > r] + r
        x = np.einsum("nl,nlk->nk", before[on - 1], m[on - 1])
        before[on] = x / (x.sum(1, keepdims=True) + 1e-300)
        on = head[pieces > r] + pieces[pieces > r] - 1 - r
        x = np.einsum("nlk,nk->nl", m[on + 1], after[on + 1])
        after[on] = x / (x.sum(1, keepdims=True) + 1e-300)
    fore = np.zeros((CHUNK, c, lang))
    a = before
    for i in range(CHUNK):
        x = (a @ step if i else np.where(opens[:, None], a, a @ step)) * p[i]
        x /= x.sum(1, keepdims=True) + 1e-300
        a = np.where(live[i][:, None], x, a)
        fore[i] = a
    pair = np.zeros((lang, lang))
    post = np.zeros((n, lang))
    b = after
    for i in range(CHUNK - 1, -1, -1):
        on = live[i]
        g = fore[i] * b
        g /= g.sum(1, keepdims=True) + 1e-300
        post[spot[i][on]] = g[on]
        back = (p[i] * b)
        prior = fore[i - 1] if i else before
        xi = prior[on][:, :, None] * step[None] * back[on][:, None, :]
        if i == 0:
            xi = xi[~opens[on]]
        pair += (xi / (xi.sum((1, 2), keepdims=True) + 1e-300)).sum(0)
        x = back @ step.T
        x /= x.sum(1, keepdims=True) + 1e-300
        b = np.where(on[:, None], x, b)
    return post, pair


def train(texts: list[str], labels: list[str], epochs: int = 4, bits: int = TABLE_BITS, seed: int = 11) -> Model:
    """Fits weights and moves by AdaGrad on the log likelihood of the words' languages.

    Texts are cut into runs of 150 words, and runs of two texts are put behind one another,
    so that moves between languages are seen.
    """
    langs = sorted(set(labels))
    want = np.searchsorted(langs, labels)
    rng = np.random.RandomState(seed)
    found = features(pa.array(texts, pa.large_string()), bits)
    rows, begin, letters, first, lexicon = found
    n, count = len(langs), len(letters)
    end = np.append(begin[1:], rows.shape[1])
    truth = np.repeat(want, np.diff(first))
    runs = [(a, min(a + 150, hi)) for lo, hi in zip(first[:-1], first[1:], strict=True) for a in range(lo, hi, 150)]
    weights, moves = np.zeros((1 << bits, n), np.float32), np.zeros((n, n))
    power, power_m = np.full_like(weights, 1e-6), np.full((n, n), 1e-6)
    for _ in range(epochs if count else 0):
        order = rng.permutation(len(runs))
        for part in np.array_split(order, max(1, len(runs) // 100)):
            w = np.concatenate([np.arange(*runs[i]) for i in part])
            sizes = [runs[i][1] - runs[i][0] for i in part]
            joined = [sum(sizes[i : i + 2]) for i in range(0, len(sizes), 2)]
            starts = np.concatenate([[0], np.cumsum(joined)])
            span = end[w] - begin[w]
            at = np.cumsum(span) - span
            cols = np.repeat(begin[w] - at, span) + np.arange(int(span.sum()))
            mine = (rows[:, cols], at, letters[w], starts, lexicon[w])
            post, pair = posteriors(emissions(mine, weights), starts, moves)
            gold = np.zeros_like(post)
            gold[np.arange(len(w)), truth[w]] = 1
            diff = gold - post
            t = truth[w]
            inner = np.ones(len(w), bool)
            inner[starts[:-1]] = False
            seen = np.zeros((n, n))
            np.add.at(seen, (t[:-1][inner[1:]], t[1:][inner[1:]]), 1)
            spread = np.repeat(np.arange(len(w)), span)
            flat = np.concatenate([mine[0][0], mine[0][1], mine[0][2], mine[4]])
            who = np.concatenate([spread, spread, spread, np.arange(len(w))])
            grad = np.stack([np.bincount(flat, diff[who, j], minlength=1 << bits) for j in range(n)], 1) / len(w)
            grad -= 1e-7 * weights
            grad[0] = 0
            power += grad**2
            weights += (0.3 * grad / np.sqrt(power)).astype(np.float32)
            g = (seen - pair) / len(w) - 1e-4 * moves
            power_m += g**2
            moves += 0.1 * g / np.sqrt(power_m)
    return Model(langs, weights, moves)


def training_sample(rows: DataFrame, per_lang: int = SAMPLE_DOCS) -> tuple[list[str], list[str]]:
    """About `per_lang` whole texts of each language, chosen by a hash of the key: a bounded sample."""
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return [], []
    part = F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), F.lit(min(1.0, per_lang / v)))])
    u = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "id"), 11).cast("double") / F.lit(2.0**53)
    got = rows.where(u < part[F.col("lang")]).select("id", "lang", "text").limit(3 * per_lang * len(counts)).collect()
    got.sort(key=lambda r: (r["id"], r["text"]))
    return [r["text"] for r in got], [r["lang"] for r in got]


def shares(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """By text: the letters in words of each language."""
    for batch in (piece for whole in batches for piece in slices(whole)):
        found = features(batch.column("text"), int(np.log2(len(model.weights))))
        _, _, letters, first, _ = found
        post, _ = posteriors(emissions(found, model.weights), first, model.moves)
        sums = np.concatenate([np.zeros((1, len(model.langs))), np.cumsum(post * letters[:, None], 0)])
        by = sums[first[1:]] - sums[first[:-1]]
        by /= np.maximum(by.sum(1, keepdims=True), 1e-9)
        flat = pa.array(by.ravel())
        lists = pa.ListArray.from_arrays(np.arange(len(by) + 1, dtype=np.int32) * len(model.langs), flat)
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in batch.schema.names if c != "text"], lists], [*[c for c in batch.schema.names if c != "text"], "shares"])


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def identify_languages(df: DataFrame, doc_id: str, text: str, lang: str, per_lang: int = SAMPLE_DOCS, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, held_out, lang_pred, score, `shares` (language to share of letters) and `row` of every row.

    `row` is a struct of the `carry` columns, so that a filter needs no join; it is absent if none are named.

    Learns from rows that aren't held out, with text, letters and language; at most about
    `per_lang` of each language are used. Predictions see the text alone. A null text or one without a
    letter is `und` with score 0, as is every text if nothing could be learned. Ties go to the
    first language in code point order. A null doc_id isn't held out. Repeated rows stay.
    """
    spark = df.sparkSession
    more = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []
    rows = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"), *more)
    kept = ["row"] if carry else []
    lettered = F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False))
    out = F.coalesce(held_out(F.col("id")), F.lit(False))
    texts, labels = training_sample(rows.where(~out & F.col("lang").isNotNull() & lettered & F.col("id").isNotNull()), per_lang)
    if not texts:
        return rows.select(F.col("id").alias(doc_id), out.alias("held_out"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.create_map().cast("map<string,double>").alias("shares"), *kept)
    model = train(texts, labels)
    sent = spark.sparkContext.broadcast(model)  # 2^TABLE_BITS rows of a float for each language
    asked = rows.select("id", "text", lettered.alias("lettered"), *kept)
    schema = ", ".join(f"{c} {t}" for c, t in asked.drop("text").dtypes) + ", shares array<double>"
    scored = asked.mapInArrow(lambda it: shares(it, sent.value), schema)
    names = F.array(*[F.lit(x) for x in model.langs])
    best = F.array_max("shares")
    return scored.select(
        F.col("id").alias(doc_id), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"),
        F.when(F.col("lettered"), F.element_at(names, F.array_position("shares", best).cast("int"))).otherwise("und").alias("lang_pred"),
        F.when(F.col("lettered"), F.least(best, F.lit(1.0))).otherwise(0.0).alias("score"),
        F.map_from_arrays(names, "shares").alias("shares"), *kept,
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify_languages(docs, "doc_id", "text", "lang")
