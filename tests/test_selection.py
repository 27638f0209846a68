"""Cross-validation with inner penalties, sweeps and global ranks against plain versions."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from stormline.operators.aggregates import average_precision, best_threshold, rank_correlation
from stormline.operators.ranks import running_totals
from stormline.plans import selection as S

X = ["a", "b", "c"]


def fold(key, salt, k=S.FOLDS):
    return int(hashlib.sha1((salt + key).encode()).hexdigest(), 16) % k


def plain_fit(x, y, l2):
    mu, sd = x.mean(0), x.std(0)
    sd = np.where(sd > 0, sd, 1.0)
    z = np.column_stack([(x - mu) / sd, np.ones(len(y))])
    b = np.zeros(z.shape[1])
    pen = np.diag([l2] * x.shape[1] + [0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-(z @ b)))
        b = b + np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + pen, z.T @ (y - p) - pen @ b)
    return lambda t: 1 / (1 + np.exp(-(np.column_stack([(t - mu) / sd, np.ones(len(t))]) @ b)))


def plain_ap(score, y):
    out, tp, n = 0.0, 0, 0
    for s in sorted(set(score), reverse=True):
        hit = score == s
        n += hit.sum()
        tp += y[hit].sum()
        out += y[hit].sum() / y.sum() * tp / n
    return out


def plain_nested(x, y, keys, split):
    outer = np.array([fold(k, split) for k in keys])
    inner = np.array([fold(k, f"inner:{split}") for k in keys])
    score, chosen = np.full(len(y), np.nan), {}
    for o in range(S.FOLDS):
        best = (-math.inf, None)
        for l2 in S.PENALTIES:
            got = []
            for i in range(S.FOLDS):
                tr, te = (outer != o) & (inner != i), (outer != o) & (inner == i)
                if te.any() and y[tr].sum() and y[te].sum():
                    got.append(plain_ap(np.round(plain_fit(x[tr], y[tr], l2)(x[te]), 12), y[te]))
            mean = np.mean(got) if got else -math.inf
            if mean > best[0] + 1e-12 or best[1] is None:
                best = (mean, l2)
        chosen[o] = best[1]
        if (outer == o).any():
            score[outer == o] = plain_fit(x[outer != o], y[outer != o], best[1])(x[outer == o])
    return outer, score, chosen


def data(n=420, groups=37):
    rng = np.random.RandomState(8)
    x = np.column_stack([rng.normal(5, 3, n), rng.exponential(100, n), (rng.rand(n) < 0.3).astype(float)])
    y = (rng.rand(n) < 1 / (1 + np.exp(-(0.5 * (x[:, 0] - 5) - 0.01 * (x[:, 1] - 100) + x[:, 2] - 0.7)))).astype(float)
    return x, y, [f"g{rng.randint(groups)}" for _ in range(n)]


def frame(spark, x, y, keys):
    return spark.createDataFrame([(i, *map(float, r), int(t), k) for i, (r, t, k) in enumerate(zip(x, y, keys, strict=True))], "id int, a double, b double, c double, y int, g string")


def test_nested_cross_validation_matches_a_plain_one(spark):
    x, y, keys = data()
    outer, score, chosen = plain_nested(x, y, keys, "s")
    v = S.nested_cv(frame(spark, x, y, keys), X, "y", "g", "s")
    assert v.penalties == chosen
    rows = v.rows.orderBy("id").collect()
    assert [r["outer"] for r in rows] == outer.tolist()
    assert np.allclose([r["score"] for r in rows], score, atol=1e-7)
    for o, (threshold, rate) in v.points.items():
        p = plain_fit(x[outer != o], y[outer != o], chosen[o])(x[outer != o])
        assert math.isclose(np.mean(p >= threshold - 1e-9), rate, abs_tol=1e-9)


def test_sweep_matches_single_fits(spark):
    x, y, keys = data()
    outer = np.array([fold(k, "s") for k in keys])
    got = {r["config"]: r["average_precision"] for r in S.sweep(frame(spark, x, y, keys), X, "y", "g", "s", 1.0, {"tail": ["b", "c"]}).collect()}
    assert set(got) == {"reference", *(f"penalty {p:g}" for p in [*S.PENALTIES, 1000.0]), "without tail"}
    for name, cols, l2 in (("reference", [0, 1, 2], 1.0), ("penalty 1000", [0, 1, 2], 1000.0), ("without tail", [0], 1.0)):
        score = np.zeros(len(y))
        for o in range(S.FOLDS):
            score[outer == o] = plain_fit(x[outer != o][:, cols], y[outer != o], l2)(x[outer == o][:, cols])
        assert math.isclose(got[name], plain_ap(score, y), abs_tol=1e-6)


def test_fits_without_both_classes_are_left_out(spark):
    x, y, keys = data(60)
    df = S.folded(frame(spark, x, np.ones(60), keys), X, "y", "g", "s")
    assert np.isnan(S.fit_many(df, X, "y", [S.Spec("all", None, None, 1.0)])).all()
    assert np.isnan(S.fit_many(df.limit(0), X, "y", [S.Spec("all", None, None, 1.0)])).all()
    assert S.chosen_penalties(df, X, "y") == dict.fromkeys(range(S.FOLDS), S.PENALTIES[0])


def test_the_shipped_penalty():
    assert S.shipped_penalty([1.0, 10.0, 1.0, 10.0, 0.1]) == 10.0 and S.shipped_penalty([0.1, 0.1, 5.0]) == 0.1 and S.shipped_penalty([]) == 1.0


def test_running_totals_match_a_plain_sum(spark):
    rng = random.Random(2)
    rows = [(rng.choice("xyz") if k % 9 else None, v, rng.randint(0, 5)) for k, v in enumerate(rng.sample(range(10_000), 700))] + [("x", None, 4)]
    df = spark.createDataFrame(rows, "k string, v int, n long")
    for down in (False, True):
        got = {(r["k"], r["v"]): r["run_n"] for r in running_totals(df, ["k"], "v", ["n"], descending=down, buckets=7).collect()}
        for k, v, _ in rows:
            at = lambda z: -math.inf if z is None else z
            assert got[k, v] == sum(n for kk, vv, n in rows if kk == k and (at(vv) >= at(v) if down else at(vv) <= at(v)))
    assert running_totals(df.limit(0), [], "v", ["n"]).count() == 0


def test_ranks_and_curves_over_ranges(spark):
    rng = np.random.RandomState(5)
    s, y = rng.randint(0, 300, 900) / 300, rng.randint(0, 2, 900)
    df = spark.createDataFrame([(float(a), int(b), float(rng.randint(40))) for a, b in zip(s, y, strict=True)], "s double, y int, o double")
    assert math.isclose(average_precision(df, "s", "y").first()[0], plain_ap(s, y), abs_tol=1e-12)
    best = best_threshold(df, "s", "y").first()
    csi = {t: (y[s >= t]).sum() / ((s >= t).sum() + y[s < t].sum()) for t in set(s)}
    assert math.isclose(best["csi"], max(csi.values())) and math.isclose(best["alert_rate"], np.mean(s >= best["threshold"]))
    o = df.toPandas()
    assert math.isclose(rank_correlation(df, "s", "o").first()[0], o["s"].rank().corr(o["o"].rank()), abs_tol=1e-12)
    assert df.where(F.lit(False)).count() == 0


def test_range_counts_match_a_plain_count(spark):
    from stormline.operators.ranks import range_counts

    rng = random.Random(7)
    points = [(rng.choice("xy") if k % 7 else None, rng.randint(0, 200) if k % 11 else None) for k in range(400)]
    spans = [(i, rng.choice("xyz") if i % 5 else None, rng.randint(-20, 220), rng.choice([None, 0, 5, 60])) for i in range(120)]
    spans = [(i, k, a, None if w is None else a + w - (1 if i % 13 == 0 else 0)) for i, k, a, w in spans]
    p, s = spark.createDataFrame(points, "k string, at long"), spark.createDataFrame(spans, "id int, k string, a long, b long")
    for keys in ([], ["k"]):
        got = {r["id"]: r["n"] for r in range_counts(p, s, "at", "a", "b", keys).collect()}
        assert got == {i: sum(at is not None and b is not None and a <= at < b and (not keys or pk == k) for pk, at in points) for i, k, a, b in spans}
