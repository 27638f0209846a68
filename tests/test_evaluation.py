"""Evaluation against plain numpy: baselines, carried alert rates, intervals' order and the gate."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F
from test_selection import data, fold, frame, plain_ap, plain_nested

from stormline.operators.ranks import quantiles_at
from stormline.plans import evaluation as E
from stormline.plans.selection import FOLDS, folded


def plain_rate(score, y):
    best = (-1.0, None)
    for s in sorted(set(score), reverse=True):
        csi = y[score >= s].sum() / ((score >= s).sum() + y[score < s].sum())
        if csi > best[0] + 1e-12:
            best = (csi, np.mean(score >= s))
    return best[1]


def plain_decided(score, outer, rates):
    out = np.zeros(len(score), bool)
    for f, r in rates.items():
        m = outer == f
        if m.any() and r:
            out[m] = score[m] >= np.quantile(score[m], 1 - r)
    return out


def test_climatology_and_base_rate(spark):
    x, y, keys = data(300)
    df = folded(frame(spark, x, y, keys).withColumn("unit", F.col("id") % 9), ["a"], "y", "g", "s")
    outer, unit = np.array([fold(k, "s") for k in keys]), np.arange(300) % 9
    for columns in ([], ["unit"]):
        got = E.climatology(df, "y", columns)
        rows = {r["id"]: r["score"] for r in got.rows.collect()}
        assert len(rows) == 300
        for f in range(FOLDS):
            tr = outer != f
            prior = y[tr].mean()
            score = np.array([(y[tr & (unit == u)].sum() + prior) / ((tr & (unit == u)).sum() + 1) for u in unit]) if columns else np.full(300, prior)
            assert all(math.isclose(rows[i], score[i]) for i in np.flatnonzero(~tr))
            assert math.isclose(got.rates[f], plain_rate(np.round(score[tr], 12), y[tr]))
        alarms = {r["id"]: r["alarm"] for r in E.decided(got).collect()}
        want = plain_decided(np.array([rows[i] for i in range(300)]), outer, got.rates)
        assert [alarms[i] for i in range(300)] == want.tolist()


def test_the_table_matches_plain_numbers(spark):
    x, y, keys = data()
    df = frame(spark, x, y, keys).withColumn("unit", F.col("id") % 9).withColumn("event", F.col("id") % 13)
    table, rows = E.evaluation_table(df, ["a", "b", "c"], "y", "g", "s", ["a", "b"], "c", ["unit"], "event", 50)
    got = {r["model"]: r for r in table.collect()}
    assert set(got) == {"model", "B0", "B1", "B2", "B3"}
    outer, score, _ = plain_nested(x, y, keys, "s")
    alarm = {r["id"]: r["alarm"] for r in rows.collect()}
    a = np.array([alarm[i] for i in range(len(y))])
    m = got["model"]
    assert (m["tp"], m["fp"], m["fn"]) == ((a & (y == 1)).sum(), (a & (y == 0)).sum(), (~a & (y == 1)).sum())
    assert math.isclose(m["csi"], m["tp"] / (m["tp"] + m["fp"] + m["fn"])) and m["lo"] <= m["csi"] <= m["hi"]
    assert math.isclose(m["average_precision"], plain_ap(np.round(score, 12), y), abs_tol=1e-9)
    assert m["ship"] == (m["csi"] > max(got["B2"]["csi"], got["B3"]["csi"])) and not any(got[b]["ship"] for b in ("B0", "B1", "B2", "B3"))
    events = E.event_rows(rows, "y", "event").collect()
    assert len(events) == 13 and sum(r["tp"] for r in events) == m["tp"]
    truth = spark.createDataFrame([(u, e, 1) for u in range(10) for e in range(2)], "unit int, event int, y int")
    both, missing = E.parent_rows(rows, truth, "unit", "event", "y")
    assert missing.first()[0] == 2 and both.count() == 18  # there is no unit 9


def test_quantiles_interpolate(spark):
    rng = np.random.RandomState(2)
    v, k = rng.randint(0, 40, 500) / 4, rng.randint(0, 3, 500)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(k, v, strict=True)] + [(0, None)], "k int, v double")
    wanted = spark.createDataFrame([(i, q) for i in range(4) for q in (0.0, 0.1, 0.37, 0.5, 1.0)], "k int, q double")
    got = {(r["k"], r["q"]): r["quantile"] for r in quantiles_at(df, ["k"], "v", wanted, "q").collect()}
    assert len(got) == 15 and all(math.isclose(got[i, q], np.quantile(v[k == i], q)) for i, q in got)
