"""Universes: rebuilt labels and fits against single rebuilds."""

from __future__ import annotations

import math
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_selection import plain_ap, plain_fit

from stormline.plans import universe as U


def world(spark):
    rng = np.random.RandomState(4)
    spots = [(i, -74 + 0.004 * (i % 5), 40.7 + 0.004 * (i // 5)) for i in range(25)]
    assets = [(i, -74 + 0.016 * rng.rand(), 40.7 + 0.016 * rng.rand(), rng.normal(), rng.normal()) for i in range(150)]
    reports = [(f"2024-01-{d:02d}", int(rng.randint(25))) for d in range(1, 29) for _ in range(rng.randint(1, 9))]
    r = spark.createDataFrame(reports, "day string, spot_id int").withColumn("day", F.to_date("day"))
    return r, spark.createDataFrame(spots, "spot_id int, lon double, lat double"), spark.createDataFrame(assets, "asset_id int, x double, y double, a double, b double")


def test_each_universe_is_what_it_would_be_alone(spark):
    r, s, a = world(spark)
    params = [(0, 0.7, 250.0), (1, 0.7, 400.0), (2, 0.9, 250.0), (3, 0.9, 0.001)]
    frame = spark.createDataFrame(params, U.PARAMETERS)
    out = {x["universe"]: x for x in U.universe_table(r, s, a, ["a", "b"], frame, 0).collect()}
    counts = sorted((x["count"], x["day"]) for x in r.groupBy("day").count().collect())
    for u, q, radius in params:
        cut = counts[max(math.ceil(q * len(counts)), 1) - 1][0]
        days = sorted(d for n, d in counts if n >= cut)
        events = {}
        for d in days:  # a run is named by its first day
            events[d] = events.get(d - timedelta(1), d)
        near = {(x["spot_id"], x["asset_id"]) for x in U.radius_join(s, a, ("lon", "lat"), ("x", "y"), radius).collect()}
        hit = {(events[x["day"]], b) for x in r.collect() if x["day"] in events for k, b in near if k == x["spot_id"]}
        assert (out[u]["n_days"], out[u]["n_events"], out[u]["n_labels"]) == (len(days), len(set(events.values())), len(hit))
        if not hit:
            assert out[u]["coef"] is None and out[u]["average_precision"] is None
            continue
        rows = [(x["a"], x["b"], float((e, x["asset_id"]) in hit)) for e in set(events.values()) for x in a.collect()]
        x, y = np.array([v[:2] for v in rows]), np.array([v[2] for v in rows])
        score = plain_fit(x, y, 1.0)(x)
        assert math.isclose(out[u]["average_precision"], plain_ap(np.round(score, 12), y), abs_tol=1e-9)
        got = 1 / (1 + np.exp(-(x @ np.array(out[u]["coef"][:2]) + out[u]["coef"][2])))
        assert np.allclose(got, score, atol=1e-8)
    assert out[1]["delta_labels"] == out[1]["n_labels"] - out[0]["n_labels"] and len({x["stamp"] for x in out.values()}) == 4


def test_universes_that_change_nothing_are_told(spark):
    r, s, a = world(spark)
    good = U.universe_table(r, s, a, ["a"], spark.createDataFrame([(0, 0.7, 250.0), (1, 0.9, 250.0)], U.PARAMETERS), 0)
    U.check_stamps(good)
    alike = U.universe_table(r, s, a, ["a"], spark.createDataFrame([(0, 0.7, 250.0), (1, 0.7, 250.0 + 1e-9)], U.PARAMETERS), 0)
    with pytest.raises(ValueError, match="rebuilt alike"):
        U.check_stamps(alike)


def test_weights_stand_for_repeated_rows(spark):
    """The matrix holds an asset's events as a weight: fit and precision are those of the rows written out."""
    from stormline.operators.aggregates import average_precision
    from stormline.plans import selection as S

    rows = spark.createDataFrame([(float(i % 7), float(i * i % 5), float(i % 3 == 0), float(1 + i % 4)) for i in range(40)], "a double, b double, y double, w double")
    rows = rows.withColumn("outer", F.lit(0)).withColumn("inner", F.lit(0))
    long = rows.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))))
    spec = [S.Spec("all", None, None, 1.0)]
    assert np.allclose(S.fit_many(rows, ["a", "b"], "y", spec, weight="w"), S.fit_many(long, ["a", "b"], "y", spec), atol=1e-9)
    assert math.isclose(average_precision(rows, "a", "y", (), "w").first()[0], average_precision(long, "a", "y").first()[0], abs_tol=1e-12)
