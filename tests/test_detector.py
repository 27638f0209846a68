"""The detector's walk, features and latches on hours made by hand."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from stormline.plans import detector as D

NY = ZoneInfo("America/New_York")
MODELS = {"stop": ({"log_total": 1.0}, 0.0), "entrance": ({"log_total": 1.0, "static": 1.0}, 0.0)}


def at(*when):
    return int(datetime(*when, tzinfo=NY).timestamp())


def dry(first, last, wet=(), missing=()):
    return [(h, 9 if h in wet else 0) for h in range(first, last + 1, 3600) if h not in missing]


def walk(spark, nows, hours, **more):
    cycles = spark.createDataFrame([(n,) for n in nows], "now long")
    got = D.anchor_walk(cycles, spark.createDataFrame(hours, "hour_end long, n_wet long"), **more).collect()
    return {r["now"]: (r["anchor"], r["state"], r["walked_days"]) for r in got}


def test_the_walk_passes_wet_evenings_and_stops_at_unknown_ones(spark):
    nine = lambda d: at(2024, 6, d, 21)
    hours = dry(at(2024, 6, 1), at(2024, 6, 20), wet={nine(d) for d in (10, 11, 12, 13, 14, 15, 16, 17)} | {nine(5) - 7200}, missing={nine(8) - 3600})
    got = walk(spark, [nine(6), nine(6) - 60, nine(7), nine(8) + 10, nine(9), nine(11), nine(17) + 5], hours)
    assert got[nine(6)] == (nine(6), "OK", 0)  # the anchor's own hour counts
    assert got[nine(6) - 60] == (nine(4), "OK", 1)  # the evening of the 5th was wet two hours before
    assert got[nine(8) + 10] == (None, "INSUFFICIENT_DATA", 0)
    assert got[nine(11)] == (nine(9), "OK", 2)
    assert got[nine(17) + 5] == (None, "WINDOW_CAPPED", 6)
    assert walk(spark, [nine(17)], hours, cap_days=9)[nine(17)] == (nine(9), "OK", 8)
    assert walk(spark, [], hours) == {}


def test_anchors_stay_at_nine_when_clocks_change(spark):
    hours = dry(at(2024, 3, 1), at(2024, 3, 14))
    for day in (9, 10, 11):
        now = at(2024, 3, day, 21, 30)
        assert walk(spark, [now], hours)[now] == (at(2024, 3, day, 21), "OK", 0)
    assert at(2024, 3, 10, 21) - at(2024, 3, 9, 21) == 23 * 3600


def test_dry_hours(spark):
    h = 3600
    wet = spark.createDataFrame([(1 * h, 9), (2 * h, 0), (3 * h, 1), (5 * h, 0), (6 * h, 0)], "hour_end long, n_wet long")
    cycles = spark.createDataFrame([(k * h + 5,) for k in range(1, 8)], "now long")
    got = {r["now"] // h: r["dry_hours"] for r in D.dry_hours(cycles, wet).collect()}
    assert got == {1: 0, 2: 1, 3: 2, 4: None, 5: 1, 6: 2, 7: None}


def replay(spark, rain, temps, units, k=1):
    start = at(2024, 6, 10, 21)
    frame = spark.createDataFrame([(c, start + h * 3600, mm) for c, h, mm in rain], "cell long, hour_end long, mm double")
    cycles = spark.createDataFrame([(start + h * 3600, t) for h, t in temps], "now long, temp_c double")
    u = spark.createDataFrame(units, "asset_id long, kind string, cell long, complex_id long, static double")
    got = D.detector_cycles(frame, cycles, u, MODELS, k).collect()
    return {((r["now"] - start) // 3600, r["asset_id"]): (r["tier_now"], r["tier"], r["suppressed"], r["dimmed"]) for r in got}


def test_tiers_latch_until_the_window_rolls(spark):
    rain = [(c, h, 0.0) for c in (1, 2) for h in range(-30, 60)]
    rain = [(c, h, 5.0 if (c, h) == (1, 2) or (c, h) == (2, 4) or (c, h) == (2, 5) else mm) for c, h, mm in rain]
    units = [(1, "stop", 1, 1, 0.0), (2, "stop", 2, 1, 0.0), (3, "stop", 3, 1, 0.0)]
    temps = [(2, 9.0), (3, 9.0), (4, 9.0), (5, 9.0), (8, 9.0), (26, 9.0)]
    got = replay(spark, rain, temps, units)
    assert (2, 3) not in got  # no rain data: no score
    assert got[2, 1][:2] == (2, 2) and got[2, 2][:2] == (0, 0)
    assert got[3, 1] == (0, 2, False, False)  # the city is dry: held
    assert got[5, 2][:2] == (2, 2) and got[5, 1][:2] == (0, 2)
    assert got[8, 1] == (0, 2, False, True)  # three dry hours dim it
    assert got[26, 1] == (0, 0, False, True)  # the next evening was dry: a new window
    cold = replay(spark, rain, [(2, 9.0), (3, 0.5), (4, 9.0)], units)
    assert cold[3, 1] == (0, 0, True, False) and cold[4, 1][:2] == (2, 2)
    assert not any(v[2] for v in replay(spark, rain, [(2, None)], units).values())  # June: no winter


def test_complexes_have_their_best_doorway_and_dark_cells_no_hole(spark):
    rain = [(c, h, 5.0 if h == 2 else 0.0) for c in (1, 2) for h in range(-30, 6)] + [(9, h, None) for h in range(-30, 6)]
    units = [(1, "entrance", 1, 7, 0.0), (2, "entrance", 2, 7, 1.0), (3, "complex", 5, 7, 0.0), (4, "complex", 5, 8, 0.0)]
    got = replay(spark, rain, [(2, 9.0)], units)
    assert set(got) == {(2, 3)} and got[2, 3][0] == 2
    start = at(2024, 6, 10, 21)
    frame = spark.createDataFrame([(c, start + h * 3600, mm) for c, h, mm in rain], "cell long, hour_end long, mm double")
    walked = D.anchor_walk(spark.createDataFrame([(start + 7200,)], "now long"), D.wet_cells(frame), 1)
    city = D.city_coverage(D.cycle_features(frame, walked)).first()
    assert city["n_cells"] == 2 and city["coverage"] == 1.0 and not city["holes"]
    holed = frame.where(~((F.col("cell") == 1) & (F.col("hour_end") == start + 3600)))
    assert D.city_coverage(D.cycle_features(holed, walked)).first()["holes"]




def test_units_are_dealt_out_before_they_meet_cycles(spark):
    """A unit comes back in every cycle, so units of one small file don't stay in one task."""
    rain = spark.createDataFrame([(1, at(2024, 6, 10, 21) - h * 3600, 0.0) for h in range(40)], "cell long, hour_end long, mm double")
    cycles = spark.createDataFrame([(at(2024, 6, 10, 21) + 3600, 9.0)], "now long, temp_c double")
    units = spark.createDataFrame([(i, "stop", 1, 1, 0.0) for i in range(50)], "asset_id long, kind string, cell long, complex_id long, static double").coalesce(1)
    out = D.detector_cycles(rain, cycles, units, MODELS, 1)
    assert "RepartitionByExpression [asset_id" in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 50
