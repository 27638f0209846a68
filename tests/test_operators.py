"""Operators on rows made by hand."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from stormline.functions import geo, scores, texts, times
from stormline.operators import aggregates, joins, windows
from stormline.plans.legs import LegRules, legs
from stormline.plans.model import cross_validated, fit_logistic
from stormline.plans.passages import matched
from stormline.sources import archives


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_ceil_hour_keeps_full_hours(spark):
    t = lambda s: F.unix_timestamp(times.ceil_hour(F.timestamp_micros(F.lit(s))))
    assert one(spark, t(7_200_000_000)) == 7200
    assert one(spark, t(7_200_000_001)) == 10800
    assert one(spark, times.ceil_hour_s(F.lit(3600.5))) == 7200


@pytest.mark.parametrize("day,offset", [("20240310", 4), ("20241103", 5), ("20240701", 4), ("20240115", 5)])
def test_service_time_counts_from_noon(spark, day, offset):
    """Noon less twelve hours is an hour off midnight on the two days of a clock change."""
    got = one(spark, F.hour(times.sched_ts(F.lit(day), F.lit(12 * 3600))))
    assert got == 12 + offset


def test_hms_beyond_a_day(spark):
    assert one(spark, times.hms_seconds(F.lit("26:05:09"))) == 26 * 3600 + 309
    assert one(spark, times.hms_seconds(F.lit("noon"))) is None


def test_geodesic_is_close_to_known_lengths(spark):
    d = lambda *p: one(spark, geo.geodesic_m(*[F.lit(float(v)) for v in p]))
    assert d(0, 0, 0, 0) == 0
    assert abs(d(0, 45, 0, 46) - 111141.55) < 2  # a degree along the meridian at 45.5
    assert abs(d(0, 0, 1, 0) - 111319.49) < 1  # a degree along the equator


def test_cells_are_hexagons_around_their_centre(spark):
    df = spark.range(400).select((F.lit(-74.0) + F.col("id") * 0.00037).alias("lon"), (F.lit(40.7) + (F.col("id") * 7 % 90) * 0.0009).alias("lat"))
    df = df.withColumn("cell", geo.cell_of(F.col("lon"), F.col("lat")))
    lon, lat = geo.cell_center(F.col("cell"))
    x, y = geo.plane_xy(F.col("lon"), F.col("lat"))
    cx, cy = geo.plane_xy(lon, lat)
    far = df.select(F.max(F.sqrt(F.pow(x - cx, 2) + F.pow(y - cy, 2))).alias("d")).first()["d"]
    assert far <= geo.EDGE_M * 1.0001
    again = df.select(F.count(F.when(geo.cell_of(lon, lat) != F.col("cell"), 1)).alias("n")).first()["n"]
    assert again == 0


def test_unknown_level_raises(spark):
    with pytest.raises(Exception, match="unknown level"):
        spark.sql("SELECT 'z' AS k").select(*scores.dummies(F.col("k"), ["a", "b"], "k")).collect()


def test_barred_and_missing_columns_fail(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        scores.bar_columns(df, ["id"])
    with pytest.raises(ValueError):
        scores.need_columns(df, ["other"])


def ping(v, trip, stop, lat, ts, fetched=0):
    return (v, trip, "B1", "20240101", stop, lat, -73.9, ts, fetched)


PING = "vehicle_id string, trip_id string, route_id string, start_date string, stop_id string, lat double, lon double, ts long, fetched_at long"


def test_leg_rules(spark):
    rows = [
        ping("a", "t1", "s1", 40.700, 0), ping("a", "t1", "s1", 40.700, 60),  # standing before the first change: terminal
        ping("a", "t1", "s2", 40.704, 120),  # counts
        ping("a", "t1", "s3", 40.708, 620),  # 500 s gap: dark
        ping("a", "t2", "s4", 40.709, 680),  # another trip: no leg across
        ping("a", "t2", "s5", 40.900, 700),  # a jump: no row
        ping("b", None, "s1", 40.7, 0), ping("b", None, "s2", 40.71, 60),  # no trip: no row
        ping("c", "t3", "s1", 40.70, 0), ping("c", "t3", "s1", 40.75, 0, fetched=9), ping("c", "t3", "s2", 40.704, 60),  # the first fetched of one ts
    ]
    got = sorted((r["vehicle_id"], r["dt_s"], r["dropped"] or "-") for r in legs(spark.createDataFrame(rows, PING)).collect())
    assert got == [("a", 60, "-"), ("a", 60, "terminal"), ("a", 500, "dark"), ("c", 60, "-")]
    kept = legs(spark.createDataFrame(rows, PING), LegRules(drop_terminal=False)).where("dropped IS NULL").count()
    assert kept == 3


def test_legs_do_not_depend_on_row_order(spark, sf_dir):
    from stormline.catalog.roles import pings

    p = pings(spark, sf_dir)
    a = legs(p).groupBy("dropped").agg(F.count("*").alias("n"), F.round(F.sum("dist_m"), 3).alias("d"))
    b = legs(p.orderBy(F.rand(3)).repartition(7)).groupBy("dropped").agg(F.count("*").alias("n"), F.round(F.sum("dist_m"), 3).alias("d"))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_passages_skip_numbers_that_are_not_scheduled(spark):
    sched = spark.createDataFrame([("t", "a", 1, 0.0), ("t", "b", 2, 30.0), ("t", "d", 4, 90.0), ("t", "e", 5, 100.0)], "trip_id string, stop_id string, stop_sequence int, dist double")
    p = spark.createDataFrame([ping("v", "t", "a", 40.70, 0), ping("v", "t", "e", 40.71, 100), ping("v", "t", "b", 40.71, 160)], PING)
    got = {r["stop_sequence"]: (r["arr"], r["interpolated"]) for r in matched(p, sched).collect()}
    assert got == {1: (50.0, False), 2: (65.0, True), 4: (95.0, True)}


def test_asof_takes_the_last_row_at_or_before(spark):
    left = spark.createDataFrame([(1, 5), (1, 10), (2, 1)], "k int, t int")
    right = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (1, 11, "c")], "k int, u int, v string")
    got = {(r["k"], r["t"]): (r["u_asof"], r["v_asof"]) for r in joins.asof_join(left, right, ["k"], "t", "u", ["v"]).collect()}
    assert got == {(1, 5): (5, "a"), (1, 10): (9, "b"), (2, 1): (None, None)}


def test_range_join_is_half_open(spark):
    p = spark.createDataFrame([(0,), (9,), (10,), (25,)], "d long")
    s = spark.createDataFrame([("x", 0, 10), ("y", 10, 26), ("z", 5, 5)], "n string, a long, b long")
    assert sorted((r["d"], r["n"]) for r in joins.range_join(p, s, "d", "a", "b", 7).collect()) == [(0, "x"), (9, "x"), (10, "y"), (25, "y")]


def test_weighted_mean_needs_its_weights(spark):
    df = spark.createDataFrame([(1, 2.0, 0.5), (1, 4.0, 0.5), (2, 2.0, 0.6), (2, None, 0.4)], "k int, v double, w double")
    got = {r["k"]: r["m"] for r in df.groupBy("k").agg(aggregates.weighted_mean(F.col("v"), F.col("w")).alias("m")).collect()}
    assert got == {1: 3.0, 2: None}


def test_digest_tells_null_from_missing_and_counts_repeats(spark):
    a = spark.createDataFrame([(1, None), (1, "x")], "k int, v string")
    d = lambda df: df.select("n", "lo", "hi").collect()
    assert d(aggregates.set_digest(a, ["k"])) == d(aggregates.set_digest(a.orderBy(F.desc("v")).repartition(3), ["k"]))
    assert d(aggregates.set_digest(a, ["k"])) != d(aggregates.set_digest(a.union(a), ["k"]))
    assert d(aggregates.set_digest(a, ["k"])) != d(aggregates.set_digest(a.fillna(""), ["k"]))


def test_sessions_split_above_the_gap_only(spark):
    df = spark.createDataFrame([("u", 0), ("u", 10), ("u", 21)], "u string, t long")
    assert [r["session"] for r in windows.with_sessions(df, ["u"], "t", 10).orderBy("t").collect()] == [1, 1, 2]


def test_fit_recovers_known_coefficients(spark):
    u = lambda k: F.shiftrightunsigned(F.xxhash64(F.lit(k), "id"), 11).cast("double") / F.lit(2.0**53)
    df = spark.range(20000).select("id", (u(1) * 4 - 2).alias("x"), (u(2) * 4 - 2).alias("z"), u(3).alias("u"))
    df = df.withColumn("y", (F.col("u") < scores.logistic(1.5 * F.col("x") - 0.7 * F.col("z") - 0.4)).cast("int"))
    fit = fit_logistic(df, ["x", "z"], "y", 1.0)
    assert abs(fit.coef["x"] - 1.5) < 0.1 and abs(fit.coef["z"] + 0.7) < 0.1 and abs(fit.intercept + 0.4) < 0.1
    assert fit.rounds < 12


def test_cross_validation_holds_groups_together(spark):
    df = spark.range(300).select((F.col("id") % 10).cast("string").alias("g"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    cv = cross_validated(df, ["x"], "y", "g", 3)
    assert cv.count() == 300
    assert cv.groupBy("g").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0


def test_bootstrap_brackets_the_ratio_and_agrees(spark):
    df = spark.range(4000).select((F.col("id") % 80).alias("c"), (F.col("id") % 5).cast("double").alias("a"), F.lit(2.0).alias("b"))
    x = aggregates.bootstrap_ratio(df, "c", "a", "b", 100, 1).first()
    y = aggregates.bootstrap_ratio(df.repartition(5), "c", "a", "b", 100, 1).first()
    assert x["lo"] <= 1.0 <= x["hi"] and math.isclose(x["lo"], y["lo"]) and math.isclose(x["hi"], y["hi"])


def test_route_class(spark):
    rows = spark.createDataFrame([("x1",), ("BxM2",), ("M15+",), ("B6",), (None,)], "r string")
    assert [r[0] for r in rows.select(texts.route_class(F.col("r"))).collect()] == ["express", "express", "sbs", "local", None]


def test_previous_other_matches_a_plain_search(spark):
    """Few vehicles and trips, equal times and nulls: the bounded walk finds what a search of all earlier rows finds."""
    import random

    from stormline.operators.windows import previous_other

    rnd = random.Random(11)
    rows = [(i, rnd.choice("ab"), rnd.randint(0, 60), rnd.choice([None, *"uvwx"]), rnd.choice("1234")) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, place string, at long, vehicle string, trip string")
    for width in (86_400, 7, 1):  # slices of many rows and of few
        got = {r["id"]: r["before"] for r in previous_other(df, ["place"], "at", ["vehicle", "trip"], "before", width).collect()}
        for i, place, at, vehicle, trip in rows:
            want = [a for _, p, a, v, t in rows if p == place and a < at and None not in (v, vehicle) and v != vehicle and t != trip]
            assert got[i] == max(want, default=None)
    assert previous_other(df.limit(0), ["place"], "at", ["vehicle", "trip"], "before").count() == 0


def test_previous_other_cuts_one_time_and_one_slice_into_blocks(spark, monkeypatch):
    """Blocks of three tuples: times that go on in the next block, repeated rows and null keys give what a plain search gives."""
    import random

    from stormline.operators import windows

    monkeypatch.setattr(windows, "BLOCK", 3)
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["a", None]), rnd.choice([1.0, 2.0, 2.0, 2.0, 3.0, 9.0]) + rnd.choice([0.0, 0.5]), rnd.choice("uvw"), rnd.choice([*"123", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, place string, at double, vehicle string, trip string")
    found = windows.previous_other(df, ["place"], "at", ["vehicle", "trip"], "before")
    assert found.columns == [*df.columns, "before"]
    got = {r["id"]: r["before"] for r in found.collect()}
    assert len(got) == len(rows)
    for i, place, at, vehicle, trip in rows:
        want = [a for _, p, a, v, t in rows if p == place and a < at and None not in (t, trip) and v != vehicle and t != trip]
        assert got[i] == max(want, default=None)


def test_bunching_is_below_half_of_the_plan(spark):
    from stormline.plans.passages import bunched

    rows = spark.createDataFrame([(299, 600), (300, 600), (None, 600), (10, None)], "h long, p long")
    assert [r[0] for r in rows.select(bunched(F.col("h"), F.col("p"))).collect()] == [True, False, None, None]


def test_days_without_rows_of_a_later_era(spark, tmp_path):
    from stormline.sources import lake

    path = str(tmp_path / "lake")
    spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v long, date string").write.partitionBy("date").parquet(path)
    spark.createDataFrame([(3, 7, "2024-01-03")], "v long, extra long, date string").write.mode("append").partitionBy("date").parquet(path)
    quiet = lake.service_day(spark, path, "2024-01-01", ["extra"], {"extra": "bigint"})
    assert sorted((r["v"], r["extra"]) for r in quiet.collect()) == [(1, None), (2, None)]
    busy = lake.service_day(spark, path, "2024-01-02", ["extra"], {"extra": "bigint"})
    assert sorted((r["v"], r["extra"]) for r in busy.collect()) == [(2, None), (3, 7)]


def test_snapshots_are_thinned_in_order_of_time(spark):
    rows = [("a", 1, 0, 10), ("a", 1, 5, 11), ("a", 1, 10, 10), ("a", 1, 12, 12), ("a", 1, 12, 13), ("a", 1, 30, 12), ("a", 2, 13, 12), ("b", 1, 3, 9), ("b", 1, 3, 9)]
    df = spark.createDataFrame(rows, "feed string, day int, fetched_at long, header_ts long")
    want, last = [], {}
    for feed, day, at, head in sorted(set(rows)):
        before = last.get((feed, day))
        if before is None or (at - before[0] >= 10 and head != before[1]):
            last[feed, day] = (at, head)
            want.append((feed, day, at, head))
    got = archives.chosen_snapshots(df, "header_ts", 10)
    assert sorted(tuple(r) for r in got.collect()) == want == [("a", 1, 0, 10), ("a", 1, 12, 12), ("a", 2, 13, 12), ("b", 1, 3, 9)]
    assert archives.chosen_snapshots(df.limit(0), "header_ts", 10).count() == 0


def test_nearest_in_rings_matches_all_pairs(spark):
    """Sites in clusters and far away, rows between them, equal places and missing ones."""
    import random

    rnd = random.Random(3)
    sites = [(i, -74 + rnd.gauss(0, 0.01) + (i % 3) * 0.3, 40.7 + rnd.gauss(0, 0.01) - (i % 2) * 0.2) for i in range(300)] + [(900, -73.0, 42.0), (901, -73.0, 42.0), (902, None, 40.0)]
    rows = [(i, -74.2 + rnd.random() * 1.4, 40.3 + rnd.random() * 1.8) for i in range(200)] + [(500, -73.0, 42.0), (501, None, 1.0)]
    left, right = spark.createDataFrame(rows, "id int, lon double, lat double"), spark.createDataFrame(sites, "site int, x double, y double")
    few = {r["id"]: (r["site"], r["dist_m"]) for r in joins.nearest(left, right, ["id"], ("lon", "lat"), ("x", "y"), "site", few=1000).collect()}
    many = {r["id"]: (r["site"], r["dist_m"]) for r in joins.nearest(left, right, ["id"], ("lon", "lat"), ("x", "y"), "site", few=10).collect()}
    assert few == many and len(few) == 201 and few[500] == (900, 0.0)
    assert joins.nearest(left.limit(0), right, ["id"], ("lon", "lat"), ("x", "y"), "site", few=10).count() == 0
    assert joins.nearest(left, right.limit(0), ["id"], ("lon", "lat"), ("x", "y"), "site").count() == 0


def shared_places(spark):
    """90 left and 600 right rows on few places: plain ones, a crowded one, null and repeated ones."""
    left = spark.range(90).select("id", (F.lit(-74.0) + F.col("id") % 9 * 0.0013).alias("x1"), (F.lit(40.7) + F.col("id") % 4 * 0.0011).alias("y1"))
    right = spark.range(600).select(F.col("id").alias("site"), F.when(F.col("id") % 50 != 7, F.lit(-74.0) + F.col("id") % 11 * 0.0009).alias("x2"), (F.lit(40.7) + F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 5) * 0.0008).alias("y2"))
    return left.union(left.where("id < 5")), right.union(right.where("site < 20"))


def test_radius_join_meets_places_once_and_loses_no_row(spark, monkeypatch):
    monkeypatch.setattr(joins, "SLOT_ROWS", 8)
    left, right = shared_places(spark)
    d = geo.geodesic_m(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    want = sorted(map(tuple, left.crossJoin(right).withColumn("dist_m", d).where("dist_m <= 150").collect()))
    got = joins.radius_join(left, right, ("x1", "y1"), ("x2", "y2"), 150.0)
    assert sorted(map(tuple, got.collect())) == want
    met = joins.near_places(left, right, ("x1", "y1"), ("x2", "y2"), 150.0).collect()
    assert len(met) == len({w[1:3] + w[4:6] for w in want}) < len(want) / 20


@pytest.mark.parametrize("k", [1, 3, 40])
def test_nearest_in_radius_takes_the_smallest_ids_of_equal_places(spark, k):
    left, right = shared_places(spark)
    all_ = joins.radius_join(left, right, ("x1", "y1"), ("x2", "y2"), 150.0)
    want = sorted((r["id"], r["rank"], r["site"], r["dist_m"]) for r in joins.top_n(all_, ["id"], [F.asc("dist_m"), F.asc("site")], k).collect())
    got = joins.nearest_in_radius(left, right, ["id"], ("x1", "y1"), ("x2", "y2"), "site", 150.0, k).collect()
    assert sorted((r["id"], r["rank"], r["site"], r["dist_m"]) for r in got) == want


def test_box_join_tests_a_shape_once_a_place(spark):
    left, right = shared_places(spark)
    boxes = left.distinct().select("id", *[(F.col(c) + s * 0.001).alias(f"{c}{n}") for c in ("x1", "y1") for n, s in (("a", -1), ("b", 1))])
    inside = (F.col("x2") + F.col("y2")) <= F.col("x1b") + F.col("y1b") - 0.0005
    want = right.crossJoin(boxes).where(F.col("x2").between(F.col("x1a"), F.col("x1b")) & F.col("y2").between(F.col("y1a"), F.col("y1b")) & inside)
    got = joins.box_join(right, boxes, ("x2", "y2"), ("x1a", "y1a", "x1b", "y1b"), 0.002, inside)
    assert sorted(map(str, got.select("site", "id").collect())) == sorted(map(str, want.select("site", "id").collect()))


def test_labels_take_an_event_once_a_unit(spark):
    from stormline.plans import labels

    left, right = shared_places(spark)
    seen = right.select((F.col("site") % 3).alias("event"), F.col("x2").alias("x"), F.col("y2").alias("y"), F.col("site").cast("double").alias("depth"), (F.col("site") % 4).alias("zone"))
    units = left.distinct().select("id", F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("id") % 5).alias("zone"))
    d = geo.geodesic_m(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    want = left.crossJoin(right).where(d <= 150).groupBy("id", (F.col("site") % 3).alias("event")).agg(F.max("site").cast("double").alias("depth"))
    got = labels.in_radius(seen, units, ("x", "y"), 150.0, "id", "event", "depth")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    zones = labels.in_zone(seen, units, "zone", "id", "event").collect()
    assert len(zones) == len(set(map(tuple, zones))) == 3 * 72


def test_nearest_of_few_sites_sorts_no_rows(spark):
    left, right = shared_places(spark)
    sites = right.where("site < 20")
    d = geo.geodesic_m(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    want = left.distinct().crossJoin(sites.dropna()).groupBy("id").agg(F.min(F.struct(d.alias("d"), "site")).alias("m")).select("id", "m.site", F.col("m.d").alias("dist_m"))
    got = joins.nearest(left, sites, ["id"], ("x1", "y1"), ("x2", "y2"), "site")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_passages_are_found_once_for_rows_and_blocks(spark, sf_dir):
    """d6_passage_facts: what its headways are read from holds no window over pings any more."""
    import __spark_entry__ as entry

    facts = entry.queries()["d6_passage_facts"](spark, sf_dir)
    assert "Window" not in facts._jdf.queryExecution().optimizedPlan().toString()
    assert facts.count() > 0


def test_sketches_are_not_kept_by_pair(spark, sf_dir):
    """a2_approx_distinct: no aggregate that groups by pairs has a sketch."""
    import re

    import __spark_entry__ as entry

    plan = entry.queries()["a2_approx_distinct"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    aggregates = re.findall(r"Aggregate\(keys=\[(.*?)\], functions=\[(.*?)\]", plan)
    assert any("approx_count_distinct" in f for _, f in aggregates)
    assert not any("l_partkey" in keys and "approx_count_distinct" in f for keys, f in aggregates)


def test_versions_of_a_day_match_a_plain_search(spark):
    """Long, short, empty and open spans, late publication, ties and nulls; no day is joined to a span."""
    import datetime
    import random

    from stormline.plans.versions import resolved

    rnd = random.Random(3)
    day0 = datetime.date(1969, 11, 20)
    at = lambda n: None if n is None else day0 + datetime.timedelta(days=n)
    versions = []
    for i in range(150):
        a = rnd.randint(0, 120)
        b = rnd.choice([a - 1, a, a + rnd.randint(0, 40), 2_000_000])
        versions.append((i % 90, rnd.choice(["x", "y", None]), rnd.choice([None, a, a + 3, a + 3, a - 40, 110]), rnd.choice([a, a, a, None]), rnd.choice([b, b, b, None])))
    days = [(c, at(n)) for c in ("x", "y", "z", None) for n in range(-5, 140)] + [("x", at(7)), ("x", None)]
    v = spark.createDataFrame([(i, c, at(p), at(a), at(b)) for i, c, p, a, b in versions], "version long, code string, published date, valid_from date, valid_to date")
    d = spark.createDataFrame(days, "code string, day date")
    found = resolved(d, v, "code", "day")
    assert found.columns == ["code", "day", "version"]
    condition = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert condition and not any("<=" in line or ">=" in line for line in condition)
    got = found.collect()
    assert len(got) == len(set(days))
    for code, day, version in got:
        hit = [(-p, i) for i, c, p, a, b in versions if None not in (day, code, p, a, b) and c == code and at(p) <= day + datetime.timedelta(days=1) and at(a) <= day <= at(b)]
        assert version == (min(hit)[1] if hit else None)


def test_multiset_difference_counts_both_builds_once(spark, monkeypatch):
    """Copies, nulls and rows of one build alone; more copies than one array gives; as many tasks as the rows need."""
    from collections import Counter

    from stormline.operators import sets

    before = [(1, "a")] * 7 + [(2, None)] * 3 + [(None, None)] + [(3, "c")] * 2500 + [(4, "d")]
    after = [(1, "a")] * 2 + [(2, None)] * 5 + [(None, None)] + [(5, "e")] * 2
    df = lambda rows: spark.createDataFrame(rows, "k int, v string")
    monkeypatch.setattr(sets, "TASK_ROWS", 100)
    found = sets.multiset_diff(df(before), df(after))
    assert found.columns == ["side", "k", "v"]
    a, b = Counter(before), Counter(after)
    want = Counter({("removed", *r): n for r, n in (a - b).items()}) + Counter({("added", *r): n for r, n in (b - a).items()})
    assert Counter(tuple(r) for r in found.collect()) == want
    assert found.rdd.getNumPartitions() >= len(before + after) // 100
    assert sets.multiset_diff(df([]), df([])).count() == 0
