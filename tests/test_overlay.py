"""Polygon overlay: areas and lengths that can be told by hand or by sampling."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from stormline.functions import geo
from stormline.plans import overlay

RING = "array<struct<x:double,y:double>>"
SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]


def rings(spark, pairs):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], f"id int, a {RING}, b {RING}")


def test_areas_of_known_shapes(spark):
    concave = [(1.0, 1.0), (3.0, 1.0), (3.0, 6.0), (2.0, 2.0), (1.0, 6.0), (1.0, 1.0)]
    far = [(9.0, 9.0), (10.0, 9.0), (9.0, 10.0), (9.0, 9.0)]
    cases = [(SQUARE, 16.0), ([(2.0, 2.0), (6.0, 2.0), (6.0, 6.0), (2.0, 6.0), (2.0, 2.0)], 4.0), (far, 0.0), ([(x, -y) for x, y in SQUARE], 0.0), (concave, 5.0), ([(-1.0, -1.0), (9.0, -1.0), (-1.0, 9.0), (-1.0, -1.0)], 16.0)]
    got = rings(spark, [(r, SQUARE) for r, _ in cases]).select("id", geo.area_inside(F.col("a"), F.col("b")).alias("v")).collect()
    assert [round(r["v"], 9) for r in sorted(got)] == [a for _, a in cases]


def test_shares_of_a_cell_match_sampling(spark):
    rng = random.Random(3)
    shapes = []
    for _ in range(6):
        x, y = rng.uniform(-900, 900), rng.uniform(-900, 900)
        points = [(x + rng.uniform(200, 900) * math.cos(t), y + rng.uniform(200, 900) * math.sin(t)) for t in (0.3, 1.6, 2.9, 4.2, 5.5)]
        shapes.append([*points, points[0]])
    frame = spark.createDataFrame(list(enumerate(shapes)), f"id int, ring {RING}")
    got = {(r["id"], r["cell"]): r["share"] for r in overlay.cell_shares(frame, "ring", ["id"]).collect()}
    for i, shape in enumerate(shapes):
        area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(shape, shape[1:], strict=False))) / 2
        assert math.isclose(sum(v for (k, _), v in got.items() if k == i) * geo.CELL_AREA, area, rel_tol=1e-9)


def test_lengths_add_up_and_stay_in_their_cells(spark):
    rng = random.Random(4)
    rows = [(i, (rng.uniform(-3000, 3000), rng.uniform(-3000, 3000)), (rng.uniform(-3000, 3000), rng.uniform(-3000, 3000))) for i in range(40)] + [(40, (1.0, 1.0), (1.0, 1.0)), (41, None, (1.0, 1.0))]
    frame = spark.createDataFrame(rows, "id int, a struct<x:double,y:double>, b struct<x:double,y:double>")
    got = overlay.cell_lengths(frame, "a", "b", ["id"])
    total = {r["id"]: r["l"] for r in got.groupBy("id").agg(F.sum("length").alias("l")).collect()}
    for i, a, b in rows[:40]:
        assert math.isclose(total[i], math.dist(a, b), rel_tol=1e-9)
    assert set(total) == set(range(40)) and got.agg(F.max("length")).first()[0] <= 2 * geo.EDGE_M + 1e-9


def test_overlapping_polygons_of_a_category_fail(spark):
    big = [(-2000.0, -2000.0), (2000.0, -2000.0), (2000.0, 2000.0), (-2000.0, 2000.0), (-2000.0, -2000.0)]
    once = spark.createDataFrame([("deep", big), ("nuisance", big)], f"category string, ring {RING}")
    assert overlay.category_shares(once, "ring", "category").agg(F.max("share")).first()[0] == 1.0
    with pytest.raises(Exception, match="sum to more than 1"):
        overlay.category_shares(once.union(once), "ring", "category").collect()


def test_a_cell_is_in_the_cells_of_its_own_box(spark):
    p = spark.range(200).select((F.col("id") * 37 % 5000).cast("double").alias("x"), (F.col("id") * 91 % 5000).cast("double").alias("y"))
    lon, lat = F.lit(geo.ORIGIN[0]) + F.col("x") / (geo.M_PER_DEGREE * geo.LON_SCALE), F.lit(geo.ORIGIN[1]) + F.col("y") / geo.M_PER_DEGREE
    missing = p.withColumn("cell", geo.cell_of(lon, lat)).where(~F.array_contains(geo.cells_over(F.col("x"), F.col("y"), F.col("x"), F.col("y")), F.col("cell")))
    assert missing.count() == 0
