"""Distances, cells and polygons as columns, on longitudes and latitudes in degrees."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS 84.
AXIS_M = 6378137.0
FLAT = 1 / 298.257223563
# The local plane of the hexagonal cells: its origin, and a cell's edge in metres.
ORIGIN = (-74.0, 40.7)
EDGE_M = 500.0
M_PER_DEGREE = 111_320.0
LON_SCALE = 0.758
BIAS = 1 << 20


def geodesic_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres on the spheroid by the Andoyer-Lambert formula.

    Its relative error is about 1e-5: a metre over a degree, a few millimetres over a bus leg.
    """
    r = F.radians
    halves = {"p": r((lat1 + lat2) / 2), "q": r((lat1 - lat2) / 2), "d": r((lon1 - lon2) / 2)}
    squares = F.struct(*[F.pow(f(v), 2).alias(f"{n}{k}") for k, v in halves.items() for n, f in (("s", F.sin), ("c", F.cos))])

    def arc(t: Column) -> Column:
        s, c = t["sq"] * t["cd"] + t["cp"] * t["sd"], t["cq"] * t["cd"] + t["sp"] * t["sd"]
        return F.struct(s.alias("s"), c.alias("c"), *[t[n].alias(n) for n in ("sp", "cp", "sq", "cq")])

    def metres(t: Column) -> Column:
        s, c = t["s"], t["c"]

        def fixed(w: Column, ratio: Column) -> Column:
            fix = (3 * ratio - 1) / (2 * c) * t["sp"] * t["cq"] - (3 * ratio + 1) / (2 * s) * t["cp"] * t["sq"]
            return 2 * w * AXIS_M * (1 + FLAT * fix)

        return F.when(s == 0, F.lit(0.0)).otherwise(let(F.atan(F.sqrt(s / c)), lambda w: let(F.sqrt(s * c) / w, lambda ratio: fixed(w, ratio))))

    # each step is a value of its own: written out, the sines stand in the expression some fifty times
    return let(let(squares, arc), metres)


def plane_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Metres east and north of the origin, on a plane that suits one city."""
    return (lon - ORIGIN[0]) * (M_PER_DEGREE * LON_SCALE), (lat - ORIGIN[1]) * M_PER_DEGREE


def cell_of(lon: Column, lat: Column) -> Column:
    """The hexagonal cell of a point: its axial pair, rounded in cube coordinates, in one long."""
    x, y = plane_xy(lon, lat)
    q, r = (x * (3**0.5 / 3) - y / 3) / EDGE_M, y * (2 / 3) / EDGE_M
    s = -q - r
    rq, rr, rs = F.floor(q + 0.5), F.floor(r + 0.5), F.floor(s + 0.5)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    fq = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    fr = F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr)
    return ((fq + BIAS) * (2 * BIAS) + (fr + BIAS)).cast("long")


def cell_center(cell: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a cell's centre."""
    q, r = F.floor(cell / (2 * BIAS)) - BIAS, cell % (2 * BIAS) - BIAS
    x, y = (q * 3**0.5 + r * (3**0.5 / 2)) * EDGE_M, r * 1.5 * EDGE_M
    return F.lit(ORIGIN[0]) + x / (M_PER_DEGREE * LON_SCALE), F.lit(ORIGIN[1]) + y / M_PER_DEGREE


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a closed ring (array of structs x, y; last point = first) covers a point, by ray parity."""
    n = F.size(ring) - 1
    hits = F.aggregate(
        F.sequence(F.lit(1), n), F.lit(0),
        lambda acc, i: acc + F.when(
            ((F.element_at(ring, i)["y"] > y) != (F.element_at(ring, i + 1)["y"] > y))
            & (x < (F.element_at(ring, i + 1)["x"] - F.element_at(ring, i)["x"]) * (y - F.element_at(ring, i)["y"])
               / (F.element_at(ring, i + 1)["y"] - F.element_at(ring, i)["y"]) + F.element_at(ring, i)["x"]), 1).otherwise(0),
    )
    return F.when(n < 3, F.lit(False)).otherwise(hits % 2 == 1)


def ring_area(ring: Column) -> Column:
    """The shoelace area of a closed ring, unsigned."""
    twice = F.aggregate(
        F.sequence(F.lit(1), F.size(ring) - 1), F.lit(0.0),
        lambda a, i: a + (F.element_at(ring, i)["x"] * F.element_at(ring, i + 1)["y"] - F.element_at(ring, i + 1)["x"] * F.element_at(ring, i)["y"]),
    )
    return F.abs(twice) / 2


def overlap(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
    """Length that two intervals share, 0 if they don't meet."""
    return F.greatest(F.least(hi1, hi2) - F.greatest(lo1, lo2), F.lit(0.0))


def box_share(box: tuple[Column, ...], other: tuple[Column, ...]) -> Column:
    """The part of box (x0, y0, x1, y1) that lies in the other box."""
    x0, y0, x1, y1 = box
    u0, v0, u1, v1 = other
    return overlap(x0, x1, u0, u1) * overlap(y0, y1, v0, v1) / ((x1 - x0) * (y1 - y0))


def segment_in_box(x0: Column, y0: Column, x1: Column, y1: Column, box: tuple[Column, ...]) -> Column:
    """The part (0 to 1) of a segment inside a box, by the four half-planes it meets."""
    u0, v0, u1, v1 = box
    dx, dy = x1 - x0, y1 - y0

    def enter(d: Column, lo: Column, hi: Column, at: Column) -> tuple[Column, Column]:
        a, b = (lo - at) / d, (hi - at) / d
        flat_in = (at >= lo) & (at <= hi)
        return (
            F.when(d == 0, F.when(flat_in, 0.0).otherwise(2.0)).otherwise(F.least(a, b)),
            F.when(d == 0, F.when(flat_in, 1.0).otherwise(-1.0)).otherwise(F.greatest(a, b)),
        )

    ax, bx = enter(dx, u0, u1, x0)
    ay, by = enter(dy, v0, v1, y0)
    return F.greatest(F.least(bx, by, F.lit(1.0)) - F.greatest(ax, ay, F.lit(0.0)), F.lit(0.0))


def ring_points(lon: Column, lat: Column, n: int, radius_m: float) -> Column:
    """n points at one distance around a point, as an array of structs (k, lon, lat)."""
    step = 2 * 3.141592653589793 / n
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda k: F.struct(
            k.alias("k"),
            (lon + F.cos(k * step) * (radius_m / M_PER_DEGREE) / F.cos(F.radians(lat))).alias("lon"),
            (lat + F.sin(k * step) * (radius_m / M_PER_DEGREE)).alias("lat"),
        ),
    )


def xy(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def cell_ring(cell: Column) -> Column:
    """A cell's six corners in the local plane as a closed ring, counter-clockwise."""
    q, r = F.floor(cell / (2 * BIAS)) - BIAS, cell % (2 * BIAS) - BIAS
    x, y = (q * 3**0.5 + r * (3**0.5 / 2)) * EDGE_M, r * 1.5 * EDGE_M
    half = 3**0.5 / 2 * EDGE_M
    corners = [(half, EDGE_M / 2), (0.0, EDGE_M), (-half, EDGE_M / 2), (-half, -EDGE_M / 2), (0.0, -EDGE_M), (half, -EDGE_M / 2), (half, EDGE_M / 2)]
    return F.array(*[xy(x + dx, y + dy) for dx, dy in corners])


CELL_AREA = 1.5 * 3**0.5 * EDGE_M**2


def cells_over(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """All cells whose box meets a box of the local plane."""
    wide, tall = 3**0.5 * EDGE_M, 1.5 * EDGE_M
    rows = F.sequence(F.ceil((y0 - EDGE_M) / tall), F.floor((y1 + EDGE_M) / tall))

    def row(r: Column) -> Column:
        first, last = F.ceil((x0 - wide / 2) / wide - r / 2), F.floor((x1 + wide / 2) / wide - r / 2)
        return F.transform(F.sequence(first, last), lambda q: ((q + BIAS) * (2 * BIAS) + (r + BIAS)).cast("long"))

    return F.flatten(F.transform(rows, row))


def _left_of(a: Column, b: Column, p: Column) -> Column:
    """Positive where p lies left of the line from a to b."""
    return (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def _sides(ring: Column) -> Column:
    """The sides of a closed ring as structs of two points."""
    return let(ring, lambda r: F.zip_with(F.slice(r, 1, F.size(r) - 1), F.slice(r, 2, F.size(r) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))


def clip_convex(ring: Column, clip: Column) -> Column:
    """The part of a closed ring inside a convex closed ring (counter-clockwise): one cut a side of the latter, as a fold.

    Gives a closed ring, empty if nothing is left. A ring that isn't convex may come back with sides that run to and fro
    along the border; its area is right all the same.
    """

    def cut(points: Column, side: Column) -> Column:
        def corner(p: Column, k: Column) -> Column:
            def kept(m: Column) -> Column:
                part = m["t"] / (m["t"] - m["s"])
                cross = xy(m["q"]["x"] + part * (p["x"] - m["q"]["x"]), m["q"]["y"] + part * (p["y"] - m["q"]["y"]))
                return F.when((m["s"] >= 0) & (m["t"] >= 0), F.array(p)).when(m["s"] >= 0, F.array(cross, p)).when(m["t"] >= 0, F.array(cross)).otherwise(F.slice(points, 1, 0))

            before = F.get(points, F.when(k == 0, F.size(points) - 1).otherwise(k - 1))
            measured = let(before, lambda q: F.struct(q.alias("q"), _left_of(side["a"], side["b"], p).alias("s"), _left_of(side["a"], side["b"], q).alias("t")))
            return let(measured, kept)

        return F.flatten(F.transform(points, corner))

    whole = F.transform(F.slice(ring, 1, F.size(ring) - 1), lambda p: xy(p["x"], p["y"]))
    return let(F.aggregate(_sides(clip), whole, cut), lambda left: F.concat(left, F.slice(left, 1, 1)))


def area_inside(ring: Column, clip: Column) -> Column:
    """The area that a closed ring shares with a convex one (counter-clockwise)."""

    def shoelace(part: Column) -> Column:
        parts = F.zip_with(part, F.slice(part, 2, F.size(part)), lambda a, b: F.coalesce(a["x"] * b["y"] - b["x"] * a["y"], F.lit(0.0)))
        return F.when(F.size(part) > 3, F.abs(F.aggregate(parts, F.lit(0.0), lambda s, v: s + v)) / 2).otherwise(0.0)

    return let(clip_convex(ring, clip), shoelace)


def share_inside(a: Column, b: Column, clip: Column) -> Column:
    """The part (0 to 1) of the segment from point a to point b inside a convex closed ring (counter-clockwise)."""

    def cut(acc: Column, side: Column) -> Column:
        def narrowed(m: Column) -> Column:
            at = m["s"] / (m["s"] - m["t"])
            return (
                F.when((m["s"] < 0) & (m["t"] < 0), F.struct(F.lit(1.0).alias("lo"), F.lit(0.0).alias("hi")))
                .when((m["s"] < 0) & (m["t"] >= 0), F.struct(F.greatest(acc["lo"], at).alias("lo"), acc["hi"].alias("hi")))
                .when((m["s"] >= 0) & (m["t"] < 0), F.struct(acc["lo"].alias("lo"), F.least(acc["hi"], at).alias("hi")))
                .otherwise(acc)
            )

        return let(F.struct(_left_of(side["a"], side["b"], a).alias("s"), _left_of(side["a"], side["b"], b).alias("t")), narrowed)

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
    return F.aggregate(_sides(clip), start, cut, lambda acc: F.greatest(acc["hi"] - acc["lo"], F.lit(0.0)))
