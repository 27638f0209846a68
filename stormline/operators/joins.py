"""Join operators that Spark has no single call for: as-of, range, radius and polygon joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormline.functions.geo import M_PER_DEGREE, cell_of, geodesic_m
from stormline.operators.scratch import stored
from stormline.operators.sets import top_n


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, carry: Sequence[str]) -> DataFrame:
    """Each left row with the `carry` values of the last right row of its keys at or before it.

    One union and one window: no row meets more than its own group. `right_at` of the row that was
    found comes along; among right rows of one time the largest values win.
    """
    tagged_left = left.select(F.struct("*").alias("_row"), *keys, F.col(left_at).alias("_at"), F.lit(None).cast(right.select(F.struct(right_at, *carry).alias("x")).schema["x"].dataType).alias("_hit"))
    tagged_right = right.select(F.lit(None).cast(tagged_left.schema["_row"].dataType).alias("_row"), *keys, F.col(right_at).alias("_at"), F.struct(right_at, *carry).alias("_hit"))
    # Right rows come before left rows of the same time.
    order = Window.partitionBy(*keys).orderBy("_at", F.col("_row").isNotNull(), F.col("_hit").asc_nulls_first())
    both = tagged_left.unionByName(tagged_right).withColumn("_found", F.last("_hit", ignorenulls=True).over(order))
    return both.where(F.col("_row").isNotNull()).select("_row.*", *[F.col(f"_found.{c}").alias(f"{c}_asof") for c in [right_at, *carry]])


def range_join(points: DataFrame, spans: DataFrame, at: str, start: str, end: str, width: int, keys: Sequence[str] = (), how: str = "inner") -> DataFrame:
    """Points with the spans [start, end) that hold them: equi-join on buckets of `width`, then the exact test.

    A span is in every bucket that it touches, a point in one, so no pair comes twice. Spans without
    length hold nothing.
    """
    bucket = lambda c: F.floor(F.col(c) / width)
    wide = spans.where(F.col(end) > F.col(start)).withColumn("_bucket", F.explode(F.sequence(bucket(start), F.floor((F.col(end) - 1) / width))))
    narrow = points.withColumn("_bucket", bucket(at))
    on = [narrow["_bucket"] == wide["_bucket"], narrow[at] >= wide[start], narrow[at] < wide[end]]
    on += [narrow[k].eqNullSafe(wide[k]) for k in keys]
    joined = narrow.join(wide, on, how)
    for k in keys:
        joined = joined.drop(wide[k])
    return joined.drop(narrow["_bucket"]).drop(wide["_bucket"])


def tasks(df: DataFrame) -> int:
    """Tasks for a step that writes far more than it reads: the session's partitions, which a small input would otherwise lose."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)


def near_places(left: DataFrame, right: DataFrame, left_xy: tuple[str, str], right_xy: tuple[str, str], radius_m: float, top_lat: float = 60.0) -> DataFrame:
    """(_x1, _y1, _x2, _y2, dist_m): places of `left` and of `right` at most radius_m apart, each pair once, however many rows share a place."""
    step = radius_m / M_PER_DEGREE
    wide = step / max(0.01, _cos(top_lat))
    cell = lambda lon, lat: (F.floor(lon / wide), F.floor(lat / step))
    places = lambda df, xy, x, y: df.where(F.col(xy[0]).isNotNull() & F.col(xy[1]).isNotNull()).select(F.col(xy[0]).alias(x), F.col(xy[1]).alias(y)).distinct()
    gx, gy = cell(F.col("_x2"), F.col("_y2"))
    near = places(right, right_xy, "_x2", "_y2").withColumn("_gx", gx).withColumn("_gy", gy)
    lx, ly = cell(F.col("_x1"), F.col("_y1"))
    shifts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    spread = places(left, left_xy, "_x1", "_y1").withColumn("_s", F.explode(shifts)).withColumn("_gx", lx + F.col("_s.i")).withColumn("_gy", ly + F.col("_s.j")).drop("_s")
    dist = geodesic_m(F.col("_x1"), F.col("_y1"), F.col("_x2"), F.col("_y2"))
    met = spread.repartition(tasks(left), "_gx", "_gy").join(near, ["_gx", "_gy"])
    return met.drop("_gx", "_gy").withColumn("dist_m", dist).where(F.col("dist_m") <= radius_m)


SLOT_ROWS = 256


def at_places(pairs: DataFrame, df: DataFrame, xy: tuple[str, str], keys: tuple[str, str]) -> DataFrame:
    """`pairs`, whose columns `keys` name a place, with every row of `df` at that place; the columns `keys` go.

    Rows of a place are dealt to slots of some SLOT_ROWS by a hash, and a pair goes to each slot, so that no task has to write all of a crowded place.
    """
    x, y = keys
    rows = df.withColumn(x, F.col(xy[0])).withColumn(y, F.col(xy[1]))
    slots = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(F.ceil(F.count("*") / SLOT_ROWS).alias("_slots"))
    dealt = rows.join(slots, [x, y]).withColumn("_slot", F.pmod(F.xxhash64(*df.columns), F.col("_slots"))).drop("_slots")
    sent = pairs.join(slots, [x, y]).withColumn("_slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slots") - 1))).drop("_slots")
    return sent.repartition(tasks(df), x, y, "_slot").join(dealt, [x, y, "_slot"]).drop(x, y, "_slot")


def radius_join(left: DataFrame, right: DataFrame, left_xy: tuple[str, str], right_xy: tuple[str, str], radius_m: float, top_lat: float = 60.0) -> DataFrame:
    """Pairs at most radius_m apart, with `dist_m`: grid cells of that size, the neighbours too, then the exact distance.

    Places meet first, once a pair of places; then the rows at them join. So distances cost by places, and only what comes out costs by rows.
    """
    met = near_places(left, right, left_xy, right_xy, radius_m, top_lat)
    both = at_places(at_places(met, left, left_xy, ("_x1", "_y1")), right, right_xy, ("_x2", "_y2"))
    return both.select(*left.columns, *right.columns, "dist_m")


def nearest_in_radius(left: DataFrame, right: DataFrame, keys: Sequence[str], left_xy: tuple[str, str], right_xy: tuple[str, str], right_id: str, radius_m: float, k: int, top_lat: float = 60.0) -> DataFrame:
    """The k nearest right rows (ties: smaller id) within radius_m of each left key, with `dist_m` and `rank`.

    Of the rows at one place only the k smallest ids can be among the k nearest, and of a left place's neighbours only the k nearest places
    (and those that tie with the last): the rest goes before any rows meet.
    """
    few = top_n(right.where(F.col(right_xy[0]).isNotNull() & F.col(right_xy[1]).isNotNull()), list(right_xy), [F.asc(right_id)], k).drop("rank")
    by_place = Window.partitionBy("_x1", "_y1").orderBy("dist_m")
    met = near_places(left, few, left_xy, right_xy, radius_m, top_lat).withColumn("_rank", F.rank().over(by_place)).where(F.col("_rank") <= k).drop("_rank")
    both = at_places(at_places(met, left, left_xy, ("_x1", "_y1")), few, right_xy, ("_x2", "_y2"))
    return top_n(both.select(*left.columns, *right.columns, "dist_m"), list(keys), [F.asc("dist_m"), F.asc(right_id)], k)


def _cos(degrees: float) -> float:
    import math

    return math.cos(math.radians(degrees))


def box_join(points: DataFrame, boxes: DataFrame, xy: tuple[str, str], box: tuple[str, str, str, str], step: float, inside: Column) -> DataFrame:
    """Points with the shapes that hold them: shapes spread over the grid cells of their boxes, then `inside`, once for each place that points share.

    `inside` is over `xy` and columns of `boxes`; boxes' columns are named otherwise than points'.
    """
    x0, y0, x1, y1 = (F.col(c) for c in box)
    grid = lambda c: F.floor(c / step)
    wide = boxes.withColumn("_gx", F.explode(F.sequence(grid(x0), grid(x1)))).withColumn("_gy", F.explode(F.sequence(grid(y0), grid(y1))))
    places = points.select(*xy).distinct().withColumn("_gx", grid(F.col(xy[0]))).withColumn("_gy", grid(F.col(xy[1])))
    held = F.col(xy[0]).between(x0, x1) & F.col(xy[1]).between(y0, y1)
    met = wide.repartition(tasks(points), "_gx", "_gy").join(places, ["_gx", "_gy"]).where(held & inside)
    pairs = met.select(F.col(xy[0]).alias("_x"), F.col(xy[1]).alias("_y"), *boxes.columns)
    return at_places(pairs, points, xy, ("_x", "_y")).select(*points.columns, *boxes.columns)


FEW_SITES = 256


def nearest(left: DataFrame, sites: DataFrame, keys: Sequence[str], left_xy: tuple[str, str], site_xy: tuple[str, str], site_id: str, few: int = FEW_SITES) -> DataFrame:
    """Each left row's nearest site (ties: smaller id) and its distance, for any number of sites.

    Places are looked up, not rows: rows at one place share what it found. Up to `few` sites, counted first, go out to all tasks
    as one list, and each place takes the least of it. More are looked up in growing rings: a row meets the sites of its own and the
    neighbouring cells of a grid; what lies outside is at least a cell's side away, so a site nearer than that is the nearest. Rows that
    found none so near go on to a grid twice as wide, until one cell spans all. The first grid has a few sites a cell.
    Rows and sites without a place have no part. Longitudes must not cross the date line.
    """
    lon1, lat1, lon2, lat2 = (F.col(c) for c in (*left_xy, *site_xy))
    known = sites.where(lon2.isNotNull() & lat2.isNotNull()).groupBy(lon2.alias("_x"), lat2.alias("_y")).agg(F.min(site_id).alias("_site"))
    all_ = left.where(lon1.isNotNull() & lat1.isNotNull()).select(*keys, lon1.alias("_lx"), lat1.alias("_ly")).distinct()
    rows = all_.select("_lx", "_ly").distinct()
    d = geodesic_m(F.col("_lx"), F.col("_ly"), F.col("_x"), F.col("_y"))
    best = F.min(F.struct(d.alias("d"), "_site")).alias("_m")
    out = lambda df: all_.join(df, ["_lx", "_ly"]).select(*keys, F.col("_m._site").alias(site_id), F.col("_m.d").alias("dist_m"))
    box = known.agg(F.count("*").alias("n"), F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1")).first()
    if box["n"] <= few:
        listed = known.agg(F.collect_list(F.struct("_site", "_x", "_y")).alias("_sites"))  # one row of at most `few` sites
        each = F.transform("_sites", lambda t: F.struct(geodesic_m(F.col("_lx"), F.col("_ly"), t["_x"], t["_y"]).alias("d"), t["_site"].alias("_site")))
        return out(rows.crossJoin(F.broadcast(listed)).where(F.size("_sites") > 0).select("_lx", "_ly", F.array_min(each).alias("_m")))
    ends = rows.agg(F.min("_lx").alias("x0"), F.max("_lx").alias("x1"), F.min("_ly").alias("y0"), F.max("_ly").alias("y1")).first()
    if ends["x0"] is None:
        return out(rows.crossJoin(F.broadcast(known.limit(0))).groupBy("_lx", "_ly").agg(best))
    across = max(max(box["x1"], ends["x1"]) - min(box["x0"], ends["x0"]), max(box["y1"], ends["y1"]) - min(box["y0"], ends["y0"]), 1e-6)
    narrow = _cos(min(89.0, max(abs(v) for v in (box["y0"], box["y1"], ends["y0"], ends["y1"]))))  # a degree of longitude is shortest here
    step = max((box["x1"] - box["x0"]) * (box["y1"] - box["y0"]) * 4 / box["n"], 1e-12) ** 0.5
    shifts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    found, open_ = None, stored(rows, "rows")
    while True:
        last = step >= across
        sure = 0.99 * M_PER_DEGREE * step * narrow
        cells = known.select("*", F.floor(F.col("_x") / step).alias("_gx"), F.floor(F.col("_y") / step).alias("_gy"))
        spread = open_.withColumn("_s", F.explode(shifts)).withColumn("_gx", F.floor(F.col("_lx") / step) + F.col("_s.i")).withColumn("_gy", F.floor(F.col("_ly") / step) + F.col("_s.j"))
        met = spread.join(cells, ["_gx", "_gy"]).groupBy("_lx", "_ly").agg(best)
        near = stored(met if last else met.where(F.col("_m.d") <= sure), "near")
        found = near if found is None else found.unionByName(near)
        if last:
            return out(found)
        open_ = stored(open_.join(near, ["_lx", "_ly"], "left_anti"), "rows")
        if open_.isEmpty():
            return out(found)
        step *= 2


def members(units: DataFrame, unit: str, parent: str) -> DataFrame:
    """(unit, member) of each unit with itself and with its children: an OR join as two equi edges."""
    own = units.select(F.col(unit).alias("unit"), F.col(unit).alias("member"))
    children = units.where(F.col(parent).isNotNull()).select(F.col(parent).alias("unit"), F.col(unit).alias("member"))
    return own.union(children).distinct()


def spine(keys: DataFrame, name: str, first: int, last: int, step: int = 1) -> DataFrame:
    """Every key with every step from first to last."""
    return keys.distinct().withColumn(name, F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"), F.lit(step).cast("long"))))


def with_cell(df: DataFrame, lon: str = "lon", lat: str = "lat", name: str = "cell") -> DataFrame:
    return df.withColumn(name, cell_of(F.col(lon), F.col(lat)))


def semi_counts(left: DataFrame, right: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of `left` with and without a partner."""
    return left.join(right, list(on), "left_semi"), left.join(right, list(on), "left_anti")
