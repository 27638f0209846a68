"""F11, D26 and J15 over hexagonal cells. The SQL cuts each cell by the polygon's sides; the queries cut each polygon by the cell's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormline.catalog.roles import PINGS, pings
from stormline.functions.geo import plane_xy, xy
from stormline.plans import overlay
from stormline.registry import query, table

#: Triangles that don't overlap, in three categories, and every cell near one.
AREAS = "tri AS (SELECT s_suppkey AS id, CASE s_suppkey % 3 WHEN 0 THEN 'deep' WHEN 1 THEN 'nuisance' ELSE 'none' END AS category, 1400.0::DOUBLE * (s_suppkey % 31) AS x, 1100.0::DOUBLE * (s_suppkey // 31) AS y, s_suppkey % 7 AS k FROM supplier)"
CORNERS = "[(0.8660254037844386, 0.5), (0, 1), (-0.8660254037844386, 0.5), (-0.8660254037844386, -0.5), (0, -1), (0.8660254037844386, -0.5)]"
Q = 3**0.5


def near_cells(x: str, y: str, reach: int) -> str:
    """Cells of an x, y table within `reach` steps of the cell at its point, with their centres."""
    return f"""SELECT *, 500 * ({Q!r} * q + {Q / 2!r} * r) AS cx, 750.0 * r AS cy, (q + 1048576) * 2097152 + r + 1048576 AS cell
  FROM (SELECT *, round({x} / {500 * Q!r} - r / 2.0)::BIGINT + dq AS q FROM (SELECT *, round({y} / 750)::BIGINT + dr AS r, unnest(range(-{reach}, {reach + 1})) AS dq FROM (SELECT *, unnest(range(-{reach}, {reach + 1})) AS dr FROM src)))"""


def cut(name: str, source: str, a: str, b: str, c: str) -> str:
    """One CTE: polygons (pid, ord, x, y) of `source` cut by the half-plane a x + b y + c >= 0 of each pid's `side`."""
    return f"""{name}_s AS (SELECT v.*, {a} * v.x + {b} * v.y + {c} AS s FROM {source} v JOIN side USING (pid)),
{name}_e AS (SELECT *, coalesce(lag(x) OVER w, last_value(x) OVER f) AS px, coalesce(lag(y) OVER w, last_value(y) OVER f) AS py, coalesce(lag(s) OVER w, last_value(s) OVER f) AS ps
  FROM {name}_s WINDOW w AS (PARTITION BY pid ORDER BY ord), f AS (PARTITION BY pid ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
{name} AS (SELECT pid, 2 * ord + 1 AS ord, x, y FROM {name}_e WHERE s >= 0 UNION ALL SELECT pid, 2 * ord, px + ps / (ps - s) * (x - px), py + ps / (ps - s) * (y - py) FROM {name}_e WHERE (s >= 0) <> (ps >= 0))"""


def half_plane(ax: str, ay: str, bx: str, by: str) -> tuple[str, str, str]:
    """Left of the line from a to b."""
    return f"(({ay}) - ({by}))", f"(({bx}) - ({ax}))", f"(({by}) - ({ay})) * ({ax}) - (({bx}) - ({ax})) * ({ay})"


P1, P2, P3 = ("side.tx - 600", "side.ty - 400"), ("side.tx + 680", "side.ty - 300"), ("side.tx + 50 * side.k", "side.ty + 500")
OVERLAY = f"""{AREAS}, src AS (SELECT * FROM tri), near AS ({near_cells('x', 'y', 3)}),
side AS (SELECT row_number() OVER () AS pid, id, category, cell, x AS tx, y AS ty, k, cx, cy FROM near),
v0 AS (SELECT pid, i AS ord, cx + 500 * list_extract({CORNERS}, i)[1] AS x, cy + 500 * list_extract({CORNERS}, i)[2] AS y FROM side, (SELECT unnest(range(1, 7)) AS i)),
{cut('v1', 'v0', *half_plane(*P1, *P2))}, {cut('v2', 'v1', *half_plane(*P2, *P3))}, {cut('v3', 'v2', *half_plane(*P3, *P1))},
shares AS (SELECT pid, abs(sum(px * y - x * py)) / 2 / {1.5 * Q * 250000!r} AS share FROM (SELECT *, coalesce(lag(x) OVER w, last_value(x) OVER f) AS px, coalesce(lag(y) OVER w, last_value(y) OVER f) AS py
  FROM v3 WINDOW w AS (PARTITION BY pid ORDER BY ord), f AS (PARTITION BY pid ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) GROUP BY pid)"""


def triangles(spark, sf) -> DataFrame:
    k = F.col("s_suppkey")
    x, y = 1400.0 * (k % 31), 1100.0 * F.floor(k / 31)
    corners = [(x - 600, y - 400), (x + 680, y - 300), (x + 50 * (k % 7), y + 500)]
    category = F.when(k % 3 == 0, "deep").when(k % 3 == 1, "nuisance").otherwise("none")
    return table(spark, sf, "supplier").select(k.alias("id"), category.alias("category"), F.array(*[xy(*p) for p in [*corners, corners[0]]]).alias("ring"))


@query("f11_convex_clip", f"WITH {OVERLAY} SELECT id, cell, round(share, 8) AS share FROM shares JOIN side USING (pid) WHERE share > 1e-7")
def f11_clip(spark, sf):
    return overlay.cell_shares(triangles(spark, sf), "ring", ["id"]).where("share > 1e-7").withColumn("share", F.round("share", 8))


@query("d26_polygon_shares", f"WITH {OVERLAY} SELECT cell, category, round(least(sum(share), 1), 8) AS share FROM shares JOIN side USING (pid) GROUP BY ALL HAVING sum(share) > 1e-7")
def d26_polygons(spark, sf):
    return overlay.category_shares(triangles(spark, sf), "ring", "category").where("share > 1e-7").withColumn("share", F.round("share", 8))


@query("j15_cell_lengths", f"""
WITH {PINGS}, pt AS (SELECT vehicle_id, seq, (lon + 0.002::DOUBLE * (seq % 7) + 74.0) * {111_320.0 * 0.758!r}::DOUBLE AS x, (lat - 40.7) * 111320.0::DOUBLE AS y FROM pings),
leg AS (SELECT vehicle_id, seq, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS "by" FROM pt WINDOW w AS (PARTITION BY vehicle_id ORDER BY seq)),
src AS (SELECT *, (ax + bx) / 2 AS mx, (ay + "by") / 2 AS my FROM leg WHERE bx IS NOT NULL), near AS ({near_cells('mx', 'my', 3)}),
half AS (SELECT *, unnest([30, 90, 150, 210, 270, 330]) AS deg FROM near),
st AS (SELECT vehicle_id, seq, cell, ax, ay, bx, "by", {250 * Q!r} - cos(radians(deg - 30)) * (ax - cx) - sin(radians(deg - 30)) * (ay - cy) AS s, {250 * Q!r} - cos(radians(deg - 30)) * (bx - cx) - sin(radians(deg - 30)) * ("by" - cy) AS t FROM half),
part AS (SELECT vehicle_id, cell, sqrt((bx - ax) ** 2 + ("by" - ay) ** 2) * greatest(min(CASE WHEN s < 0 AND t < 0 THEN -1 WHEN s >= 0 AND t < 0 THEN s / (s - t) ELSE 1 END) - max(CASE WHEN s < 0 AND t >= 0 THEN s / (s - t) ELSE 0 END), 0) AS length FROM st GROUP BY vehicle_id, seq, cell, ax, ay, bx, "by")
SELECT vehicle_id, cell, round(sum(length), 5) AS length FROM part GROUP BY ALL HAVING sum(length) > 1e-4""")
def j15_lengths(spark, sf):
    from pyspark.sql import Window

    p = pings(spark, sf).withColumn("lon", F.expr("lon + 0.002D * (seq % 7)"))
    at = p.select("vehicle_id", "seq", xy(*plane_xy(F.col("lon"), F.col("lat"))).alias("a"))
    legs = at.withColumn("b", F.lead("a").over(Window.partitionBy("vehicle_id").orderBy("seq")))
    return overlay.cell_lengths(legs, "a", "b", ["vehicle_id"]).where("length > 1e-4").withColumn("length", F.round("length", 5))
