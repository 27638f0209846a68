"""D6: the whole passage fact over all pings; two trips in three have a schedule."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormline.catalog.roles import DAY0, PINGS, pings
from stormline.plans import passages
from stormline.registry import query

KEY = "vehicle_id, trip_id, start_date"
PLAN = """plan AS (
  SELECT DISTINCT trip_id, stop_id, substr(stop_id, 2)::INTEGER AS stop_sequence, CASE WHEN substr(stop_id, 2)::INTEGER % 7 <> 3 THEN substr(stop_id, 2)::INTEGER * 100.0::DOUBLE + substr(stop_id, 2)::INTEGER % 5 END AS dist,
         substr(stop_id, 2)::BIGINT * 420 + event_id % 12 * 30 - 17000 AS arrival_s, 60 + 300 * (event_id % 3) AS headway_sched_s, CASE WHEN event_id % 3 = 0 THEN 'headway' ELSE 'schedule' END AS family, event_id % 2 AS direction_id
  FROM pings WHERE trip_id IS NOT NULL AND event_id % 12 < 8)"""
COLUMNS = ["vehicle_id", "trip_id", "stop_id", "stop_sequence", "source", "arr", "interpolated", "censor_width_s", "is_first", "is_last", "delay_s", "headway_obs_s", "headway_sched_s", "family", "wait_ok", "bunched",
           "segment_s", "sched_segment_s", "segment_excess_s", "pred_last_off_s", "pred_err_s", "pred_range_s", "n_changes", "n_vehicles_on_trip"]


def plan(spark, sf):
    p = pings(spark, sf).where("trip_id IS NOT NULL AND event_id % 12 < 8")
    n = F.expr("CAST(substr(stop_id, 2) AS INT)")
    return p.select(
        "trip_id", "stop_id", n.alias("stop_sequence"), F.when(n % 7 != 3, n * 100.0 + n % 5).alias("dist"), (n.cast("long") * 420 + F.col("event_id") % 12 * 30 - 17000).alias("arrival_s"),
        (60 + 300 * (F.col("event_id") % 3)).alias("headway_sched_s"), F.when(F.col("event_id") % 3 == 0, "headway").otherwise("schedule").alias("family"), "direction_id",
    ).distinct()


def predictions(spark, sf):
    """Each ping predicts its stop ten minutes ahead."""
    p = pings(spark, sf).where("trip_id IS NOT NULL")
    return p.select("trip_id", "vehicle_id", "stop_id", F.expr("ts - 600 - seq % 2 * 7").alias("fetched_at"), F.expr("ts + event_id % 7 * 10").alias("pred"))


@query("d6_full_passages", f"""
WITH {PINGS}, {PLAN}, pr AS (SELECT trip_id, vehicle_id, stop_id, ts - 600 - seq % 2 * 7 AS fetched_at, ts + event_id % 7 * 10 AS pred FROM pings WHERE trip_id IS NOT NULL),
m AS (SELECT p.*, s.stop_sequence AS sq FROM pings p LEFT JOIN plan s USING (trip_id, stop_id) WHERE p.trip_id IN (SELECT trip_id FROM plan)),
e AS (SELECT *, max(sq) OVER (PARTITION BY {KEY} ORDER BY ts, fetched_at, stop_id) AS env FROM m),
g AS (SELECT *, lag(env) OVER w AS env0, lag(ts) OVER w AS ts0 FROM e WINDOW w AS (PARTITION BY {KEY} ORDER BY ts, fetched_at, stop_id)),
x AS (SELECT {KEY}, route_id, env0, env, ts, ts0, (ts0 + ts) / 2.0 AS mid, unnest(range(env0, env)) AS k FROM g WHERE env > env0),
y AS (SELECT x.*, s.dist AS dk, s.stop_sequence AS known, a.dist AS d0, b.dist AS d1 FROM x LEFT JOIN plan s ON s.trip_id = x.trip_id AND s.stop_sequence = k LEFT JOIN plan a ON a.trip_id = x.trip_id AND a.stop_sequence = env0 LEFT JOIN plan b ON b.trip_id = x.trip_id AND b.stop_sequence = env),
crossed AS (SELECT {KEY}, route_id, k::INTEGER AS stop_sequence, CASE WHEN k = env0 THEN mid::DOUBLE ELSE round(mid + CASE WHEN dk > d0 AND dk < d1 THEN (dk - d0) / (d1 - d0) ELSE (k - env0) / (env - env0)::DOUBLE END * (ts - mid), 3)::DOUBLE END AS arr, k > env0 AS interpolated, (ts - ts0)::BIGINT AS censor_width_s, 'crossing' AS source FROM y WHERE known IS NOT NULL),
lim AS (SELECT trip_id, min(stop_sequence) AS first, max(stop_sequence) AS last, arg_max(stop_id, stop_sequence) AS last_stop, list_sort(list(stop_sequence), 'DESC')[2] AS gate FROM plan GROUP BY trip_id),
got AS (SELECT {KEY}, max(route_id) AS route_id, max(stop_sequence) AS got, max(arr) AS last_arr FROM crossed GROUP BY ALL),
tail AS (SELECT {KEY}, route_id, last AS stop_sequence, pred::DOUBLE AS arr, false AS interpolated, NULL::BIGINT AS censor_width_s, 'prediction' AS source
  FROM got JOIN lim USING (trip_id) JOIN (SELECT trip_id, vehicle_id, stop_id, arg_max(pred, fetched_at) AS pred FROM pr GROUP BY ALL) q USING (trip_id, vehicle_id) WHERE got = gate AND q.stop_id = last_stop AND pred > last_arr),
planned AS (SELECT c.*, s.stop_id, s.arrival_s, s.headway_sched_s, s.family, s.direction_id, c.stop_sequence = first AS is_first, c.stop_sequence = last AS is_last FROM (SELECT * FROM crossed UNION ALL SELECT * FROM tail) c JOIN plan s USING (trip_id, stop_sequence) JOIN lim USING (trip_id)),
o AS (SELECT *, lag(stop_id) OVER w AS passed, lag(ts) OVER w AS ts0 FROM pings WHERE trip_id IS NOT NULL AND event_id % 12 >= 8 WINDOW w AS (PARTITION BY {KEY} ORDER BY ts, fetched_at, stop_id)),
f AS (SELECT *, row_number() OVER (PARTITION BY {KEY}, passed ORDER BY ts0) AS r FROM o WHERE passed <> stop_id),
base AS (
  SELECT {KEY}, route_id, stop_sequence, stop_id, arr, interpolated, censor_width_s, source, arrival_s, headway_sched_s, family, direction_id, is_first, is_last FROM planned UNION ALL
  SELECT {KEY}, route_id, row_number() OVER (PARTITION BY {KEY} ORDER BY ts0)::INTEGER, passed, ((ts0 + ts) / 2.0)::DOUBLE, false, ts - ts0, 'flip', NULL, NULL, NULL, direction_id, NULL, NULL FROM f WHERE r = 1),
h AS (SELECT x.vehicle_id, x.trip_id, x.stop_sequence, x.arr, round(x.arr - max(y.arr))::BIGINT AS headway_obs_s FROM base x LEFT JOIN base y ON y.route_id = x.route_id AND y.direction_id = x.direction_id AND y.stop_id = x.stop_id AND y.arr < x.arr AND y.vehicle_id <> x.vehicle_id AND y.trip_id <> x.trip_id GROUP BY x.vehicle_id, x.trip_id, x.stop_sequence, x.arr),
c AS (SELECT trip_id, vehicle_id, stop_id, sum(CASE WHEN pred <> was THEN 1 ELSE 0 END)::BIGINT AS n_changes FROM (SELECT *, lag(pred) OVER (PARTITION BY trip_id, vehicle_id, stop_id ORDER BY fetched_at) AS was FROM pr) GROUP BY ALL),
t AS (SELECT b.trip_id, b.vehicle_id, b.stop_id, b.arr, arg_max(pred, fetched_at) - b.arr AS pred_last_off_s, arg_max(pred, fetched_at) FILTER (WHERE fetched_at <= b.arr - 600) - b.arr AS pred_err_s, max(pred) - min(pred) AS pred_range_s FROM (SELECT DISTINCT trip_id, vehicle_id, stop_id, arr FROM base) b JOIN pr USING (trip_id, vehicle_id, stop_id) GROUP BY b.trip_id, b.vehicle_id, b.stop_id, b.arr),
v AS (SELECT trip_id, count(DISTINCT vehicle_id) AS n_vehicles_on_trip FROM base GROUP BY trip_id),
s AS (SELECT *, round(arr - lag(arr) OVER w)::BIGINT AS segment_s, arrival_s - lag(arrival_s) OVER w AS sched_segment_s FROM base WINDOW w AS (PARTITION BY {KEY} ORDER BY arr, stop_sequence))
SELECT s.vehicle_id, s.trip_id, s.stop_id, s.stop_sequence, source, s.arr, interpolated, CASE WHEN censor_width_s IS NOT NULL THEN least(censor_width_s, 32767) END AS censor_width_s, is_first, is_last, round(s.arr - ({DAY0} + 18000 + arrival_s))::BIGINT AS delay_s, headway_obs_s, headway_sched_s, family,
       headway_obs_s <= headway_sched_s + 180 AS wait_ok, headway_obs_s < 0.5 * headway_sched_s AS bunched, segment_s, sched_segment_s, segment_s - sched_segment_s AS segment_excess_s, pred_last_off_s, pred_err_s, pred_range_s, n_changes, n_vehicles_on_trip
FROM s JOIN h USING (vehicle_id, trip_id, stop_sequence, arr) LEFT JOIN t ON t.trip_id = s.trip_id AND t.vehicle_id = s.vehicle_id AND t.stop_id = s.stop_id AND t.arr = s.arr LEFT JOIN c ON c.trip_id = t.trip_id AND c.vehicle_id = t.vehicle_id AND c.stop_id = t.stop_id JOIN v ON v.trip_id = s.trip_id""")
def d6_full(spark, sf):
    return passages.passage_facts(pings(spark, sf), plan(spark, sf), predictions(spark, sf)).select(*COLUMNS)
