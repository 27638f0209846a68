"""Phrase matching against a plain scan, and alert texts made by hand."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from stormline.operators.phrases import leftmost_longest, spans_of
from stormline.plans import alerts


def test_phrases_match_a_plain_scan(spark):
    rng = random.Random(6)
    phrases = sorted({" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(14)})
    texts = [(i, [rng.choice("abcd") for _ in range(rng.randrange(0, 30))]) for i in range(80)] + [(100, None)]
    want = set()
    for key, words in texts:
        at = 0
        while words and at < len(words):
            n = max((n for n in range(1, 6) if " ".join(words[at : at + n]) in phrases and at + n <= len(words)), default=0)
            if n:
                want.add((key, at, n, " ".join(words[at : at + n])))
            at += max(n, 1)
    known = spark.createDataFrame([(p,) for p in [*phrases, "", None]], "phrase string")
    got = leftmost_longest(spark.createDataFrame(texts, "id long, w array<string>"), "id", "w", known, "phrase")
    rows = [tuple(r) for r in got.select("id", "at", "n", "phrase").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_spans(spark):
    rows = spark.createDataFrame([("FLOODS xx FLOOD",), ("none",), ("",), (None,)], "t string")
    got = [r[0] for r in rows.select(spans_of(F.col("t"), "FLOOD[A-Z]*")).collect()]
    assert [[tuple(x) for x in g or []] for g in got] == [[(0, 6), (10, 15)], [], [], []]


STATIONS = [
    ("s1", "Grand Av", 1, ["A"]), ("s2", "Grand Av-Newtown", 2, ["B"]), ("s3", "42nd Street", 3, ["A"]), ("s4", "42nd Street", 4, ["C"]),
    ("s5", "Prince's Bay", 5, ["S"]), ("s6", "W 4 St-Wash Sq", 6, ["A"]),
]


def observed(spark, rows):
    """rows: (alert, header, route, fetched_at)"""
    frame = spark.createDataFrame([(a, h, None, r, t) for a, h, r, t in rows], "alert_id string, header string, description string, route_id string, fetched_at long")
    aliases = alerts.station_aliases(spark.createDataFrame(STATIONS, "asset_id string, name string, complex_id long, routes array<string>"))
    return sorted((r["event_id"], r["complex_id"], r["state"], r["n_revisions"], r["n_rows"], r["last_seen"]) for r in alerts.alert_observations(frame, aliases).collect())


def test_the_longest_alias_wins_and_the_cause_must_be_tied(spark):
    water = "We are removing water from the tracks"
    rows = [
        ("lmm:alert:1:0", f"{water} at Grand Av-Newtown.", "X", 5),  # its own name, not that of Grand Av
        ("lmm:alert:2:0", f"{water} at the W 4 St.", "X", 5),  # a part of a name
        ("lmm:alert:3:0", f"No trains to Prince's Bay. {water} at Grand Av.", "X", 5),  # a mention blames nothing; Grand Av is in two names, but s2's part is s1's whole
        ("lmm:alert:4:0", f"{water} between Prince's Bay and W 4 St.", "X", 5),
        ("lmm:alert:5:0", f"{water} {'far ' * 20}at W 4 St.", "X", 5),  # beyond 70 characters
    ]
    assert observed(spark, rows) == [("1", 2, "active", 1, 1, 5), ("2", 6, "active", 1, 1, 5), ("4", 5, "active", 1, 1, 5), ("4", 6, "active", 1, 1, 5)]


def test_routes_of_the_whole_alert_choose_between_places(spark):
    text = "We are removing water from the tracks at 42 St"
    assert observed(spark, [("lmm:alert:1:0", text, "A", 1)]) == [("1", 3, "active", 1, 1, 1)]
    assert observed(spark, [("lmm:alert:1:0", text, "X", 1)]) == []
    assert observed(spark, [("lmm:alert:1:0", text, "A", 1), ("lmm:alert:1:0", text, "C", 1)]) == []
    # the route came with another text of the same alert
    assert observed(spark, [("lmm:alert:1:0", text, None, 1), ("lmm:alert:1:0", "Soon.", "C", 2)]) == [("1", 4, "active", 1, 1, 1)]


def test_the_newest_text_has_the_state(spark):
    now, then = "We are removing water from the tracks at W 4 St", "We removed water from the tracks at W 4 St"
    assert observed(spark, [("lmm:alert:1:3", now, "A", 9), ("lmm:alert:1:4", then, "A", 9)]) == [("1", 6, "cleared", 2, 2, 9)]
    assert observed(spark, [("lmm:alert:1:4", now, "A", 9), ("lmm:alert:1:3", then, "A", 8)]) == [("1", 6, "active", 2, 2, 9)]


def test_planned_reminders_and_other_ids_say_nothing(spark):
    water = "removing water from the tracks at W 4 St"
    rows = [("lmm:alert:1:0", f"Flood mitigation: {water}", "A", 1), ("lmm:alert:2:0", f"Reminder: we are {water}. Stay safe.", "A", 1), ("other:3", f"We are {water}", "A", 1), (None, water, "A", 1)]
    assert observed(spark, rows) == []
    assert observed(spark, []) == []


def test_an_alias_is_resolved_once_for_all_alerts_with_the_same_routes(spark):
    from stormline.plans.alerts import meanings

    one = lambda i, name, complex_id, routes: (i, name, complex_id, routes)
    known = [("1 ST", [one(1, "b", 10, ["A"]), one(2, "a", 10, ["A", "C"]), one(3, "c", 11, ["B"])]), ("2 ST", [one(4, "d", None, ["A"]), one(5, "e", 12, ["A"])])]
    aliases = spark.createDataFrame(known, "alias string, candidates array<struct<asset_id:int,name:string,complex_id:int,routes:array<string>>>")
    asked = spark.createDataFrame([("1 ST", ["A"]), ("1 ST", ["A", "B"]), ("1 ST", ["B", "Z"]), ("1 ST", ["Z"]), ("1 ST", None), ("2 ST", ["A"])], "alias string, _routes array<string>")
    got = sorted(map(str, map(tuple, meanings(asked, aliases).collect())))
    assert got == sorted(map(str, [("1 ST", ["A"], 10, "a"), ("1 ST", ["B", "Z"], 11, "c")]))
