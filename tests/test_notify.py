"""Notifications against a plain walk from cycle to cycle."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime
from zoneinfo import ZoneInfo

import pytest

from stormline.plans import notify

NY = ZoneInfo("America/New_York")
UNITS = "now long, anchor long, asset_id int, kind string, tier int, rank double, silent boolean, own_mm double, active boolean"
SMALL = "/root/testdata/sf0.001"
START = int(datetime(2024, 6, 1, 20, tzinfo=NY).timestamp())


def random_units(rng, cycles=14, assets=12):
    rows, tier = [], {}
    for c in range(cycles):
        anchor, silent = c // 6, rng.random() < 0.2
        for a in range(assets):
            if rng.random() < 0.15:
                tier.pop(a, None)
                continue
            tier[a] = max(tier.get(a, 0) if c % 6 else 0, rng.choice([0, 0, 0, 1, 2]))
            rows.append((START + c * 3600, anchor, a, "complex" if a % 4 == 0 else "stop", tier[a], rng.random(), silent, rng.choice([1.0, 2.0, 5.0]), rng.random() < 0.8))
    return rows


def plain(rows, subs, cap, fuse, top=None):
    """The rules, one cycle after the other; with `top`, the watch branch."""
    out, latched, watched, sent, window = [], {}, set(), {}, None
    for now in sorted({r[0] for r in rows}):
        units = [r for r in rows if r[0] == now]
        anchor, silent = units[0][1], units[0][6]
        if anchor != window:
            latched, watched, sent, window = {}, set(), {}, anchor
        if silent:
            continue
        if top is None:
            entered = [r for r in units if r[4] >= 1 and r[4] > latched.get(r[2], 0)]
        else:
            entered = []
            for kind, n in top.items():
                good = sorted((r for r in units if r[3] == kind and r[8] and r[7] >= 2), key=lambda r: (-r[5], r[2]))[:n]
                entered += [r for r in good if r[2] not in watched]
        latched = {r[2]: r[4] for r in units}
        watched |= {r[2] for r in entered}
        n_sent = 0
        hour = datetime.fromtimestamp(now, NY).hour
        for r in sorted(entered, key=lambda r: r[2]):
            for handle, asset, optin in sorted(s for s in subs if s[1] == r[2]):
                urgent = top is None and r[4] == 2
                if top is None and not urgent and not optin:
                    continue
                drop = None
                if not urgent and (hour >= 22 or hour < 7):
                    drop = "quiet"
                elif sent.get(handle, 0) >= cap:
                    drop = "handle_cap"
                elif n_sent >= fuse:
                    drop = "cycle_fuse"
                else:
                    n_sent += 1
                    sent[handle] = sent.get(handle, 0) + 1
                out.append((now, handle, asset, drop))
    return sorted(out, key=str)


@pytest.mark.parametrize(("cap", "fuse"), [(10, 500), (2, 3), (3, 2), (1, 1)])
def test_decisions_match_a_plain_walk(spark, cap, fuse):
    rng = random.Random(cap * 10 + fuse)
    rows = random_units(rng)
    subs = sorted({(f"h{rng.randrange(4)}", rng.randrange(12), rng.random() < 0.6) for _ in range(24)})
    subs = list({(h, a): (h, a, o) for h, a, o in subs}.values())
    units, s = spark.createDataFrame(rows, UNITS), spark.createDataFrame(subs, "handle string, asset_id int, elevated_optin boolean")
    got = notify.decisions(notify.tier_entries(units), s, handle_cap=cap, cycle_fuse=fuse)
    assert sorted((tuple(r) for r in got.select("now", "handle", "asset_id", "dropped").collect()), key=str) == plain(rows, subs, cap, fuse)
    top = {"stop": 3, "complex": 1}
    got = notify.decisions(notify.watch_entries(units, top), s, tiers=False, handle_cap=cap, cycle_fuse=fuse)
    assert sorted((tuple(r) for r in got.select("now", "handle", "asset_id", "dropped").collect()), key=str) == plain(rows, subs, cap, fuse, top)


def test_kinds_that_no_one_can_subscribe_to_raise(spark):
    units = spark.createDataFrame([(START, 0, 1, "cell", 2, 1.0, False, 3.0, True)], UNITS)
    with pytest.raises(ValueError, match="subscribe"):
        notify.decisions(notify.tier_entries(units), spark.createDataFrame([("h", 1, True)], "handle string, asset_id int, elevated_optin boolean"))


def test_a_replay_is_worked_out_once(spark):
    """Entries and decisions read what was stored: each row that isn't silent is made once."""
    from pyspark.sql import functions as F

    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def kind(was):
        made.add(1)
        return was

    rows = random_units(random.Random(4))
    units = spark.createDataFrame(rows, UNITS).withColumn("kind", kind("kind"))
    subs = spark.createDataFrame([("h", a, True) for a in range(12)], "handle string, asset_id int, elevated_optin boolean")
    assert notify.decisions(notify.tier_entries(units), subs).count() > 0
    assert made.value == sum(not r[6] for r in rows)


def test_the_registered_query_blows_its_fuse_as_its_sql_does(spark, tmp_path):
    """Customers and events repeated with shifted keys and nations, so that cycles want more than the fuse lets through."""
    import duckdb

    import __spark_entry__ as entry

    con, name = duckdb.connect(), "d46_notification_decisions"
    copies = f"FROM '{SMALL}/customer.parquet' c, (SELECT unnest(range(0, 60)) AS k)"
    con.execute(f"COPY (SELECT c.* REPLACE (c_custkey + 168 * k AS c_custkey, ((c_nationkey + k) % 25)::INT AS c_nationkey, c_acctbal + k AS c_acctbal) {copies}) TO '{tmp_path}/customer.parquet'")
    con.execute(f"COPY (SELECT e.* REPLACE (user_id + k AS user_id) FROM '{SMALL}/events.parquet' e, (SELECT unnest(range(0, 25)) AS k)) TO '{tmp_path}/events.parquet'")
    con.execute(f"COPY (FROM '{SMALL}/nation.parquet') TO '{tmp_path}/nation.parquet'")
    for t in ("customer", "events", "nation"):
        con.execute(f"CREATE VIEW {t} AS FROM '{tmp_path}/{t}.parquet'")
    got = [tuple(r) for r in entry.queries()[name](spark, str(tmp_path)).select("now", "handle", "asset_id", "kind", "tier", "dropped").collect()]
    want = con.sql(entry.oracle_sql()[name]).project("now, handle, asset_id, kind, tier, dropped").fetchall()
    assert sorted(got, key=str) == sorted(want, key=str)
    sent = Counter(r[0] for r in got if r[5] is None)
    assert {r[0] for r in got if r[5] == "cycle_fuse"} == {now for now, n in sent.items() if n == notify.CYCLE_FUSE} != set()
    assert max(sent.values()) == notify.CYCLE_FUSE


def test_rounds_are_one_more_than_the_cycles_that_trip(spark, monkeypatch):
    """Each handle has more than its cap in a cycle, spread over all assets: a fuse moves the caps of the rows behind it."""
    rng, cap, fuse = random.Random(9), 3, 40
    rows = [(START + c * 3600, 0, a, "stop", 1 + c, 1.0, False, 3.0, True) for c in range(2) for a in range(400)]
    subs = [(f"h{rng.randrange(30)}", a, True) for a in range(400)]
    rounds = []
    keep = notify.stored
    monkeypatch.setattr(notify, "stored", lambda df, name: (rounds.append(name), keep(df, name))[1])
    units, s = spark.createDataFrame(rows, UNITS), spark.createDataFrame(subs, "handle string, asset_id int, elevated_optin boolean")
    got = notify.decisions(notify.tier_entries(units), s, handle_cap=cap, cycle_fuse=fuse)
    got = sorted((tuple(r) for r in got.select("now", "handle", "asset_id", "dropped").collect()), key=str)
    assert got == plain(rows, subs, cap, fuse)
    assert rounds.count("told") <= 1 + len({r[0] for r in got if r[3] == "cycle_fuse"})
