"""Alerts: mentions of places in prose, incident states and id grammars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormline.functions.texts import norm_words
from stormline.operators.phrases import leftmost_longest, spans_of
from stormline.operators.scratch import stored
from stormline.operators.windows import latest_by


def words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.upper(text), "[^A-Z0-9]+", " "), " "), lambda w: w != "")


def mentions(texts: DataFrame, key: str, text: str, aliases: DataFrame, n: int) -> DataFrame:
    """(key, asset_id, n_mentions): places whose alias of n words stands in a text, by equal runs of words.

    An alias that belongs to two places says nothing and is dropped.
    """
    sure = aliases.groupBy("alias").agg(F.countDistinct("asset_id").alias("_n"), F.min("asset_id").alias("asset_id")).where("_n = 1").drop("_n")
    w = texts.select(key, words(F.col(text)).alias("_w")).where(F.size("_w") >= n)
    runs = F.transform(F.sequence(F.lit(1), F.size("_w") - (n - 1)), lambda i: F.array_join(F.slice("_w", i, n), " "))
    return w.select(key, F.explode(runs).alias("alias")).join(sure, "alias").groupBy(key, "asset_id").agg(F.count("*").alias("n_mentions"))


def chips(revisions: DataFrame, incident: str, order: Sequence[str], active: Column) -> DataFrame:
    """(incident, state, n_revisions, text_of_newest): active if any revision's window is open, else by the newest one."""
    newest = latest_by(revisions, [incident], [F.desc(c) for c in order])
    by = revisions.groupBy(incident).agg(F.bool_or(active).alias("_active"), F.count("*").alias("n_revisions"))
    return newest.join(by, incident).withColumn("state", F.when(F.col("_active"), "active").otherwise("closed")).drop("_active")


def incident_of(alert_id: Column) -> Column:
    """lmm:planned:123_v4 and the like: the number of the incident, without its revision."""
    return F.nullif(F.regexp_extract(alert_id, r"^(?:[a-z]+:)*([0-9]+)(?:[_#-]v?[0-9]+)?$", 1), F.lit(""))


def revision_of(alert_id: Column, incident: Column, order: Sequence[str]) -> Column:
    """The revision in the id, else the place in order of time."""
    said = F.nullif(F.regexp_extract(alert_id, r"[_#-]v?([0-9]+)$", 1), F.lit("")).cast("int")
    return F.coalesce(said, F.row_number().over(Window.partitionBy(incident).orderBy(*order)) - 1)


# Canonical words, and the patterns that tie a station to water on the tracks.
CANON = {
    "AVENUE": "AV", "AVENUES": "AVS", "AVE": "AV", "STREET": "ST", "STREETS": "STS", "ROAD": "RD", "BOULEVARD": "BLVD", "PARKWAY": "PKWY",
    "SQUARE": "SQ", "CENTER": "CTR", "CENTRE": "CTR", "HEIGHTS": "HTS", "FORT": "FT", "MOUNT": "MT",
}
LIVE_ANCHOR = r"REMOV(?:E|ES|ING|ED) WATER FROM THE TRACKS"
ANCHOR = LIVE_ANCHOR + r"|FLOOD[A-Z]*|WATER CONDITIONS?|WATER MAIN BREAK"
KEYWORDS = r"FLOOD|WATER COND|WATER FROM THE TRACKS"
FORWARD = r" (?:S )?(?:(?:ON|IN|INSIDE|CAUSED BY|OF|FROM|THAT IS CAUSING|CAUSING)(?:(?!\bAND\b|\bAT\b)[A-Z0-9 ]){0,45} )?(?:AT|NEAR) (?:THE )?"
BETWEEN = r"(?:S| CONDITIONS)? BETWEEN (?:THE )?"
BACKWARD = (
    r" (?:ON THE [A-Z0-9]{1,3} LINE )?(?:IS |ARE )?(?:CLOSED|SKIPPED|SUSPENDED) (?:BECAUSE OF|DUE TO|AFTER) (?:A |AN |THE )?(?:HEAVY |STREET LEVEL )?"
    r"|(?: (?:IS |ARE )?)?WHILE WE (?:CORRECT|ADDRESS|INVESTIGATE) (?:A |AN |THE )?"
)
AFTER_AT = r" (?:(?!\bAND\b)[A-Z0-9 ]){0,40} ?"
SKIPPING, AT, ENDS_AT = r" (?:NEAR|BYPASSING|SKIPPING)$", r" AT$", r"TERMINAT\w* AT$"
PLANNED = r"FLOOD (?:PROTECTION|MITIGATION|BARRIER|RESILIENCY|PREVENTION)"
CLEARED, ONGOING = r"REMOVED WATER FROM THE TRACKS|WHAT HAPPENED", r"REMOV(?:E|ES|ING) WATER FROM THE TRACKS"
ALERT_ID = r"^lmm:alert:([^:]+):(\d+)$"
REACH = 70


def station_aliases(stations: DataFrame) -> DataFrame:
    """(alias, candidates): normalised names of stations (asset_id, name, complex_id, routes), and long enough hyphen parts of names.

    A part needs four characters and a digit or two words. `candidates` lists every station that an alias may mean.
    """
    full = norm_words(F.col("name"), CANON, between=True)
    part = norm_words(F.col("_part"), CANON, between=True)
    own = F.struct("asset_id", "name", "complex_id", "routes").alias("station")
    whole = stations.select(full.alias("alias"), own)
    parts = stations.withColumn("_full", full).withColumn("_part", F.explode(F.split("name", "-"))).select("_full", part.alias("alias"), own)
    parts = parts.where((F.col("alias") != F.col("_full")) & (F.length("alias") >= 4) & F.col("alias").rlike("[0-9 ]")).drop("_full")
    return whole.union(parts).where("alias <> ''").groupBy("alias").agg(F.collect_set("station").alias("candidates"))


def _whole(gap: Column, pattern: str) -> Column:
    return gap.rlike(rf"\A(?:{pattern})\z")


def _is_cause(text: Column, m: Column, anchors: Column) -> Column:
    """Whether a bridge of at most 70 characters ties a match to some anchor, before or behind it."""
    between = lambda a, b: F.substring(text, a + 1, b - a)
    before = F.rtrim(F.substring(text, F.lit(1), m["begin"]))
    placed = before.rlike(SKIPPING) | (before.rlike(AT) & ~before.rlike(ENDS_AT))

    def tied(a: Column) -> Column:
        ahead, behind = between(a["end"], m["begin"]), between(m["end"], a["begin"])
        forward = m["begin"].between(a["end"], a["end"] + REACH) & (_whole(ahead, FORWARD) | _whole(ahead, BETWEEN))
        backward = a["begin"].between(m["end"], m["end"] + REACH) & (_whole(behind, BACKWARD) | (placed & _whole(behind, AFTER_AT)))
        return forward | backward

    return F.exists(anchors, tied)


def revisions_of(rows: DataFrame) -> DataFrame:
    """Captured rows (alert_id, header, description, route_id, fetched_at), one an informed entity, to one row a text.

    An id's text changes in place, so the text belongs to the key; routes belong to the id, since
    an edit splits the entities of one alert over its texts.
    """
    routes = rows.groupBy(F.col("alert_id").alias("_id")).agg(F.collect_set("route_id").alias("routes"))
    texts = rows.groupBy("alert_id", "header", "description").agg(F.min("fetched_at").alias("first_seen"), F.max("fetched_at").alias("last_seen"), F.count("*").alias("n_rows"))
    return texts.join(routes, texts["alert_id"].eqNullSafe(routes["_id"])).drop("_id")


def station_causes(revisions: DataFrame, aliases: DataFrame) -> DataFrame:
    """`revisions` that name water on the tracks now, with `key`, event_id, update, state, and for each station they blame: alias, complex_id, name.

    Planned work and texts that only a reminder's sentence qualifies are left out. A match that may mean two
    complexes, even after the alert's routes chose among them, blames none.
    """
    text = F.concat_ws("\n", F.nullif("header", F.lit("")), F.nullif("description", F.lit("")))
    t, upper = F.col("text"), F.upper(F.col("_raw"))
    hits = F.filter(F.split(upper, r"(?<=[.!?])\s+"), lambda s: s.rlike(KEYWORDS))
    reminder = (F.size(hits) > 0) & F.forall(hits, lambda s: F.ltrim(s).startswith("REMINDER"))
    live = (
        revisions.withColumn("_raw", text).where(upper.rlike(KEYWORDS) & ~upper.rlike(PLANNED) & ~reminder & F.col("alert_id").rlike(ALERT_ID))
        .withColumn("text", norm_words(F.col("_raw"), CANON, between=True)).where(t.rlike(LIVE_ANCHOR)).drop("_raw")
        .withColumn("event_id", F.regexp_extract("alert_id", ALERT_ID, 1)).withColumn("update", F.regexp_extract("alert_id", ALERT_ID, 2).cast("long"))
        .withColumn("state", F.when(t.rlike(CLEARED) & ~t.rlike(ONGOING), "cleared").otherwise("active"))
        .withColumn("key", F.sha2(F.to_json(F.struct("alert_id", "header", "description")), 256))
    )
    live = stored(live, "live")
    # texts repeat from alert to alert: each is searched once
    words = F.split("text", " ")
    texts = stored(live.select("text").distinct().withColumn("words", words), "texts")
    found = leftmost_longest(texts, "text", "words", aliases, "alias")
    begin = F.when(F.col("at") == 0, 0).otherwise(F.length(F.array_join(F.slice(words, 1, F.col("at")), " ")) + 1)
    placed = found.select("text", "alias", begin.alias("begin")).withColumn("end", F.col("begin") + F.length("alias"))
    listed = placed.groupBy("text").agg(F.sort_array(F.collect_list(F.struct("begin", "end", "alias"))).alias("matches"))
    anchored = listed.withColumn("anchors", spans_of(F.col("text"), ANCHOR))
    anchored = anchored.withColumn("matches", F.transform("matches", lambda m: F.struct(m["begin"].alias("begin"), m["end"].alias("end"), m["alias"].alias("alias"), _is_cause(t, m, F.col("anchors")).alias("cause"))))

    def second(m: Column, i: Column) -> Column:
        """The other end of "between A and B"."""
        before = F.get("matches", i - 1)
        gap = F.substring(t, before["end"] + 1, m["begin"] - before["end"])
        opened = F.exists("anchors", lambda a: (a["end"] <= before["begin"]) & _whole(F.substring(t, a["end"] + 1, before["begin"] - a["end"]), BETWEEN))
        return m["cause"] | F.coalesce((i > 0) & before["cause"] & gap.isin(" AND ", " ") & opened, F.lit(False))

    causes = F.filter(F.transform("matches", lambda m, i: F.struct(m["alias"].alias("alias"), second(m, i).alias("cause"))), lambda m: m["cause"])
    said = anchored.select("text", F.explode(F.array_distinct(F.transform(causes, lambda m: m["alias"]))).alias("alias"))
    blamed = live.join(said, "text").withColumn("_routes", F.sort_array("routes"))
    meant = meanings(blamed.select("alias", "_routes").distinct(), aliases)
    on = (blamed["alias"] == meant["_alias"]) & blamed["_routes"].eqNullSafe(meant["_of"])
    return blamed.join(meant, on).drop("_alias", "_of", "_routes")


def meanings(asked: DataFrame, aliases: DataFrame) -> DataFrame:
    """(_alias, _of, complex_id, name) of each alias and list of routes asked for (alias, _routes) that means one complex: of the stations with such a route, or of all if none has one.

    Stations are summed up by alias and route first, so that none of the alerts carries the list of an alias's stations along.
    """
    each = aliases.select("alias", F.explode("candidates").alias("c")).select("alias", "c.complex_id", "c.name", "c.routes")
    held = [F.min("complex_id").alias("low"), F.max("complex_id").alias("high"), F.bool_or(F.col("complex_id").isNull()).alias("none"), F.min("name").alias("name")]
    whole = each.groupBy("alias").agg(F.struct(*held).alias("all"))
    by_route = each.withColumn("route", F.explode("routes")).groupBy("alias", "route").agg(*held)
    named = asked.select("alias", "_routes", F.explode("_routes").alias("route")).join(by_route, ["alias", "route"])
    merged = F.struct(F.min("low").alias("low"), F.max("high").alias("high"), F.bool_or("none").alias("none"), F.min("name").alias("name"))
    fits = named.groupBy(F.col("alias").alias("_alias"), F.col("_routes").alias("_of")).agg(merged.alias("fit"))
    both = asked.join(whole, "alias").join(fits, (asked["alias"] == F.col("_alias")) & asked["_routes"].eqNullSafe(F.col("_of")), "left")
    picked = both.select(asked["alias"].alias("_alias"), F.col("_routes").alias("_of"), F.coalesce("fit", "all").alias("p"))
    single = F.when(F.col("p.none"), F.col("p.low").isNull()).otherwise(F.col("p.low") == F.col("p.high"))
    return picked.where(single).select("_alias", "_of", F.col("p.low").alias("complex_id"), F.col("p.name").alias("name"))


def alert_observations(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row an event and complex: name, first_seen, last_seen, state (both of the newest text, ties: the higher update), alert_ids, n_revisions, n_rows."""
    once = station_causes(revisions_of(rows), aliases).groupBy("key", "event_id", "complex_id", "alert_id", "update", "state", "first_seen", "last_seen", "n_rows").agg(F.min("name").alias("name"))
    newest = F.max(F.struct(F.coalesce("last_seen", F.lit(0)).alias("seen"), "update", "key", "last_seen", "state"))
    out = once.groupBy("event_id", "complex_id").agg(
        F.min("name").alias("name"), F.min("first_seen").alias("first_seen"), newest.alias("_n"), F.sort_array(F.collect_set("alert_id")).alias("alert_ids"),
        F.count("*").alias("n_revisions"), F.sum("n_rows").alias("n_rows"),
    )
    return out.select("event_id", "complex_id", "name", "first_seen", F.col("_n.last_seen").alias("last_seen"), F.col("_n.state").alias("state"), "alert_ids", "n_revisions", "n_rows")
