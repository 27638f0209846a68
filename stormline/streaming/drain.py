"""Streams: micro-batch appends by event time, windows with watermarks, keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stormline.sources.lake import append_by_event_time


def append_stream(stream: DataFrame, path: str, checkpoint: str, ts: str, enrich: Callable[[DataFrame], DataFrame], progress: Callable[[int, int], None] | None = None):
    """Starts a query that enriches each micro-batch and appends it to the partitions of its own time.

    At least once: a batch that is replayed is appended again, and readers take the latest row a key.
    `progress` hears (batch, rows) after each batch with rows.
    """

    def each(batch: DataFrame, number: int) -> None:
        out = enrich(batch).persist()
        n = out.count()
        if n:
            append_by_event_time(out, path, ts)
            if progress:
                progress(number, n)
        out.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)


def drain(writer) -> None:
    """Runs a query over all that is there now, then stops."""
    writer.trigger(availableNow=True).start().awaitTermination()


def hourly(stream: DataFrame, ts: str, late: str, *aggregates: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """Tumbling hours, labelled by their end; rows later than `late` no longer count."""
    out = stream.withWatermark(ts, late).groupBy(F.window(ts, "1 hour").alias("w"), *keys).agg(*aggregates)
    return out.select(F.col("w.end").alias("hour_end"), *out.columns[1:])


def sessions(stream: DataFrame, ts: str, late: str, gap: str, *aggregates: Column, keys: tuple[str, ...]) -> DataFrame:
    """Sessions that a silence longer than `gap` ends."""
    out = stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(*aggregates)
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *out.columns[1:])


LATCH = "unit string, anchor long, h long, level int, latched int"


def latch_levels(stream: DataFrame, window_h: int) -> DataFrame:
    """The highest level of each unit so far in its window of `window_h` hours; a new window starts anew.

    Input: unit, h, level. The state of a unit is its window's start and its highest level: two numbers.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        anchor, top = state.get if state.exists else (-1, 0)
        rows = []
        for b in batches:
            for h, level in sorted(zip(b["h"], b["level"], strict=True)):
                start = h // window_h * window_h
                if start > anchor:
                    anchor, top = start, 0
                if start == anchor:
                    top = max(top, level)
                    rows.append((key[0], anchor, h, level, top))
        state.update((int(anchor), int(top)))
        yield pd.DataFrame(rows, columns=["unit", "anchor", "h", "level", "latched"])

    return stream.groupBy("unit").applyInPandasWithState(step, LATCH, "anchor long, top int", "append", GroupStateTimeout.NoTimeout)


ROLLED = "unit string, anchor long, h long, level int, latched int, kind string"


def roll_latches(stream: DataFrame, arrived: str, late: str, quiet_s: int) -> DataFrame:
    """The highest level of each unit so far in the window that its rows name; the state rolls when a later window begins.

    Input: unit, anchor (start of the row's window), h, level and the time `arrived`. Output kinds: `live` rows with the
    latched level; `late` rows of a window that is over, given back as they are instead of vanishing; one `closed`
    row with the last level when a unit was silent for `quiet_s`, whose state (two numbers) is then freed. The
    watermark runs on arrival, which never goes back, so the engine drops no row, however old its window.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            anchor, top = state.get
            state.remove()
            yield pd.DataFrame([(key[0], anchor, None, None, top, "closed")], columns=["unit", "anchor", "h", "level", "latched", "kind"])
            return
        anchor, top = state.get if state.exists else (None, 0)
        rows, last = [], 0
        for b in batches:
            last = max(last, int(b[arrived].max().timestamp() * 1000))
            rows += zip(b["anchor"].tolist(), b["h"].tolist(), b["level"].tolist(), strict=True)
        out = []
        for start, h, level in sorted(rows):
            if anchor is not None and start < anchor:
                out.append((key[0], start, h, level, None, "late"))
                continue
            anchor, top = start, level if start != anchor else max(top, level)
            out.append((key[0], start, h, level, top, "live"))
        state.update((int(anchor), int(top)))
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + quiet_s * 1000)
        frame = pd.DataFrame(out, columns=["unit", "anchor", "h", "level", "latched", "kind"])
        yield frame.astype({"h": "Int64", "level": "Int32", "latched": "Int32"})

    timed = stream.withWatermark(arrived, late).groupBy("unit")
    return timed.applyInPandasWithState(step, ROLLED, "anchor long, top int", "append", GroupStateTimeout.EventTimeTimeout)


def drain_all(writers: list) -> None:
    """Runs several queries side by side over all that is there now: one failing stream fails the app."""
    running = [w.trigger(availableNow=True).start() for w in writers]
    for q in running:
        q.awaitTermination()


PROGRESS = "batch long, n_in long, n_broken long, n_out long"


def watched_messages(messages: DataFrame, schema: str) -> DataFrame:
    """JSON messages (column `value`) as rows; the stream's own metrics count those that can't be parsed, which are dropped."""
    parsed = messages.select(F.from_json("value", schema).alias("m")).select("m.*")
    broken = F.count(F.when(F.col("fetched_at").isNull(), 1)).alias("n_broken")
    return parsed.observe("messages", F.count(F.lit(1)).alias("n_in"), broken).where(F.col("fetched_at").isNotNull())


def drain_with_progress(writer, metrics: str = "messages") -> list[tuple[int, int, int, int]]:
    """Runs a query over all that is there and gives its progress: (batch, n_in, n_broken, n_out) of each batch with rows.

    The counts are those of the stream's own metrics, so nothing is counted twice or held in memory for it. Batches stay
    within the cap that the source was given (maxFilesPerTrigger, maxOffsetsPerTrigger).
    """
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    rows = []
    for p in query.recentProgress:
        seen = p.observedMetrics.get(metrics)
        if seen is not None and seen["n_in"]:
            rows.append((p.batchId, seen["n_in"], seen["n_broken"], seen["n_in"] - seen["n_broken"]))
    return rows
