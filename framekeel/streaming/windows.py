"""Windows, sessions and late rows on streams, in append mode: a window is given once, when it closes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import transform
from ..functions.paths import window_bounds
from ..operators.windows import MICROS

#: Keys share the state rows of the windows that cover their panes; so many rows has a window at most.
BUCKETS = 128


def with_lateness(df: DataFrame, delay: str = "0 seconds", event_time: str = "event_time") -> DataFrame:
    """Watermark on the event time; rows behind it by more than ``delay`` are dropped."""
    return df.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)


def drop_repeats(df: DataFrame, *keys: str) -> DataFrame:
    """Drop messages delivered twice within the watermark."""
    return df.dropDuplicatesWithinWatermark(list(keys))


def window_stats(
    df: DataFrame, key: str, size_seconds: int, *aggregates: Column, slide_seconds: int | None = None
) -> DataFrame:
    """Aggregates per key and tumbling window, or sliding window if ``slide_seconds`` is given."""
    slide = f"{slide_seconds} seconds" if slide_seconds else None
    window = F.window("event_time", f"{size_seconds} seconds", slide)
    grouped = df.groupBy(key, window).agg(*aggregates)
    return grouped.select(
        key, *window_bounds(F.col("window")), *(c for c in grouped.columns if c not in (key, "window"))
    )


def _runs(panes: Column, fold: Callable[[Column], Column]) -> Column:
    """``fold`` of the panes of each key, where ``panes`` are sorted by key."""

    def key(i: Column) -> Column:
        return F.get(panes, i)["key"]

    at = F.sequence(F.lit(0), F.size(panes) - 1)
    heads = F.filter(at, lambda i: (i == 0) | ~key(i).eqNullSafe(key(i - 1)))

    def run(heads: Column, i: Column, j: Column) -> Column:
        return F.slice(panes, i + 1, F.coalesce(F.get(heads, j + 1), F.size(panes)) - i)

    # Through lists of one, the heads and each run are worked out once.
    return F.transform(
        F.array(heads),
        lambda heads: F.transform(heads, lambda i, j: F.transform(F.array(run(heads, i, j)), fold)[0]),
    )[0]


def later_panes(own: Column) -> Column:
    """A key's panes but for the first, with which a fold starts: most windows of a sparse key have no other."""
    return F.slice(own, F.lit(2), F.size(own) - 1)


def covering_windows(
    panes: DataFrame, key: str, size_seconds: int, slide_seconds: int, fold: Callable[[Column, Column], Column]
) -> DataFrame:
    """The sliding windows that cover the panes of each key: the key, the bounds and the fields of ``fold``.

    ``panes`` has one row per key and ``pane``, a window of one slide. ``fold`` makes a struct of a key's panes in a
    window, structs of their ``start`` and the other columns in order of time, and of the window's start. A pane lies
    in many windows, and a state row for each of them and each key costs more than what is in it. So the panes of a
    bucket of keys are first put in one list, and state has a row per window and bucket with the lists of its panes.
    """
    carry = [c for c in panes.columns if c not in (key, "pane")]
    entry = F.struct(F.col(key).alias("key"), F.unix_timestamp("pane.start").alias("start"), *carry)
    bucket = F.pmod(F.hash(key), F.lit(BUCKETS)).alias("bucket")
    lists = panes.groupBy(bucket, "pane").agg(F.collect_list(entry).alias("panes"))
    window = F.window(F.window_time("pane"), f"{size_seconds} seconds", f"{slide_seconds} seconds")
    grouped = lists.groupBy("bucket", window.alias("window")).agg(F.collect_list("panes").alias("panes"))
    begin = F.unix_timestamp("window.start")

    def found(own: Column) -> Column:
        return F.struct(own[0]["key"].alias("key"), fold(own, begin).alias("fields"))

    rows = F.transform(F.array(F.sort_array(F.flatten("panes"))), lambda panes: _runs(panes, found))[0]
    each = grouped.select("window", F.explode(rows).alias("found"))
    return each.select(F.col("found.key").alias(key), *window_bounds(F.col("window")), "found.fields.*")


def sliding_stats(df: DataFrame, key: str, value: str, size_seconds: int, slide_seconds: int) -> DataFrame:
    """Count, sum, minimum and maximum of ``value`` per key and sliding window.

    Rows are reduced to one per key and slide first, and these panes to the windows that cover them
    (:func:`covering_windows`), so rows are not copied a window at a time.
    """
    if size_seconds % slide_seconds:
        raise ValueError("the window size must be a multiple of the slide")
    pane = F.window("event_time", f"{slide_seconds} seconds").alias("pane")
    panes = df.groupBy(key, pane).agg(
        F.count(value).alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high")
    )
    # Sums of sums have a type of their own if the values are decimals.
    kind = panes.agg(F.sum("total").alias("total")).schema["total"].dataType

    def stats(n: Column, total: Column, low: Column, high: Column) -> Column:
        return F.struct(n.alias("n"), total.cast(kind).alias("total"), low.alias("low"), high.alias("high"))

    def step(s: Column, p: Column) -> Column:
        total = F.coalesce(s["total"] + p["total"], s["total"], p["total"])
        return stats(s["n"] + p["n"], total, F.least(s["low"], p["low"]), F.greatest(s["high"], p["high"]))

    def fold(own: Column, begin: Column) -> Column:
        first = own[0]
        return F.aggregate(later_panes(own), stats(first["n"], first["total"], first["low"], first["high"]), step)

    return covering_windows(panes, key, size_seconds, slide_seconds, fold)


@transform(needs="event_time timestamp", gives="session_start timestamp, session_end timestamp, n_rows bigint")
def session_latest(df: DataFrame, key: str, gap_seconds: int, order_id: str, *carry: str) -> DataFrame:
    """Sessions with their latest row, in the columns of the table version.

    Spark joins events exactly one gap apart; the gap is one microsecond less, so these split.
    """
    micros = F.unix_micros("event_time")
    latest = F.struct(micros.alias("us"), order_id, *(c for c in carry if c != order_id))
    window = F.session_window("event_time", f"{gap_seconds * MICROS - 1} microseconds")
    grouped = df.groupBy(key, window.alias("span")).agg(
        F.count("*").alias("n_rows"), F.max(latest).alias("latest")
    )
    return grouped.select(
        key,
        F.col("span.start").alias("session_start"),
        F.timestamp_micros(F.unix_micros("span.end") + 1).alias("session_end"),
        "n_rows",
        F.timestamp_micros("latest.us").alias("latest_event_time"),
        *(F.col(f"latest.{c}").alias(f"latest_{c}") for c in dict.fromkeys((order_id, *carry))),
    )
