"""Event time, windows and sessions for tables. Streams use the same shapes in ``streaming``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import transform
from ..functions.paths import window_bounds

MICROS = 1_000_000


def assign_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add ``event_time`` from epoch seconds."""
    return df.withColumn("event_time", F.timestamp_seconds(F.col(ts)))


def with_window(df: DataFrame, period_seconds: int) -> DataFrame:
    """Add the tumbling window of each row as ``window_start`` and ``window_end`` epoch seconds."""
    windowed = df.withColumn("window", F.window("event_time", f"{period_seconds} seconds"))
    return windowed.select("*", *window_bounds(F.col("window"))).drop("window")


def group_by_window(df: DataFrame, key: str, period_seconds: int, *aggregates: Column) -> DataFrame:
    """Aggregates per key and tumbling window."""
    grouped = df.groupBy(key, F.window("event_time", f"{period_seconds} seconds")).agg(*aggregates)
    return grouped.select(
        key, *window_bounds(F.col("window")), *(c for c in grouped.columns if c not in (key, "window"))
    )


def first_per_window(df: DataFrame, key: str, order: list[str], period_seconds: int, *carry: str) -> DataFrame:
    """Columns ``carry`` of the first row in each key and window, by ``order``."""
    first = F.min(F.struct(*order, *(c for c in carry if c not in order))).alias("first")
    return group_by_window(df, key, period_seconds, first).select(
        key, "window_start", "window_end", *(F.col(f"first.{c}").alias(c) for c in carry)
    )


@transform(needs="event_time timestamp", gives="session_start timestamp, session_end timestamp, n_rows bigint")
def sessions(df: DataFrame, key: str, gap_seconds: int, order_id: str, *carry: str) -> DataFrame:
    """Sessions per key: rows less than ``gap_seconds`` apart belong together.

    Gives start, end (last event plus gap), row count and, as ``latest_*``, the event time,
    ``order_id`` and ``carry`` columns of the latest row; ``order_id`` breaks ties.

    Rows are first reduced to one per key and time slot of one gap: rows in a slot are always in the
    same session, and the slots of a hot key spread over the cluster. Only slots reach the per-key
    window, and a key has no more of them than its time span divided by the gap.
    """
    gap = gap_seconds * MICROS
    micros = F.unix_micros("event_time")
    latest = F.struct(micros.alias("us"), order_id, *(c for c in carry if c != order_id))
    slots = df.groupBy(key, (micros - F.pmod(micros, F.lit(gap))).alias("slot")).agg(
        F.min(micros).alias("first_us"),
        F.max(micros).alias("last_us"),
        F.count("*").alias("n_rows"),
        F.max(latest).alias("latest"),
    )
    in_order = Window.partitionBy(key).orderBy("slot")
    previous = F.lag("last_us").over(in_order)
    starts = F.coalesce(F.col("first_us") - previous >= gap, F.lit(True)).cast("int")
    numbered = slots.withColumn("starts", starts).withColumn(
        "session_no", F.sum("starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    merged = numbered.groupBy(key, "session_no").agg(
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
        F.sum("n_rows").alias("n_rows"),
        F.max("latest").alias("latest"),
    )
    return merged.select(
        key,
        F.timestamp_micros("first_us").alias("session_start"),
        F.timestamp_micros(F.col("last_us") + gap).alias("session_end"),
        "n_rows",
        F.timestamp_micros("last_us").alias("latest_event_time"),
        *(F.col(f"latest.{c}").alias(f"latest_{c}") for c in dict.fromkeys((order_id, *carry))),
    )


def sliding_stats(
    df: DataFrame, key: str, value: str, size_seconds: int, slide_seconds: int
) -> DataFrame:
    """Count, sum, minimum, maximum and mean of ``value`` per key and sliding window.

    Rows are reduced to one per key and slide first; only these are copied into the windows that
    cover them, instead of every row into every window.
    """
    if size_seconds % slide_seconds:
        raise ValueError("the window size must be a multiple of the slide")
    pane = F.unix_timestamp(F.window("event_time", f"{slide_seconds} seconds")["start"])
    panes = df.withColumn("pane", pane).groupBy(key, "pane").agg(
        F.count(value).alias("n"),
        F.sum(value).alias("total"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )
    covering = F.transform(
        F.sequence(F.lit(0), F.lit(size_seconds // slide_seconds - 1)),
        lambda k: F.col("pane") - k * slide_seconds,
    )
    return (
        panes.withColumn("window_start", F.explode(covering))
        .groupBy(key, "window_start")
        .agg(
            F.sum("n").alias("n"),
            F.sum("total").alias("total"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
        .select(
            key,
            "window_start",
            (F.col("window_start") + size_seconds).alias("window_end"),
            "n",
            "total",
            "low",
            "high",
            (F.col("total") / F.col("n")).alias("mean"),
        )
    )


def lookback(cursors: DataFrame, size_seconds: int, period_seconds: int, cursor: str = "cursor") -> DataFrame:
    """Starts of the windows before each cursor, as ``window_start``.

    The cursor's own window and the oldest of the ``size / period`` windows are left out.
    """
    last = size_seconds // period_seconds - 1
    steps = F.sequence(F.lit(1), F.lit(last)) if last >= 1 else F.array().cast("array<int>")
    return cursors.withColumn(
        "window_start", F.explode(F.transform(steps, lambda n: F.col(cursor) - n * period_seconds))
    )
