"""Health trend per session and sliding window, for streams and tables alike.

Three aggregations in a chain, each on the windows of the one before: the health of each second, the sums of a pane
of one slide, and the windows that a pane lies in. State holds a row per open second and pane, and one per open window
and bucket of keys, never one per detection, and a detection is not copied into the windows that cover it. The running
sum needs the points in order; a pane's points are folded to six numbers that say what the line through the running sum
needs, and those of panes in order add up to those of their window, so a window keeps a few numbers per pane. They are
means and sums about the means, as plain sums of squares lose the digits that a flat line's root needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import transform
from ..operators.health import second_health, with_line
from .windows import covering_windows, later_panes

_SUMS = "struct<n:bigint,t:double,tt:double,total:double,c:double,tc:double,first:bigint,last:bigint>"


def _sums(n, t, tt, total, c, tc, first, last) -> Column:
    """Number of points, mean time and its squares; sum of the health, mean running sum, and its products with time.

    Squares and products are summed about the means.
    """
    names = ("n", "t", "tt", "total", "c", "tc", "first", "last")
    return F.struct(*(v.alias(name) for v, name in zip((n, t, tt, total, c, tc, first, last), names))).cast(_SUMS)


def _nothing() -> Column:
    zero, none = F.lit(0.0), F.lit(None)
    return _sums(F.lit(0), zero, zero, zero, zero, zero, none, none)


def _fold_points(points: Column, start: Column) -> Column:
    """The sums of a pane's points (ts, health) in order, with times counted from ``start``."""

    def step(s: Column, p: Column) -> Column:
        n, total = s["n"] + 1, s["total"] + p["health"]
        later = (p["ts"] - start).cast("double") - s["t"]
        c = s["c"] + (total - s["c"]) / n
        return _sums(
            n,
            s["t"] + later / n,
            s["tt"] + later * later * (s["n"] / n),
            total,
            c,
            s["tc"] + later * (total - c),
            F.coalesce(s["first"], p["ts"]),
            p["ts"],
        )

    return F.aggregate(points, _nothing(), step)


def _fold_panes(panes: Column, start: Column) -> Column:
    """The sums of a window from those of its panes (start, sums) in order, with times counted from ``start``."""

    def time(p: Column) -> Column:
        return p["sums"]["t"] + (p["start"] - start)

    def step(s: Column, p: Column) -> Column:
        own = p["sums"]
        n = s["n"] + own["n"]
        # The pane's running sum goes on from where the ones before it ended.
        later, share = time(p) - s["t"], own["n"] / n
        further = own["c"] + s["total"]
        c = s["c"] + (further - s["c"]) * share
        return _sums(
            n,
            s["t"] + later * share,
            s["tt"] + own["tt"] + later * later * share * s["n"],
            s["total"] + own["total"],
            c,
            s["tc"] + own["tc"] + later * (further - c) * own["n"],
            s["first"],
            own["last"],
        )

    first = panes[0]["sums"]
    rest = (first[name] for name in ("tt", "total", "c", "tc", "first", "last"))
    return F.aggregate(later_panes(panes), _sums(first["n"], time(panes[0]), *rest), step)


@transform(
    needs="event_time timestamp, health_weight double, health_score double",
    gives="window_start bigint, window_end bigint, n bigint, total double, c0 double, c1 double, root double",
)
def health_trends(rows: DataFrame, key: str, size_seconds: int, slide_seconds: int) -> DataFrame:
    """Per key and sliding window: points, times of the first and last, running sum at the end, and its line.

    ``rows`` are detections with ``event_time`` (with a watermark, if they are a stream). A point is a second with a
    detection that has a weight. Columns as in :func:`framekeel.operators.health.trend`, with ``total``.
    """
    if size_seconds % slide_seconds:
        raise ValueError("the window size must be a multiple of the slide")
    # No filter before the watermark's rows are counted: it would move below it and hold it back.
    seconds = rows.groupBy(key, F.window("event_time", "1 second").alias("second")).agg(second_health().alias("health"))
    seconds = seconds.where(F.col("health").isNotNull())
    point = F.struct(F.unix_timestamp("second.start").alias("ts"), "health")
    pane = F.window(F.window_time("second"), f"{slide_seconds} seconds").alias("pane")
    panes = seconds.groupBy(key, pane).agg(F.sort_array(F.collect_list(point)).alias("points"))
    start = F.unix_timestamp("pane.start")
    panes = panes.select(key, "pane", _fold_points(F.col("points"), start).alias("sums"))

    def fold(own: Column, begin: Column) -> Column:
        return F.struct(_fold_panes(own, begin).alias("s"))

    found = covering_windows(panes, key, size_seconds, slide_seconds, fold)
    found = found.select("*", F.col("s.n").alias("n"), F.col("s.first").alias("x_min"), F.col("s.last").alias("x_max"))
    found = found.withColumns(
        {
            "total": F.col("s.total"),
            "slope": F.col("s.tc") / F.when(F.col("n") > 1, F.col("s.tt")),
            "x_mean": F.col("window_start") + F.col("s.t"),
            "y_mean": F.col("s.c"),
        }
    )
    return with_line(found).select(key, "window_start", "window_end", "n", "x_min", "x_max", "total", "c0", "c1", "root")
