"""Distribution of durations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def whole_millis(seconds: Column) -> Column:
    """Seconds to whole milliseconds, cut off."""
    return (seconds * 1000).cast("bigint")


def _distribution(ms: str) -> list[Column]:
    return [
        F.count(ms).alias("count"),
        F.sum(ms).alias("sum"),
        F.min(ms).alias("min"),
        F.max(ms).alias("max"),
        F.avg(ms).alias("mean"),
    ]


def duration_distribution(df: DataFrame, ms: str, *by: str) -> DataFrame:
    """Count, sum, minimum, maximum and mean of a duration column, per group if wanted."""
    return df.groupBy(*by).agg(*_distribution(ms))


def observe_durations(df: DataFrame, ms: str, name: str | Observation) -> DataFrame:
    """The same numbers as metrics of a running job, read from an observation or query progress."""
    return df.observe(name, *_distribution(ms))
