"""Small per-key tables for joining back to the rows they came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_key(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """One row per key with ``aggregates``, or the distinct keys without any.

    Made for a join on ``keys`` with rows in which a key may be hot. Grouping by a struct keeps Spark
    from reusing the grouping's partitions for the join: both sides are shuffled for it, and only
    then can AQE split the hot key's partition.
    """
    grouped = df.groupBy(F.struct(*keys).alias("_key"))
    table = grouped.agg(*aggregates) if aggregates else df.select(F.struct(*keys).alias("_key")).distinct()
    return table.select("_key.*", *(c for c in table.columns if c != "_key"))
