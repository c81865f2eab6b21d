"""Join each row with the version of a dimension that was in force at its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


def asof_join(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    *,
    at: str = "ts",
    since: str = "valid_from",
    chunk_seconds: int = DAY,
) -> DataFrame:
    """``rows`` with the other columns of ``versions``: those of the last version of the key at or before ``at``.

    ``at`` and ``since`` are epoch seconds. Rows before the first version, or without key or time, have nulls. Of
    versions of one key and time the greatest counts, column by column. A null ``since`` is never in force.

    Time is cut into chunks. For each key and chunk that rows have, one row says which version was in force when the
    chunk began and which ones came inside it; that version is carried on from chunk to chunk in a window that sees a
    row per key and chunk. The rows themselves are neither sorted nor gathered by key: they meet these small rows in one
    equi-join on key and chunk, which Spark broadcasts or splits where a key is hot, and pick their version there.
    Choose chunks in which a key has few versions.
    """
    keys = list(keys)
    values = [c for c in versions.columns if c not in (*keys, since)]
    clash = [c for c in values if c in rows.columns]
    if clash:
        raise ValueError(f"rows have the versions' columns {', '.join(clash)}")
    known = versions.where(F.col(since).isNotNull())
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    chunk = lambda c: F.floor(F.col(c) / chunk_seconds).alias("_chunk")
    version = F.struct(F.col(since).cast("bigint").alias("since"), F.struct(*values).alias("values"))
    changes = known.groupBy(*keys, chunk(since), since).agg(F.max(version).alias("version"))
    changes = changes.groupBy(*keys, "_chunk").agg(F.sort_array(F.collect_list("version")).alias("_inside"))
    asked = rows.select(*keys, chunk(at)).where(F.col("_chunk").isNotNull()).distinct()
    marks = asked.withColumn("_asked", F.lit(True)).join(changes, [*keys, "_chunk"], "full")
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.element_at("_inside", -1), ignorenulls=True).over(earlier)
    # Grouped by a struct, so that Spark shuffles both sides of the join and can split a hot key's rows.
    marks = marks.withColumn("_before", carried).where("_asked")
    marks = marks.groupBy(F.struct(*keys, "_chunk").alias("_key")).agg(
        F.first("_before").alias("_before"), F.first("_inside").alias("_inside")
    )
    marks = marks.select("_key.*", "_before", "_inside")
    joined = rows.withColumn("_chunk", chunk(at)).join(marks, [*keys, "_chunk"], "left")
    so_far = F.filter("_inside", lambda v: v["since"] <= F.col(at))
    found = F.coalesce(F.try_element_at(so_far, F.lit(-1)), F.col("_before"))["values"]
    joined = joined.withColumn("_found", found)
    return joined.select(*rows.columns, *(F.col(f"_found.{c}").alias(c) for c in values))
