"""Check records against a schema: good rows on one side, named problems on the other."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TELEMETRY_LISTS


def _always_fits(kind: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value has a cast: any number is a floating one, and any atom a text."""
    if isinstance(wanted, T.StringType):
        return isinstance(kind, T.AtomicType)
    return isinstance(kind, T.NumericType) and isinstance(wanted, (T.FloatType, T.DoubleType))


def _checked(
    df: DataFrame, schema: T.StructType, lists: Iterable[str], count: str
) -> tuple[list[Column], Column]:
    """Cast columns, and the array of features that do not fit."""
    lists = [name for name in lists if name in schema.names]
    missing = [f.name for f in schema.fields if f.name not in df.columns and not f.nullable]
    if missing:
        raise ValueError(f"record lacks {', '.join(missing)}")
    cast, problems = [], []
    for field in schema.fields:
        if field.name not in df.columns:
            cast.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        source, wanted = F.col(field.name), field.dataType
        value = source.try_cast(wanted)
        kind = df.schema[field.name].dataType
        if kind == wanted or _always_fits(kind, wanted):
            bad = F.lit(False)
        elif isinstance(wanted, T.ArrayType) and isinstance(kind, T.ArrayType) and _always_fits(kind.elementType, wanted.elementType):
            bad = F.lit(False)
        elif isinstance(wanted, T.ArrayType):
            lost = F.exists(
                source, lambda e: e.isNotNull() & e.try_cast(wanted.elementType).isNull()
            )
            bad = F.coalesce(lost, F.lit(False))
        else:
            bad = source.isNotNull() & value.isNull()
        if not field.nullable:
            bad = bad | source.isNull()
        if field.name in lists:
            size = F.coalesce(F.size(source), F.lit(0))
            bad = bad | (size != F.coalesce(F.col(count).try_cast("int"), F.lit(0)))
        cast.append(value.alias(field.name))
        problems.append(F.when(bad, F.lit(field.name)))
    return cast, F.filter(F.array(*problems), lambda p: p.isNotNull())


def checked(
    df: DataFrame,
    schema: T.StructType,
    *,
    lists: Iterable[str] = TELEMETRY_LISTS,
    count: str = "num_detections",
) -> DataFrame:
    """All rows with ``record``, the row in ``schema``, and ``problems``, the features that do not fit.

    For jobs that write good rows and rejects from one pass.
    """
    cast, problems = _checked(df, schema, lists, count)
    return df.select("*", F.struct(*cast).alias("record"), problems.alias("problems"))


def conform(
    df: DataFrame,
    schema: T.StructType,
    *,
    lists: Iterable[str] = TELEMETRY_LISTS,
    count: str = "num_detections",
) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into rows of ``schema`` and rejects.

    A feature is rejected if its value cannot be cast, is null where the schema forbids it, or if it
    is one of ``lists`` and its length differs from ``count``. Columns outside the schema are left
    out of the good rows. Rejects keep the row as it came and gain ``feature``, one row for each.
    """
    rows = checked(df, schema, lists=lists, count=count)
    good = rows.where(F.size("problems") == 0).select("record.*")
    rejects = rows.select(*df.columns, F.explode("problems").alias("feature"))
    return good, rejects
