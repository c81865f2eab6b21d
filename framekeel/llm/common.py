"""What several operators share: the text class of white space, written tables, and row numbers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir

#: A run of characters that are not white space, and one of white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The folders of each open scope, the innermost last; threads and tasks have scopes of their own.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, the tables that were ``staged`` inside and not ``kept``."""
    own: list[str] = []
    outer = _scopes.get()
    _scopes.set((*outer, own))
    try:
        yield
    finally:
        _scopes.set(outer)
        for path in own:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, name: str, kept: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage and fixes its rows."""
    spark = df.sparkSession
    path = fresh_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    # A kept table lives as long as what surrounds the innermost scope.
    scopes = _scopes.get()[:-1] if kept else _scopes.get()
    if scopes:
        scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, by names in quotes, so that dots in them do no harm."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def numbered(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Add a number that is unique to the row; write the result before using it twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def row_key(docs: DataFrame) -> Column:
    """128 bits that rows of ``docs`` share only if they agree in all columns."""
    text = F.col("text").cast("string")
    others = [c.alias(f"c{k}") for k, (n, c) in enumerate(zip(docs.columns, columns_of(docs))) if n != "text"]
    rest = F.to_json(F.struct(*others)) if others else F.lit("")
    # The length first, null as -1, so that no two rows are spelled alike.
    size = F.coalesce(F.length(text), F.lit(-1)).cast("string")
    return F.md5(F.concat_ws("\n", size, text, rest).cast("binary"))


def keyed(docs: DataFrame, *columns: Column | str, key: Column | None = None) -> DataFrame:
    """``columns`` of ``docs`` with a new number, ``row_id``, and ``key``, null if there is none."""
    return numbered(docs.select((F.lit(None).cast("string") if key is None else key).alias("key"), *columns))


def as_often(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as ``decided`` has their ``row_key`` (``key``, ``times``).

    Rows that agree in all columns share a key; their ``times`` add up.
    """
    times = decided.groupBy("key").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("rows"))
    times = staged(times, "decided", kept=True)
    key, number = unused(docs, "_key"), unused(docs, "_times")
    rows = docs.withColumn(key, row_key(docs))
    if not times.where("rows > 1").isEmpty():
        rows = rows.dropDuplicates([key])
    chosen = times.where("times > 0").select(F.col("key").alias(key), F.col("times").cast("int").alias(number))
    if chosen.where(F.col(number) > 1).isEmpty():
        return rows.join(chosen, key, "left_semi").select(*columns_of(docs))
    copies = F.explode(F.array_repeat(F.lit(1), F.col(number)))
    return rows.join(chosen, key).select(*columns_of(docs), copies.alias(number)).select(*columns_of(docs))


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
