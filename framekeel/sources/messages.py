"""Messages in and out: streams of a ``value`` column, and the JSON or protobuf inside it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
TEXT_VALUE = T.StructType([T.StructField("value", T.StringType())])


def read_messages(
    spark: SparkSession,
    path: str | None = None,
    *,
    schema: T.StructType = TEXT_VALUE,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """Messages from files below ``path``, or from another format such as ``kafka`` by its options.

    Kafka brings its own schema and needs its package on the cluster.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt).options(**options)
    if path is None:
        return reader.load()
    if max_files_per_trigger and streaming:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.schema(schema).load(path)


def decode(df: DataFrame, schema: T.StructType, value: str = "value", mode: str = "PERMISSIVE") -> DataFrame:
    """Add ``message`` decoded from JSON text or bytes in ``value``, and ``is_malformed``.

    ``mode="FAILFAST"`` raises on the first malformed message instead.
    """
    text = F.col(value).cast("string")
    if mode == "FAILFAST":
        parsed = F.from_json(text, schema, {"mode": mode})
        return df.withColumn("message", parsed).withColumn("is_malformed", F.lit(False))
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(text, marked, {"mode": mode, "columnNameOfCorruptRecord": CORRUPT})
    bad = F.col("_parsed").isNull() | F.col(f"_parsed.{CORRUPT}").isNotNull()
    return (
        # A filter on the message would parse it again, many times over; past a generator of one element it does not.
        df.withColumn("_parsed", F.explode(F.array(parsed)))
        .withColumn("is_malformed", bad)
        .withColumn(
            "message",
            F.when(~F.col("is_malformed"), F.struct(*(F.col(f"_parsed.{n}").alias(n) for n in schema.names))),
        )
        .drop("_parsed")
    )


def decode_protobuf(df: DataFrame, message_name: str, descriptor: str, value: str = "value", mode: str = "PERMISSIVE") -> DataFrame:
    """The same for protobuf bytes, given a descriptor file; needs Spark's protobuf package."""
    from pyspark.sql.protobuf.functions import from_protobuf

    parsed = from_protobuf(F.col(value), message_name, descriptor, {"mode": mode})
    return df.withColumn("message", parsed).withColumn("is_malformed", F.col("message").isNull())


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    """The fields of a message that are no structs, by their paths."""
    found = []
    for field in schema.fields:
        own = (*path, field.name)
        nested = isinstance(field.dataType, T.StructType)
        found += _leaves(field.dataType, own) if nested else [(own, field.dataType)]
    return found


def _as_text(schema: T.StructType) -> T.StructType:
    """The same message with all its fields as text."""
    kinds = ((f.name, f.dataType) for f in schema.fields)
    return T.StructType(
        [T.StructField(n, _as_text(k) if isinstance(k, T.StructType) else T.StringType()) for n, k in kinds]
    )


def explain_malformed(decoded: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Add ``problems``: of a malformed message that is JSON, the fields whose values do not have their type.

    Only malformed messages are read again. Null for good ones, and for those that are no JSON at all.
    """
    marked = T.StructType([*_as_text(schema).fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    loose = F.when(F.col("is_malformed"), F.from_json(F.col(value).cast("string"), marked, options))

    def wrong(text: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.BinaryType):
            return F.try_to_binary(text, F.lit("base64")).isNull()
        if isinstance(kind, T.AtomicType):
            return text.try_cast(kind).isNull()
        return F.from_json(text, kind).isNull()

    def problem(path: tuple[str, ...], kind: T.DataType) -> Column:
        text = F.col("_loose." + ".".join(f"`{n}`" for n in path))
        return F.when(text.isNotNull() & wrong(text, kind), F.lit(".".join(path)))

    found = F.array_compact(F.array(*(problem(*leaf) for leaf in _leaves(schema))))
    is_json = F.col("_loose").isNotNull() & F.col(f"_loose.{CORRUPT}").isNull()
    return decoded.withColumn("_loose", loose).withColumn("problems", F.when(is_json, found)).drop("_loose")


def with_reject(decoded: DataFrame, required: Sequence[str]) -> DataFrame:
    """Add ``reject``: why a decoded message cannot be used, null if it can.

    ``required`` are fields of the message, such as ``metadata.ts``, that must not be null. With ``problems``, from
    :func:`explain_malformed`, a message with wrong types is rejected by the names of its fields.
    """
    reason = F.when(F.col("is_malformed"), F.lit("malformed"))
    if "problems" in decoded.columns:
        fields = F.when(F.size("problems") > 0, F.concat(F.lit("bad "), F.array_join("problems", ", ")))
        reason = F.when(F.col("is_malformed"), F.coalesce(fields, F.lit("malformed")))
    for field in required:
        reason = reason.when(F.col(f"message.{field}").isNull(), F.lit(f"no {field}"))
    return decoded.withColumn("reject", reason)


def split_malformed(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good messages, and the malformed ones for an error output."""
    good = decoded.where(~F.col("is_malformed")).drop("is_malformed")
    bad = decoded.where("is_malformed").drop("message", "is_malformed")
    return good, bad


def encode(*fields: Column | str) -> Column:
    """Columns as the JSON text of one message, named ``value``."""
    return F.to_json(F.struct(*fields)).alias("value")


def publish(
    messages: DataFrame, path: str | None = None, *, checkpoint: str, fmt: str = "parquet", trigger=None, **options: str
):
    """Start writing a stream of ``value`` messages to files below ``path`` or to Kafka."""
    writer = messages.select("value").writeStream.format(fmt).options(**options)
    if path is not None:
        writer = writer.option("path", path)
    return (
        writer.option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
