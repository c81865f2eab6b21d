"""Frames, detections and calibrations derived from the order, line item, customer and nation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.boxes import BoxCols
from ..operators.lookups import per_key

# Total order of the detections in a frame.
POSITION = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_shipdate",
]
AREA = (0.1, 0.1, 0.8, 0.8)
DAY = 86_400
WINDOW = 30 * DAY
GAP = 180 * DAY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(
    spark: SparkSession, sf_dir: str, *, device: bool = False, datesegment: bool = False, spread_out: bool = False
) -> DataFrame:
    """One frame per order; its session is the customer. With ``spread_out``, orders of a small file go to all cores."""
    orders = table(spark, sf_dir, "orders")
    if spread_out:
        # The scan is asked for its parts, as asking the joins for theirs would run them.
        orders = spread(orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"))
    event_time = F.col("o_orderdate").cast("timestamp")
    out = orders.select(
        F.col("o_orderkey").alias("frame_id"),
        F.col("o_custkey").cast("string").alias("session"),
        F.col("o_custkey").alias("user_id"),
        F.unix_timestamp(event_time).alias("ts"),
        event_time.alias("event_time"),
        F.col("o_orderpriority").alias("payload"),
    )
    if datesegment:
        first = F.date_format(F.min("event_time"), "yyyy/MM/dd").alias("datesegment")
        out = out.join(per_key(out, ["user_id"], first), "user_id")
    if device:
        customer = table(spark, sf_dir, "customer")
        out = out.join(
            customer.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("device_id")),
            "user_id",
            "left",
        )
    return out


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detection per line item."""
    box = {
        "ymin": F.col("l_discount") * 5,
        "xmin": F.col("l_tax") * 5,
        "ymax": F.col("l_discount") * 5 + F.col("l_quantity") / 100,
        "xmax": F.col("l_tax") * 5 + F.col("l_linenumber") / F.lit(10.0),
    }
    score = (F.col("l_partkey") * 13 + F.col("l_linenumber") * 17 + F.col("l_suppkey")) % 100
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frame_id"),
        (F.col("l_partkey") % 7).cast("int").alias("class"),
        (score / F.lit(100.0)).alias("score"),
        *(c.alias(n) for n, c in box.items()),
        *POSITION,
    )


def calibrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated area per device; every fourth device has none."""
    return (
        table(spark, sf_dir, "nation")
        .where(F.col("n_nationkey") % 4 != 0)
        .select(
            F.col("n_nationkey").alias("device_id"),
            *(F.lit(v).alias("c_" + n) for n, v in zip(BoxCols._fields, AREA)),
        )
    )


def calibrated_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir, device=True).join(calibrations(spark, sf_dir), "device_id", "left")


def calibrated_detections(spark: SparkSession, sf_dir: str, *carry: str) -> DataFrame:
    """Detections with the area of their frame's device."""
    area = ["c_" + n for n in BoxCols._fields]
    return detections(spark, sf_dir).join(
        calibrated_frames(spark, sf_dir).select("frame_id", *area, *carry), "frame_id"
    )


def nested_frames(spark: SparkSession, sf_dir: str, *, datesegment: bool = False) -> DataFrame:
    """Frames that carry up to twenty detections each, made of the numbers of a vector; two share a place."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    rows = frames(spark, sf_dir, device=True, datesegment=datesegment, spread_out=True)

    def share(x):
        return x - F.floor(x)

    def all_of(vector):
        """Twenty detections, of which a frame carries the first ones."""

        def number(k):
            return F.abs(F.get(vector, F.lit(k)).cast("double"))

        def detection(i):
            corner = (i - 1) // 2 * 4
            ymin, xmin, height, width = (share(number(corner + k)) / 2 for k in range(4))
            return F.struct(
                F.lit(i).alias("pos"),
                (F.floor(number(i + 43) * 1000) % 7).cast("int").alias("class"),
                share(number(i + 39) * 10).alias("score"),
                ymin.alias("ymin"),
                xmin.alias("xmin"),
                (ymin + height).alias("ymax"),
                (xmin + width).alias("xmax"),
            )

        return F.array(*(detection(i) for i in range(1, 21)))

    # Worked out once a vector, not once a frame.
    found = vectors.select("vec_id", all_of(F.col("embedding")).alias("found"))
    rows = rows.withColumn("vec_id", F.col("frame_id") % vectors.count()).join(found, "vec_id", "left")
    n = F.greatest(F.col("frame_id") % 21, F.lit(0)).cast("int")
    unknown = all_of(F.lit(None).cast("array<float>"))
    first = F.slice(F.coalesce(F.col("found"), unknown), F.lit(1), n)
    # A generator of one element is worked out once, however often later steps use the array.
    return rows.withColumn("detections", F.explode(F.array(first))).drop("vec_id", "found")


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many parts as there are cores, if a small file gave it fewer."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as frames of a session per user."""
    return table(spark, sf_dir, "events").withColumn("event_time", F.col("ts").cast("timestamp"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream. The braces make the path a pattern, which may name a single file."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events.parquet}}")
