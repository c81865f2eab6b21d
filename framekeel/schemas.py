"""One schema per record, shared by batch and streaming code."""

from __future__ import annotations

from pyspark.sql import types as T

BOX = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("ymin", "xmin", "ymax", "xmax")]
)

# Detections of a frame: one bounded array (a model returns at most a few dozen boxes per image).
DETECTION = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("class", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        *BOX.fields,
    ]
)
DETECTIONS = T.ArrayType(DETECTION)

METADATA = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("session", T.StringType()),
        T.StructField("datesegment", T.StringType()),
        T.StructField("device_id", T.IntegerType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("client_version", T.StringType()),
        T.StructField("cloudiot_device_id", T.LongType()),
    ]
)

MONITORING_IMAGE = T.StructType(
    [T.StructField("data", T.BinaryType()), T.StructField("metadata", METADATA)]
)

VIDEO_RENDER_REQUEST = T.StructType(
    [T.StructField("cdn_output_path", T.StringType()), T.StructField("metadata", METADATA)]
)

CALIBRATION_FILE = T.StructType(
    [
        T.StructField("box", T.StructType([T.StructField("xy", T.ArrayType(T.DoubleType()))])),
        T.StructField("fps", T.DoubleType()),
    ]
)

# One frame as struct-of-arrays. Every list has `num_detections` elements.
TELEMETRY_LISTS = (
    "detection_scores",
    "detection_classes",
    "boxes_ymin",
    "boxes_xmin",
    "boxes_ymax",
    "boxes_xmax",
)
TELEMETRY_EVENT = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("client_version", T.StringType()),
        T.StructField("session", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("device_id", T.IntegerType()),
        T.StructField("cloudiot_device_id", T.LongType()),
        T.StructField("detection_scores", T.ArrayType(T.FloatType())),
        T.StructField("detection_classes", T.ArrayType(T.IntegerType())),
        T.StructField("num_detections", T.IntegerType()),
        T.StructField("boxes_ymin", T.ArrayType(T.FloatType())),
        T.StructField("boxes_xmin", T.ArrayType(T.FloatType())),
        T.StructField("boxes_ymax", T.ArrayType(T.FloatType())),
        T.StructField("boxes_xmax", T.ArrayType(T.FloatType())),
        T.StructField("image_width", T.IntegerType()),
        T.StructField("image_height", T.IntegerType()),
        T.StructField("image_data", T.BinaryType()),
        T.StructField("annotated_image_data", T.BinaryType()),
    ]
)

# Raw model output for one image, batch dimension already removed.
MODEL_OUTPUT = T.StructType(
    [
        T.StructField("boxes", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("classes", T.ArrayType(T.DoubleType())),
        T.StructField("scores", T.ArrayType(T.DoubleType())),
        T.StructField("count", T.DoubleType()),
    ]
)
