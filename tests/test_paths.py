import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from framekeel.functions import typed_path
from framekeel.functions.paths import join_path, window_stem

PARTS = dict(
    bucket="test-bucket",
    base_path="dataflow/base/path",
    key="abcd1234",
    datesegment="2021/01/01",
    module="module_pb.StructName",
    ext="jpg",
    filename="1234_1239.jpg",
)
TAIL = "test-bucket/dataflow/base/path/module_pb.StructName/2021/01/01/abcd1234/jpg/1234_1239.jpg"


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("protocol", ["gs://", "s3://"])
def test_order_of_parts(spark, protocol):
    assert value(spark, typed_path(**PARTS, protocol=protocol)) == protocol + TAIL
    columns = {k: F.lit(v) for k, v in PARTS.items()}
    assert value(spark, typed_path(**columns, protocol=protocol)) == protocol + TAIL


def test_empty_filename_ends_in_slash(spark):
    assert value(spark, typed_path(**{**PARTS, "filename": ""})).endswith("/jpg/")


part = st.sampled_from(["", "a", "b/", "c/d", "e//", "gs://"])


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(part, min_size=1, max_size=6))
def test_joins_like_the_file_system(spark, parts):
    expected = os.path.join(*parts)
    row = spark.range(1).select(join_path(*parts), join_path(*map(F.lit, parts))).first()
    assert tuple(row) == (expected, expected)


def test_absolute_inner_part_is_refused(spark):
    with pytest.raises(ValueError):
        join_path("a", "/b")
    with pytest.raises(PySparkException):
        value(spark, join_path("a", F.concat(F.lit("/"), F.col("id").cast("string"))))


def test_window_stem(spark):
    assert value(spark, window_stem(F.lit(60), F.lit(120))) == "60_120"
