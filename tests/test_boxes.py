import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framekeel.functions import BoxCols, arrays_to_boxes, boxes_to_arrays, percent_intersection


def overlaps(spark, boxes, area):
    rows = spark.createDataFrame([tuple(map(float, b)) for b in boxes], "ymin double, xmin double, ymax double, xmax double")
    share = percent_intersection(BoxCols.of_columns(), BoxCols.of_values(area))
    return [r[0] for r in rows.coalesce(1).select(share).collect()]


@pytest.mark.parametrize(
    "box, area, expected",
    [
        ((0.3, 0.3, 0.9, 0.9), (0.2, 0.2, 0.8, 0.8), 0.25 / 0.36),
        ((0.3, 0.3, 0.9, 0.9), (0.1, 0.1, 0.2, 0.2), 0.0),
        ((0.5, 0.2, 0.9, 0.4), (0.1, 0.7, 0.39, 0.8), 0.0),
        ((0.2, 0.2, 0.8, 0.8), (0.1, 0.1, 0.9, 0.9), 1.0),
        # Touching corners, a box without area, and a box larger than the area.
        ((0.2, 0.2, 0.3, 0.3), (0.3, 0.3, 0.4, 0.4), 0.0),
        ((0.5, 0.5, 0.5, 0.5), (0.1, 0.1, 0.9, 0.9), 0.0),
        ((0.0, 0.0, 1.0, 1.0), (0.0, 0.0, 0.5, 0.5), 0.25),
    ],
)
def test_share_of_box_in_area(spark, box, area, expected):
    assert overlaps(spark, [box], area)[0] == pytest.approx(expected)


def test_no_area_gives_null(spark):
    rows = spark.sql(
        "SELECT 0.1D ymin, 0.1D xmin, 0.2D ymax, 0.2D xmax, "
        "cast(null AS double) c_ymin, cast(null AS double) c_xmin, cast(null AS double) c_ymax, cast(null AS double) c_xmax"
    )
    share = percent_intersection(BoxCols.of_columns(), BoxCols.of_columns("c_"))
    assert rows.select(share).first()[0] is None


@st.composite
def proper_box(draw):
    low = [draw(st.floats(0, 0.9)) for _ in range(2)]
    return (*low, *(v + draw(st.floats(0.01, 1)) for v in low))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(proper_box(), min_size=20, max_size=60), proper_box())
def test_matches_numpy(spark, boxes, area):
    b = np.array(boxes)
    height = np.clip(np.minimum(b[:, 2], area[2]) - np.maximum(b[:, 0], area[0]), 0, None)
    width = np.clip(np.minimum(b[:, 3], area[3]) - np.maximum(b[:, 1], area[1]), 0, None)
    expected = height * width / ((b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1]))
    got = overlaps(spark, boxes, area)
    np.testing.assert_allclose(got, expected, atol=1e-12)
    assert all(0 <= v <= 1 + 1e-9 for v in got)


def test_arrays_and_boxes_are_inverse(spark):
    rows = spark.sql("SELECT array(1F, 2F) a, array(3F, 4F) b, array(5F, 6F) c, array(7F, 8F) d").select(
        arrays_to_boxes(*(F.col(n) for n in "abcd")).alias("boxes")
    )
    first, second = rows.first()["boxes"]
    assert tuple(first) == (1, 3, 5, 7) and tuple(second) == (2, 4, 6, 8)
    back = rows.select(*(c.alias(n) for n, c in boxes_to_arrays(F.col("boxes")).items())).first()
    assert back.asDict() == {"ymin": [1, 2], "xmin": [3, 4], "ymax": [5, 6], "xmax": [7, 8]}
