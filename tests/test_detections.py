import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framekeel.operators import exploded, nested
from framekeel.operators.conform import conform
from framekeel.operators.overlay import frame_overlays
from framekeel.plans import queries, tables
from framekeel.schemas import DETECTIONS

AREA = ["c_ymin", "c_xmin", "c_ymax", "c_xmax"]
FRAME = T.StructType(
    [
        T.StructField("frame_id", T.LongType()),
        T.StructField("device_id", T.IntegerType()),
        T.StructField("detections", DETECTIONS),
    ]
)


def boxes(n, scores, box=(0.2, 0.2, 0.3, 0.3), label=1):
    return [(i + 1, label, float(s), *box) for i, s in zip(range(n), scores)]


def frames(spark, *rows):
    return spark.createDataFrame([(i, d, found) for i, (d, found) in enumerate(rows)], FRAME)


def calibrations(spark, *rows):
    return spark.createDataFrame(list(rows), "device_id int, " + ", ".join(f"{c} double" for c in AREA))


@pytest.mark.parametrize(
    "area, scores, kept",
    [
        ((0.3, 0.3, 0.4, 0.4), np.linspace(0, 0.5, 10), 0),
        ((0.1, 0.1, 0.9, 0.9), np.linspace(0.6, 1, 10), 10),
    ],
)
def test_area_filter_keeps_all_or_none(spark, area, scores, kept):
    rows = nested.merge_filtered(frames(spark, (1, boxes(10, scores))), calibrations(spark, (1, *area)))
    got = rows.first()["annotations_filtered"]
    assert got["num_detections"] == kept and len(got["detections"]) == kept
    assert all(d["health_weight"] == 0.0 for d in got["detections"])


def test_overlap_must_be_above_the_threshold(spark):
    found = [(1, 4, 0.9, 0.0, 0.0, 1.0, 1.0), (2, 4, 0.9, 0.0, 0.0, 1.0, 0.5)]
    rows = nested.merge_filtered(frames(spark, (1, found)), calibrations(spark, (1, 0.0, 0.0, 1.0, 0.75)))
    assert [d["pos"] for d in rows.first()["annotations_filtered"]["detections"]] == [2]


def test_uncalibrated_and_empty_frames(spark):
    found = boxes(3, (0.9, 0.8, 0.7))
    source = frames(spark, (1, found), (2, found), (3, found), (1, []), (2, None))
    cals = calibrations(spark, (1, 0.1, 0.1, 0.9, 0.9), (2, 0.5, 0.5, 0.9, 0.9))
    rows = nested.effective_annotations(nested.merge_filtered(source, cals)).orderBy("frame_id").collect()
    filtered = [r["annotations_filtered"] and r["annotations_filtered"]["num_detections"] for r in rows]
    # Device 2 keeps nothing and falls back to all; device 3 has no calibration.
    assert filtered == [3, 0, None, 0, 0]
    assert [r["effective"]["num_detections"] for r in rows] == [3, 3, 3, 0, 0]


def test_drawable_is_positional(spark):
    found = boxes(6, (0.1, 0.5, 0.51, 0.9, 0.2, 0.99))
    rows = frames(spark, (1, found)).select(
        nested.drawable(F.col("detections"), 5, 0.5)["pos"].alias("five"),
        nested.drawable(F.col("detections"), None, 0.5)["pos"].alias("every"),
    )
    assert tuple(rows.first()) == ([3, 4], [3, 4, 6])


def test_missing_score_is_drawn_black(spark):
    rows = frames(spark, (1, [(1, 4, None, 0.0, 0.0, 1.0, 1.0)])).withColumn(
        "drawn", nested.drawable(F.col("detections"))
    )
    place = nested.overlay_boxes(rows).first()["overlay"][0]
    assert (place["labels"], place["color"]) == ([], "black")


NAN, INF = float("nan"), float("inf")


def test_numbers_that_are_none(spark):
    box = (0.2, 0.2, 0.4, 0.4)
    found = [
        (1, 4, NAN, *box),
        (2, 4, 0.9, NAN, 0.2, 0.4, 0.4),
        (3, 4, 0.8, 0.2, 0.2, NAN, 0.4),
        (4, 4, INF, *box),
        (5, 4, None, 0.3, 0.3, 0.5, 0.5),
        (6, 4, 0.7, 0.2, 0.2, 0.4, INF),
        (7, 4, 0.6, 0.25, 0.25, 0.35, 0.35),
        (8, 4, 0.5, None, 0.2, 0.4, 0.4),
        (9, None, 0.95, 0.3, 0.2, 0.4, 0.4),
    ]
    source, cals = frames(spark, (1, found)), calibrations(spark, (1, 0.1, 0.1, 0.9, 0.9))
    merged = nested.effective_annotations(nested.merge_filtered(source, cals))
    kept = [d["pos"] for d in merged.first()["annotations_filtered"]["detections"]]
    rows = exploded.with_overlap(nested.join_calibration(long_rows(spark, source), cals))
    assert kept == sorted(r["pos"] for r in rows.where("kept").collect()) == [1, 4, 5, 7, 9]
    drawn = merged.withColumn("drawn", nested.drawable(F.col("effective.detections"), None, 0.5))
    places = nested.overlay_boxes(drawn).first()["overlay"]
    by_array = {(p["ymin"], p["xmin"]): (p["labels"], p["color"]) for p in places}
    ranked = exploded.drawable(rows.withColumnRenamed("pos", "place"), ["place"], None, 0.5, effective=True)
    by_row = {(r["ymin"], r["xmin"]): (r["labels"], r["color"]) for r in exploded.by_location(ranked).collect()}
    assert by_array == by_row == {
        (0.2, 0.2): (["print"], "Azure"),
        (0.3, 0.3): ([], "black"),
        (0.25, 0.25): (["print: 60%"], "Azure"),
        (0.3, 0.2): (["N/A: 95%"], None),
    }


def test_overlay_options(spark):
    found = [(1, 4, 0.9, 0.1, 0.1, 0.2, 0.2), (2, 6, 0.8, 0.1, 0.1, 0.2, 0.2), (3, 4, None, 0.5, 0.5, 0.6, 0.6)]
    rows = frames(spark, (1, found)).withColumn(
        "drawn", F.transform("detections", lambda d: d.withField("track_id", d["pos"] + 200_000_000))
    )

    def drawn(**options):
        return [(p["labels"], p["color"], p["ignored"]) for p in nested.overlay_boxes(rows, **options).first()["overlay"]]

    assert drawn(ignored=lambda d: d["class"] == 6)[0][0] == ["print: 90% (ignored)", "N/A: 80% (ignored)"]
    assert drawn(skip_scores=True)[0][0] == ["print", "N/A"] and drawn(skip_labels=True)[0][0] == ["90%", "80%"]
    assert drawn(track_ids=True)[0][0] == ["print: 90%: ID 200000001", "N/A: 80%: ID 200000002"]
    assert drawn()[1] == ([], "black", False)


def test_frame_ids_of_any_type(spark):
    rows = spark.sql("SELECT 'f' frame_id, id place, 0.9D score, id % 2 = 0 kept FROM range(6)")
    found = exploded.drawable(rows, ["place"], 2, effective=True).collect()
    assert sorted(r["place"] for r in found) == [0, 2]


def test_overlay_joins_boxes_at_one_place(spark):
    same, other = (0.1, 0.1, 0.2, 0.2), (0.5, 0.5, 0.6, 0.6)
    found = [(1, 4, 0.9, *same), (2, 1, 0.8, *other), (3, 3, 0.7, *same)]
    rows = frames(spark, (1, found)).withColumn("drawn", F.col("detections"))
    overlay = nested.overlay_boxes(rows).first()["overlay"]
    assert [(p["labels"], p["color"]) for p in overlay] == [
        (["print: 90%", "spaghetti: 70%"], "Aquamarine"),
        (["nozzle: 80%"], "Chartreuse"),
    ]


def long_rows(spark, source):
    return source.select("frame_id", "device_id", F.inline("detections"))


def test_long_form_agrees_with_nested(spark):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(60):
        low = rng.random((rng.integers(0, 9), 2)) * 0.8
        high = low + rng.random(low.shape) * 0.4 + 0.01
        rows.append(
            (
                int(rng.integers(0, 4)),
                [
                    (i + 1, int(rng.integers(0, 7)), float(rng.integers(0, 100)) / 100, *map(float, lo), *map(float, hi))
                    for i, (lo, hi) in enumerate(zip(low, high))
                ],
            )
        )
    source = frames(spark, *rows)
    cals = calibrations(spark, (0, 0.1, 0.1, 0.8, 0.8), (1, 0.3, 0.3, 0.9, 0.9), (2, 0.0, 0.0, 0.1, 0.1))
    merged = nested.effective_annotations(nested.merge_filtered(source, cals))
    expected = {
        r["frame_id"]: (
            r["annotations_all"]["num_detections"],
            r["annotations_filtered"] and r["annotations_filtered"]["num_detections"],
            r["effective"]["num_detections"],
        )
        for r in merged.collect()
    }
    found = exploded.with_overlap(nested.join_calibration(long_rows(spark, source), cals))
    counts = exploded.annotation_counts(nested.join_calibration(source, cals), found).collect()
    assert {r["frame_id"]: (r["num_all"], r["num_filtered"], r["num_effective"]) for r in counts} == expected

    ranked = exploded.drawable(found.withColumnRenamed("pos", "place"), ["place"], 3, 0.3, effective=True)
    drawn = merged.select("frame_id", F.inline(nested.drawable(F.col("effective.detections"), 3, 0.3)))
    assert sorted(map(tuple, ranked.select("frame_id", "place").collect())) == sorted(
        map(tuple, drawn.select("frame_id", "pos").collect())
    )


def test_hot_frame_is_cut_before_the_shuffle(spark):
    rows = spark.range(100).selectExpr("id % 2 frame_id", "id place", "0.9D score")
    plan = exploded.drawable(rows, ["place"], 5)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_ignored_flag_of_last_box_marks_the_place(spark):
    rows = spark.createDataFrame(
        [(1, 1, 4, 0.9, 0.0, 0.0, 1.0, 1.0, False), (1, 2, 3, 0.8, 0.0, 0.0, 1.0, 1.0, True)],
        "frame_id int, pos int, class int, score double, ymin double, xmin double, ymax double, xmax double, skip boolean",
    )
    got = exploded.by_location(rows, ignored=F.col("skip")).first()
    assert got["labels"] == ["print: 90% (ignored)", "spaghetti: 80% (ignored)"]
    assert (got["color"], got["ignored"]) == ("Aquamarine", True)


def test_postprocess_counts_classes_from_one(spark):
    raw = spark.sql("SELECT array(array(0.1F, 0.2F, 0.3F, 0.4F), array(0F, 0F, 1F, 1F)) b, array(3F, 7F) c, array(0.5F, 0.25F) s, 1F n")
    columns = [F.col(n) for n in "bcsn"]
    whole = raw.select(nested.postprocess(*columns).alias("a")).first()["a"]
    assert (whole["num_detections"], [d["class"] for d in whole["detections"]]) == (1, [4, 8])
    assert [d["health_weight"] for d in whole["detections"]] == [1.0, None]
    assert whole["detections"][0]["xmax"] == pytest.approx(0.4, abs=1e-7)
    cut = raw.select(nested.postprocess(*columns, cut_to_count=True).alias("a")).first()["a"]
    assert len(cut["detections"]) == 1


def test_frames_without_image_are_set_aside(spark):
    source = frames(spark, (1, boxes(2, (0.9, 0.8))), (1, [])).selectExpr(
        "*", "'s' session", "'2021/01/01' datesegment", "frame_id + 100 ts", "if(frame_id = 0, 'x', '') image_data"
    )
    merged = nested.merge_filtered(source, calibrations(spark, (1, 0.1, 0.1, 0.9, 0.9)))
    plans, errors = frame_overlays(merged, bucket="b", base_path="p/", module="m")
    assert plans.first()["outpath"] == "gs://b/p/m/2021/01/01/s/jpg/100.jpg"
    assert [p["labels"] for p in plans.first()["overlay"]] == [["nozzle: 90%", "nozzle: 80%"]]
    assert [r["frame_id"] for r in errors.collect()] == [1]
    assert "image_data" not in plans.columns and "image_data" not in errors.columns


def test_drop_images(spark):
    rows = spark.sql("SELECT 1 a, 'x' image_data")
    assert nested.drop_images(rows).columns == ["a"]


def test_detections_are_worked_out_per_vector_and_not_per_frame(spark, sf_dir):
    rows = tables.nested_frames(spark, sf_dir)
    assert "lambdafunction" not in rows._jdf.queryExecution().optimizedPlan().toString()
    sizes = {r["frame_id"]: len(r["detections"]) for r in rows.select("frame_id", "detections").collect()}
    assert all(n == key % 21 for key, n in sizes.items())


def test_lists_that_always_fit_are_not_looked_through(spark, sf_dir):
    plan = queries.conform_good(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("exists(") == 1
    schema = T.StructType([T.StructField("num_detections", T.IntegerType()), T.StructField("detection_scores", T.ArrayType(T.FloatType()))])
    rows = spark.createDataFrame([(3, [1e300, float("nan"), None]), (1, [])], "num_detections int, detection_scores array<double>")
    good, rejects = conform(rows, schema)
    assert good.count() == 1 and [r["feature"] for r in rejects.collect()] == ["detection_scores"]
    assert good.first()["detection_scores"][0] == float("inf")
