"""Contracts of transforms, versions of calibrations, compaction, and broken model output."""

import pytest
from pyspark.sql import functions as F

from framekeel import contracts
from framekeel.operators import asof, health, nested, overlay, windows
from framekeel.operators.scoring import score_frames
from framekeel.sources import archive, calibrations, frames, messages
from framekeel.schemas import MONITORING_IMAGE


def test_a_wrong_type_names_transform_and_field(spark):
    rows = spark.sql("SELECT 'x' ts, 1D health_weight, 1D health_score")
    with pytest.raises(contracts.ContractError, match="input of score_by_ts: ts is string, not bigint"):
        health.score_by_ts(rows)
    found = spark.sql("SELECT 1 device_id, array(struct('c' class, 1D score, 0D ymin, 0D xmin, 0D ymax, 0D xmax)) detections")
    with pytest.raises(contracts.ContractError, match=r"input of merge_filtered: detections\[\].class is string, not int"):
        nested.merge_filtered(found, found)
    with pytest.raises(contracts.ContractError, match="input of sessions: event_time is missing"):
        windows.sessions(spark.sql("SELECT 1 session"), "session", 1, "session")
    # Whole numbers of any width fit, and as numbers too.
    assert health.score_by_ts(spark.sql("SELECT 1 ts, 1 health_weight, 2 health_score")).first()["health"] == 2

    @contracts.transform(gives="n bigint")
    def broken(df):
        return df.withColumn("n", F.lit("many"))

    with pytest.raises(contracts.ContractError, match="output of broken: n is string"):
        broken(spark.range(1))
    assert health.trend.gives and health.score_by_ts.needs.startswith("ts")


def test_problems_of_messages_field_by_field(spark):
    sent = [
        '{"data":"aW1n","metadata":{"ts":1,"session":"s"}}',
        '{"data":"aW1n","metadata":{"ts":"x","session":"s","device_id":{"a":1}}}',
        '{"data":"*","metadata":{"ts":1}}',
        '{"data":"aW1n","metadata":7}',
        "no json",
        None,
    ]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(sent)], "id int, value string")
    decoded = messages.explain_malformed(messages.decode(rows, MONITORING_IMAGE), MONITORING_IMAGE)
    found = {r.id: (r.problems, r.reject) for r in messages.with_reject(decoded, ["metadata.ts"]).collect()}
    assert found[0] == (None, None)
    assert found[1] == (["metadata.ts", "metadata.device_id"], "bad metadata.ts, metadata.device_id")
    assert found[2] == (["data"], "bad data")
    assert all(found[k][1] == "malformed" for k in (3, 4, 5))


# --- as of ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("chunk", [1, 10, 1000])
def test_the_version_in_force_is_joined(spark, chunk):
    versions = [(1, 10, "a"), (1, 25, "b"), (1, 25, "bb"), (2, 0, "c"), (None, 1, "n"), (3, None, "m"), (1, 400, "z")]
    dimension = spark.createDataFrame(versions, "device int, valid_from long, area string")
    times = [(1, 9), (1, 10), (1, 24), (1, 25), (1, 399), (1, 400), (2, 5), (2, -5), (3, 5), (None, 3), (1, None), (1, 10)]
    rows = spark.createDataFrame([(k, *r) for k, r in enumerate(times)], "id int, device int, ts long")
    found = {r.id: r.area for r in asof.asof_join(rows, dimension, ["device"], chunk_seconds=chunk).collect()}
    assert [found[k] for k in range(12)] == [None, "a", "a", "bb", "bb", "z", "c", None, None, None, None, "a"]
    assert asof.asof_join(rows.limit(0), dimension, ["device"]).count() == 0
    assert asof.asof_join(rows, dimension.limit(0), ["device"]).where("area IS NULL").count() == 12
    with pytest.raises(ValueError, match="area"):
        asof.asof_join(rows.withColumn("area", F.lit(1)), dimension, ["device"])


def test_rows_are_neither_sorted_nor_gathered_by_device(spark):
    dimension = spark.sql("SELECT 1 device, 0L valid_from, 'a' area")
    rows = spark.range(1000).selectExpr("id", "1 device", "id ts", "repeat('x', 10) payload")
    plan = asof.asof_join(rows, dimension, ["device"])._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window [last") :]
    assert "payload" not in window


def test_a_replay_finds_the_versions_of_its_time(spark, tmp_path):
    base, table = tmp_path / "files", str(tmp_path / "versions")

    def calibrate(device, low):
        folder = base / str(device)
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "calibration.json").write_text(f'{{"box": {{"xy": [{low}, 0.1, 0.9, 0.9]}}, "fps": 1.0}}')

    source = spark.sql(
        "SELECT id frame_id, 1 device_id, id * 100 ts, array(struct(1 pos, 4 class, 0.9D score, 0.2D ymin, 0.2D xmin,"
        " 0.4D ymax, 0.4D xmax)) detections FROM range(3)"
    )

    def kept():
        merged = nested.merge_filtered(source, calibrations.read_versions(spark, table))
        return [r[0] for r in merged.orderBy("frame_id").select("annotations_filtered.num_detections").collect()]

    assert kept() == [None, None, None]
    calibrate(1, 0.1)
    calibrations.record_versions(spark, str(base), table, 100)
    calibrations.record_versions(spark, str(base), table, 150)
    assert kept() == [None, 1, 1] and calibrations.read_versions(spark, table).count() == 1
    calibrate(1, 0.5)
    calibrations.record_versions(spark, str(base), table, 200)
    # What came before has the area it had.
    assert kept() == [None, 1, 0]


# --- archives ------------------------------------------------------------------------------------


def test_readers_of_a_compacted_archive_see_old_or_new(spark, tmp_path):
    base, target = str(tmp_path / "archive"), str(tmp_path / "compacted")

    def arrive(batch, *windows_of):
        rows = spark.createDataFrame([(w, bytes([batch])) for w in windows_of], "window string, image_data binary")
        rows.withColumn("event_time", F.timestamp_seconds(F.lit(1.5))).repartition(2).write.partitionBy("window").parquet(
            f"{base}/batch_id={batch}"
        )

    arrive(0, "0_60", "0_60", "60_120", "rejects")
    arrive(1, "0_60", "60_120")
    with pytest.raises(ValueError, match="no snapshot"):
        archive.read_snapshot(spark, target)
    archive.compact_snapshot(spark, base, target, 60)
    old = archive.read_snapshot(spark, target)
    assert old.count() == 3 and len(old.inputFiles()) == 1
    assert old.select("event_time").distinct().collect()[0][0].microsecond == 500_000
    arrive(2, "0_60")
    archive.compact_snapshot(spark, base, target, 120)
    new = archive.read_snapshot(spark, target)
    counts = {r.window: r["count"] for r in new.groupBy("window").count().collect()}
    assert counts == {"0_60": 4, "60_120": 2} and old.count() == 3
    # A run that found nothing new, and one that broke off, change nothing that readers see.
    archive.compact_snapshot(spark, base, target, 120)
    (tmp_path / "compacted/_snapshots/9").mkdir()
    assert archive.read_snapshot(spark, target).count() == 6
    assert archive.read_snapshot(spark, target, 1).count() == 3
    many = str(tmp_path / "many")
    archive.compact_snapshot(spark, base, many, 60, file_bytes=1)
    assert len(archive.read_snapshot(spark, many).inputFiles()) == 4


def test_frame_files_are_written_and_listed(spark, tmp_path):
    rows = [(f"{tmp_path}/s{k % 2}/jpg/{k}.jpg", bytes(k + 1)) for k in range(5)] + [(None, b"x"), (f"{tmp_path}/y.jpg", None)]
    written = frames.write_frames(spark.createDataFrame(rows, "path string, image_data binary"))
    assert sorted(r.length for r in written.collect()) == [1, 2, 3, 4, 5]
    listed = frames.list_frames(spark, f"{tmp_path}/*").collect()
    assert sorted((r.ts, r.length) for r in listed) == [(k, k + 1) for k in range(5)]


def test_the_manifest_of_a_day_is_one_file(spark, tmp_path):
    plan = spark.range(4000).selectExpr("id", "concat('d', id % 7) datesegment").repartition(8)
    plan.hint("rebalance", F.col("datesegment")).write.partitionBy("datesegment").parquet(str(tmp_path / "m"))
    assert len(list((tmp_path / "m").rglob("*.parquet"))) == 7


# --- overlays and broken output ------------------------------------------------------------------


def test_overlay_looks_at_each_box_once(spark):
    """Places in order of their first box, with equal places far apart, nulls and negative zeros."""
    boxes = [(0.5, 4), (0.1, 2), (0.5, 3), (None, 1), (0.1, 4), (-0.0, 1), (0.0, 2), (None, 4)]
    drawn = ", ".join(
        f"named_struct('class', {c}, 'score', 0.9D, 'ymin', {'cast(null as double)' if y is None else f'{y}D'},"
        f" 'xmin', 0D, 'ymax', 1D, 'xmax', 1D)"
        for y, c in boxes
    )
    rows = spark.sql(f"SELECT 1 id, array({drawn}) drawn UNION ALL SELECT 2, slice(array({drawn}), 1, 0)")
    found = {r.id: r.overlay for r in nested.overlay_boxes(rows).collect()}
    assert [(p.ymin, len(p.labels)) for p in found[1]] == [(0.5, 2), (0.1, 2), (None, 2), (0.0, 2)]
    assert found[1][0].labels == ["print: 90%", "spaghetti: 90%"] and found[2] == []


BROKEN = [
    None,
    "text",
    (),
    ([[0.1, 0.1, 0.2, 0.2]], [float("nan")], [0.5], float("nan")),
    ([[0.1, 0.1, 0.2, 0.2]], [float("inf")], [0.5], float("inf")),
    ([[0.1, 0.1, 0.2, 0.2]], [2147483647], [0.5], 1 << 40),
    ([[0.1, 0.1, 0.2, 0.2]], [-5], [None], -3),
    ([[0.1], "x", None, 7], ["a", 3, 3], ["b"], None),
    (5, 6, 7, 8),
    ([[0.1, 0.1, 0.2, 0.2, 0.3]], [3], [0.9], "1"),
]


def test_no_model_output_stops_the_job(spark):
    def load():
        return lambda images: [BROKEN[bytes(i)[0]] for i in images][:-1]

    images = spark.createDataFrame([(k, bytes([k])) for k in [*range(len(BROKEN)), 0]], "id int, image_data binary").coalesce(1)
    for batch_size in (1, 64):
        rows = {r.id: r.annotations_all for r in score_frames(images, load, batch_size=batch_size).collect()}
        assert all(0 <= a.num_detections <= len(a.detections) for a in rows.values() if a is not None)
    ids = {k: [d["class"] for d in rows[k].detections] for k in rows if rows[k] is not None}
    assert ids[3] == ids[4] == ids[5] == [None] and ids[6] == [-4] and ids[9] == [4]
    assert [rows[k].num_detections for k in (3, 4, 5, 6, 9)] == [0, 1, 1, 0, 1]
    frame_rows = score_frames(images, load).selectExpr(
        "id frame_id", "1 device_id", "cast(id as bigint) ts", "'s' session", "'d' datesegment", "annotations_all.detections"
    )
    area = spark.sql("SELECT 1 device_id, 0D c_ymin, 0D c_xmin, 1D c_ymax, 1D c_xmax")
    merged = nested.merge_filtered(frame_rows, area)
    assert overlay.overlay_plans(merged, bucket="b", base_path="p", module="m").count() == len(BROKEN) + 1
    rows_form = nested.explode_detections(frame_rows, "frame_id")
    assert rows_form.where("detection_class IS NULL AND health_weight IS NOT NULL").count() == 0


def test_a_broken_result_leaves_its_neighbours_as_they_are(spark):
    good = ([[0.1, 0.2, 0.3]], [3], [0.9], 1)

    def load():
        return lambda images: [good if bytes(i) == b"g" else "broken" for i in images]

    rows = [(k, b"b" if k in (1, 200) else None if k == 7 else b"g") for k in range(300)]
    images = spark.createDataFrame(rows, "id int, image_data binary").coalesce(1)
    scored = score_frames(images, load, batch_size=64)
    found = {r.id: r for r in scored.collect()}
    assert found[7].annotations_all is None and found[1].annotations_all.num_detections == 0
    boxes = [found[k].annotations_all.detections[0] for k in found if k not in (1, 7, 200)]
    # A box of three corners has no fourth one, whether or not another frame's result is broken.
    assert len(boxes) == 297 and all((b.ymax, b.xmax) == (0.3, None) for b in boxes)
    assert [found[k].predict_images for k in sorted(found) if found[k].predict_images] == [63, 64, 64, 64, 44]


def test_raw_output_is_worked_out_once(spark):
    images = spark.createDataFrame([(1, b"g")], "id int, image_data binary")
    plan = score_frames(images, lambda: lambda images: [()])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("arrays_zip") == 1
