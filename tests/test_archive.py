import json

from pyspark.sql import functions as F

from framekeel.operators.windows import assign_event_time
from framekeel.plans import queries
from framekeel.sources import archive
from framekeel.sources.calibrations import read_calibrations
from framekeel.sources.frames import list_frames, pack_frames


def frames(spark):
    rows = spark.range(400).selectExpr(
        "id frame_id", "concat('s', id % 3) session", "concat('2021/01/0', id % 3 + 1) datesegment", "id ts", "'img' image_data"
    )
    return assign_event_time(rows)


def test_one_file_per_session_and_window(spark, tmp_path):
    base = str(tmp_path / "a")
    archive.write_windowed_archive(frames(spark).repartition(5), base, 60)
    files = list((tmp_path / "a").rglob("*.parquet"))
    assert len(files) == 3 * 7 and len({f.parent for f in files}) == len(files)
    assert all(f.parent.name.startswith("window=") for f in files)
    stored = archive.read_archive(spark, base)
    assert stored.count() == 400 and "image_data" not in stored.columns


def test_reading_one_window_skips_the_others(spark, tmp_path):
    base = str(tmp_path / "a")
    archive.write_windowed_archive(frames(spark), base, 60, layout="flat", keep_images=True)
    stored = archive.read_archive(spark, base).where("session = 's1' AND window = '60_120'")
    assert stored.count() == 20 and stored.first()["image_data"] == "img"
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session" in plan


def test_files_do_not_grow_in_number_with_the_sessions(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "fresh_dir", lambda spark, name: str(tmp_path / name))
    found = queries.flat_archive(spark, sf_dir)
    windows = found.select("window").distinct().count()
    files = list((tmp_path / "flat-archive").rglob("*.parquet"))
    assert len(files) <= archive.BUCKETS * windows < found.count()


def test_reading_sessions_skips_other_buckets(spark, tmp_path):
    base = str(tmp_path / "a")
    names = F.concat(F.lit("0"), (F.col("frame_id") % 97).cast("string"))
    rows = frames(spark).withColumn("session", F.when(F.col("frame_id") != 5, names))
    archive.write_windowed_archive(rows, base, 60, layout="bucket")
    assert archive.read_archive(spark, base).where("session IS NULL").count() == 1
    stored = archive.read_sessions(spark, base, "07", "011")
    assert sorted(r["frame_id"] for r in stored.collect()) == [k for k in range(400) if k % 97 in (7, 11)]
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan


def test_json_container(spark, tmp_path):
    base = str(tmp_path / "a")
    archive.write_windowed_archive(frames(spark), base, 60, layout="window", fmt="json")
    assert archive.read_archive(spark, base, "json").count() == 400


def test_an_oversized_window_is_split(spark, tmp_path):
    base = str(tmp_path / "a")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        hot = spark.range(0, 200_000, 1, 8).selectExpr(
            "id frame_id", "'hot' session", "'2021/01/01' datesegment", "id % 60 ts", "uuid() filler"
        )
        archive.write_windowed_archive(assign_event_time(hot), base, 60)
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "a").rglob("*.parquet"))) > 1
    assert archive.read_archive(spark, base).count() == 200_000


def test_manifest_takes_the_date_of_the_first_frame(spark):
    rows = frames(spark).withColumn("session", F.lit("s"))
    got = archive.archive_manifest(rows, 300, bucket="b", base_path="p", module="m").orderBy("window_start").collect()
    assert [r["n_frames"] for r in got] == [300, 100]
    assert got[0]["path"] == "gs://b/p/m/2021/01/01/s/tfrecord/0_300.tfrecords.gz"


def test_parquet_window_path(spark):
    path = archive.parquet_window_path("gs://b/base", F.lit("s"), F.lit(0), F.lit(60))
    assert spark.range(1).select(path).first()[0] == "gs://b/base/s/parquet/0_60.parquet"


def test_calibration_files(spark, tmp_path):
    for device, body in ((7, {"box": {"xy": [0.1, 0.2, 0.8, 0.9]}, "fps": 1.5}), (12, {"box": {"xy": [0, 0, 1, 1]}})):
        (tmp_path / str(device)).mkdir()
        (tmp_path / str(device) / "calibration.json").write_text(json.dumps(body, indent=1))
    (tmp_path / "13").mkdir()
    (tmp_path / "13" / "other.json").write_text("{}")
    got = {r["device_id"]: tuple(r)[1:] for r in read_calibrations(spark, str(tmp_path)).collect()}
    assert got == {7: (0.1, 0.2, 0.8, 0.9, 1.5), 12: (0.0, 0.0, 1.0, 1.0, None)}


def test_frame_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "jpg").mkdir()
    for name in ("100.jpg", "99.jpg", "notes.txt", "x.jpg"):
        (tmp_path / "jpg" / name).write_bytes(b"abc")
    listed = list_frames(spark, str(tmp_path))
    assert sorted((r["ts"] or -1, r["length"]) for r in listed.collect()) == [(-1, 3), (99, 3), (100, 3)]
    assert "content" not in listed._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_packed_frames_are_listed_from_few_files(spark, sf_dir, tmp_path, monkeypatch):
    rows = [("b/s1/jpg/7.jpg", b"abc"), ("b/s2/jpg/x.jpg", b"a"), ("b/s2/jpg/9.txt", b"a"), ("b/8.jpg", b""), (None, b"a"), ("b/6.jpg", None)]
    pack_frames(spark.createDataFrame(rows, "path string, image_data binary"), str(tmp_path / "jpg"))
    listed = list_frames(spark, str(tmp_path), packed=True)
    assert sorted((r["path"], r["ts"], r["length"]) for r in listed.collect()) == [("b/s1/jpg/7.jpg", 7, 3), ("b/s2/jpg/x.jpg", None, 1)]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan[plan.index("ReadSchema") :]
    monkeypatch.setattr(queries, "fresh_dir", lambda spark, name: str(tmp_path / name))
    assert queries.list_frames(spark, sf_dir).count() > 1000
    assert len([f for f in (tmp_path / "frame-files").rglob("*") if f.is_file()]) < 100


def test_no_calibration_at_all(spark, tmp_path):
    assert read_calibrations(spark, str(tmp_path / "nothing")).collect() == []


def test_paths_are_what_was_written(spark, tmp_path):
    base = str(tmp_path / "a")
    archive.write_windowed_archive(frames(spark), base, 60)
    listed = archive.archived_paths(spark, base, "frame_id").groupBy("folder").agg(F.sum("n_frames").alias("n"))
    folders = {str(p.parent.relative_to(tmp_path / "a")) + "/" for p in (tmp_path / "a").rglob("*.parquet")}
    assert {r["folder"] for r in listed.collect()} == folders
    assert sum(r["n"] for r in listed.collect()) == 400
