import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.testing import assertSchemaEqual

from framekeel.operators import metrics, nested
from framekeel.operators.conform import checked, conform
from framekeel.operators.scoring import score_frames
from framekeel.plans import render
from framekeel.schemas import MONITORING_IMAGE, TELEMETRY_EVENT, VIDEO_RENDER_REQUEST
from framekeel.sources import messages

SMALL = T.StructType(
    [
        T.StructField("ts", T.LongType(), False),
        T.StructField("n", T.IntegerType()),
        T.StructField("scores", T.ArrayType(T.FloatType())),
    ]
)


def test_rejects_name_the_feature(spark):
    rows = spark.createDataFrame(
        [
            ("1", "2", ["0.5", "0.25"], "kept"),
            ("x", "1", ["0.5"], "ts"),
            ("3", "2", ["0.5"], "length"),
            ("4", "2", ["0.5", "bad"], "element"),
            ("5", "many", ["0.5"], "count"),
            (None, "0", [], "null"),
            ("6", "1", [None], "null element is allowed"),
        ],
        "ts string, n string, scores array<string>, why string",
    )
    good, rejects = conform(rows, SMALL, lists=["scores"], count="n")
    assert sorted(r["ts"] for r in good.collect()) == [1, 6]
    got = sorted((r["why"], r["feature"]) for r in rejects.collect())
    assert got == [
        ("count", "n"),
        ("count", "scores"),
        ("element", "scores"),
        ("length", "scores"),
        ("null", "ts"),
        ("ts", "ts"),
    ]
    assert "why" not in good.columns
    every = {r["why"]: (r["record"]["ts"], r["problems"]) for r in checked(rows, SMALL, lists=["scores"], count="n").collect()}
    assert len(every) == 7 and every["kept"] == (1, []) and every["count"] == (5, ["n", "scores"])


def test_conform_gives_the_schema(spark):
    good, _ = conform(spark.sql("SELECT '7' ts, 'v' client_version"), TELEMETRY_EVENT)
    assertSchemaEqual(good.schema, TELEMETRY_EVENT, ignoreNullable=True)
    with pytest.raises(ValueError, match="ts"):
        conform(spark.sql("SELECT 1 n"), SMALL)


def test_message_round_trip_and_malformed(spark):
    rows = spark.sql("SELECT 7L ts, 's' session, '2021/01/01' datesegment, 3 device_id, cast('img' AS binary) data")
    value = messages.encode("data", render.metadata_struct(rows).alias("metadata"))
    sent = rows.select(value).unionByName(spark.sql("SELECT '{\"data\":' value UNION ALL SELECT 'no json'"))
    decoded = messages.decode(sent, MONITORING_IMAGE)
    good, bad = messages.split_malformed(decoded)
    assert good.count() == 1 and bad.count() == 2
    message = good.first()["message"]
    assert bytes(message["data"]) == b"img" and message["metadata"]["device_id"] == 3
    assertSchemaEqual(decoded.schema["message"].dataType, MONITORING_IMAGE, ignoreNullable=True)
    with pytest.raises(Exception, match="MALFORMED"):
        messages.decode(sent, MONITORING_IMAGE, mode="FAILFAST").collect()


def test_bytes_decode_like_text(spark):
    sent = spark.sql("SELECT cast('{\"cdn_output_path\":\"p\"}' AS binary) value")
    assert messages.decode(sent, VIDEO_RENDER_REQUEST).first()["message"]["cdn_output_path"] == "p"


def test_protobuf_needs_its_package(spark, tmp_path):
    (tmp_path / "empty.desc").write_bytes(b"")
    sent = spark.sql("SELECT cast('' AS binary) value")
    with pytest.raises(Exception, match="(?i)protobuf"):
        messages.decode_protobuf(sent, "M", str(tmp_path / "empty.desc")).collect()


def test_render_request_path(spark):
    latest = spark.sql("SELECT 's1' session, '2021/01/01' datesegment, 5L ts")
    row = render.render_requests(latest).first()
    assert row["cdn_output_path"] == "media/uploads/PrintSessionAlert/2021/01/01/s1"
    assert row["value"].startswith('{"cdn_output_path":"media/') and '"ts":5' in row["value"]


def test_render_manifest_and_alerts(spark):
    requests = render.render_requests(spark.sql("SELECT inline(array(('a', 'd', 9L), ('b', 'd', 9L))) AS (session, datesegment, ts)"))
    frames = spark.sql("SELECT 'a' session, 'd' datesegment, id + 10 ts, concat('f', id) outpath FROM range(3)")
    manifest = render.render_manifest(requests, frames, bucket="b", base_path="p", module="m")
    got = {r["session"]: r for r in manifest.collect()}
    assert (got["a"]["frame_count"], got["a"]["first_ts"], got["a"]["last_ts"]) == (3, 10, 12)
    assert got["a"]["input_path"] == "gs://b/p/m/d/a/jpg/"
    assert got["a"]["output_path"] == "gs://b/p/m/d/a/mp4/annotated_video.mp4"
    assert got["a"]["video_path"] == "gs://b/media/uploads/PrintSessionAlert/d/a/annotated_video.mp4"
    assert got["b"]["frame_count"] == 0
    assert [r["session"] for r in render.alerts(manifest).collect()] == ["a"]


def test_frame_lists_are_written_in_playing_order(spark, tmp_path):
    frames = spark.range(500).selectExpr("'a' session", "'d' datesegment", "(id * 37) % 500 ts", "concat('f', id) outpath")
    requests = spark.sql("SELECT 'a' session, 'd' datesegment UNION ALL SELECT 'a', 'd'")
    render.write_render_frames(render.render_frames(requests, frames), str(tmp_path / "out"))
    stored = []
    for path in sorted((tmp_path / "out").glob("part-*")):
        stored += [r["ts"] for r in spark.read.parquet(str(path)).collect()]
    assert stored == list(range(500))


def test_durations(spark):
    rows = spark.sql("SELECT 'a' k, 0.0019D s UNION ALL SELECT 'a', 2.5D UNION ALL SELECT 'b', 1.0D")
    timed = rows.withColumn("ms", metrics.whole_millis(F.col("s")))
    got = {r["k"]: tuple(r)[1:] for r in metrics.duration_distribution(timed, "ms", "k").collect()}
    assert got == {"a": (2, 2501, 1, 2500, 1250.5), "b": (1, 1000, 1000, 1000, 1000.0)}
    seen = Observation("predict")
    metrics.observe_durations(timed, "ms", seen).write.format("noop").mode("overwrite").save()
    assert (seen.get["count"], seen.get["max"]) == (3, 2500)


def test_model_is_loaded_once_per_task_and_sees_images(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import uuid
        from pathlib import Path

        Path(folder, uuid.uuid4().hex).touch()

        def predict(images):
            assert len(images) <= 4
            return [([[0.0, 0.0, 1.0, len(i)]], [3], [0.5], 1) for i in images]

        return predict

    frames = spark.range(0, 30, 1, 2).selectExpr("id", "cast(repeat('x', cast(id AS int)) AS binary) image_data")
    rows = score_frames(frames, load, batch_size=4).collect()
    assert len(rows) == 30 and len(list(tmp_path.iterdir())) == 2
    for r in rows:
        only = r["annotations_all"]["detections"][0]
        assert (only["xmax"], only["class"], only["health_weight"]) == (r["id"], 4, 1.0)
    assert "image_data" not in rows[0]
    # Each call of the model counts once, with its images.
    calls = [r for r in rows if r["predict_ms"] is not None]
    assert sum(r["predict_images"] for r in calls) == 30 and len(calls) == 8
    kept = score_frames(frames, load, batch_size=4, keep_image=True).collect()
    assert {r["id"]: len(r["image_data"]) for r in kept} == {k: k for k in range(30)}


def test_explode_keeps_position(spark):
    found = "transform(array(3, 6), (c, i) -> named_struct('pos', i + 1, 'class', c, 'score', 0.5D))"
    rows = spark.sql(f"SELECT 1L ts, 's' session, {found} detections")
    got = nested.explode_detections(rows).collect()
    columns = ("pos", "detection_class", "health_weight", "health_score")
    assert [tuple(r[c] for c in columns) for r in got] == [(1, 3, -0.5, -0.25), (2, 6, None, None)]


def test_null_images_pass_the_model_by(spark):
    def load():
        def predict(images):
            assert None not in images
            return [([], [], [], 0) for _ in images]

        return predict

    frames = spark.sql("SELECT 1 id, cast('x' AS binary) image_data UNION ALL SELECT 2, cast(null AS binary)")
    got = {r["id"]: r for r in score_frames(frames.coalesce(1), load).collect()}
    assert got[1]["annotations_all"]["num_detections"] == 0
    assert (got[2]["annotations_all"], got[2]["predict_ms"]) == (None, None)


def test_a_filter_on_a_message_does_not_parse_it_again(spark):
    sent = spark.createDataFrame([('{"session":"a","ts":1}',), ('{"session":"a"}',), ("broken",), (None,)], "value string")
    found = messages.with_reject(messages.decode(sent, T.StructType.fromDDL("session string, ts bigint")), ["ts"])
    good = found.where("reject IS NULL").select("message.*")
    assert [r.asDict() for r in good.collect()] == [{"session": "a", "ts": 1}]
    assert [r["reject"] for r in found.collect()] == [None, "no ts", "malformed", "malformed"]
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
