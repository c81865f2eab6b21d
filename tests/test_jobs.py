import json
import random

from pyspark.sql import functions as F

from framekeel.config import HealthJobConfig, RenderJobConfig
from framekeel.plans import render
from framekeel.sources.archive import compact_closed
from framekeel.sources.messages import read_messages
from framekeel.streaming import jobs


def model():
    def load():
        def predict(images):
            box, outside = [0.2, 0.2, 0.4, 0.4], [0.0, 0.0, 0.1, 0.1]
            nan = float("nan")
            # What a broken model may give: a score and a corner that are no numbers.
            broken = ([[0.3, 0.3, nan, 0.5], box], [3, 3], [0.9, nan])
            return [([box, outside, *broken[0]], [3, 2, *broken[1]], [0.9, 0.8, *broken[2]], 4) for _ in images]

        return predict

    return load


def frame(session, ts, device, data="aW1n"):
    metadata = {"ts": ts, "session": session, "datesegment": "2021/01/01", "device_id": device, "client_version": "1"}
    return json.dumps({"data": data, "metadata": metadata})


def test_frames_to_alerts(spark, tmp_path):
    inbox = tmp_path / "frames"
    inbox.mkdir()
    lines = [frame("a", t, 1) for t in (0, 59, 61)] + [frame("b", t, 2) for t in (10, 400)]
    lacking = ["{}", frame(None, 5, 1), frame("a", None, 1)]
    (inbox / "1.txt").write_text("\n".join([*lines, frame("a", 62, 1, ""), "broken", *lacking]))
    (inbox / "2.txt").write_text(frame("c", 5000, 3))
    health = HealthJobConfig(bucket="b", base_path="p", module="m", checkpoint=str(tmp_path / "cp"))
    assert health.session_gap_seconds == 120
    out = str(tmp_path / "out")

    def calibrations():
        return spark.sql("SELECT 1 device_id, 0.1D c_ymin, 0.1D c_xmin, 0.8D c_ymax, 0.8D c_xmax")

    def messages():
        return read_messages(spark, str(inbox), fmt="text")

    annotated = jobs.annotate_and_archive(messages(), calibrations, model(), health, out)
    annotated.awaitTermination()
    manifest = spark.read.parquet(f"{out}/manifest")
    labels = {(r["session"], r["ts"]): [p["labels"] for p in r["overlay"]] for r in manifest.collect()}
    assert len(labels) == 6
    assert labels["a", 0] == [["print: 90%"]]
    assert labels["b", 10] == [["print: 90%"], ["spaghetti: 80%"], ["print: 90%"]]
    rejects = {r["value"]: r["reject"] for r in spark.read.parquet(f"{out}/rejects").collect()}
    assert rejects == dict(zip(["broken", *lacking], ["malformed", "no metadata.ts", "no metadata.session", "no metadata.ts"]))
    assert [r["ts"] for r in spark.read.parquet(f"{out}/frames_without_image").collect()] == [62]
    archived = spark.read.parquet(f"{out}/archive")
    assert archived.count() == 7 + 4 and "annotations_filtered" not in archived.columns
    assert archived.where("window = '0_60'").count() == 3 and archived.where("window = 'rejects'").count() == 4
    assert {bytes(r["image_data"]) for r in archived.where("image_data IS NOT NULL").collect()} == {b"img"}
    assert archived.where("image_data IS NOT NULL").count() == 6
    done = [p["observedMetrics"]["predict"] for p in map(as_dict, annotated.recentProgress) if p.get("observedMetrics")]
    assert sum(m["count"] for m in done) >= 1

    for closed_before in (70, 120):
        compact_closed(spark, f"{out}/archive", f"{out}/closed", closed_before)
    closed = [f.parent.name for f in (tmp_path / "out/closed").rglob("*.parquet")]
    assert sorted(closed) == ["window=0_60", "window=60_120"]
    assert spark.read.parquet(f"{out}/closed").where("image_data IS NOT NULL").count() == 4

    requests = str(tmp_path / "requests")
    jobs.request_renders(messages(), health, requests).awaitTermination()
    sent = [json.loads(r["value"]) for r in spark.read.parquet(requests).collect()]
    assert sorted((m["metadata"]["session"], m["metadata"]["ts"]) for m in sent) == [("a", 62), ("b", 10), ("b", 400)]
    assert {m["cdn_output_path"] for m in sent} == {
        f"media/uploads/PrintSessionAlert/2021/01/01/{s}" for s in "ab"
    }

    config = RenderJobConfig(bucket="b", base_path="p", module="m", checkpoint=str(tmp_path / "cp"))
    jobs.render_and_alert(
        read_messages(spark, requests),
        lambda: manifest.where(F.col("session") != "b"),
        config,
        f"{out}/render",
    ).awaitTermination()
    renders = {r["session"]: r["frame_count"] for r in spark.read.parquet(f"{out}/render/renders").collect()}
    assert renders == {"a": 3, "b": 0}
    alerts = [json.loads(r["value"])["metadata"]["session"] for r in spark.read.parquet(f"{out}/render/alerts").collect()]
    assert alerts == ["a"]
    assert [r["ts"] for r in spark.read.parquet(f"{out}/render/frames").orderBy("ts").collect()] == [0, 59, 61]


def as_dict(progress):
    return json.loads(progress.json)


def test_the_last_session_ends_with_a_heartbeat(spark, tmp_path):
    inbox, beats = tmp_path / "frames", tmp_path / "beats"
    inbox.mkdir(), beats.mkdir()
    (inbox / "1.txt").write_text("\n".join(frame("only", t, 1) for t in (0, 30, 60)))

    def run(name, heartbeat=None):
        config = HealthJobConfig(bucket="b", base_path="p", module="m", checkpoint=str(tmp_path / name), repeats_within="10 minutes")
        sent = str(tmp_path / f"{name}-requests")
        jobs.request_renders(
            read_messages(spark, str(inbox), fmt="text"), config, sent, heartbeat=heartbeat
        ).awaitTermination()
        return [json.loads(r["value"])["metadata"] for r in spark.read.schema("value string").parquet(sent).collect()]

    assert run("quiet") == []
    (beats / "1.json").write_text('{"timestamp": "1970-01-01T00:10:00Z"}')
    heartbeat = spark.readStream.schema("timestamp timestamp").json(str(beats))
    assert [(m["session"], m["ts"]) for m in run("beating", heartbeat)] == [("only", 60)]


def test_repeated_frames_are_archived_once(spark, tmp_path):
    inbox = tmp_path / "frames"
    inbox.mkdir()
    (inbox / "1.txt").write_text("\n".join([frame("a", 1, 1), frame("a", 1, 1), frame("a", 2, 1), "broken"]))
    config = HealthJobConfig(bucket="b", base_path="p", module="m", checkpoint=str(tmp_path / "cp"), repeats_within="10 minutes")
    none = spark.createDataFrame([], "device_id int, c_ymin double, c_xmin double, c_ymax double, c_xmax double")
    out = str(tmp_path / "out")
    source = read_messages(spark, str(inbox), fmt="text")
    jobs.annotate_and_archive(source, lambda: none, model(), config, out).awaitTermination()
    assert sorted(r["ts"] or 0 for r in spark.read.parquet(f"{out}/archive").collect()) == [0, 1, 2]


def test_render_reads_only_the_days_asked_for(spark, tmp_path):
    manifest = str(tmp_path / "manifest")
    rows = spark.range(3000).selectExpr("concat('s', id % 50) session", "concat('d', id % 30) datesegment", "id ts", "concat('f', id) outpath")
    rows.write.partitionBy("datesegment").parquet(manifest)
    requests = spark.sql("SELECT 's5' session, 'd5' datesegment, 'p' cdn_output_path")
    stored = spark.read.parquet(manifest)
    renders = render.render_manifest(requests, stored, bucket="b", base_path="p", module="m")
    assert renders.first()["frame_count"] == rows.where("session = 's5' AND datesegment = 'd5'").count() > 0
    plan = renders._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Aggregate [datesegment") :]
    assert "LeftSemi" in below


def test_no_frames_yet(spark, tmp_path):
    config = RenderJobConfig(bucket="b", base_path="p", module="m", checkpoint=str(tmp_path / "cp"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text('{"cdn_output_path":"p","metadata":{"session":"s","datesegment":"d"}}\nnope')
    nothing = spark.sql("SELECT 's' session, 'd' datesegment, 1L ts, 'f' outpath").where("false")
    jobs.render_and_alert(
        read_messages(spark, str(tmp_path / "in"), fmt="text"), lambda: nothing, config, str(tmp_path / "out")
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/renders")).first()["frame_count"] == 0
    assert spark.read.parquet(str(tmp_path / "out/malformed")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out/alerts")).count() == 0


def test_counts_and_frame_lists_agree_if_the_manifest_changes(spark, tmp_path):
    config = RenderJobConfig(bucket="b", base_path="p", module="m", checkpoint=str(tmp_path / "cp"))
    (tmp_path / "in").mkdir()
    asked = [f'{{"cdn_output_path":"p{n}","metadata":{{"session":"{s}","datesegment":"d"}}}}' for n, s in enumerate("aabx")]
    (tmp_path / "in" / "1.txt").write_text("\n".join([*asked, "nope"]))
    # Each time it is read, other frames are there.
    there = F.udf(lambda: random.random() < 0.5, "boolean").asNondeterministic()
    frames = spark.range(3000).selectExpr("substr('abc', 1 + id % 3, 1) session", "'d' datesegment", "id ts", "concat('f', id) outpath")
    out = str(tmp_path / "out")
    jobs.render_and_alert(
        read_messages(spark, str(tmp_path / "in"), fmt="text"), lambda: frames.where(there()), config, out
    ).awaitTermination()
    listed = [(r["session"], r["ts"]) for r in spark.read.parquet(f"{out}/frames").collect()]
    counts = {session: sum(s == session for s, _ in listed) for session in "abx"}
    renders = spark.read.parquet(f"{out}/renders").collect()
    assert sorted((r["cdn_output_path"], r["frame_count"]) for r in renders) == [
        (f"p{n}", counts[s]) for n, s in enumerate("aabx")
    ]
    assert counts["a"] > 0 and counts["x"] == 0 and len(listed) == counts["a"] + counts["b"]
    assert sorted(r["value"] for r in spark.read.parquet(f"{out}/alerts").collect()) == asked[:3]
    assert [r["value"] for r in spark.read.parquet(f"{out}/malformed").collect()] == ["nope"]
