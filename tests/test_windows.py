from datetime import timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framekeel.operators import windows

QUICK = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def events(spark, rows, schema="session string, ts long, frame_id long"):
    return windows.assign_event_time(spark.createDataFrame(rows, schema).coalesce(1))


def brute_sessions(rows, gap):
    out = []
    for key in {r[0] for r in rows}:
        current = []
        for r in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])):
            if current and r[1] - current[-1][1] >= gap:
                out.append(current)
                current = []
            current.append(r)
        out.append(current)
    return sorted((s[0][0], s[0][1], s[-1][1] + gap, len(s), s[-1][2]) for s in out)


def our_sessions(spark, rows, gap):
    got = windows.sessions(events(spark, rows), "session", gap, "frame_id").select(
        "session", F.unix_timestamp("session_start"), F.unix_timestamp("session_end"), "n_rows", "latest_frame_id"
    )
    return sorted(map(tuple, got.collect()))


def test_event_time_is_epoch_seconds(spark):
    assert events(spark, [("a", 60, 1)]).selectExpr("unix_micros(event_time)").first()[0] == 60_000_000


def test_sessions_split_at_the_gap(spark):
    rows = [("a", t, i) for i, t in enumerate((0, 119, 241))] + [("b", 0, 7), ("b", 120, 8)]
    assert our_sessions(spark, rows, 120) == [
        ("a", 0, 239, 2, 1),
        ("a", 241, 361, 1, 2),
        ("b", 0, 120, 1, 7),
        ("b", 120, 240, 1, 8),
    ]


def test_ties_go_to_the_greatest_id(spark):
    assert our_sessions(spark, [("a", 5, 2), ("a", 5, 9), ("a", 5, 4)], 120)[0][-1] == 9


@QUICK
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-300, 900)), min_size=1, max_size=60), st.sampled_from([7, 60, 120]))
def test_sessions_match_brute_force(spark, pairs, gap):
    rows = [(k, t, i) for i, (k, t) in enumerate(pairs)]
    assert our_sessions(spark, rows, gap) == brute_sessions(rows, gap)


def test_sessions_below_a_second(spark):
    rows = spark.sql(
        "SELECT 'a' s, id, timestamp_micros(id * 1999999) event_time FROM range(4) UNION ALL "
        "SELECT 'b', id, timestamp_micros(id * 2000000) FROM range(4)"
    )
    got = windows.sessions(rows, "s", 2, "id").groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in got} == {"a": 1, "b": 4}


def test_a_hot_session_reaches_the_window_as_slots(spark):
    rows = spark.range(200_000).selectExpr("'hot' s", "id", "timestamp_seconds(id % 1200) event_time")
    sessions = windows.sessions(rows, "s", 120, "id")
    assert [(r["n_rows"], r["latest_id"]) for r in sessions.collect()] == [(200_000, 199_199)]
    plan = sessions._jdf.queryExecution().executedPlan().toString()
    window_input = plan[plan.rindex("Window [") :]
    assert "partial_max" in window_input and "Exchange" in window_input


def test_tumbling_window_bounds(spark):
    rows = events(spark, [("a", 59, 1), ("a", 60, 2), ("a", 119, 3), ("b", 0, 4)])
    got = windows.group_by_window(rows, "session", 60, F.count("*").alias("n"))
    assert sorted(map(tuple, got.collect())) == [("a", 0, 60, 1), ("a", 60, 120, 2), ("b", 0, 60, 1)]
    first = windows.first_per_window(rows, "session", ["event_time", "frame_id"], 60, "frame_id")
    assert sorted(map(tuple, first.collect())) == [("a", 0, 60, 1), ("a", 60, 120, 2), ("b", 0, 60, 4)]


@QUICK
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 2000), st.integers(-9, 9)), min_size=1, max_size=60))
def test_sliding_matches_the_built_in_window(spark, rows):
    df = events(spark, rows, "session string, ts long, value long")
    ours = windows.sliding_stats(df, "session", "value", 300, 60)
    built_in = df.groupBy("session", F.window("event_time", "300 seconds", "60 seconds")).agg(
        F.count("value"), F.sum("value"), F.min("value"), F.max("value")
    )
    expected = {(r[0], int(r[1]["start"].replace(tzinfo=timezone.utc).timestamp()), *r[2:]) for r in built_in.collect()}
    assert {tuple(r) for r in ours.select("session", "window_start", "n", "total", "low", "high").collect()} == expected


def test_lookback_leaves_out_current_and_oldest(spark):
    cursor = spark.sql("SELECT 1000 cursor")

    def starts(size, period):
        return [r["window_start"] for r in windows.lookback(cursor, size, period).collect()]

    assert starts(300, 60) == [940, 880, 820, 760]
    assert starts(60, 60) == [] and starts(120, 60) == [940]
