"""SQL of the queries in ``stream_queries``."""

from __future__ import annotations

from .oracle import _CALS, _CATS, _CLOSED, _EMBEDDING, _EVENT_SESSIONS, _FRAMES, _MARK, _MODEL, _SCORED, _SESSIONS, _WINDOW

_HALVES = "(SELECT (min(event_id) + max(event_id)) / 2 FROM events)"


def oracle_sql() -> dict[str, str]:
    return {
        "stream_health_trend": f"""WITH {_CATS}, sec AS (
  SELECT user_id, epoch_us(ts) // 1000000 AS s, coalesce(max(w * value / 100) FILTER (WHERE w > 0), 0)
    + coalesce(min(w * value / 100) FILTER (WHERE w < 0), 0) AS health
  FROM events JOIN cats ON class = event_id % 7 WHERE w <> 0 GROUP BY 1, 2),
win AS (SELECT *, s // 3600 * 3600 - k * 3600 AS window_start FROM sec, unnest(range(0, 5)) AS t(k)),
cum AS (
  SELECT *, sum(health) OVER (PARTITION BY user_id, window_start ORDER BY s ROWS UNBOUNDED PRECEDING) AS c,
    min(s) OVER (PARTITION BY user_id, window_start) AS lo, max(s) OVER (PARTITION BY user_id, window_start) AS hi FROM win),
fit AS (
  SELECT user_id, window_start, count(*) AS n, lo AS x_min, hi AS x_max, arg_max(c, s) AS total,
    CASE WHEN count(*) > 1 THEN regr_intercept(c, -1 + 2 * (s - lo) / nullif(hi - lo, 0)::double) END AS c0,
    CASE WHEN count(*) > 1 THEN regr_slope(c, -1 + 2 * (s - lo) / nullif(hi - lo, 0)::double) END AS c1
  FROM cum GROUP BY user_id, window_start, lo, hi)
SELECT user_id, window_start, window_start + 18000 AS window_end, n, x_min, x_max, round(total, 6) AS total,
  round(c0, 6) AS c0, round(c1, 6) AS c1,
  CASE WHEN abs(c1) > 1e-9 * greatest(abs(c0), abs(c1)) THEN round(x_min + (1 - c0 / c1) / 2 * (x_max - x_min), 0) END AS root
FROM fit {_CLOSED.format(size=18000)}""",
        "stream_subscription": "SELECT event_id, epoch_us(ts) AS us, user_id, event_type FROM events",
        "stream_publish_commit": f"""SELECT event_id, epoch_us(ts) AS us,
  CASE WHEN event_id <= {_HALVES} THEN 1 ELSE 2 END AS seen, 1 AS copies FROM events""",
        "calibration_asof": f"""WITH {_FRAMES}, v AS (
  SELECT device_id, CAST(strftime(to_timestamp(ts), '%Y') AS INTEGER) AS y, min(ts) AS first FROM frames
  WHERE device_id % 5 <> 0 GROUP BY 1, 2),
versions AS (
  SELECT device_id, first + device_id * 86400 AS valid_from, 0.1::double + ((y + device_id) % 4) / 10::double AS c_ymin FROM v)
SELECT frame_id, f.device_id, round(c_ymin, 6) AS c_ymin, CASE WHEN c_ymin IS NOT NULL THEN 0.8::double END AS c_ymax
FROM frames f ASOF LEFT JOIN versions v ON f.device_id = v.device_id AND f.ts >= v.valid_from""",
        "calibration_versions": f"""WITH {_CALS}
SELECT device_id, 0::bigint AS valid_from, c_ymin, c_xmax, 1.0::double AS fps FROM cals
UNION ALL SELECT device_id, 788918400, 0.2::double, c_xmax, 1.0::double FROM cals WHERE device_id % 3 = 0""",
        "stream_render_join": f"""WITH {_SESSIONS}
SELECT r.session, r.latest_ts AS requested, f.frame_id FROM latest r
LEFT JOIN frames f ON f.session = r.session AND f.ts BETWEEN r.session_start AND r.latest_ts AND f.payload = '1-URGENT'""",
        "stream_late_rejects": """WITH e AS (
  SELECT *, epoch_us(ts) AS us, event_id % 10 = 0
    AND epoch_us(ts) < (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events) AS last FROM events),
m AS (SELECT max(us) // 1000 - 3600000 AS mark FROM e WHERE NOT last),
j AS (SELECT user_id, CASE WHEN last AND us <= mark * 1000 THEN mark - us // 1000 END AS late_ms FROM e, m)
SELECT user_id, count(*) FILTER (WHERE late_ms IS NULL) AS n_kept, count(late_ms) AS n_late, min(late_ms) AS least_ms,
  max(late_ms) AS most_ms FROM j GROUP BY user_id""",
        "stream_state": f"""WITH c AS (
  SELECT user_id, epoch_us(ts) // 86400000000 * 86400 AS window_start, value FROM events)
SELECT user_id, window_start, window_start + 86400 AS window_end, count(value) AS n, round(sum(value), 6) AS total,
  min(value) AS low, max(value) AS high
FROM c WHERE (window_start + 86400) * 1000000 > {_MARK} - 10 * 86400000000 GROUP BY user_id, window_start""",
        "stream_state_sessions": f"""WITH {_EVENT_SESSIONS}
SELECT * FROM event_sessions WHERE end_us - 1 > {_MARK} - 10 * 86400000000""",
        "decode_problems": f"""WITH {_FRAMES}, r AS (
  SELECT frame_id, CASE WHEN frame_id % 97 = 0 THEN 'malformed'
    WHEN frame_id % 29 = 0 OR frame_id % 19 = 0 OR frame_id % 23 = 0 THEN 'bad ' || concat_ws(', ',
      CASE WHEN frame_id % 29 = 0 THEN 'data' END, CASE WHEN frame_id % 19 = 0 THEN 'metadata.ts' END,
      CASE WHEN frame_id % 23 = 0 THEN 'metadata.user_id' END) END AS reject FROM frames)
SELECT * FROM r WHERE reject IS NOT NULL""",
        "score_held_model": f"WITH {_CATS}, {_MODEL}",
        "broken_outputs": f"""WITH {_CATS}, v AS (
  SELECT vec_id, vec_id % 5 AS turn, list_concat(e, [0, 0, 0, 0, 0, 0]) AS e, (len(e) + 5) // 6 AS n FROM ({_EMBEDDING}) x),
o AS (
  SELECT vec_id, CAST(CASE WHEN turn IN (0, 2) THEN 0 ELSE n END AS INTEGER) AS num_detections, CAST(i + 1 AS INTEGER) AS pos,
    CASE WHEN i <> turn OR turn > 2 THEN CAST(floor(abs(e[i * 6 + 5]::double) * 1000) % 6 AS INTEGER) + 1 END AS class,
    CASE WHEN turn <> 3 OR i < 2 THEN abs(e[i * 6 + 6]::double) - floor(abs(e[i * 6 + 6]::double)) END AS score
  FROM v, unnest(range(0, n)) AS t(i))
SELECT o.*, w AS health_weight FROM o LEFT JOIN cats ON cats.class = o.class""",
        "archive_compacted": f"""WITH {_SCORED}
SELECT (ts // {_WINDOW} * {_WINDOW}) || '_' || (ts // {_WINDOW} * {_WINDOW} + {_WINDOW}) AS "window",
  count(*) AS n_frames, CAST(sum(strlen(payload)) FILTER (WHERE frame_id % 89 <> 0) AS BIGINT) AS n_detections,
  CAST(sum(strlen(payload)) FILTER (WHERE frame_id % 89 <> 0) AS BIGINT) AS image_bytes, 1::bigint AS n_files
FROM arrived GROUP BY ts // {_WINDOW}""",
    }
