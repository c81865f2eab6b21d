"""The same queries in plain SQL, written independently of the Spark code."""

from __future__ import annotations

_AREA = "0.1::double AS c_ymin, 0.1::double AS c_xmin, 0.8::double AS c_ymax, 0.8::double AS c_xmax"

_FRAMES = """frames AS (
  SELECT o_orderkey AS frame_id, CAST(o_custkey AS VARCHAR) AS session, o_custkey AS user_id,
    c_nationkey AS device_id, epoch_us(o_orderdate) // 1000000 AS ts, o_orderpriority AS payload,
    strftime(min(o_orderdate) OVER (PARTITION BY o_custkey), '%Y/%m/%d') AS datesegment
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""

_DETS = """dets AS (
  SELECT l_orderkey AS frame_id,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
      l_extendedprice, l_discount, l_tax, l_shipdate) AS pos,
    CAST(l_partkey % 7 AS INTEGER) AS class, l_partkey, l_suppkey,
    ((l_partkey * 13 + l_linenumber * 17 + l_suppkey) % 100) / 100.0::double AS score,
    l_discount * 5 AS ymin, l_tax * 5 AS xmin, l_discount * 5 + l_quantity / 100 AS ymax,
    l_tax * 5 + l_linenumber / 10.0::double AS xmax
  FROM lineitem)"""

_CATS = """cats AS (
  SELECT * FROM (VALUES (0, 'background', 0.0::double), (1, 'nozzle', 0.0::double),
    (2, 'adhesion', -0.5::double), (3, 'spaghetti', -0.5::double), (4, 'print', 1.0::double),
    (5, 'raft', 1.0::double)) AS t(class, name, w))"""

_CALS = f"""cals AS (
  SELECT n_nationkey AS device_id, {_AREA} FROM nation WHERE n_nationkey % 4 <> 0)"""


def _share(d: str = "", c: str = "") -> str:
    top, left = f"greatest({d}ymin, {c}c_ymin)", f"greatest({d}xmin, {c}c_xmin)"
    bottom, right = f"least({d}ymax, {c}c_ymax)", f"least({d}xmax, {c}c_xmax)"
    area = f"(({d}ymax - {d}ymin) * ({d}xmax - {d}xmin))"
    return f"""CASE WHEN {c}c_ymin IS NULL THEN NULL WHEN {bottom} < {top} OR {right} < {left} THEN 0.0::double
      ELSE coalesce((({bottom} - {top}) * ({right} - {left})) / nullif({area}, 0), 0.0::double) END"""


_LABELLED = f"""{_DETS}, {_CATS}, labelled AS (
  SELECT d.*, coalesce(name, 'N/A') AS name, w, CAST(trunc(100 * score) AS INTEGER) AS pct
  FROM dets d LEFT JOIN cats c ON c.class = d.class)"""

_OVERLAP = f"""{_FRAMES}, {_DETS}, {_CALS}, seen AS (
  SELECT f.*, c.* EXCLUDE (device_id) FROM frames f LEFT JOIN cals c ON c.device_id = f.device_id),
found AS (
  SELECT d.*, s.session, s.ts, s.c_ymin, {_share('d.', 's.')} AS overlap
  FROM dets d JOIN seen s ON s.frame_id = d.frame_id)"""

_COUNTS = f"""{_OVERLAP}, counts AS (
  SELECT s.frame_id, count(f.pos) AS num_all,
    CASE WHEN any_value(s.c_ymin) IS NULL THEN NULL ELSE count(*) FILTER (WHERE overlap > 0.75) END AS num_filtered,
    max(f.score) AS max_all, max(f.score) FILTER (WHERE overlap > 0.75) AS max_filtered
  FROM seen s LEFT JOIN found f ON f.frame_id = s.frame_id GROUP BY s.frame_id)"""

# Frames with detections made of the numbers of a vector.
def _part(k: str) -> str:
    return f"(abs(e[{k}]::double) - floor(abs(e[{k}]::double)))"


_NESTED = f"""{_FRAMES}, {_CATS}, {_CALS}, nested AS (
  SELECT f.*, CAST(i AS INTEGER) AS pos, CAST(floor(abs(e[i + 44]::double) * 1000) % 7 AS INTEGER) AS class,
    abs(e[i + 40]::double) * 10 - floor(abs(e[i + 40]::double) * 10) AS score,
    {_part('(i - 1) // 2 * 4 + 1')} / 2 AS ymin, {_part('(i - 1) // 2 * 4 + 2')} / 2 AS xmin,
    {_part('(i - 1) // 2 * 4 + 1')} / 2 + {_part('(i - 1) // 2 * 4 + 3')} / 2 AS ymax,
    {_part('(i - 1) // 2 * 4 + 2')} / 2 + {_part('(i - 1) // 2 * 4 + 4')} / 2 AS xmax
  FROM frames f JOIN (SELECT vec_id, embedding AS e FROM embeddings) v
    ON v.vec_id = f.frame_id % (SELECT count(*) FROM embeddings), unnest(range(1, frame_id % 21 + 1)) AS t(i)),
weighted AS (SELECT n.*, w FROM nested n LEFT JOIN cats c ON c.class = n.class),
kept AS (
  SELECT n.*, c.c_ymin, {_share('n.', 'c.')} AS overlap
  FROM weighted n LEFT JOIN cals c ON c.device_id = n.device_id),
flagged AS (
  SELECT *, count(*) FILTER (WHERE overlap > 0.75) OVER (PARTITION BY frame_id) AS n_kept FROM kept),
effective AS (
  SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY pos) AS rank
  FROM flagged WHERE n_kept = 0 OR overlap > 0.75),
drawn AS (SELECT * FROM effective WHERE rank <= 5 AND score > 0.66)"""

_WINDOW = 30 * 86400
_GAP = 180 * 86400
_EVENT_GAP = 12 * 3600 * 1000000

_SESSIONS = f"""{_FRAMES}, breaks AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY session ORDER BY ts, frame_id) < {_GAP} THEN 0 ELSE 1 END AS b
  FROM frames),
numbered AS (
  SELECT *, sum(b) OVER (PARTITION BY session ORDER BY ts, frame_id) AS session_no FROM breaks),
latest AS (
  SELECT session, session_no, min(ts) AS session_start, max(ts) + {_GAP} AS session_end, count(*) AS n_rows,
    max(ts) AS latest_ts, any_value(user_id) AS user_id, any_value(datesegment) AS datesegment,
    arg_max(frame_id, struct_pack(a := ts, b := frame_id)) AS latest_frame_id
  FROM numbered GROUP BY session, session_no),
requests AS (
  SELECT *, 'media/uploads/PrintSessionAlert/' || datesegment || '/' || session AS cdn_output_path FROM latest)"""

_REQUEST_JSON = """'{"cdn_output_path":"' || cdn_output_path || '","metadata":{"ts":' || CAST(latest_ts AS VARCHAR)
  || ',"session":"' || session || '","datesegment":"' || datesegment || '","user_id":' || CAST(user_id AS VARCHAR) || '}}'"""

_EVENT_SESSIONS = f"""eb AS (
  SELECT user_id, event_id, event_type, value, epoch_us(ts) AS us,
    CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) < {_EVENT_GAP}
      THEN 0 ELSE 1 END AS b FROM events),
en AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY us, event_id) AS session_no FROM eb),
event_sessions AS (
  SELECT user_id, min(us) AS start_us, max(us) + {_EVENT_GAP} AS end_us, count(*) AS n_rows,
    arg_max(event_id, struct_pack(a := us, b := event_id)) AS latest_event_id,
    arg_max(event_type, struct_pack(a := us, b := event_id)) AS latest_event_type,
    arg_max(value, struct_pack(a := us, b := event_id)) AS latest_value
  FROM en GROUP BY user_id, session_no)"""

# The watermark that closes windows: the latest event time, in whole milliseconds.
_MARK = "(SELECT max(epoch_us(ts)) // 1000 * 1000 FROM events)"

_SLIDING = """SELECT user_id, epoch_us(ts) // 3600000000 * 3600 - k * 3600 AS window_start, value
  FROM events, unnest(range(0, 5)) AS t(k)"""

_HEALTH = f"""{_FRAMES}, {_DETS}, {_CATS}, hr AS (
  SELECT f.session, f.ts, d.frame_id, d.pos, d.class, d.score, w, w * score AS hs
  FROM dets d JOIN frames f ON f.frame_id = d.frame_id LEFT JOIN cats c ON c.class = d.class),
byts AS (
  SELECT session, ts, coalesce(max(hs) FILTER (WHERE w > 0), 0) + coalesce(min(hs) FILTER (WHERE w < 0), 0) AS health
  FROM hr WHERE w <> 0 GROUP BY session, ts),
cum AS (
  SELECT *, sum(health) OVER (PARTITION BY session ORDER BY ts ROWS UNBOUNDED PRECEDING) AS cumsum FROM byts)"""

_TREND = f"""{_HEALTH}, dom AS (
  SELECT session, count(*) AS n, min(ts) AS x_min, max(ts) AS x_max FROM cum GROUP BY session),
scaled AS (
  SELECT c.*, d.n, x_min, x_max, -1 + 2 * (ts - x_min) / nullif(x_max - x_min, 0)::double AS u
  FROM cum c JOIN dom d ON d.session = c.session),
fit AS (
  SELECT session, n, x_min, x_max,
    CASE WHEN n > 1 THEN regr_intercept(cumsum, u) END AS c0, CASE WHEN n > 1 THEN regr_slope(cumsum, u) END AS c1
  FROM scaled GROUP BY session, n, x_min, x_max)"""

_PATH = "'gs://frame-archive/dataflow/sliding_window_health/monitoring_pb2.AnnotatedMonitoringImage/'"
_FRAME_PATH = f"{_PATH} || datesegment || '/' || session || '/jpg/' || CAST(ts AS VARCHAR) || '.jpg'"

_EMBEDDING = "SELECT vec_id, embedding AS e, (len(embedding) + 3) // 4 AS n FROM embeddings"
_MODEL = """out AS (
  SELECT vec_id, CAST((n + 5) // 6 AS INTEGER) AS num_detections, CAST(i + 1 AS INTEGER) AS pos,
    CAST(floor(abs(e[i * 6 + 5]::double) * 1000) % 6 AS INTEGER) + 1 AS class,
    abs(e[i * 6 + 6]::double) - floor(abs(e[i * 6 + 6]::double)) AS score,
    abs(e[i * 6 + 1]::double) AS ymin, abs(e[i * 6 + 2]::double) AS xmin,
    abs(e[i * 6 + 3]::double) AS ymax, abs(e[i * 6 + 4]::double) AS xmax
  FROM (SELECT vec_id, list_concat(embedding, [0, 0, 0, 0, 0, 0]) AS e, len(embedding) AS n FROM embeddings) v,
    unnest(range(0, (n + 5) // 6)) AS t(i))
SELECT out.*, w AS health_weight FROM out LEFT JOIN cats ON cats.class = out.class"""

_REJECT_LISTS = " UNION ALL ".join(
    f"SELECT frame_id, '{f}' AS feature FROM frames WHERE frame_id % 41 = 0"
    for f in ("detection_scores", "boxes_ymin", "boxes_xmin", "boxes_ymax", "boxes_xmax")
)

_CLOSED = f"WHERE (window_start + {{size}}) * 1000000 <= {_MARK}"

# Colour names, from the position of each in the palette.
_COLOR7 = """CASE class WHEN 0 THEN 'AliceBlue' WHEN 1 THEN 'Chartreuse' WHEN 2 THEN 'Aqua'
  WHEN 3 THEN 'Aquamarine' WHEN 4 THEN 'Azure' WHEN 5 THEN 'Beige' ELSE 'Bisque' END"""


# Messages that arrive whole, and the detections the payload model makes of their images.
_SCORED = f"""{_FRAMES}, {_CATS}, {_CALS}, arrived AS (SELECT * FROM frames WHERE frame_id % 97 <> 0),
imaged AS (SELECT * FROM arrived WHERE frame_id % 89 <> 0),
found AS (
  SELECT f.*, CAST(i AS INTEGER) AS pos, ord(substr(payload, i + 1, 1)) % 6 + 1 AS class,
    CASE WHEN substr(payload, i + 1, 1) = ' ' THEN 0 ELSE ord(substr(payload, i + 1, 1)) / 128.0::double END AS score, 0.2::double * i AS ymin, 0.1::double AS xmin,
    0.2::double * i + 0.2::double AS ymax, 0.5::double AS xmax
  FROM imaged f, unnest(range(0, strlen(payload))) AS t(i)),
kept AS (SELECT f.*, c.c_ymin, {_share('f.', 'c.')} AS overlap FROM found f LEFT JOIN cals c ON c.device_id = f.device_id),
flagged AS (SELECT *, count(*) FILTER (WHERE overlap > 0.75) OVER (PARTITION BY frame_id) AS n_kept FROM kept),
effective AS (
  SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY pos) AS rank
  FROM flagged WHERE n_kept = 0 OR overlap > 0.75)"""


# Colour names in palette order, kept here as well so that the SQL does not rest on the code it checks.
_PALETTE = """
    AliceBlue Chartreuse Aqua Aquamarine Azure Beige Bisque BlanchedAlmond BlueViolet BurlyWood CadetBlue
    AntiqueWhite Chocolate Coral CornflowerBlue Cornsilk Crimson Cyan DarkCyan DarkGoldenRod DarkGrey DarkKhaki
    DarkOrange DarkOrchid DarkSalmon DarkSeaGreen DarkTurquoise DarkViolet DeepPink DeepSkyBlue DodgerBlue
    FireBrick FloralWhite ForestGreen Fuchsia Gainsboro GhostWhite Gold GoldenRod Salmon Tan HoneyDew HotPink
    IndianRed Ivory Khaki Lavender LavenderBlush LawnGreen LemonChiffon LightBlue LightCoral LightCyan
    LightGoldenRodYellow LightGray LightGrey LightGreen LightPink LightSalmon LightSeaGreen LightSkyBlue
    LightSlateGray LightSlateGrey LightSteelBlue LightYellow Lime LimeGreen Linen Magenta MediumAquaMarine
    MediumOrchid MediumPurple MediumSeaGreen MediumSlateBlue MediumSpringGreen MediumTurquoise MediumVioletRed
    MintCream MistyRose Moccasin NavajoWhite OldLace Olive OliveDrab Orange OrangeRed Orchid PaleGoldenRod
    PaleGreen PaleTurquoise PaleVioletRed PapayaWhip PeachPuff Peru Pink Plum PowderBlue Purple Red RosyBrown
    RoyalBlue SaddleBrown Green SandyBrown SeaGreen SeaShell Sienna Silver SkyBlue SlateBlue SlateGray SlateGrey
    Snow SpringGreen SteelBlue GreenYellow Teal Thistle Tomato Turquoise Violet Wheat White WhiteSmoke Yellow
    YellowGreen
"""


def _palette() -> str:
    return "[" + ", ".join(f"'{name}'" for name in _PALETTE.split()) + "]"


def oracle_sql() -> dict[str, str]:
    return {
        "decode_frames": f"""WITH {_FRAMES}, m AS (SELECT *, frame_id % 97 = 0 AS bad FROM frames)
SELECT frame_id, CASE WHEN NOT bad THEN session END AS session, CASE WHEN NOT bad THEN datesegment END AS datesegment,
  CASE WHEN NOT bad THEN ts END AS ts, CASE WHEN NOT bad THEN device_id END AS device_id,
  CASE WHEN NOT bad THEN CAST(strlen(payload) AS INTEGER) END AS n_bytes, bad AS is_malformed FROM m""",
        "decode_render_request": f"""WITH {_SESSIONS}
SELECT cdn_output_path, session, datesegment, latest_ts AS ts, false AS is_malformed FROM requests""",
        "encode_render_request": f"""WITH {_SESSIONS}
SELECT session, datesegment, cdn_output_path, latest_ts AS ts, user_id, {_REQUEST_JSON} AS value FROM requests""",
        "assign_event_time": f"WITH {_FRAMES} SELECT frame_id, session, ts * 1000000 AS event_us FROM frames",
        "typed_path": f"""WITH {_FRAMES} SELECT frame_id, {_FRAME_PATH} AS path,
  's3://' || substr({_PATH}, 6) || datesegment || '/' || session || '/mp4/' AS folder FROM frames""",
        "boxes_zip": f"""SELECT vec_id, CAST(i AS INTEGER) AS pos, e[i + 1]::double AS ymin, e[n + i + 1]::double AS xmin,
  e[2 * n + i + 1]::double AS ymax, e[3 * n + i + 1]::double AS xmax
FROM ({_EMBEDDING}) v, unnest(range(0, n)) AS t(i)""",
        "boxes_unzip": "SELECT vec_id, "
        + ", ".join(
            f"array_to_string([CAST(round(1000000 * x::double) AS BIGINT) FOR x IN e[{k} * n + 1:{k + 1} * n]], ',') AS {c}"
            for k, c in enumerate(("ymin", "xmin", "ymax", "xmax"))
        )
        + f" FROM ({_EMBEDDING}) v",
        "conform_rejects": f"""WITH {_FRAMES} {_REJECT_LISTS}
UNION ALL SELECT frame_id, 'user_id' FROM frames WHERE frame_id % 53 = 0
UNION ALL SELECT frame_id, 'detection_classes' FROM frames
  WHERE frame_id % 41 = 0 OR (frame_id % 59 = 0 AND frame_id % 21 > 0)""",
        "conform_good": f"""WITH {_NESTED}
SELECT f.session, f.ts, CAST(f.user_id AS BIGINT) AS user_id, f.device_id,
  CAST(f.frame_id % 21 AS INTEGER) AS num_detections,
  coalesce(string_agg(CAST(class AS VARCHAR), ',' ORDER BY pos), '') AS classes,
  coalesce(string_agg(CAST(round(1000 * xmax::float)::int AS VARCHAR), ',' ORDER BY pos), '') AS right_edges
FROM frames f LEFT JOIN nested n ON n.frame_id = f.frame_id
WHERE f.frame_id % 41 <> 0 AND f.frame_id % 53 <> 0 AND NOT (f.frame_id % 59 = 0 AND f.frame_id % 21 > 0)
GROUP BY f.frame_id, f.session, f.ts, f.user_id, f.device_id""",
        "explode_detections": f"""WITH {_NESTED}
SELECT ts, session, frame_id, pos, class AS detection_class, score AS detection_score, w AS health_weight,
  w * score AS health_score FROM weighted""",
        "health_weight": f"WITH {_LABELLED} SELECT frame_id, class, w AS health_weight, name FROM labelled",
        "percent_intersection": f"""WITH {_DETS}, a AS (SELECT *, {_AREA} FROM dets)
SELECT frame_id, class, score, {_share()} AS overlap FROM a""",
        "display_label": f"""WITH {_LABELLED}
SELECT frame_id, name || ': ' || pct || '%' AS label, name AS name_only, pct || '%' AS score_only,
  pct || '%' AS agnostic, name || ': ' || pct || '%: ID ' || l_suppkey AS tracked, 'ID ' || l_suppkey AS track_only
FROM labelled""",
        "box_color": f"""WITH {_DETS} SELECT frame_id, ({_palette()})[class % 126 + 1] AS color,
  ({_palette()})[(13 * l_partkey) % 126 + 1] AS track_color,
  CASE WHEN score >= 0.05::double THEN 'DarkOrange' ELSE 'black' END AS agnostic_color FROM dets""",
        "aoi_filter": f"""WITH {_OVERLAP}, {_CATS}
SELECT frame_id, f.class, score, overlap, w AS health_weight FROM found f LEFT JOIN cats c ON c.class = f.class
WHERE overlap > 0.75""",
        "merge_filtered": f"WITH {_COUNTS} SELECT frame_id, num_all, num_filtered FROM counts",
        "effective_annotations": f"""WITH {_COUNTS}
SELECT frame_id, CASE WHEN num_filtered > 0 THEN 'filtered' ELSE 'all' END AS source,
  CASE WHEN num_filtered > 0 THEN num_filtered ELSE num_all END AS num_effective,
  CASE WHEN num_filtered > 0 THEN max_filtered ELSE max_all END AS max_score FROM counts""",
        "drawable_boxes": f"""WITH {_DETS}
SELECT frame_id, CAST(pos AS INTEGER) AS pos, class, score FROM dets WHERE pos <= 5 AND score > 0.66""",
        "effective_drawable": f"""WITH {_COUNTS}, eff AS (
  SELECT f.*, overlap > 0.75 AS kept, row_number() OVER (PARTITION BY f.frame_id ORDER BY pos) AS rank
  FROM found f JOIN counts c ON c.frame_id = f.frame_id
  WHERE coalesce(num_filtered, 0) = 0 OR overlap > 0.75)
SELECT frame_id, CAST(rank AS INTEGER) AS pos, class, score, kept FROM eff WHERE rank <= 5 AND score > 0.66""",
        "calibration_join": f"""WITH {_FRAMES}, {_CALS}
SELECT frame_id, f.device_id, c_ymin, c_xmin, c_ymax, c_xmax FROM frames f LEFT JOIN cals c ON c.device_id = f.device_id""",
        "category_join": f"WITH {_LABELLED} SELECT frame_id, class, name, w AS health_weight, score FROM labelled",
        "read_calibrations": f"WITH {_CALS} SELECT *, device_id + 0.5::double AS fps FROM cals",
        "nested_aoi_filter": f"""WITH {_NESTED}
SELECT frame_id, pos, class, score, w AS health_weight FROM kept WHERE overlap > 0.75""",
        "nested_effective": f"""WITH {_NESTED}
SELECT f.frame_id, CAST(f.frame_id % 21 AS INTEGER) AS num_all,
  CASE WHEN f.device_id % 4 <> 0 THEN CAST(count(e.pos) FILTER (WHERE overlap > 0.75) AS INTEGER) END AS num_filtered,
  CAST(count(e.pos) AS INTEGER) AS num_effective, max(score) AS max_score
FROM frames f LEFT JOIN effective e ON e.frame_id = f.frame_id GROUP BY f.frame_id, f.device_id""",
        "nested_drawable": f"WITH {_NESTED} SELECT frame_id, pos, class, score FROM drawn",
        "nested_overlay": f"""WITH {_NESTED}
SELECT frame_id, ymin, xmin, ymax, xmax,
  string_agg(coalesce(name, 'N/A') || ': ' || CAST(trunc(100 * score) AS INTEGER) || '%'
    || CASE WHEN last_class = 6 THEN ' (ignored)' ELSE '' END, ';' ORDER BY pos) AS labels,
  arg_max({_COLOR7.replace('class', 'n.class')}, pos) AS color, any_value(last_class) = 6 AS ignored
FROM (SELECT *, arg_max(class, pos) OVER (PARTITION BY frame_id, ymin, xmin, ymax, xmax) AS last_class
  FROM nested WHERE pos <= 5 AND score > 0.2) n LEFT JOIN cats c ON c.class = n.class
GROUP BY frame_id, ymin, xmin, ymax, xmax""",
        "window_health": f"""WITH {_OVERLAP}, {_CATS}, per_window AS (
  SELECT session, ts // {_WINDOW} * {_WINDOW} AS window_start, count(*) AS n_frames FROM seen GROUP BY 1, 2),
found_window AS (
  SELECT session, ts // {_WINDOW} * {_WINDOW} AS window_start, count(*) AS n_detections,
    count(*) FILTER (WHERE overlap > 0.75) AS n_kept, min(w * score) AS min_health, max(w * score) AS max_health
  FROM found f LEFT JOIN cats c ON c.class = f.class GROUP BY 1, 2)
SELECT p.session, p.window_start, n_frames, coalesce(n_detections, 0) AS n_detections, coalesce(n_kept, 0) AS n_kept,
  min_health, max_health
FROM per_window p LEFT JOIN found_window d ON d.session = p.session AND d.window_start = p.window_start""",
        "fixed_window_group": f"""WITH {_FRAMES}
SELECT session, ts // {_WINDOW} * {_WINDOW} AS window_start, ts // {_WINDOW} * {_WINDOW} + {_WINDOW} AS window_end,
  count(*) AS n_frames, min(ts) AS first_ts, max(ts) AS last_ts FROM frames GROUP BY session, ts // {_WINDOW}""",
        "window_first": f"""WITH {_FRAMES}, r AS (
  SELECT *, ts // {_WINDOW} * {_WINDOW} AS window_start,
    row_number() OVER (PARTITION BY session, ts // {_WINDOW} ORDER BY ts, frame_id) AS rank FROM frames)
SELECT session, window_start, window_start + {_WINDOW} AS window_end, frame_id, device_id, datesegment
FROM r WHERE rank = 1""",
        "session_latest": f"""WITH {_SESSIONS}
SELECT session, session_start, session_end, n_rows, latest_frame_id, latest_ts FROM latest""",
        "event_sessions": f"WITH {_EVENT_SESSIONS} SELECT * FROM event_sessions",
        "sliding_health": f"""WITH s AS ({_SLIDING})
SELECT user_id, window_start, window_start + 18000 AS window_end, count(value) AS n, round(sum(value), 6) AS total,
  min(value) AS low, max(value) AS high, round(sum(value) / count(value), 6) AS mean
FROM s GROUP BY user_id, window_start""",
        "duration_distribution": """WITH d AS (SELECT event_type, CAST(trunc(value * 1000) AS BIGINT) AS ms FROM events)
SELECT event_type, count(ms) AS count, CAST(sum(ms) AS BIGINT) AS sum, min(ms) AS min, max(ms) AS max,
  round(avg(ms), 6) AS mean FROM d GROUP BY event_type""",
        "health_score_by_ts": f"WITH {_HEALTH} SELECT session, ts, round(health, 6) AS health FROM byts",
        "health_cumsum": f"""WITH {_HEALTH}
SELECT session, ts, round(health, 6) AS health, round(cumsum, 6) AS cumsum FROM cum""",
        "health_trend": f"""WITH {_TREND}
SELECT session, n, x_min, x_max, round(c0, 6) AS c0, round(c1, 6) AS c1,
  CASE WHEN abs(c1) > 1e-9 * greatest(abs(c0), abs(c1)) THEN round(x_min + (1 - c0 / c1) / 2 * (x_max - x_min), 0) END AS root FROM fit""",
        "health_trend_record": f"""WITH {_TREND}
SELECT session, CASE WHEN n > 1 THEN 2 ELSE 0 END AS n_coef, x_min::double AS domain_min, x_max::double AS domain_max,
  -1.0::double AS window_min, 1.0::double AS window_max,
  CASE WHEN n > 1 AND abs(c1) > 1e-9 * greatest(abs(c0), abs(c1)) THEN 1 ELSE 0 END AS n_roots,
  round(c0, 6) AS c0, round(c1, 6) AS c1,
  CASE WHEN abs(c1) > 1e-9 * greatest(abs(c0), abs(c1)) THEN round(x_min + (1 - c0 / c1) / 2 * (x_max - x_min), 0) END AS root,
  1 AS degree FROM fit""",
        "polynomial_trend": f"""WITH {_TREND}, s AS (
  SELECT session, n, x_min, x_max, sum(u) AS s1, sum(u * u) AS s2, sum(u * u * u) AS s3, sum(u * u * u * u) AS s4,
    sum(cumsum) AS t0, sum(u * cumsum) AS t1, sum(u * u * cumsum) AS t2 FROM scaled GROUP BY session, n, x_min, x_max),
det AS (SELECT *, n * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2) AS d FROM s),
c AS (
  SELECT *,
    CASE WHEN n > 2 THEN (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / d END AS c0,
    CASE WHEN n > 2 THEN (n * (t1 * s4 - s3 * t2) - t0 * (s1 * s4 - s2 * s3) + s2 * (s1 * t2 - t1 * s2)) / d END AS c1,
    CASE WHEN n > 2 THEN (n * (s2 * t2 - t1 * s3) - s1 * (s1 * t2 - t1 * s2) + t0 * (s1 * s3 - s2 * s2)) / d END AS c2
  FROM det),
m AS (SELECT *, 1e-9 * greatest(abs(c0), abs(c1), abs(c2)) AS zero, c1 * c1 - 4 * c0 * c2 AS disc FROM c),
r AS (
  SELECT *, CASE WHEN abs(c2) > zero AND disc >= 0 THEN (-c1 - sign(c2) * sqrt(greatest(disc, 0))) / (2 * c2)
      WHEN abs(c2) <= zero AND abs(c1) > zero THEN -c0 / c1 END AS u0,
    CASE WHEN abs(c2) > zero AND disc >= 0 THEN (-c1 + sign(c2) * sqrt(greatest(disc, 0))) / (2 * c2) END AS u1 FROM m)
SELECT session, n, round(c0, 6) AS c0, round(c1, 6) AS c1, round(c2, 6) AS c2,
  round((u0 + 1) / 2, 4) AS root0, round((u1 + 1) / 2, 4) AS root1 FROM r""",
        "nested_trend": f"""WITH {_HEALTH}, w AS (SELECT *, ts // {_WINDOW} * {_WINDOW} AS window_start FROM hr),
h AS (SELECT *, ts // {_WINDOW} * {_WINDOW} AS window_start FROM byts),
hc AS (SELECT *, sum(health) OVER (PARTITION BY session, window_start ORDER BY ts) AS cumsum FROM h),
hd AS (SELECT *, min(ts) OVER p AS lo, max(ts) OVER p AS hi FROM hc WINDOW p AS (PARTITION BY session, window_start)),
fit AS (
  SELECT session, window_start, lo, hi,
    CASE WHEN count(*) > 1 THEN regr_intercept(cumsum, -1 + 2 * (ts - lo) / nullif(hi - lo, 0)::double) END AS c0,
    CASE WHEN count(*) > 1 THEN regr_slope(cumsum, -1 + 2 * (ts - lo) / nullif(hi - lo, 0)::double) END AS c1
  FROM hd GROUP BY session, window_start, lo, hi),
recs AS (
  SELECT session, window_start, ts, min(frame_id) AS frame_id, CAST(count(*) AS INTEGER) AS n,
    string_agg(CAST(100 * class AS VARCHAR), ',' ORDER BY frame_id, pos) AS detection_class,
    string_agg(CAST(round(100 * score)::int AS VARCHAR), ',' ORDER BY frame_id, pos) AS detection_score,
    string_agg(coalesce(CAST(round(100 * w)::int AS VARCHAR), '-'), ',' ORDER BY frame_id, pos) AS health_weight,
    string_agg(coalesce(CAST(round(100 * hs)::int AS VARCHAR), '-'), ',' ORDER BY frame_id, pos) AS health_score
  FROM w GROUP BY session, window_start, ts),
closing AS (SELECT *, ts = max(ts) OVER (PARTITION BY session, window_start) AS is_last FROM recs)
SELECT r.session, r.window_start, r.window_start + {_WINDOW} AS window_end, r.ts, frame_id, n, detection_class,
  detection_score, health_weight, health_score, round(cumsum, 6) AS cumsum,
  CASE WHEN is_last THEN round(c0, 6) END AS c0, CASE WHEN is_last THEN round(c1, 6) END AS c1,
  CASE WHEN is_last AND abs(c1) > 1e-9 * greatest(abs(c0), abs(c1)) THEN round(lo + (1 - c0 / c1) / 2 * (hi - lo), 0) END AS root
FROM closing r LEFT JOIN hc ON hc.session = r.session AND hc.ts = r.ts
LEFT JOIN fit f ON f.session = r.session AND f.window_start = r.window_start""",
        "overlay_by_location": f"""WITH {_LABELLED}, d AS (
  SELECT *, max(pos) OVER (PARTITION BY frame_id, ymin, xmin, ymax, xmax) AS last_pos
  FROM labelled WHERE pos <= 5 AND score > 0.2),
e AS (SELECT *, max(CASE WHEN pos = last_pos THEN class END) OVER (PARTITION BY frame_id, ymin, xmin, ymax, xmax) AS last_class FROM d)
SELECT frame_id, ymin, xmin, ymax, xmax,
  string_agg(name || ': ' || pct || '%' || CASE WHEN last_class = 6 THEN ' (ignored)' ELSE '' END, ';' ORDER BY pos) AS labels,
  any_value({_COLOR7.replace('class', 'last_class')}) AS color
FROM e GROUP BY frame_id, ymin, xmin, ymax, xmax""",
        "lookback_windows": f"""WITH {_FRAMES}, c AS (
  SELECT session, ts // {_WINDOW} * {_WINDOW} AS window_start, count(*) AS n_frames FROM frames GROUP BY 1, 2),
m AS (SELECT session, max(window_start) AS cursor FROM c GROUP BY session)
SELECT c.session, c.window_start, cursor, n_frames FROM c JOIN m ON m.session = c.session
WHERE window_start < cursor AND window_start > cursor - 10 * {_WINDOW}""",
        "archive_manifest": f"""WITH {_FRAMES}, g AS (
  SELECT session, datesegment, ts // {_WINDOW} * {_WINDOW} AS window_start, count(*) AS n_frames FROM frames GROUP BY 1, 2, 3)
SELECT session, window_start, window_start + {_WINDOW} AS window_end, n_frames,
  {_PATH} || datesegment || '/' || session || '/tfrecord/' || window_start || '_' || (window_start + {_WINDOW})
    || '.tfrecords.gz' AS path FROM g""",
        "archive_write": f"""WITH {_FRAMES}
SELECT session, (ts // {_WINDOW} * {_WINDOW}) || '_' || (ts // {_WINDOW} * {_WINDOW} + {_WINDOW}) AS "window",
  count(*) AS n_frames, CAST(sum(frame_id) AS BIGINT) AS frame_id_sum FROM frames GROUP BY session, ts // {_WINDOW}""",
        "parquet_window_path": f"""WITH {_FRAMES}, g AS (SELECT DISTINCT session, ts // {_WINDOW} * {_WINDOW} AS window_start FROM frames)
SELECT session, window_start, 'gs://frame-archive/health/' || session || '/parquet/' || window_start || '_'
  || (window_start + {_WINDOW}) || '.parquet' AS path FROM g""",
        "frame_manifest": f"""WITH {_NESTED}, d AS (
  SELECT n.*, coalesce(name, 'N/A') || ': ' || CAST(trunc(100 * score) AS INTEGER) || '%' AS label,
    min(pos) OVER p AS first_pos, max(pos) OVER p AS last_pos
  FROM drawn n LEFT JOIN cats c ON c.class = n.class
  WINDOW p AS (PARTITION BY frame_id, ymin, xmin, ymax, xmax)),
places AS (
  SELECT frame_id, CAST(count(DISTINCT first_pos) AS INTEGER) AS n_places,
    string_agg(label, ';' ORDER BY first_pos, pos) AS labels,
    string_agg(CASE WHEN pos = last_pos THEN {_COLOR7.replace('class', 'd.class')} END, ';' ORDER BY first_pos) AS colors
  FROM d GROUP BY frame_id)
SELECT f.frame_id, session, {_FRAME_PATH} AS outpath, coalesce(n_places, 0) AS n_places, coalesce(labels, '') AS labels,
  coalesce(colors, '') AS colors
FROM frames f LEFT JOIN places p ON p.frame_id = f.frame_id WHERE f.frame_id % 89 <> 0""",
        "frame_errors": f"WITH {_FRAMES} SELECT frame_id, session, ts FROM frames WHERE frame_id % 89 = 0",
        "render_manifest": f"""WITH {_SESSIONS}, per_session AS (
  SELECT session, count(*) AS frame_count, min(ts) AS first_ts, max(ts) AS last_ts
  FROM frames WHERE frame_id % 89 <> 0 GROUP BY session)
SELECT r.session, latest_ts AS request_ts, coalesce(frame_count, 0) AS frame_count, first_ts, last_ts,
  {_PATH} || datesegment || '/' || r.session || '/jpg/' AS input_path,
  {_PATH} || datesegment || '/' || r.session || '/mp4/annotated_video.mp4' AS output_path,
  'gs://frame-archive/' || cdn_output_path || '/annotated_video.mp4' AS video_path
FROM requests r LEFT JOIN per_session p ON p.session = r.session""",
        "render_frames": f"""WITH {_FRAMES}
SELECT session, datesegment, ts, {_FRAME_PATH} AS outpath FROM frames WHERE frame_id % 89 <> 0""",
        "alert_messages": f"""WITH {_SESSIONS}
SELECT session, {_REQUEST_JSON} AS value FROM requests
WHERE session IN (SELECT session FROM frames WHERE frame_id % 89 <> 0)""",
        "postprocess_detections": f"WITH {_CATS}, {_MODEL}",
        "score_frames": f"WITH {_CATS}, {_MODEL}",
        "stream_fixed_window": f"""WITH c AS (
  SELECT user_id, epoch_us(ts) // 86400000000 * 86400 AS window_start, count(value) AS n, round(sum(value), 6) AS total,
    min(value) AS low, max(value) AS high FROM events GROUP BY 1, 2)
SELECT user_id, window_start, window_start + 86400 AS window_end, n, total, low, high FROM c
{_CLOSED.format(size=86400)}""",
        "stream_sliding_health": f"""WITH s AS ({_SLIDING}), c AS (
  SELECT user_id, window_start, count(value) AS n, round(sum(value), 6) AS total, min(value) AS low, max(value) AS high
  FROM s GROUP BY 1, 2)
SELECT user_id, window_start, window_start + 18000 AS window_end, n, total, low, high FROM c
{_CLOSED.format(size=18000)}""",
        "stream_session_latest": f"""WITH {_EVENT_SESSIONS}
SELECT * FROM event_sessions WHERE end_us - 1 <= {_MARK}""",
        "stream_publish": """SELECT event_id, epoch_us(ts) AS us, user_id, event_type, false AS is_malformed FROM events""",
        "stream_drop_repeats": "SELECT event_id, user_id, value FROM events",
        "job_annotate": f"""WITH {_SCORED}
SELECT f.session, f.ts, {_FRAME_PATH.replace('datesegment', 'f.datesegment').replace('session', 'f.session').replace('CAST(ts', 'CAST(f.ts')} AS outpath,
  coalesce(string_agg(coalesce(name, 'N/A') || ': ' || CAST(trunc(100 * score) AS INTEGER) || '%', ';' ORDER BY pos), '') AS labels
FROM imaged f LEFT JOIN effective e ON e.frame_id = f.frame_id AND rank <= 5 AND score > 0.66
LEFT JOIN cats c ON c.class = e.class
GROUP BY f.frame_id, f.session, f.ts, f.datesegment""",
        "job_archive": f"""WITH {_SCORED}
SELECT (ts // {_WINDOW} * {_WINDOW}) || '_' || (ts // {_WINDOW} * {_WINDOW} + {_WINDOW}) AS "window",
  count(*) AS n_frames, CAST(sum(strlen(payload)) FILTER (WHERE frame_id % 89 <> 0) AS BIGINT) AS n_detections,
  CAST(sum(strlen(payload)) FILTER (WHERE frame_id % 89 <> 0) AS BIGINT) AS image_bytes FROM arrived GROUP BY ts // {_WINDOW}
UNION ALL SELECT 'rejects', count(*), NULL, NULL FROM frames WHERE frame_id % 97 = 0
UNION ALL SELECT 'output rejects', count(*), NULL, NULL FROM frames WHERE frame_id % 97 = 0
UNION ALL SELECT 'output frames_without_image', count(*), NULL, NULL FROM arrived WHERE frame_id % 89 = 0""",
        "decode_rejects": f"""WITH {_FRAMES}, r AS (
  SELECT frame_id, CASE WHEN frame_id % 97 = 0 OR frame_id % 89 = 0 THEN 'malformed'
    WHEN frame_id % 13 = 0 THEN 'no metadata.ts' WHEN frame_id % 17 = 0 THEN 'no metadata.session' END AS reject FROM frames)
SELECT * FROM r WHERE reject IS NOT NULL""",
        "archive_paths": f"""WITH {_FRAMES}, w AS (SELECT *, ts // 31536000 * 31536000 AS s FROM frames)
SELECT 'window=' || s || '_' || (s + 31536000) || '/' AS folder, session, count(*) AS n_frames FROM w GROUP BY s, session""",
        "flat_archive": f"""WITH {_FRAMES}
SELECT session, (ts // {_WINDOW} * {_WINDOW}) || '_' || (ts // {_WINDOW} * {_WINDOW} + {_WINDOW}) AS "window",
  count(*) AS n_frames, CAST(sum(frame_id) AS BIGINT) AS frame_id_sum FROM frames GROUP BY 1, 2""",
        "no_calibrations": f"WITH {_FRAMES} SELECT frame_id, NULL::double AS c_ymin FROM frames",
        "list_frames": f"""WITH {_FRAMES} SELECT session, ts, CAST(strlen(min(payload)) AS BIGINT) AS length
FROM frames GROUP BY session, ts""",
        "drop_images": f"WITH {_FRAMES} SELECT frame_id, session, ts FROM frames",
        "render_order": f"""WITH {_FRAMES}, r AS (
  SELECT session, datesegment, ts, {_FRAME_PATH} AS outpath FROM frames WHERE frame_id % 89 <> 0)
SELECT *, CAST(row_number() OVER (PARTITION BY datesegment, session ORDER BY ts, outpath) AS INTEGER) AS place FROM r""",
        "job_alerts": f"""WITH {_FRAMES}, arrived AS (SELECT * FROM frames WHERE frame_id % 97 <> 0),
breaks AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY session ORDER BY ts) < {2 * _WINDOW} THEN 0 ELSE 1 END AS b FROM arrived),
numbered AS (SELECT *, sum(b) OVER (PARTITION BY session ORDER BY ts, b DESC ROWS UNBOUNDED PRECEDING) AS session_no FROM breaks),
finished AS (
  SELECT session, datesegment, device_id, max(ts) AS ts FROM numbered GROUP BY session, session_no, datesegment, device_id
  HAVING max(ts) + {2 * _WINDOW} <= (SELECT max(ts) FROM arrived))
SELECT 'media/uploads/PrintSessionAlert/' || datesegment || '/' || session AS cdn_output_path, session, ts, device_id,
  false AS is_malformed FROM finished WHERE session IN (SELECT session FROM frames WHERE frame_id % 89 <> 0)""",
        "stream_late_drop": f"""WITH e AS (
  SELECT *, epoch_us(ts) AS us, (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events) AS middle FROM events),
c AS (
  SELECT user_id, us // 86400000000 * 86400 AS window_start, count(*) AS n FROM e
  WHERE us >= middle OR event_id % 10 <> 0 GROUP BY 1, 2)
SELECT user_id, window_start, window_start + 86400 AS window_end, n FROM c {_CLOSED.format(size=86400)}""",
    }
