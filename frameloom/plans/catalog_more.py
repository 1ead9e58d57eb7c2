"""More queries, registered beside those of catalog: quality scores, tracks of segments, labels, sources and small functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from frameloom.functions import geometry as g
from frameloom.functions import values
from frameloom.operators import context, evaluate, frames, hands, labels, scoring, segments, tracks
from frameloom.plans import catalog as c
from frameloom.plans.catalog import query, r6
from frameloom.sources import media
from frameloom.sources import views as v

_SEG = c._SEG_SQL
#: Segments beside hands, objects and motion.
_ALL = f"{c._SPLIT_SQL}, {v.HANDS_SQL}, {v.OBJECTS_SQL}, {c._MOTION_CTES}, {_SEG.removeprefix(c._SPLIT_SQL + ', ')}"


def _seen(spark, d):
    """What was seen in a frame: points of its hand, its objects, its depth."""
    found = v.objects(spark, d).groupBy("video_id", "seq").agg(F.array_sort(F.collect_list(F.struct("ordinal", "class_name", "confidence"))).alias("found"))
    h = v.hands(spark, d).select("video_id", "seq", "ts", F.when(F.col("missing"), 0).otherwise(21).alias("n_points"), "depth")
    return h.join(found, ["video_id", "seq"], "left").withColumn("found", F.coalesce("found", F.expr("cast(array() as array<struct<ordinal:bigint,class_name:string,confidence:double>>)")))


_PARTS = f"""{_ALL}, fnd AS (SELECT video_id, seq, list(class_name ORDER BY ordinal) AS names, list_sum(list(confidence ORDER BY ordinal)) / count(*) AS mean FROM objects_v GROUP BY 1, 2),
sn AS (SELECT h.video_id, h.seq, h.ts, CASE WHEN missing THEN 0 ELSE 1e0 END AS full_hand, depth, names, mean FROM hands_v h LEFT JOIN fnd f ON f.video_id = h.video_id AND f.seq = h.seq),
inw AS (SELECT s.video_id, s.segment_id, sn.*, s.objects AS wanted FROM seg s JOIN sn ON sn.video_id = s.video_id AND sn.ts BETWEEN s.start_time AND s.end_time),
dep AS (SELECT video_id, segment_id, 1 - count(*) FILTER (stp > 0.5e0) / CAST(nullif(count(stp), 0) AS DOUBLE) AS steady FROM (SELECT video_id, segment_id, abs(depth - lag(depth) OVER (PARTITION BY video_id, segment_id ORDER BY ts, seq)) AS stp FROM inw WHERE depth IS NOT NULL) GROUP BY 1, 2),
po AS (SELECT video_id, segment_id, avg(full_hand) AS pose, avg(coalesce(least(1, mean * CASE WHEN len(wanted) > 0 THEN 0.5e0 + 0.5e0 * len(list_filter(wanted, lambda e: list_contains(names, e))) / len(wanted) ELSE 1 END), 0)) AS objects_seen FROM inw GROUP BY 1, 2),
fq AS (SELECT s.video_id, s.segment_id, 0.7e0 * least(1, avg(f.lapvar) / 200) + 0.3e0 * greatest(0, 1 - stddev_pop(f.brightness) / 80) AS q FROM seg s JOIN frames f ON f.video_id = s.video_id AND f.ts BETWEEN s.start_time AND s.end_time GROUP BY 1, 2),
jr AS (SELECT video_id, handedness, coalesce(greatest(0, 1 - avg(j) / 100), 0.5e0) AS smooth FROM (SELECT video_id, handedness, sqrt((ax_s - lag(ax_s) OVER (PARTITION BY video_id, handedness ORDER BY seq)) ** 2 + (ay_s - lag(ay_s) OVER (PARTITION BY video_id, handedness ORDER BY seq)) ** 2) AS j FROM acc) GROUP BY 1, 2),
parts AS (SELECT s.video_id, s.segment_id, coalesce(pose, 0) AS pose, coalesce(objects_seen, 0) AS objects_seen, coalesce(steady, 0.5e0) AS depth_steady, coalesce(q, 0.5e0) AS frame_quality,
  coalesce(CASE hand_used WHEN 'left' THEN l.smooth WHEN 'right' THEN r.smooth WHEN 'both' THEN coalesce(r.smooth, l.smooth) END, 0.5e0) AS smoothness, CASE WHEN pos = list_sort(pos) THEN least(1, confidence_avg + 0.1e0) ELSE confidence_avg END AS clarity
  FROM seg s LEFT JOIN po ON po.video_id = s.video_id AND po.segment_id = s.segment_id LEFT JOIN dep ON dep.video_id = s.video_id AND dep.segment_id = s.segment_id LEFT JOIN fq ON fq.video_id = s.video_id AND fq.segment_id = s.segment_id
  LEFT JOIN jr l ON l.video_id = s.video_id AND l.handedness = 'left' LEFT JOIN jr r ON r.video_id = s.video_id AND r.handedness = 'right'),
scored AS (SELECT *, CAST(round(CAST(least(1, greatest(0, round(0.25e0 * pose + 0.2e0 * objects_seen + 0.2e0 * smoothness + 0.15e0 * clarity + 0.1e0 * frame_quality + 0.1e0 * depth_steady, 9))) AS DECIMAL(18, 9)), 4) AS DOUBLE) AS composite FROM parts)"""
_OFF = lambda x: F.round(F.col(x), 9).alias(x)


def _scored(spark, d):
    s = scoring.parts(c._segments(spark, d), _seen(spark, d), v.frames(spark, d).select("video_id", "ts", "brightness", "lapvar"))
    return scoring.composite(scoring.track_of_segment(scoring.clarity(s), tracks.smoothness(c._motion(spark, d))))


@query(f"{_PARTS} SELECT video_id, segment_id, round(pose, 9) AS pose FROM parts")
def quality_pose(spark, d):
    return scoring.pose_and_objects(c._segments(spark, d), _seen(spark, d)).select("video_id", "segment_id", _OFF("pose"))


@query(f"{_PARTS} SELECT video_id, segment_id, round(objects_seen, 9) AS objects_seen FROM parts")
def quality_objects(spark, d):
    return scoring.pose_and_objects(c._segments(spark, d), _seen(spark, d)).select("video_id", "segment_id", _OFF("objects_seen"))


@query(f"{_PARTS} SELECT video_id, segment_id, round(smoothness, 9) AS smoothness FROM parts")
def quality_smooth(spark, d):
    return scoring.track_of_segment(c._segments(spark, d), tracks.smoothness(c._motion(spark, d))).select("video_id", "segment_id", _OFF("smoothness"))


@query(f"{_PARTS} SELECT video_id, segment_id, round(depth_steady, 9) AS depth_steady FROM parts")
def quality_depth(spark, d):
    return scoring.pose_and_objects(c._segments(spark, d), _seen(spark, d)).select("video_id", "segment_id", _OFF("depth_steady"))


@query(f"{_PARTS} SELECT video_id, segment_id, composite, composite < 0.2e0 AS may_discard, round(clarity, 9) AS clarity FROM scored")
def quality_composite(spark, d):
    return _scored(spark, d).select("video_id", "segment_id", "composite", "may_discard", _OFF("clarity"))


@query(f"""{_PARTS} SELECT video_id, round(avg(composite), 9) AS mean, round(median(composite), 9) AS median, min(composite) AS min, max(composite) AS max, round(stddev_pop(composite), 9) AS std, count(*) FILTER (composite >= 0.8e0) AS excellent, count(*) FILTER (composite >= 0.6e0 AND composite < 0.8e0) AS good,
count(*) FILTER (composite >= 0.4e0 AND composite < 0.6e0) AS fair, count(*) FILTER (composite >= 0.2e0 AND composite < 0.4e0) AS poor, count(*) FILTER (composite < 0.2e0) AS discard, count(*) AS n FROM scored GROUP BY 1""")
def quality_video(spark, d):
    return segments.score_summary(_scored(spark, d), "composite").withColumns({x: F.round(F.col(x), 9) for x in ("mean", "median", "std")})


# --- tracks and activity ------------------------------------------------------


@query(f"WITH {v.HANDS_SQL}, st AS (SELECT video_id, ts - lag(ts) OVER (PARTITION BY video_id ORDER BY ts) AS d FROM hands_v) SELECT video_id, CASE WHEN median(d) IS NULL THEN 0.5e0 WHEN median(d) <= 0 THEN 1e0 ELSE median(d) END AS dt FROM st GROUP BY 1")
def median_dt(spark, d):
    return tracks.median_dt(v.hands(spark, d).select("video_id", "ts"))


_RPY = """SELECT video_id, seq, {roll} AS roll, {pitch} AS pitch, {yaw} AS yaw FROM (SELECT video_id, seq, pixels[6].x - pixels[1].x AS ix, pixels[6].y - pixels[1].y AS iy, pixels[18].x - pixels[1].x AS px, pixels[18].y - pixels[1].y AS py, pixels[10].x - pixels[1].x AS mx, pixels[10].y - pixels[1].y AS my FROM hands_v WHERE NOT missing)""".format(
    roll="round(acos(least(greatest(ix / (sqrt(ix * ix + iy * iy) + 1e-8) * (px / (sqrt(px * px + py * py) + 1e-8)) + iy / (sqrt(ix * ix + iy * iy) + 1e-8) * (py / (sqrt(px * px + py * py) + 1e-8)), -1), 1)), 6)",
    pitch="round(atan2(ix * py - iy * px, sqrt(mx * mx + my * my) + 1e-8), 6)", yaw="round(atan2(my, mx), 6)",
)


@query(f"WITH {v.HANDS_SQL} {_RPY}")
def orientation_rpy(spark, d):
    h = v.hands(spark, d).where(~F.col("missing")).withColumn("o", g.orientation(F.col("pixels")))
    return h.select("video_id", "seq", *[F.round(f"o.{x}", 6).alias(x) for x in ("roll", "pitch", "yaw")])


_ACT = f"""{c._BOX_SQL}, ar AS (SELECT *, greatest(hx2 - hx1, 0) * greatest(hy2 - hy1, 0) AS area FROM boxes),
pv AS (SELECT *, lag(pixels) OVER w AS pp, lag(area) OVER w AS pa, NOT lag(missing) OVER w AND lag(handedness) OVER w = handedness AS same FROM ar WINDOW w AS (PARTITION BY video_id ORDER BY seq)),
st AS (SELECT *, list_transform(list_zip(pixels, pp), lambda z: sqrt((z[1].x - z[2].x) ** 2 + (z[1].y - z[2].y) ** 2)) AS d FROM pv),
act AS (SELECT video_id, seq, CASE WHEN missing THEN 0 ELSE least(1, 0.2e0 + CASE WHEN same THEN 0.3e0 * least(1, d[1] / 50) + 0.2e0 * least(1, list_sum(d) / (21 + 1e-8) / 30) + 0.1e0 * least(1, CASE WHEN pa > 0 THEN abs(area - pa) / pa / (1 + 1e-8) ELSE 0 END / 0.3e0) ELSE 0 END) END AS activity FROM st)"""


@query(f"{_ACT} SELECT video_id, seq, round(activity, 6) AS activity, CASE WHEN activity >= 0.6e0 THEN 'active_manipulation' WHEN activity >= 0.2e0 THEN 'possible_activity' ELSE 'idle_or_observing' END AS activity_class FROM act")
def activity_score(spark, d):
    a = evaluate.activity(c._boxed(spark, d).select("video_id", "seq", "handedness", "pixels", "hand_box", "missing"))
    return a.select("video_id", "seq", r6("activity"), hands.activity_class(F.col("activity")).alias("activity_class"))


_TRAJ = f"""{_ALL}, pctl AS (SELECT video_id, handedness, quantile_cont(pinch, 0.05e0) AS p5, quantile_cont(pinch, 0.95e0) AS p95, count(pinch) AS valid FROM wr GROUP BY 1, 2),
sig AS (SELECT w.video_id, w.handedness, w.seq, w.ts, CASE WHEN valid < 2 OR p95 - p5 < 1e-6 THEN 0 ELSE 1 / (1 + exp(-6 * (coalesce(least(greatest((p95 - pinch) / (p95 - p5), 0), 1), 0) - 0.5e0))) END AS grasp FROM wr w JOIN pctl p ON w.video_id = p.video_id AND w.handedness = p.handedness),
evt AS (SELECT video_id, ts FROM (SELECT video_id, ts, grasp, lag(grasp) OVER (PARTITION BY video_id, handedness ORDER BY seq) AS was FROM sig) WHERE was < 0.5e0 AND grasp >= 0.5e0 OR was >= 0.5e0 AND grasp < 0.5e0),
trk AS (SELECT video_id, handedness FROM wr GROUP BY 1, 2 HAVING count(x) >= 2),
sm1 AS (SELECT s.video_id, s.segment_id, max(p.path_length) AS path_length, max(p.max_velocity) AS max_velocity FROM seg s JOIN pth p ON p.video_id = s.video_id JOIN trk t ON t.video_id = p.video_id AND t.handedness = p.handedness
  WHERE EXISTS (SELECT 1 FROM wr w WHERE w.video_id = p.video_id AND w.handedness = p.handedness AND w.ts BETWEEN s.start_time AND s.end_time) GROUP BY 1, 2),
sm2 AS (SELECT s.video_id, s.segment_id, count(*) AS grasp_events FROM seg s JOIN evt e ON e.video_id = s.video_id AND e.ts BETWEEN s.start_time AND s.end_time GROUP BY 1, 2),
traj AS (SELECT s.*, coalesce(path_length, 0) AS path_length, coalesce(max_velocity, 0) AS max_velocity, coalesce(grasp_events, 0) AS grasp_events FROM seg s LEFT JOIN sm1 ON sm1.video_id = s.video_id AND sm1.segment_id = s.segment_id LEFT JOIN sm2 ON sm2.video_id = s.video_id AND sm2.segment_id = s.segment_id)"""


def _with_tracks(spark, d):
    moving, wrist = c._motion(spark, d), c._wrist(spark, d)
    paths = tracks.path_summary(moving).join(tracks.tracked(wrist), ["video_id", "handedness"], "left_semi")
    return tracks.segment_summary(c._segments(spark, d), wrist, paths, tracks.grasp_events(tracks.grasp_signal(wrist, "pinch")))


@query(f"{_TRAJ} SELECT video_id, segment_id, round(path_length, 4) AS path_length, round(max_velocity, 4) AS max_velocity, grasp_events FROM traj")
def segment_traj_summary(spark, d):
    return _with_tracks(spark, d).select("video_id", "segment_id", F.round("path_length", 4).alias("path_length"), F.round("max_velocity", 4).alias("max_velocity"), "grasp_events")


@query(f"""{_TRAJ} SELECT video_id, segment_id, round(confidence_avg, 4) AS f0, round(confidence_min, 4) AS f1, duration AS f2, CAST(frames_analyzed AS DOUBLE) AS f3, CASE WHEN hand_used = 'right' THEN 1e0 ELSE 0 END AS f4, CASE WHEN hand_used = 'left' THEN 1e0 ELSE 0 END AS f5, CASE WHEN hand_used = 'both' THEN 1e0 ELSE 0 END AS f6,
CAST(len(objects) AS DOUBLE) AS f7, CAST(len(phases) AS DOUBLE) AS f8, round(path_length, 0) AS f9, round(max_velocity, 0) AS f10, CAST(grasp_events AS DOUBLE) AS f11 FROM traj""")
def metadata_features(spark, d):
    f = evaluate.metadata_features(_with_tracks(spark, d))
    digits = {0: 4, 1: 4, 9: 0, 10: 0}
    at = lambda i: F.get("features", F.lit(i)).cast("double")
    return f.select("video_id", "segment_id", *[(F.round(at(i), digits[i]) if i in digits else at(i)).alias(f"f{i}") for i in range(12)])


@query(f"""{_ALL}, stp2 AS (SELECT s.video_id, s.segment_id, h.seq, row_number() OVER w - 1 AS step, h.handedness, h.pixels, h.missing, h.depth, lag(h.pixels) OVER w AS pp, lag(h.missing) OVER w AS pm, lag(h.handedness) OVER w AS ph, lag(h.depth) OVER w AS pd
  FROM seg s JOIN hands_v h ON h.video_id = s.video_id AND h.ts BETWEEN s.start_time AND s.end_time WINDOW w AS (PARTITION BY s.video_id, s.segment_id ORDER BY h.ts, h.seq))
SELECT video_id, segment_id, step, CASE WHEN step > 0 AND NOT missing AND NOT pm AND ph = handedness THEN round(pixels[1].x - pp[1].x, 6) ELSE 0 END AS dx, CASE WHEN step > 0 AND NOT missing AND NOT pm AND ph = handedness THEN round(pixels[1].y - pp[1].y, 6) ELSE 0 END AS dy,
coalesce(CASE WHEN step > 0 AND NOT missing AND NOT pm THEN round(depth - pd, 6) END, 0) AS dz, CASE WHEN step > 0 AND NOT missing THEN round(1 - least(sqrt((pixels[5].x - pixels[9].x) ** 2 + (pixels[5].y - pixels[9].y) ** 2) / 100, 1), 6) ELSE 0 END AS grasp FROM stp2""")
def episode_actions(spark, d):
    s = c._segments(spark, d).select("video_id", "segment_id", "start_time", "end_time")
    steps = segments.steps(s, v.hands(spark, d).select("video_id", "seq", "ts", "handedness", "pixels", "missing", "depth"))
    return segments.actions(steps).select("video_id", "segment_id", "step", r6("dx"), r6("dy"), r6("dz"), r6("grasp"))


# --- labels -------------------------------------------------------------------

_RESP_SQL = """resp AS (SELECT event_id, k, CASE k % 10 WHEN 0 THEN '```json' || chr(10) || '{"actions": [{"action": "' || event_type || '"' || chr(10) || '```' WHEN 1 THEN '[1, 2]' WHEN 2 THEN '{"other": 1}' WHEN 3 THEN ' {"actions": []} '
  ELSE '```json' || chr(10) || '{"actions": [{"action": "' || event_type || '", "hand_used": "left", "confidence": ' || CAST(k AS VARCHAR) || '.5, "is_idle": true, "objects_involved": ["bolt", "nut"]}, {"action": "second"}]}' || chr(10) || '```  ' END AS response
  FROM (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events))"""


def _responses(spark, d):
    e = v.table(spark, d, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    n, k = F.lit("\n"), F.col("k") % 10
    start = F.concat(F.lit('```json\n{"actions": [{"action": "'), "event_type", F.lit('"'))
    whole = F.concat(start, F.lit(', "hand_used": "left", "confidence": '), F.col("k").cast("string"), F.lit('.5, "is_idle": true, "objects_involved": ["bolt", "nut"]}, {"action": "second"}]}\n```  '))
    text = F.when(k == 0, F.concat(start, n, F.lit("```"))).when(k == 1, "[1, 2]").when(k == 2, '{"other": 1}').when(k == 3, ' {"actions": []} ').otherwise(whole)
    return e.select("event_id", "k", text.alias("response"))


@query(f"""WITH {_RESP_SQL}, b AS (SELECT event_id, trim(regexp_replace(regexp_replace(trim(response, ' ' || chr(10)), '^```(?:json)?\\s*\\n?', ''), '\\n?```\\s*$', '')) AS body FROM resp),
e AS (SELECT event_id, body, CASE WHEN NOT json_valid(body) THEN 'not_json' WHEN json_type(body) <> 'OBJECT' THEN 'not_object' WHEN NOT list_contains(json_keys(body), 'actions') THEN 'missing_fields' END AS error FROM b),
p AS (SELECT event_id, error, CASE WHEN error IS NULL THEN json_extract(body, '$.actions[0]') END AS a FROM e)
SELECT event_id, error, CASE WHEN error IS NULL THEN coalesce(json_extract_string(a, '$.action'), 'unknown') END AS action, CASE WHEN error IS NULL THEN coalesce(json_extract_string(a, '$.hand_used'), 'none') END AS hand,
CASE WHEN error IS NULL THEN CASE WHEN a IS NULL THEN 'VLM returned no actions' ELSE coalesce(json_extract_string(a, '$.action_description'), '') END END AS description, CASE WHEN error IS NULL THEN coalesce(CAST(json_extract(a, '$.confidence') AS DOUBLE), 0) END AS confidence,
CASE WHEN error IS NULL THEN coalesce(array_to_string(CAST(json_extract(a, '$.objects_involved') AS VARCHAR[]), ','), '') END AS objects, CASE WHEN error IS NULL THEN coalesce(CAST(json_extract(a, '$.is_idle') AS BOOLEAN), false) END AS is_idle FROM p""")
def parse_response(spark, d):
    p = labels.parse_responses(_responses(spark, d))
    return p.select("event_id", "error", "action", "hand", "description", "confidence", F.array_join("objects", ",").alias("objects"), "is_idle")


@query(f"""{c.L_SQL}, u AS (SELECT video_id, seq, start, "end", action, hand, confidence, 0 AS rank FROM labels_v WHERE action <> 'idle' UNION ALL SELECT video_id, seq, ts, ts, 'idle', 'none', 0.95e0, 1 FROM frames WHERE k % 5 = 0)
SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY start, rank, seq) AS place, start, "end", action, hand, confidence FROM u""")
def label_union_idle(spark, d):
    mine = v.labels(spark, d).where("action <> 'idle'")
    out = labels.with_idle(mine, v.frames(spark, d).where("k % 5 = 0").select("video_id", "seq", "ts"))
    return out.select("video_id", "place", "start", "end", "action", "hand", "confidence")


@query(f"""WITH n AS (SELECT unnest(range(5)) AS class_id, unnest({list(v.ACTIONS)}) AS name), p AS (SELECT doc_id AS sample_id, doc_id % 7 AS class_id, (n_chars % 100) / 100e0 AS confidence FROM documents),
a AS (SELECT p.*, coalesce(name, 'class_' || p.class_id) AS action FROM p LEFT JOIN n ON n.class_id = p.class_id) SELECT sample_id, action, confidence < 0.4e0 OR action IN ('place', 'inspect') AS fallback FROM a""")
def fallback_route(spark, d):
    p = v.table(spark, d, "documents").select(F.col("doc_id").alias("sample_id"), (F.col("doc_id") % 7).alias("class_id"), ((F.col("n_chars") % 100) / 100).alias("confidence"))
    names = spark.createDataFrame(list(enumerate(v.ACTIONS)), "class_id long, name string")
    pairs = spark.createDataFrame([("place", "inspect", 0.2)], "class_a string, class_b string, confusion_rate double")
    return labels.route(p, names, pairs).select("sample_id", "action", "fallback")


_RESULTS_SQL = f"""{c.F_SQL}, res AS (SELECT video_id, CASE video_id % 7 WHEN 0 THEN 'skipped' WHEN 1 THEN 'error' ELSE 'complete' END AS status, count(*) AS segments, 0.05e0 * ceil(count(*) / 5e0) AS cost_inr, count(*) FILTER (k < 10) AS needs_review, CASE WHEN video_id % 5 = 0 THEN 0 ELSE round(avg(k) / 100, 3) END AS quality_mean FROM frames GROUP BY video_id)"""


@query(f"""{_RESULTS_SQL} SELECT count(*) FILTER (status = 'complete') AS n_complete, count(*) FILTER (status = 'skipped') AS n_skipped, count(*) FILTER (status = 'error') AS n_error, CAST(coalesce(sum(segments) FILTER (status = 'complete'), 0) AS BIGINT) AS segments, CAST(coalesce(sum(needs_review) FILTER (status = 'complete'), 0) AS BIGINT) AS needs_review,
round(coalesce(sum(cost_inr) FILTER (status = 'complete'), 0), 2) AS cost_inr, round(coalesce(avg(quality_mean) FILTER (status = 'complete' AND quality_mean <> 0), 0), 3) AS mean_quality FROM res""")
def batch_summary(spark, d):
    f = v.frames(spark, d).groupBy("video_id").agg(F.count("*").alias("segments"), F.count_if(F.col("k") < 10).alias("needs_review"), F.round(F.avg("k") / 100, 3).alias("q"))
    status = F.when(F.col("video_id") % 7 == 0, "skipped").when(F.col("video_id") % 7 == 1, "error").otherwise("complete")
    res = f.select("video_id", status.alias("status"), "segments", "needs_review", (0.05 * F.ceil(F.col("segments") / 5)).alias("cost_inr"), F.when(F.col("video_id") % 5 == 0, 0.0).otherwise(F.col("q")).alias("quality_mean"))
    return labels.batch_summary(res)


@query(f"""{c.F_SQL}, b AS (SELECT video_id, seq // 5 AS batch_id FROM frames GROUP BY 1, 2), n AS (SELECT video_id, count(*) FILTER (batch_id % 4 <> 0) AS total_calls FROM b GROUP BY 1)
SELECT video_id, total_calls, round(total_calls * 0.08e0, 2) AS total_cost_inr, coalesce(round(total_calls * 0.08e0 / nullif(total_calls, 0), 4), 0) AS cost_per_call_inr FROM n""")
def call_costs(spark, d):
    b = frames.batches(v.frames(spark, d)).select("video_id", (F.col("batch_id") % 4 != 0).alias("succeeded"))
    return labels.call_costs(b, frames.PRICES["claude_haiku"])


_CONTACTS = f"{c._SQL['hand_object_contact'].split('SELECT video_id, seq, ordinal, class_name, round(iou', 1)[0]}"


@query(f"""{_CONTACTS}SELECT video_id, batch_id, hand, class_name, contact_score, row_number() OVER (PARTITION BY video_id, batch_id ORDER BY r) AS rank FROM (SELECT * FROM (SELECT w.*, h.handedness AS hand, w.seq // 5 AS batch_id, row_number() OVER (PARTITION BY w.video_id, w.seq // 5 ORDER BY contact_score DESC, w.seq, w.ordinal) AS r FROM w JOIN hands_v h ON h.video_id = w.video_id AND h.seq = w.seq WHERE contact_score >= 0.3e0) WHERE r <= 5 QUALIFY row_number() OVER (PARTITION BY video_id, batch_id, hand, class_name ORDER BY r) = 1)""")
def topk_interactions(spark, d):
    found = evaluate.contacts(c._boxed(spark, d).select("video_id", "seq", "handedness", "pixels", "hand_box"), v.objects(spark, d))
    rows = found.select("video_id", F.floor(F.col("seq") / 5).cast("long").alias("batch_id"), F.col("handedness").alias("hand"), "class_name", "contact_score", "seq", "ordinal")
    return labels.top_interactions(rows).select("video_id", "batch_id", "hand", "class_name", "contact_score", "rank")


_CONTEXT = f"""{_CONTACTS.rstrip()}{_ACT.removeprefix(c._BOX_SQL)}{c._GRASP_RULES_SQL.removeprefix(c.H_SQL)},
sp AS (SELECT h.video_id, h.seq // 5 AS batch_id, min(h.ts) AS a, max(h.ts) AS z, avg(activity) AS mean FROM hands_v h JOIN act ON act.video_id = h.video_id AND act.seq = h.seq GROUP BY 1, 2),
hp AS (SELECT video_id, batch_id, string_agg(handedness || ' hand detected (conf ' || printf('%.2f', mean + 1e-9) || ')', ', ' ORDER BY first) AS t FROM (SELECT video_id, seq // 5 AS batch_id, handedness, avg(0.5e0 + abs(e[44])) AS mean, min(seq) AS first FROM hands_v WHERE NOT missing GROUP BY 1, 2, 3) GROUP BY 1, 2),
ob AS (SELECT *, seq // 5 AS batch_id, min(seq * 2 + ordinal) OVER (PARTITION BY video_id, seq // 5, class_name) AS first, row_number() OVER (PARTITION BY video_id, seq // 5, class_name ORDER BY confidence DESC, seq, ordinal) AS place FROM objects_v),
op AS (SELECT video_id, batch_id, string_agg(class_name || ' (conf ' || printf('%.2f', confidence + 1e-9) || ', center [' || CAST(floor((x1 + x2) / 2) AS INT) || ',' || CAST(floor((y1 + y2) / 2) AS INT) || '])', ', ' ORDER BY confidence DESC, first) AS t FROM ob WHERE place = 1 GROUP BY 1, 2),
ix AS (SELECT video_id, batch_id, string_agg(hand || ' hand contacting ' || class_name || ' (IoU ' || printf('%.2f', iou + 1e-9) || ', grasp: ' || grasp_type || ', conf ' || printf('%.2f', contact_score + 1e-9) || ')', '; ' ORDER BY place) AS t FROM (SELECT * FROM (
  SELECT w.video_id, w.class_name, w.iou, w.contact_score, h.handedness AS hand, r.grasp_type, w.seq // 5 AS batch_id, row_number() OVER (PARTITION BY w.video_id, w.seq // 5 ORDER BY w.contact_score DESC, w.seq, w.ordinal) AS place FROM w JOIN hands_v h ON h.video_id = w.video_id AND h.seq = w.seq JOIN r ON r.video_id = w.video_id AND r.seq = w.seq WHERE w.contact_score >= 0.3e0)
  WHERE place <= 5 QUALIFY row_number() OVER (PARTITION BY video_id, batch_id, hand, class_name ORDER BY place) = 1) GROUP BY 1, 2),
cx AS (SELECT sp.*, CASE WHEN round(mean, 9) > 0.6e0 THEN 'active manipulation' WHEN round(mean, 9) > 0.2e0 THEN 'possible activity' ELSE 'idle/observing' END AS name, hp.t AS hands, op.t AS objects, ix.t AS contacts FROM sp LEFT JOIN hp ON hp.video_id = sp.video_id AND hp.batch_id = sp.batch_id LEFT JOIN op ON op.video_id = sp.video_id AND op.batch_id = sp.batch_id LEFT JOIN ix ON ix.video_id = sp.video_id AND ix.batch_id = sp.batch_id)"""


@query(f"""{_CONTEXT} SELECT video_id, batch_id, round(mean, 6) AS mean_activity, name AS activity_name, 'Local CV metadata for frames ' || printf('%.1f', a + 1e-9) || 's - ' || printf('%.1f', z + 1e-9) || 's:' || chr(10) || '  Hands: ' || coalesce(hands, 'none detected') || chr(10) || '  Objects: ' || coalesce(objects, 'none detected') || chr(10) || '  Interactions: ' || coalesce(contacts, 'none detected') || chr(10) || '  Activity: ' || printf('%.2f', mean + 1e-9) || ' (' || name || ')' AS context FROM cx""")
def prompt_context(spark, d):
    batch = F.floor(F.col("seq") / 5).cast("long").alias("batch_id")
    boxed = c._boxed(spark, d)
    seen = evaluate.activity(boxed.select("video_id", "seq", "ts", "handedness", "pixels", "hand_box", "missing")).select("video_id", batch, "ts", "activity")
    hands = boxed.where(~F.col("missing")).select("video_id", batch, "seq", "handedness", (0.5 + F.abs(F.get("e", F.lit(43)))).alias("confidence"))
    at = g.centre(F.col("bbox"))
    objects = v.objects(spark, d).select("video_id", batch, "seq", "ordinal", "class_name", "confidence", at["x"].alias("cx"), at["y"].alias("cy"))
    held = g.with_grasp(boxed.select("video_id", "seq", "handedness", "pixels", "hand_box"), "pixels").select("video_id", "seq", "handedness", "pixels", "hand_box", "grasp_type")
    contacts = evaluate.contacts(held, v.objects(spark, d)).select("video_id", batch, F.col("handedness").alias("hand"), "class_name", "iou", "grasp_type", "contact_score", "seq", "ordinal")
    return context.batch_context(seen, hands, objects, contacts).select("video_id", "batch_id", r6("mean_activity"), "activity_name", "context")


# --- sources and small functions ------------------------------------------------


@query(f"""{c.F_SQL}, cam AS (SELECT * FROM (VALUES (1, 0, 'head', 0e0), (2, 1, 'wrist', 0.033e0), (3, 2, 'cam2', 0e0)) t(video_id, camera, mount, off))
SELECT f.video_id, CAST(camera AS BIGINT) AS camera, mount, seq, round(ts + off, 6) AS ts FROM frames f JOIN cam ON cam.video_id = f.video_id""")
def multicam_sync(spark, d):
    manifest = spark.createDataFrame([([(1, "head"), (2, "wrist"), (3, None), (-5, "gone")], [0, 33])], "cameras array<struct<video_id:bigint,mount:string>>, sync_offset_ms array<int>")
    return media.camera_frames(manifest, v.frames(spark, d).select("video_id", "seq", "ts")).select("video_id", "camera", "mount", "seq", r6("ts"))


#: What a probe says of a video, by event: two streams, a container's duration, no frame rate, no video at all.
_PROBES = (
    ('{"streams": [{"codec_type": "audio"}, {"codec_type": "video", "r_frame_rate": "', '001/1001", "duration": "10.5", "width": 640, "height": 480, "codec_name": "h264"}]}'),
    ('{"streams": [{"codec_type": "video", "r_frame_rate": "25/1", "width": 19', ', "height": 1080}], "format": {"duration": "7.25"}}'),
    ('{"streams": [{"codec_type": "video", "r_frame_rate": "', '/0"}]}'),
    ('{"streams": [{"codec_type": "audio", "duration": "', '"}]}'),
)
_K_SQL = "CAST(json_extract(props, '$.k') AS BIGINT)"


@query(f"""WITH p AS (SELECT event_id AS id, CASE event_id % 4 {" ".join(f"WHEN {i} THEN '{a}' || {_K_SQL} || '{z}'" for i, (a, z) in enumerate(_PROBES))} END AS probe FROM events), s AS (SELECT id, probe, list_filter(CAST(json_extract(probe, '$.streams') AS JSON[]), lambda x: json_extract_string(x, '$.codec_type') = 'video')[1] AS v FROM p),
r AS (SELECT *, string_split(coalesce(json_extract_string(v, '$.r_frame_rate'), '0/1'), '/') AS f FROM s)
SELECT CAST(id AS BIGINT) AS id, CASE WHEN v IS NOT NULL THEN coalesce(CAST(json_extract_string(v, '$.duration') AS DOUBLE), CAST(json_extract_string(probe, '$.format.duration') AS DOUBLE), 0) END AS duration, CASE WHEN v IS NOT NULL THEN CASE WHEN CAST(f[2] AS DOUBLE) = 0 THEN 0 ELSE round(CAST(f[1] AS DOUBLE) / CAST(f[2] AS DOUBLE), 2) END END AS fps,
CASE WHEN v IS NOT NULL THEN coalesce(json_extract_string(v, '$.width'), '0') || 'x' || coalesce(json_extract_string(v, '$.height'), '0') END AS resolution, CASE WHEN v IS NOT NULL THEN coalesce(json_extract_string(v, '$.codec_name'), 'unknown') END AS codec, CASE WHEN v IS NULL THEN 'no video stream' END AS error FROM r""")
def probe_metadata(spark, d):
    k, kind = F.get_json_object("props", "$.k"), F.col("event_id") % 4
    probe = F.coalesce(*[F.when(kind == i, F.concat(F.lit(a), k, F.lit(z))) for i, (a, z) in enumerate(_PROBES)])
    rows = v.table(spark, d, "events").select(F.col("event_id").alias("id"), probe.alias("probe"))
    return media.probe_metadata(rows).select("id", "duration", "fps", "resolution", "codec", "error")


@query(f"""{_SEG}, b AS (SELECT video_id, segment_id, CAST(floor(start_time * 30) AS BIGINT) AS s, CAST(floor(end_time * 30) AS BIGINT) AS e FROM seg)
SELECT video_id, segment_id, CASE WHEN e > s THEN array_to_string(list_transform(range(16), lambda i: CASE WHEN e - s >= 16 THEN CAST(floor(s + i * (e - 1 - s) / 15e0) AS BIGINT) ELSE least(s + i, e - 1) END), ',') ELSE '' END AS frame_indices FROM b""")
def clip_sample(spark, d):
    s = segments.clip_frames(c._segments(spark, d))
    return s.select("video_id", "segment_id", F.array_join(F.col("frame_indices").cast("array<string>"), ",").alias("frame_indices"))


@query("WITH ch AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?s).')) AS ch FROM documents), n AS (SELECT doc_id, ch, count(*) AS n FROM ch GROUP BY 1, 2) SELECT doc_id, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 4) AS entropy FROM n GROUP BY 1")
def char_entropy(spark, d):
    made = v.table(spark, d, "documents").where("text <> ''").select("doc_id", values.text_entropy("text").alias("entropy"))
    return made.select("doc_id", F.round("entropy", 4).alias("entropy"))


@query(f"""WITH {v.HANDS_SQL}, m AS (SELECT video_id, seq, e, list_min(e) AS lo, list_max(e) AS hi, greatest(least(CAST(floor(pixels[1].x / 80) AS INT), 7), 0) AS x, greatest(least(CAST(floor(pixels[1].y / 60) AS INT), 7), 0) AS y FROM hands_v)
SELECT video_id, seq, round((e[y * 8 + x + 1] - lo) / (hi - lo), 6) AS depth, round(abs((e[y * 8 + x + 1] - lo) / (hi - lo) - (e[37] - lo) / (hi - lo)), 6) AS depth_diff FROM m""")
def depth_lookup(spark, d):
    h = v.hands(spark, d).select("video_id", "seq", values.spread_depth(F.col("e")).alias("m"), F.get("pixels", F.lit(0)).alias("w"))
    at = values.depth_at(F.col("m"), 8, 8, F.col("w.x") / 80, F.col("w.y") / 60)
    centre = values.depth_at(F.col("m"), 8, 8, F.lit(4), F.lit(4))
    return h.select("video_id", "seq", F.round(at, 6).alias("depth"), F.round(F.abs(at - centre), 6).alias("depth_diff"))


@query(f"""WITH {v.HANDS_SQL}, s AS (SELECT video_id, seq // 5 AS batch_id, list(DISTINCT handedness) FILTER (NOT missing) AS hs FROM hands_v GROUP BY 1, 2)
SELECT video_id, batch_id, CASE WHEN hs IS NULL THEN 'no_hands' WHEN list_contains(hs, 'left') AND list_contains(hs, 'right') THEN 'both_full' WHEN list_contains(hs, 'left') THEN 'left_only' ELSE 'right_only' END AS visibility FROM s""")
def hand_visibility(spark, d):
    s = v.hands(spark, d).groupBy("video_id", F.floor(F.col("seq") / 5).cast("long").alias("batch_id")).agg(F.collect_set(F.when(~F.col("missing"), F.col("handedness"))).alias("hs"))
    return s.select("video_id", "batch_id", evaluate.visibility("hs").alias("visibility"))


# --- training and evaluation ------------------------------------------------------


@query(f"{c._TRAIN_SQL}, vocab AS (SELECT DISTINCT action FROM seg) SELECT action, count(k.segment_id) FILTER (k.confidence_min > 0.5e0) AS n FROM vocab LEFT JOIN kept k USING (action) GROUP BY 1")
def class_distribution(spark, d):
    s = c._segments(spark, d)
    return evaluate.class_distribution(evaluate.training_samples(s, 0.4).where("confidence_min > 0.5"), s)


@query(f"""{c._CM_SQL}, m AS (SELECT c AS cls, CAST((SELECT sum(n) FROM cm WHERE true_cls = c) AS BIGINT) AS support, CAST((SELECT sum(n) FROM cm WHERE pred_cls = c) AS BIGINT) AS predicted, (SELECT n FROM cm WHERE true_cls = c AND pred_cls = c) AS hit FROM cls),
pr AS (SELECT cls, support, hit, hit / CAST(greatest(predicted, 1) AS DOUBLE) AS p, hit / CAST(greatest(support, 1) AS DOUBLE) AS r FROM m), f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM pr)
SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(hit) / CAST(greatest(sum(support), 1) AS DOUBLE), 6) AS accuracy, round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / greatest(sum(support), 1), 6) AS weighted_f1 FROM f""")
def overall_metrics(spark, d):
    return evaluate.overall_metrics(evaluate.confusion_matrix(v.predictions(spark, d))).select("n", r6("accuracy"), r6("macro_f1"), r6("weighted_f1"))


@query(f"{_SEG} SELECT action, sum(duration) AS total_duration FROM seg GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def top_actions(spark, d):
    return segments.action_summary(c._segments(spark, d)).select("action", "total_duration").limit(5)
