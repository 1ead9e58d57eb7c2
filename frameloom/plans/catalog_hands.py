"""Queries over frames with any number of hands: activity, routing, actions, contacts and whole trajectories, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from frameloom.operators import context, hands, labels, segments, trajectories
from frameloom.sources import views as v

from . import catalog as c
from .catalog import query
from .catalog_more import _ALL

_HF = f"{c.H_SQL}, {v.HAND_FRAMES_SQL}"
_BOX = lambda p, k: f"greatest(list_min(list_transform({p}, lambda u: u.{k})) - 10, 0)"
_END = lambda p, k, most: f"least(list_max(list_transform({p}, lambda u: u.{k})) + 10, {most})"
_AREA = lambda p: f"greatest({_END(p, 'x', 640)} - {_BOX(p, 'x')}, 0) * greatest({_END(p, 'y', 480)} - {_BOX(p, 'y')}, 0)"
_DIST = lambda a, b: f"sqrt(({a}.x - {b}.x) ** 2 + ({a}.y - {b}.y) ** 2)"
_LIST = f"{_HF}, hd AS (SELECT video_id, seq, i, h.handedness AS label, h.pixels AS px FROM (SELECT video_id, seq, unnest(hands) AS h, generate_subscripts(hands, 1) AS i FROM hf))"

_PAIRS = f"""{_LIST}, lab AS (SELECT video_id, seq, label, arg_max(px, i) AS px FROM hd GROUP BY ALL),
rd AS (SELECT video_id, seq, len(hands) AS n, lag(seq) OVER (PARTITION BY video_id ORDER BY seq) AS prev FROM hf WHERE hands IS NOT NULL),
pr AS (SELECT rd.video_id, rd.seq, a.px AS p, b.px AS q, {_AREA("a.px")} AS ca, {_AREA("b.px")} AS pa FROM rd JOIN lab a ON a.video_id = rd.video_id AND a.seq = rd.seq JOIN lab b ON b.video_id = rd.video_id AND b.seq = rd.prev AND b.label = a.label),
st AS (SELECT video_id, seq, avg({_DIST("p[1]", "q[1]")}) AS wrist, sum(list_sum(list_transform(range(1, least(len(p), len(q)) + 1), lambda k: {_DIST("p[k]", "q[k]")}))) / (sum(least(len(p), len(q))) + 1e-8) AS pts,
  coalesce(sum(abs(ca - pa) / pa) FILTER (pa > 0), 0) / (count(*) FILTER (pa > 0) + 1e-8) AS grown FROM pr GROUP BY ALL)"""


def _score_sql(weights: tuple[float, ...]) -> str:
    a, b, k, g = (f"{w}e0" for w in weights)
    presence = f"{a} * CASE WHEN n = 0 THEN 0 WHEN n = 1 THEN 0.5e0 ELSE 1 END"
    return f"{_PAIRS}, act AS (SELECT hf.video_id, hf.seq, CASE WHEN hands IS NOT NULL THEN least(1, {presence} + CASE WHEN wrist IS NULL THEN 0 ELSE {b} * least(1, wrist / 50e0) + {k} * least(1, pts / 30e0) + {g} * least(1, grown / 0.3e0) END) END AS activity FROM hf LEFT JOIN rd ON rd.video_id = hf.video_id AND rd.seq = hf.seq LEFT JOIN st ON st.video_id = hf.video_id AND st.seq = hf.seq)"


_CLASS = "CASE WHEN activity >= 0.6e0 THEN 'active_manipulation' WHEN activity >= 0.2e0 THEN 'possible_activity' ELSE 'idle_or_observing' END"


@query(f"{_score_sql(hands.WEIGHTS)} SELECT video_id, seq, round(activity, 6) AS activity, {_CLASS} AS activity_class FROM act")
def hands_activity(spark, d):
    scored = hands.activity(v.hand_frames(spark, d).select("video_id", "seq", "hands"))
    return scored.select("video_id", "seq", c.r6("activity"), hands.activity_class(F.col("activity")).alias("activity_class"))


@query(f"{_score_sql(hands.LIGHT)} SELECT video_id, seq, round(activity, 6) AS activity FROM act")
def hands_activity_lite(spark, d):
    return hands.activity(v.hand_frames(spark, d).select("video_id", "seq", "hands"), hands.LIGHT).select("video_id", "seq", c.r6("activity"))


@query(f"""{_score_sql(hands.WEIGHTS)}, n AS (SELECT video_id, count(*) AS total, count(*) FILTER ({_CLASS} <> 'idle_or_observing') AS n_sent, count(*) FILTER ({_CLASS} = 'idle_or_observing') AS n_idle, count(activity) AS n_scored, round(avg(activity), 6) AS mean_activity FROM act GROUP BY 1)
SELECT *, round(100e0 * n_sent / total, 1) AS sent_pct, round(100e0 * n_idle / total, 1) AS idle_pct FROM n""")
def hands_route(spark, d):
    return hands.routed(hands.activity(v.hand_frames(spark, d).select("video_id", "seq", "hands"))).withColumn("mean_activity", F.round("mean_activity", 6))


_FIRST = lambda side: f"list_filter(hands, lambda h: h.handedness = '{side}')[1].pixels[1]"
_WHOLE = "list_filter(hands, lambda h: len(h.pixels) >= 21)[1].pixels"


@query(f"""{_ALL}, {v.HAND_FRAMES_SQL}, fr AS (SELECT video_id, seq, ts, depth, {_FIRST("right")} AS rw, {_FIRST("left")} AS lw, {_WHOLE} AS px FROM hf),
fz AS (SELECT *, CASE WHEN depth IS NOT NULL THEN {v.map_sql("depth", "coalesce(rw, lw).x", "coalesce(rw, lw).y")} END AS z FROM fr),
es AS (SELECT s.video_id, s.segment_id, row_number() OVER w - 1 AS step, rw, lw, px, z, lag(rw) OVER w AS rw0, lag(lw) OVER w AS lw0, lag(z) OVER w AS z0 FROM seg s JOIN fz ON fz.video_id = s.video_id AND fz.ts BETWEEN s.start_time AND s.end_time WINDOW w AS (PARTITION BY s.video_id, s.segment_id ORDER BY fz.ts, fz.seq))
SELECT video_id, segment_id, step, {", ".join(f"CASE WHEN step > 0 THEN round(coalesce(rw.{k} - rw0.{k}, lw.{k} - lw0.{k}, 0), 6) ELSE 0 END AS d{k}" for k in "xy")}, CASE WHEN step > 0 THEN round(coalesce(z - z0, 0), 6) ELSE 0 END AS dz, 0e0 AS droll, 0e0 AS dpitch, 0e0 AS dyaw,
  CASE WHEN step > 0 THEN round(coalesce(1 - least({_DIST("px[5]", "px[9]")} / 100, 1), 0), 6) ELSE 0 END AS grasp FROM es""")
def hands_actions(spark, d):
    s = c._segments(spark, d).select("video_id", "segment_id", "start_time", "end_time")
    steps = segments.steps(s, v.hand_frames(spark, d).select("video_id", "seq", "ts", "hands", "depth"))
    seven = ("dx", "dy", "dz", "droll", "dpitch", "dyaw", "grasp")
    return hands.actions(steps, "depth", v.map_at).select("video_id", "segment_id", "step", *[c.r6(k) for k in seven])


_CONTACTS = f"""{_LIST}, ob AS (SELECT video_id, seq, k, vec_id, e FROM hands_v, (SELECT unnest([0, 1]) AS k)),
bx AS (SELECT video_id, seq, k, ['wrench', 'bolt', 'screw', 'panel', 'cable', 'plate', 'gear'][1 + CAST((vec_id + k) % 7 AS INT)] AS class_name, CAST(floor((e[47 + 4 * k] + 0.5e0) * 640) AS BIGINT) AS x1, CAST(floor((e[48 + 4 * k] + 0.5e0) * 480) AS BIGINT) AS y1 FROM ob),
pa AS (SELECT hd.video_id, hd.seq, hd.i - 1 AS hand_no, bx.k AS object_no, label AS handedness, class_name, px, x1, y1, x1 + 100 + 20 * k AS x2, y1 + 80 AS y2, hf.depth,
  {_BOX("px", "x")} AS a1, {_BOX("px", "y")} AS b1, {_END("px", "x", 640)} AS a2, {_END("px", "y", 480)} AS b2 FROM hd JOIN bx USING (video_id, seq) JOIN hf USING (video_id, seq)),
io AS (SELECT *, greatest(least(a2, x2) - greatest(a1, x1), 0) * greatest(least(b2, y2) - greatest(b1, y1), 0) AS inter, greatest(a2 - a1, 0) * greatest(b2 - b1, 0) + greatest(x2 - x1, 0) * greatest(y2 - y1, 0) AS areas,
  len(list_filter([px[5], px[9], px[13], px[17], px[21]], lambda p: p.x BETWEEN x1 AND x2 AND p.y BETWEEN y1 AND y2)) AS tips,
  CASE WHEN depth IS NOT NULL THEN abs({v.map_sql("depth", "px[1].x", "px[1].y")} - {v.map_sql("depth", "((x1 + x2) // 2)", "((y1 + y2) // 2)")}) END AS depth_diff FROM pa),
s0 AS (SELECT *, coalesce(inter / nullif(areas - inter, 0), 0) AS iou FROM io),
s1 AS (SELECT *, round(CASE WHEN depth_diff IS NULL THEN 0.525e0 * least(1, iou / 0.3e0) + 0.475e0 * least(1, tips / 3e0) ELSE 0.4e0 * least(1, iou / 0.3e0) + 0.25e0 * greatest(0, 1 - depth_diff / 0.1e0) + 0.35e0 * least(1, tips / 3e0) END, 4) AS b0 FROM s0),
s2 AS (SELECT *, greatest(b0, CASE WHEN iou > 0.3e0 THEN 0.5e0 ELSE 0 END, CASE WHEN iou > 0.1e0 AND depth_diff < 0.05e0 THEN 0.6e0 ELSE 0 END, CASE WHEN tips >= 1 THEN 0.4e0 ELSE 0 END) AS contact_score FROM s1)"""


@query(f"""{_CONTACTS}
SELECT video_id, seq, hand_no, CAST(object_no AS BIGINT) AS object_no, handedness, class_name, round(iou, 6) AS iou, tips, round(depth_diff, 6) AS depth_diff, contact_score, row_number() OVER (PARTITION BY video_id, seq ORDER BY contact_score DESC, hand_no, object_no) AS contact_rank FROM s2 WHERE contact_score >= 0.3e0""")
def hands_contacts(spark, d):
    return _contacts(spark, d).drop("centre").withColumns({k: F.round(k, 6) for k in ("iou", "depth_diff")})


def _contacts(spark, d):
    seen = v.objects(spark, d).groupBy("video_id", "seq").agg(F.array_sort(F.collect_list(F.struct("ordinal", "class_name", "bbox"))).alias("objects"))  # two in a frame
    rows = v.hand_frames(spark, d).select("video_id", "seq", "hands", "depth").join(seen, ["video_id", "seq"])
    return hands.contacts(rows, "depth", v.map_at)


@query(f"""{v.OBJECTS_SQL.join(["WITH " + v.HANDS_SQL + ", ", ""])} SELECT video_id, seq, string_agg(class_name, ',' ORDER BY confidence DESC, ordinal) FILTER (confidence - 0.05e0 >= 0.3e0) AS names FROM objects_v GROUP BY 1, 2""")
def confident_objects(spark, d):
    """Detections of enough confidence, the surest first; the view's are lowered so that some are not."""
    seen = v.objects(spark, d).groupBy("video_id", "seq").agg(F.array_sort(F.collect_list(F.struct("ordinal", "class_name", (F.col("confidence") - 0.05).alias("confidence")))).alias("objects"))
    named = F.transform("objects", lambda o: o["class_name"])
    return hands.confident(seen).select("video_id", "seq", F.when(F.size("objects") > 0, F.array_join(named, ",")).alias("names"))


# --- text of a batch ------------------------------------------------------------

_batch = lambda: F.floor(F.col("seq") / 5).cast("long").alias("batch_id")
_TOP = f"""{_score_sql(hands.LIGHT)}{_CONTACTS.removeprefix(_LIST)}, {v.OBJECTS_SQL},
ct AS (SELECT s2.*, seq // 5 AS batch_id, (x1 + x2) // 2 AS cx, (y1 + y2) // 2 AS cy, row_number() OVER (PARTITION BY video_id, seq ORDER BY contact_score DESC, hand_no, object_no) AS rank FROM s2 WHERE contact_score >= 0.3e0),
tp AS (SELECT *, row_number() OVER (PARTITION BY video_id, batch_id ORDER BY contact_score DESC, seq, rank) AS place FROM ct)"""


def _batches(spark, d):
    """Frames that could be read, their hands, objects and contacts, by batch."""
    seen = hands.activity(v.hand_frames(spark, d), hands.LIGHT).where("hands is not null").select("video_id", _batch(), "seq", "ts", "activity", "hands", "depth")
    each = seen.select("video_id", "batch_id", "seq", F.explode("hands.handedness").alias("handedness"))
    objects = v.objects(spark, d).select("video_id", _batch(), "seq", "ordinal", "class_name", "confidence")
    held = _contacts(spark, d).select("video_id", _batch(), "seq", F.col("handedness").alias("hand"), "class_name", "contact_score", F.col("contact_rank").alias("ordinal"), "centre.x", "centre.y").toDF("video_id", "batch_id", "seq", "hand", "class_name", "contact_score", "ordinal", "cx", "cy")
    return seen, each, objects, held


@query(f"""{_TOP}, sp AS (SELECT hf.video_id, hf.seq // 5 AS batch_id, min(ts) AS a, max(ts) AS z, avg(activity) AS m FROM hf JOIN act USING (video_id, seq) WHERE hands IS NOT NULL GROUP BY 1, 2),
hn AS (SELECT video_id, batch_id, string_agg(label, ', ' ORDER BY label) AS t FROM (SELECT DISTINCT video_id, seq // 5 AS batch_id, label FROM hd) GROUP BY 1, 2),
cn AS (SELECT video_id, batch_id, string_agg(class_name || ' (conf ' || printf('%.2f', c + 1e-9) || ')', ', ' ORDER BY c DESC, first) AS t FROM (SELECT video_id, seq // 5 AS batch_id, class_name, max(confidence) AS c, min((seq, ordinal)) AS first FROM objects_v GROUP BY 1, 2, 3) GROUP BY 1, 2),
ix AS (SELECT video_id, batch_id, string_agg(handedness || ' hand -> ' || class_name || ' (score ' || printf('%.2f', contact_score + 1e-9) || ')', '; ' ORDER BY place) AS t FROM tp WHERE place <= 3 GROUP BY 1, 2)
SELECT sp.video_id, sp.batch_id, 'Local CV metadata for frames ' || printf('%.1f', a + 1e-9) || 's - ' || printf('%.1f', z + 1e-9) || 's:' || chr(10) || '  Hands: ' || coalesce(hn.t || ' detected', 'none detected') || coalesce(chr(10) || '  Objects: ' || cn.t, '') || coalesce(chr(10) || '  Interactions: ' || ix.t, '') || chr(10) || '  Activity score: ' || printf('%.2f', m + 1e-9) AS context
FROM sp LEFT JOIN hn USING (video_id, batch_id) LEFT JOIN cn USING (video_id, batch_id) LEFT JOIN ix USING (video_id, batch_id)""")
def inline_context(spark, d):
    seen, each, objects, held = _batches(spark, d)
    return context.short_context(seen, each, objects, held)


@query(f"""{_TOP}, fd AS (SELECT video_id, seq // 5 AS batch_id, arg_min(hands, seq) AS hands, arg_min(depth, seq) AS m FROM hf WHERE depth IS NOT NULL AND hands IS NOT NULL GROUP BY 1, 2),
hw AS (SELECT video_id, batch_id, string_agg('hand at ' || printf('%.2f', {v.map_sql("m", "h.pixels[1].x", "h.pixels[1].y")} + 1e-9), ', ' ORDER BY i) AS t FROM (SELECT video_id, batch_id, m, unnest(hands) AS h, generate_subscripts(hands, 1) AS i FROM fd) GROUP BY 1, 2),
ow AS (SELECT tp.video_id, tp.batch_id, string_agg(class_name || ' at ' || printf('%.2f', {v.map_sql("m", "cx", "cy")} + 1e-9), ', ' ORDER BY place) AS t FROM tp JOIN fd USING (video_id, batch_id) WHERE place <= 2 GROUP BY 1, 2)
SELECT video_id, batch_id, CASE WHEN hw.t IS NULL THEN ow.t ELSE hw.t || ', ' || ow.t END AS deep FROM ow LEFT JOIN hw USING (video_id, batch_id)""")
def depth_lines(spark, d):
    seen, _, _, held = _batches(spark, d)
    return context.depth_line(seen, held, "depth", v.map_at)


@query(f"""{c._SEG_SQL.replace("WITH RECURSIVE ", "WITH RECURSIVE " + v.HANDS_SQL + ", ", 1)}, an AS (SELECT video_id, CAST(round(ts * 1000) AS BIGINT) AS ms, arg_max(vec_id, vec_id) AS vec_id FROM (SELECT label % 10 AS video_id, (vec_id % 40) * 0.5e0 + 1e-7 AS ts, vec_id FROM embeddings) GROUP BY 1, 2)
SELECT f.video_id, f.seq, an.vec_id FROM frames f JOIN an ON an.video_id = f.video_id AND an.ms = CAST(round(f.ts * 1000) AS BIGINT)""")
def annotations_at_frames(spark, d):
    """Frames with the last annotation of their millisecond; the annotations' times are a little off and repeat."""
    e = v.table(spark, d, "embeddings").select((F.col("label") % 10).cast("long").alias("video_id"), ((F.col("vec_id") % 40) * 0.5 + 1e-7).alias("ts"), "vec_id")
    return labels.at_frames(v.frames(spark, d).select("video_id", "seq", "ts"), e, "vec_id").select("video_id", "seq", "vec_id")


# --- trajectories -------------------------------------------------------------

_W = "PARTITION BY video_id, handedness ORDER BY seq"
_SMOOTHED = ("x", "y", "z", "roll", "pitch", "yaw", "tx", "ty", "tz")


def _fill_sql(name: str, src: str, columns: tuple[str, ...], most: int | None) -> str:
    """CTE with each column's gaps of at most `most` samples filled, by the places of the known samples around a gap."""
    upto, after = f"OVER ({_W} ROWS UNBOUNDED PRECEDING)", f"OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    sides = ", ".join(f"last_value({k} IGNORE NULLS) {upto} AS l_{k}, max(CASE WHEN {k} IS NOT NULL THEN i END) {upto} AS li_{k}, first_value({k} IGNORE NULLS) {after} AS r_{k}, min(CASE WHEN {k} IS NOT NULL THEN i END) {after} AS ri_{k}" for k in columns)

    def one(k: str) -> str:
        n, place = f"(coalesce(ri_{k}, m + 1) - coalesce(li_{k}, 0) - 1)", f"(i - coalesce(li_{k}, 0) - 1)"
        left, right = f"coalesce(l_{k}, r_{k})", f"coalesce(r_{k}, l_{k})"
        small = f"{n} <= {most}" if most else "true"
        return f"coalesce({k}, CASE WHEN {small} THEN CASE WHEN {n} > 1 THEN {left} + ({right} - {left}) * {place} / ({n} - 1) ELSE {left} END END) AS {k}"

    return f"{name} AS (SELECT * REPLACE ({', '.join(map(one, columns))}) FROM (SELECT *, {sides} FROM {src}))"


_V = lambda k, a, b: f"({a}[{k}].x - {b}.x), ({a}[{k}].y - {b}.y)"
_TRACK = f"""{_HF}, sp AS (SELECT video_id, seq, ts, depth, side AS handedness, list_filter(hands, lambda h: h.handedness = side) AS own FROM hf, (SELECT unnest(['left', 'right']) AS side)),
s0 AS (SELECT *, own[1].pixels AS p, coalesce(len(own), 0) AS sightings FROM sp),
s1 AS (SELECT *, p[6].x - p[1].x AS ix, p[6].y - p[1].y AS iy, p[18].x - p[1].x AS px, p[18].y - p[1].y AS py, p[10].x - p[1].x AS mx, p[10].y - p[1].y AS my, len(p) >= 21 AS whole FROM s0),
s2 AS (SELECT video_id, handedness, seq, ts, sightings, depth IS NOT NULL AS deep, p[1].x AS x, p[1].y AS y, CASE WHEN p[1] IS NOT NULL THEN CASE WHEN depth IS NOT NULL THEN {v.map_sql("depth", "p[1].x", "p[1].y")} ELSE 0 END END AS z,
  CASE WHEN whole THEN p[9].x END AS tx, CASE WHEN whole THEN p[9].y END AS ty, CASE WHEN whole AND depth IS NOT NULL THEN {v.map_sql("depth", "p[9].x", "p[9].y")} END AS tz, CASE WHEN whole THEN {_DIST("p[5]", "p[9]")} END AS pinch,
  CASE WHEN whole THEN acos(greatest(-1, least(1, ix / (sqrt(ix * ix + iy * iy) + 1e-8) * (px / (sqrt(px * px + py * py) + 1e-8)) + iy / (sqrt(ix * ix + iy * iy) + 1e-8) * (py / (sqrt(px * px + py * py) + 1e-8))))) END AS roll,
  CASE WHEN whole THEN atan2(ix * py - iy * px, sqrt(mx * mx + my * my) + 1e-8) END AS pitch, CASE WHEN whole THEN atan2(my, mx) END AS yaw FROM s1),
s3 AS (SELECT *, row_number() OVER ({_W}) AS i, count(*) OVER (PARTITION BY video_id, handedness) AS m, ts - lag(ts) OVER ({_W}) AS dts, x AS x5 FROM s2),
{_fill_sql("s4", "s3", ("x5",), 5)},
g AS (SELECT video_id, handedness, sum(sightings) >= 2 AND count(x5) >= 2 AS tracked, bool_or(deep) AS deep3, count(roll) > 0 AS turned, count(tx) >= 2 AS tips, CASE WHEN median(dts) IS NULL THEN 0.5e0 WHEN median(dts) <= 0 THEN 1 ELSE median(dts) END AS dt FROM s4 GROUP BY 1, 2)"""
_MOVING = f"""{_TRACK},
t0 AS (SELECT s3.* REPLACE (CASE WHEN deep3 THEN z END AS z, CASE WHEN tips THEN tx END AS tx, CASE WHEN tips THEN ty END AS ty, CASE WHEN tips AND deep3 THEN tz END AS tz), deep3, turned, tips, dt FROM s3 JOIN g USING (video_id, handedness) WHERE tracked),
{_fill_sql("t1", "t0", _SMOOTHED, None)},
t2 AS (SELECT * REPLACE (CASE WHEN tips AND deep3 AND m >= 5 THEN coalesce(tz, 0) ELSE tz END AS tz) FROM t1),
{_fill_sql("t3", "t2", ("pinch",), 5)},
t4 AS (SELECT * EXCLUDE (i, m) FROM t3),
{c._smooth_sql("pos", "t4", *_SMOOTHED)},
pos2 AS (SELECT * EXCLUDE (i, m) FROM pos),
v0 AS (SELECT * FROM (SELECT video_id, handedness, seq, dt, {", ".join(f"({k}_s - lag({k}_s) OVER ({_W})) / dt AS v{k}" for k in "xyz")} FROM pos2) WHERE vx IS NOT NULL),
{c._smooth_sql("vel", "v0", "vx", "vy", "vz")},
a0 AS (SELECT * FROM (SELECT video_id, handedness, seq, {", ".join(f"(v{k}_s - lag(v{k}_s) OVER ({_W})) / dt AS a{k}" for k in "xyz")} FROM vel) WHERE ax IS NOT NULL),
{c._smooth_sql("acc", "a0", "ax", "ay", "az")},
len_ AS (SELECT video_id, handedness, round(coalesce(sum(sqrt(dx * dx + dy * dy + coalesce(dz * dz, 0))), 0), 2) AS path_length FROM (SELECT video_id, handedness, {", ".join(f"{k}_s - lag({k}_s) OVER ({_W}) AS d{k}" for k in "xyz")} FROM pos2) GROUP BY 1, 2),
spd AS (SELECT video_id, handedness, round(max(sqrt(vx_s * vx_s + vy_s * vy_s + coalesce(vz_s * vz_s, 0))), 2) AS max_velocity FROM vel GROUP BY 1, 2),
q AS (SELECT video_id, handedness, quantile_cont(pinch, 0.05e0) AS p5, quantile_cont(pinch, 0.95e0) AS p95, count(pinch) AS valid FROM t3 GROUP BY 1, 2),
sig AS (SELECT p.*, path_length, coalesce(max_velocity, 0) AS max_velocity, CASE WHEN valid < 2 OR p95 - p5 < 1e-6 THEN 0 ELSE 1 / (1 + exp(-6 * (coalesce(least(greatest((p95 - pinch) / (p95 - p5), 0), 1), 0) - 0.5e0))) END AS grasp
  FROM pos2 p JOIN q USING (video_id, handedness) JOIN len_ USING (video_id, handedness) LEFT JOIN spd USING (video_id, handedness))"""
_R = lambda e, k: f"round({e}, 4) AS {k}"


def _moving(spark, d):
    frames = v.hand_frames(spark, d).select("video_id", "seq", "ts", "hands", "depth")
    return trajectories.gated(trajectories.samples(frames, "depth", v.map_at))


@query(f"""{_MOVING} SELECT s.video_id, s.handedness, s.seq, {", ".join(_R(f"s.{k}_s", k) for k in _SMOOTHED)}, CASE WHEN deep3 AND turned THEN round(s.x_s + s.y_s + s.z_s + s.roll_s + s.pitch_s + s.yaw_s, 4) END AS pose6_sum,
{", ".join(_R(f"{k}_s", k) for k in ("vx", "vy", "vz", "ax", "ay", "az"))}, {_R("grasp", "grasp")}, CASE WHEN deep3 THEN 'camera_relative' ELSE 'pixel' END AS coordinate_frame, path_length, max_velocity
FROM sig s LEFT JOIN vel USING (video_id, handedness, seq) LEFT JOIN acc USING (video_id, handedness, seq)""")
def trajectory(spark, d):
    t = trajectories.trajectories(_moving(spark, d))
    pose = F.round(F.aggregate("pose6", F.lit(0.0), lambda a, x: a + x), 4).alias("pose6_sum")
    return t.select("video_id", "handedness", "seq", *[F.round(k, 4).alias(k) for k in _SMOOTHED], pose, *[F.round(k, 4).alias(k) for k in ("vx", "vy", "vz", "ax", "ay", "az", "grasp")], "coordinate_frame", "path_length", "max_velocity")


@query(f"""{_MOVING}, ev AS (SELECT *, CASE WHEN was < 0.5e0 AND grasp >= 0.5e0 THEN 'close' WHEN was >= 0.5e0 AND grasp < 0.5e0 THEN 'open' END AS event_type FROM (SELECT video_id, handedness, seq, ts, grasp, lag(grasp) OVER ({_W}) AS was FROM sig))
SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY handedness, ts) - 1 AS event_no, handedness, ts, event_type, round(lead(ts) OVER ({_W}) - ts, 4) AS duration_to_next FROM ev WHERE event_type IS NOT NULL""")
def trajectory_events(spark, d):
    return trajectories.events(trajectories.trajectories(_moving(spark, d)))


@query(f"{_TRACK} SELECT video_id, bool_or(tracked AND handedness = 'left') AS has_left, bool_or(tracked AND handedness = 'right') AS has_right, bool_or(tracked AND handedness = 'left') AND bool_or(tracked AND handedness = 'right') AS bimanual FROM g GROUP BY 1")
def bimanual(spark, d):
    return trajectories.bimanual(_moving(spark, d))
