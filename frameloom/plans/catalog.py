"""Queries over the provided tables, one for each group of operators, and the same in DuckDB SQL for those that SQL can express.

Floats are rounded to six digits on both sides, and counts are BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions import geometry as g
from frameloom.operators import evaluate, frames, hands, scoring, segments, tracks
from frameloom.sources import views as v

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    from frameloom.plans import catalog_hands, catalog_more, catalog_outputs, catalog_rasters  # noqa: F401  register their own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)


def r6(c: str) -> Column:
    return F.round(c, 6).alias(c)


F_SQL, L_SQL = f"WITH {v.FRAMES_SQL}", f"WITH {v.FRAMES_SQL}, {v.LABELS_SQL}"
H_SQL = f"WITH {v.HANDS_SQL}"

# --- frames -----------------------------------------------------------------


@query(f"{F_SQL} SELECT video_id, seq, ts FROM frames QUALIFY row_number() OVER (PARTITION BY video_id, floor(ts * 0.4e0) ORDER BY ts) = 1")
def frame_sample_fps(spark, d):
    return frames.sample_fps(v.frames(spark, d), 0.4).select("video_id", "seq", "ts")


@query(f"{F_SQL} SELECT video_id, seq, seq / 30e0 AS ts FROM frames WHERE seq % 4 = 0 AND seq < 60")
def frame_stride(spark, d):
    return frames.sample_stride(v.frames(spark, d), 30.0, 7.5, 2.0).select("video_id", "seq", "ts")


@query(f"{F_SQL} SELECT video_id, CAST(regexp_extract(frame_path, '(\\d+)', 1) AS BIGINT) AS n, CAST((CAST(regexp_extract(frame_path, '(\\d+)', 1) AS BIGINT) - 1) * 500 + 15 AS BIGINT) AS ts_ms, 'frame_' || lpad(CAST((CAST(regexp_extract(frame_path, '(\\d+)', 1) AS BIGINT) - 1) * 500 + 15 AS VARCHAR), 10, '0') || '.jpg' AS frame_name FROM frames WHERE seq > 0")
def frame_names(spark, d):
    files = v.frames(spark, d).where("seq > 0").withColumnRenamed("frame_path", "file")
    return frames.name_frames(files, 2.0, 0.015).select("video_id", F.regexp_extract("file", r"(\d+)", 1).cast("long").alias("n"), "ts_ms", "frame_name")


@query(f"{F_SQL} SELECT video_id, seq, seq / 30e0 AS ts FROM frames WHERE seq % 4 = 0")
def frame_stride_whole(spark, d):
    return frames.sample_stride(v.frames(spark, d), 30.0, 7.5).select("video_id", "seq", "ts")


@query(f"{F_SQL} SELECT video_id, CAST(seq + 1 AS BIGINT) AS n, CAST(seq * 500 + 15 AS BIGINT) AS ts_ms, 'frame_' || lpad(CAST(seq * 500 + 15 AS VARCHAR), 10, '0') || '.jpg' AS frame_name FROM frames")
def frame_names_whole(spark, d):
    files = v.frames(spark, d).withColumn("file", F.format_string("frame_%06d.jpg", F.col("seq") + 1))
    return frames.name_frames(files, 2.0, 0.015).select("video_id", F.regexp_extract("file", r"(\d+)", 1).cast("long").alias("n"), "ts_ms", "frame_name")


@query(f"""{F_SQL} SELECT video_id, seq, CASE WHEN brightness < 30 THEN 'too_dark' WHEN brightness > 240 THEN 'overexposed' ELSE '' END AS dark_reason,
CASE WHEN brightness IS NULL OR brightness < 30 OR brightness > 240 THEN 'dark' WHEN lapvar < 50 THEN 'blur' ELSE 'good' END AS verdict FROM frames""")
def dark_blur_verdict(spark, d):
    return frames.stateless_verdict(v.frames(spark, d)).select("video_id", "seq", "dark_reason", "verdict")


_DEDUP_SQL = f"""WITH RECURSIVE {v.FRAMES_SQL},
kept AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY seq) AS i FROM frames WHERE brightness BETWEEN 30 AND 240 AND lapvar >= 50),
fold AS (
  SELECT video_id, seq, i, brightness AS last, coalesce(flow, 0) AS f1, CAST(NULL AS DOUBLE) AS f2, 1 AS n, 'good' AS verdict FROM kept WHERE i = 1
  UNION ALL
  SELECT k.video_id, k.seq, k.i,
         CASE WHEN 1 - abs(k.brightness - p.last) / 100e0 > 0.95e0 OR (p.n >= 2 AND coalesce(k.flow, 0) > 15 AND p.f1 > 15) THEN p.last ELSE k.brightness END,
         CASE WHEN 1 - abs(k.brightness - p.last) / 100e0 > 0.95e0 THEN p.f1 ELSE coalesce(k.flow, 0) END,
         CASE WHEN 1 - abs(k.brightness - p.last) / 100e0 > 0.95e0 THEN p.f2 ELSE p.f1 END,
         CASE WHEN 1 - abs(k.brightness - p.last) / 100e0 > 0.95e0 THEN p.n ELSE p.n + 1 END,
         CASE WHEN 1 - abs(k.brightness - p.last) / 100e0 > 0.95e0 THEN 'duplicate' WHEN p.n >= 2 AND coalesce(k.flow, 0) > 15 AND p.f1 > 15 THEN 'transition' ELSE 'good' END
  FROM fold p JOIN kept k ON k.video_id = p.video_id AND k.i = p.i + 1),
verdicts AS (SELECT f.video_id, f.seq, f.ts, coalesce(x.verdict, CASE WHEN f.brightness < 30 OR f.brightness > 240 THEN 'dark' ELSE 'blur' END) AS verdict FROM frames f LEFT JOIN fold x USING (video_id, seq))"""


@query(f"{_DEDUP_SQL} SELECT video_id, seq, verdict FROM verdicts")
def dedup_last_accepted(spark, d):
    return frames.filter_frames(v.frames(spark, d)).select("video_id", "seq", "verdict")


@query(f"""{_DEDUP_SQL}, runs AS (SELECT *, sum(CASE WHEN verdict = 'transition' THEN 0 ELSE 1 END) OVER (PARTITION BY video_id ORDER BY seq) AS run FROM verdicts WHERE verdict IN ('good', 'transition'))
SELECT video_id, min(ts) AS start, max(ts) AS "end" FROM runs WHERE verdict = 'transition' GROUP BY video_id, run""")
def transition_ranges(spark, d):
    return frames.transition_ranges(frames.filter_frames(v.frames(spark, d)))


_STATS_SQL = f"""{_DEDUP_SQL}, runs AS (SELECT *, sum(CASE WHEN verdict = 'transition' THEN 0 ELSE 1 END) OVER (PARTITION BY video_id ORDER BY seq) AS run FROM verdicts WHERE verdict IN ('good', 'transition')),
tr AS (SELECT video_id, count(DISTINCT run) AS n_transition FROM runs WHERE verdict = 'transition' GROUP BY 1),
stats AS (SELECT video_id, count(*) AS total, count(*) FILTER (verdict = 'good') AS n_good, count(*) FILTER (verdict = 'dark') AS n_dark, count(*) FILTER (verdict = 'blur') AS n_blur, count(*) FILTER (verdict = 'duplicate') AS n_duplicate FROM verdicts GROUP BY 1),
st AS (SELECT stats.*, coalesce(n_transition, 0) AS n_transition FROM stats LEFT JOIN tr USING (video_id))"""


@query(f"""{_STATS_SQL} SELECT *, {", ".join(f"round(100e0 * n_{x} / total, 1) AS {x}_pct" for x in ("good", "dark", "blur", "duplicate", "transition"))} FROM st""")
def filter_stats(spark, d):
    return frames.filter_stats(frames.filter_frames(v.frames(spark, d)))


@query(f"""{F_SQL} SELECT video_id, batch_id, count(*) AS n_frames, min(ts) AS start, max(ts) AS "end" FROM (SELECT video_id, ts, seq // 5 AS batch_id FROM frames) GROUP BY 1, 2""")
def frame_batches(spark, d):
    return frames.batches(v.frames(spark, d))


@query(f"""{_STATS_SQL}, c AS (SELECT video_id, total, n_good AS kept FROM st),
n AS (SELECT *, CAST(ceil(kept / 5e0) AS BIGINT) AS n_batches FROM c)
SELECT video_id, total, kept, n_batches, round(kept / CAST(total AS DOUBLE), 3) AS keep_ratio, round(n_batches * 0.05e0, 2) AS cost_inr, round(CAST(ceil(total / 5e0) AS BIGINT) * 0.05e0 - n_batches * 0.05e0, 2) AS saved_inr, round(n_batches * 0.05e0, 2) AS cost_gemini,
round(n_batches * 0.08e0, 2) AS cost_claude_haiku, round(n_batches * 0.1e0, 2) AS cost_openai, round(n_batches * 0.35e0, 2) AS cost_claude_sonnet FROM n""")
def cost_estimate(spark, d):
    s = frames.filter_stats(frames.filter_frames(v.frames(spark, d)))
    return frames.estimate_cost(s.select("video_id", "total", F.col("n_good").alias("kept")))


@query(f"{F_SQL} SELECT video_id, seq, ts FROM frames WHERE k % 3 <> 0")
def resume_unprocessed(spark, d):
    f = v.frames(spark, d)
    return frames.unprocessed(f, f.where("k % 3 = 0")).select("video_id", "seq", "ts")


@query(f"{H_SQL} SELECT video_id, seq, round(last_value(depth IGNORE NULLS) OVER (PARTITION BY video_id ORDER BY seq ROWS UNBOUNDED PRECEDING), 6) AS carried FROM hands_v")
def depth_carry_forward(spark, d):
    return frames.carry_forward(v.hands(spark, d)).select("video_id", "seq", r6("carried"))


# --- hands and objects ------------------------------------------------------

_BOX_SQL = f"""{H_SQL}, boxes AS (SELECT *, greatest(list_min(list_transform(pixels, lambda p: p.x)) - 10, 0) AS hx1, greatest(list_min(list_transform(pixels, lambda p: p.y)) - 10, 0) AS hy1,
least(list_max(list_transform(pixels, lambda p: p.x)) + 10, 640) AS hx2, least(list_max(list_transform(pixels, lambda p: p.y)) + 10, 480) AS hy2 FROM hands_v)"""


def _boxed(spark, d):
    return v.hands(spark, d).withColumn("hand_box", g.box_of(F.col("pixels"), v.WIDTH, v.HEIGHT))


@query(f"""{_BOX_SQL} SELECT video_id, seq, round(hx1, 6) AS x1, round(hy1, 6) AS y1, round(hx2, 6) AS x2, round(hy2, 6) AS y2, round(greatest(hx2 - hx1, 0) * greatest(hy2 - hy1, 0), 4) AS area,
CAST(floor((hx1 + hx2) / 2) AS INT) AS cx, CAST(floor((hy1 + hy2) / 2) AS INT) AS cy FROM boxes""")
def hand_bbox(spark, d):
    b = F.col("hand_box")
    return _boxed(spark, d).select("video_id", "seq", *[F.round(b[c], 6).alias(c) for c in ("x1", "y1", "x2", "y2")], F.round(g.area(b), 4).alias("area"), g.centre(b)["x"].alias("cx"), g.centre(b)["y"].alias("cy"))


def _angle_sql(a: int, b: int, c: int) -> str:
    ax, ay, cx, cy = (f"(pixels[{i + 1}].{d} - pixels[{b + 1}].{d})" for i, d in ((a, "x"), (a, "y"), (c, "x"), (c, "y")))
    return f"acos(least(greatest(({ax} * {cx} + {ay} * {cy}) / (sqrt({ax} * {ax} + {ay} * {ay}) * sqrt({cx} * {cx} + {cy} * {cy}) + 1e-8), -1), 1))"


_P = lambda i, j: f"sqrt((pixels[{i + 1}].x - pixels[{j + 1}].x) ** 2 + (pixels[{i + 1}].y - pixels[{j + 1}].y) ** 2)"
_CURLS_SQL = ", ".join(f"least(greatest(1 - ({_angle_sql(*j[:3])} + {_angle_sql(*j[1:])}) / (2 * pi()), 0), 1) AS {f}" for f, j in g.FINGERS.items())
_GRASP_RULES_SQL = f"""{H_SQL}, m0 AS (SELECT video_id, seq, pixels, {_CURLS_SQL}, {_P(0, 12)} + 1e-6 AS scale, pixels[5].x AS px, pixels[5].y AS py, pixels[6].x AS ax, pixels[6].y AS ay, pixels[7].x - pixels[6].x AS dx, pixels[7].y - pixels[6].y AS dy FROM hands_v),
m1 AS (SELECT *, {_P(4, 8)} / scale AS tips, ({_P(8, 12)} + {_P(12, 16)} + {_P(16, 20)}) / (3 * scale) AS spread, coalesce(least(greatest(((px - ax) * dx + (py - ay) * dy) / nullif(dx * dx + dy * dy, 0), 0), 1), 0) AS t, ("index" + middle + ring + pinky) / 4 AS mc, (middle + ring + pinky) / 3 AS oc FROM m0),
m AS (SELECT *, sqrt((px - (ax + t * dx)) ** 2 + (py - (ay + t * dy)) ** 2) / scale AS side FROM m1),
r AS (SELECT *, CASE WHEN mc < 0.3e0 AND spread > 0.25e0 THEN 'no_contact' WHEN tips < 0.25e0 AND oc < 0.6e0 THEN 'pinch' WHEN mc > 0.7e0 AND thumb > 0.5e0 THEN 'power' WHEN side < 0.12e0 AND "index" > 0.4e0 THEN 'lateral' WHEN mc > 0.5e0 AND thumb < 0.3e0 THEN 'hook' WHEN mc > 0.3e0 AND spread > 0.2e0 THEN 'spherical' ELSE 'unknown' END AS grasp_type FROM m)"""


@query(f"""{_GRASP_RULES_SQL} SELECT video_id, seq, grasp_type, round(CASE grasp_type WHEN 'no_contact' THEN least(1, 0.5e0 + (0.3e0 - mc) + spread) WHEN 'unknown' THEN 0.3e0 ELSE greatest(0.4e0, least(1, CASE grasp_type WHEN 'pinch' THEN (0.25e0 - tips) * 4 WHEN 'power' THEN mc WHEN 'lateral' THEN (0.12e0 - side) * 8 WHEN 'hook' THEN mc * 0.8e0 ELSE spread * 2 END)) END, 6) AS confidence, {", ".join(f'round("{f}", 6) AS "{f}"' for f in g.FINGERS)} FROM r""")
def finger_curl_grasp(spark, d):
    h = g.with_grasp(v.hands(spark, d).select("video_id", "seq", "pixels"), "pixels")
    return h.select("video_id", "seq", "grasp_type", r6("confidence"), *map(r6, g.FINGERS))


@query(f"""{_BOX_SQL}, {v.OBJECTS_SQL}, pairs AS (
  SELECT b.video_id, b.seq, o.ordinal, o.class_name, greatest(least(hx2, x2) - greatest(hx1, x1), 0) * greatest(least(hy2, y2) - greatest(hy1, y1), 0) AS inter,
         greatest(hx2 - hx1, 0) * greatest(hy2 - hy1, 0) + (x2 - x1) * (y2 - y1) AS areas,
         CAST(len(list_filter([5, 9, 13, 17, 21], lambda i: pixels[i].x BETWEEN x1 AND x2 AND pixels[i].y BETWEEN y1 AND y2)) AS BIGINT) AS tips
  FROM boxes b JOIN objects_v o USING (video_id, seq)),
u AS (SELECT *, inter / (areas - inter) AS iou FROM pairs),
s AS (SELECT *, round(0.525e0 * least(1, iou / 0.3e0) + 0.475e0 * least(1, tips / 3e0), 4) AS s0 FROM u),
t AS (SELECT *, CASE WHEN iou > 0.3e0 THEN greatest(s0, 0.5e0) ELSE s0 END AS s1 FROM s),
w AS (SELECT *, CASE WHEN tips >= 1 THEN greatest(s1, 0.4e0) ELSE s1 END AS contact_score FROM t)
SELECT video_id, seq, ordinal, class_name, round(iou, 6) AS iou, tips, contact_score, row_number() OVER (PARTITION BY video_id, seq ORDER BY contact_score DESC, ordinal) AS rank FROM w WHERE contact_score >= 0.3e0""")
def hand_object_contact(spark, d):
    found = evaluate.contacts(_boxed(spark, d).select("video_id", "seq", "pixels", "hand_box"), v.objects(spark, d))
    return found.select("video_id", "seq", "ordinal", "class_name", r6("iou"), "tips", "contact_score", "rank")


@query(f"{H_SQL}, {v.OBJECTS_SQL} SELECT video_id, class_name, seq, ordinal, confidence FROM objects_v QUALIFY row_number() OVER (PARTITION BY video_id, class_name ORDER BY confidence DESC, seq, ordinal) = 1")
def best_object_per_class(spark, d):
    return evaluate.best_object_per_class(v.objects(spark, d))


@query(f"""{H_SQL}, pairs AS (SELECT video_id, seq, e AS a, lag(e) OVER (PARTITION BY video_id ORDER BY seq) AS b FROM hands_v),
m AS (SELECT *, list_sum(a) / len(a) AS ma, list_sum(b) / len(b) AS mb FROM pairs WHERE b IS NOT NULL),
z AS (SELECT video_id, seq, list_transform(a, lambda x: x - ma) AS da, list_transform(b, lambda x: x - mb) AS db FROM m)
SELECT video_id, seq, round(least(greatest(list_sum(list_transform(list_zip(da, db), lambda p: p[1] * p[2])) / len(da) / greatest(sqrt(list_sum(list_transform(da, lambda x: x * x)) / len(da)), 1e-8) / greatest(sqrt(list_sum(list_transform(db, lambda x: x * x)) / len(db)), 1e-8), 0), 1), 6) AS similarity FROM z""")
def ncc_similarity(spark, d):
    h = v.hands(spark, d)
    was = F.lag("e").over(segments.Window.partitionBy("video_id").orderBy("seq"))
    return h.withColumn("b", was).where("b is not null").select("video_id", "seq", F.round(g.ncc(F.col("e"), F.col("b")), 6).alias("similarity"))


@query(f"""{H_SQL}, pv AS (SELECT *, lag(pixels) OVER w AS pp, NOT lag(missing) OVER w AND lag(handedness) OVER w = handedness AS same FROM hands_v WINDOW w AS (PARTITION BY video_id ORDER BY seq)),
st AS (SELECT *, list_transform(list_zip(pixels, pp), lambda z: sqrt((z[1].x - z[2].x) ** 2 + (z[1].y - z[2].y) ** 2)) AS d FROM pv)
SELECT video_id, seq, round(CASE WHEN missing THEN 0 ELSE least(1, 0.2e0 + CASE WHEN same THEN 0.35e0 * least(1, d[1] / 50) + 0.25e0 * least(1, list_sum(d) / 21 / 30) ELSE 0 END) END, 6) AS activity FROM st""")
def activity_score_lite(spark, d):
    return evaluate.activity_lite(v.hands(spark, d)).select("video_id", "seq", r6("activity"))


@query(f"""{H_SQL}, pv AS (SELECT *, lag(pixels) OVER w AS pp, NOT lag(missing) OVER w AND lag(handedness) OVER w = handedness AS same FROM hands_v WINDOW w AS (PARTITION BY video_id ORDER BY seq)),
st AS (SELECT *, list_transform(list_zip(pixels, pp), lambda z: sqrt((z[1].x - z[2].x) ** 2 + (z[1].y - z[2].y) ** 2)) AS d FROM pv),
sc AS (SELECT video_id, round(CASE WHEN missing THEN 0 ELSE least(1, 0.2e0 + CASE WHEN same THEN 0.35e0 * least(1, d[1] / 50) + 0.25e0 * least(1, list_sum(d) / 21 / 30) ELSE 0 END) END, 6) AS a FROM st)
SELECT video_id, count(*) AS total, count(*) FILTER (a >= 0.6e0) AS n_active, count(*) FILTER (a >= 0.2e0 AND a < 0.6e0) AS n_possible, count(*) FILTER (a < 0.2e0) AS n_idle, round(sum(a) / (count(*) + 1e-8), 3) AS mean_activity FROM sc GROUP BY 1""")
def activity_route(spark, d):
    a = evaluate.activity_lite(v.hands(spark, d)).select("video_id", r6("activity"))
    kind = hands.activity_class(F.col("activity"))
    n = lambda k: F.count_if(kind.startswith(k)).alias(f"n_{k}")
    return a.groupBy("video_id").agg(F.count("*").alias("total"), n("active"), n("possible"), n("idle"), F.round(F.sum("activity") / (F.count("*") + 1e-8), 3).alias("mean_activity"))


# --- tracks -----------------------------------------------------------------


def _wrist(spark, d):
    p = F.get("pixels", F.lit(0))
    tip = g.dist(F.get("pixels", F.lit(4)), F.get("pixels", F.lit(8)))
    hide = lambda c: F.when(~F.col("missing"), c)
    return v.hands(spark, d).select("video_id", "handedness", "seq", "ts", hide(p["x"]).alias("x"), hide(p["y"]).alias("y"), hide(tip).alias("pinch"))


_WRIST_SQL = f"""{H_SQL}, wrist AS (SELECT video_id, handedness, seq, ts, CASE WHEN NOT missing THEN pixels[1].x END AS x, CASE WHEN NOT missing THEN sqrt((pixels[5].x - pixels[9].x) ** 2 + (pixels[5].y - pixels[9].y) ** 2) END AS pinch FROM hands_v),
runs AS (SELECT *, count(x) OVER (PARTITION BY video_id, handedness ORDER BY seq) AS run FROM wrist),
gaps AS (SELECT *, count(*) OVER (PARTITION BY video_id, handedness, run, x IS NULL) AS n, row_number() OVER (PARTITION BY video_id, handedness, run, x IS NULL ORDER BY seq) - 1 AS k,
  last_value(x IGNORE NULLS) OVER (PARTITION BY video_id, handedness ORDER BY seq ROWS UNBOUNDED PRECEDING) AS l0,
  first_value(x IGNORE NULLS) OVER (PARTITION BY video_id, handedness ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r0 FROM runs),
sides AS (SELECT *, coalesce(l0, r0) AS l, coalesce(r0, l0) AS r FROM gaps),
alls AS (SELECT video_id, handedness, seq, ts, coalesce(x, CASE WHEN n > 1 THEN l + (r - l) * k / (n - 1) ELSE l END) AS x, row_number() OVER (PARTITION BY video_id, handedness ORDER BY seq) AS i, count(*) OVER (PARTITION BY video_id, handedness) AS m FROM sides),
sm AS (SELECT *, CASE WHEN m < 5 THEN x
  WHEN i = 1 THEN (31 * x + 9 * lead(x, 1) OVER w - 3 * lead(x, 2) OVER w - 5 * lead(x, 3) OVER w + 3 * lead(x, 4) OVER w) / 35e0
  WHEN i = 2 THEN (9 * lag(x, 1) OVER w + 13 * x + 12 * lead(x, 1) OVER w + 6 * lead(x, 2) OVER w - 5 * lead(x, 3) OVER w) / 35e0
  WHEN i = m - 1 THEN (-5 * lag(x, 3) OVER w + 6 * lag(x, 2) OVER w + 12 * lag(x, 1) OVER w + 13 * x + 9 * lead(x, 1) OVER w) / 35e0
  WHEN i = m THEN (3 * lag(x, 4) OVER w - 5 * lag(x, 3) OVER w - 3 * lag(x, 2) OVER w + 9 * lag(x, 1) OVER w + 31 * x) / 35e0
  ELSE (-3 * lag(x, 2) OVER w + 12 * lag(x, 1) OVER w + 17 * x + 12 * lead(x, 1) OVER w - 3 * lead(x, 2) OVER w) / 35e0 END AS s
  FROM alls WINDOW w AS (PARTITION BY video_id, handedness ORDER BY seq))"""


@query(f"{_WRIST_SQL} SELECT video_id, handedness, seq, round(CASE WHEN x IS NOT NULL THEN x WHEN n <= 5 THEN CASE WHEN n > 1 THEN l + (r - l) * k / (n - 1) ELSE l END END, 6) AS x FROM sides")
def wrist_gapfill(spark, d):
    return tracks.fill_gaps(_wrist(spark, d), "x").select("video_id", "handedness", "seq", r6("x"))


@query(f"{_WRIST_SQL} SELECT video_id, handedness, seq, round(s, 6) AS x FROM sm")
def savgol_smooth(spark, d):
    return tracks.smooth(tracks.fill_gaps(_wrist(spark, d), "x", max_gap=None), "x").select("video_id", "handedness", "seq", r6("x"))


def _smooth_sql(name: str, src: str, *cols: str) -> str:
    """CTE with c_s for each c, smoothed over five samples."""
    at = lambda c, row, p: "(" + " + ".join(f"{k} * " + (c if j == p else f"lag({c}, {p - j}) OVER w" if j < p else f"lead({c}, {j - p}) OVER w") for j, k in enumerate(row)) + ") / 35e0"
    one = lambda c: f"CASE WHEN m < 5 THEN {c} WHEN i = 1 THEN {at(c, tracks.SMOOTH[0], 0)} WHEN i = 2 THEN {at(c, tracks.SMOOTH[1], 1)} WHEN i = m - 1 THEN {at(c, tracks.SMOOTH[3], 3)} WHEN i = m THEN {at(c, tracks.SMOOTH[4], 4)} ELSE {at(c, tracks.SMOOTH[2], 2)} END AS {c}_s"
    return f"{name} AS (SELECT *, {', '.join(map(one, cols))} FROM (SELECT *, row_number() OVER (PARTITION BY video_id, handedness ORDER BY seq) AS i, count(*) OVER (PARTITION BY video_id, handedness) AS m FROM {src}) WINDOW w AS (PARTITION BY video_id, handedness ORDER BY seq))"


_W = "PARTITION BY video_id, handedness ORDER BY seq"
_FILL = lambda c: f"coalesce({c}, CASE WHEN n > 1 THEN coalesce(l{c}, r{c}) + (coalesce(r{c}, l{c}) - coalesce(l{c}, r{c})) * k / (n - 1) ELSE coalesce(l{c}, r{c}) END) AS {c}"
_MOTION_CTES = f"""wr AS (SELECT video_id, handedness, seq, ts, CASE WHEN NOT missing THEN pixels[1].x END AS x, CASE WHEN NOT missing THEN pixels[1].y END AS y, CASE WHEN NOT missing THEN sqrt((pixels[5].x - pixels[9].x) ** 2 + (pixels[5].y - pixels[9].y) ** 2) END AS pinch FROM hands_v),
rn AS (SELECT *, count(x) OVER ({_W}) AS run FROM wr),
gp AS (SELECT *, count(*) OVER (PARTITION BY video_id, handedness, run, x IS NULL) AS n, row_number() OVER (PARTITION BY video_id, handedness, run, x IS NULL ORDER BY seq) - 1 AS k,
  {", ".join(f"last_value({c} IGNORE NULLS) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS l{c}, first_value({c} IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r{c}" for c in "xy")} FROM rn),
fl AS (SELECT video_id, handedness, seq, ts, pinch, {_FILL("x")}, {_FILL("y")} FROM gp),
{_smooth_sql("pos", "fl", "x", "y")},
v0 AS (SELECT * FROM (SELECT video_id, handedness, seq, ts, (x_s - lag(x_s) OVER ({_W})) / 0.5e0 AS vx, (y_s - lag(y_s) OVER ({_W})) / 0.5e0 AS vy FROM pos) WHERE vx IS NOT NULL),
{_smooth_sql("vel", "v0", "vx", "vy")},
a0 AS (SELECT * FROM (SELECT video_id, handedness, seq, ts, (vx_s - lag(vx_s) OVER ({_W})) / 0.5e0 AS ax, (vy_s - lag(vy_s) OVER ({_W})) / 0.5e0 AS ay FROM vel) WHERE ax IS NOT NULL),
{_smooth_sql("acc", "a0", "ax", "ay")},
stp AS (SELECT video_id, handedness, sqrt((x_s - lag(x_s) OVER ({_W})) ** 2 + (y_s - lag(y_s) OVER ({_W})) ** 2) AS step FROM pos),
pth AS (SELECT p.video_id, p.handedness, n_samples, path_length, coalesce(max_velocity, 0) AS max_velocity FROM (SELECT video_id, handedness, count(*) AS n_samples, coalesce(sum(step), 0) AS path_length FROM stp GROUP BY 1, 2) p
  LEFT JOIN (SELECT video_id, handedness, max(sqrt(vx_s ** 2 + vy_s ** 2)) AS max_velocity FROM vel GROUP BY 1, 2) q ON p.video_id = q.video_id AND p.handedness = q.handedness)"""


def _motion(spark, d):
    rows = _wrist(spark, d)
    filled = tracks.fill_gaps(rows, "x", "y", max_gap=None)
    return tracks.motion(tracks.smooth(filled, "x", "y"), 0.5)


@query(f"""{H_SQL}, {_MOTION_CTES} SELECT pos.video_id, pos.handedness, pos.seq, {", ".join(f"round({c}_s, 5) AS {c}" for c in ("vx", "vy", "ax", "ay"))} FROM pos
LEFT JOIN vel ON vel.video_id = pos.video_id AND vel.handedness = pos.handedness AND vel.seq = pos.seq LEFT JOIN acc ON acc.video_id = pos.video_id AND acc.handedness = pos.handedness AND acc.seq = pos.seq""")
def derivatives(spark, d):
    return _motion(spark, d).select("video_id", "handedness", "seq", *[F.round(c, 5).alias(c) for c in ("vx", "vy", "ax", "ay")])


_GRASP_SQL = f"""{_WRIST_SQL}, p AS (SELECT video_id, handedness, quantile_cont(pinch, 0.05e0) AS p5, quantile_cont(pinch, 0.95e0) AS p95, count(pinch) AS valid FROM wrist GROUP BY 1, 2),
sig AS (SELECT w.video_id, w.handedness, seq, ts, CASE WHEN valid < 2 OR p95 - p5 < 1e-6 THEN 0 ELSE 1 / (1 + exp(-6 * (coalesce(least(greatest((p95 - pinch) / (p95 - p5), 0), 1), 0) - 0.5e0))) END AS grasp FROM wrist w JOIN p ON w.video_id = p.video_id AND w.handedness = p.handedness)"""


@query(f"{_GRASP_SQL} SELECT video_id, handedness, seq, round(grasp, 6) AS grasp FROM sig")
def grasp_signal(spark, d):
    return tracks.grasp_signal(_wrist(spark, d), "pinch").select("video_id", "handedness", "seq", r6("grasp"))


@query(f"""{_GRASP_SQL}, c AS (SELECT *, lag(grasp) OVER (PARTITION BY video_id, handedness ORDER BY seq) AS was FROM sig),
e AS (SELECT *, CASE WHEN was < 0.5e0 AND grasp >= 0.5e0 THEN 'close' WHEN was >= 0.5e0 AND grasp < 0.5e0 THEN 'open' END AS event_type FROM c)
SELECT video_id, handedness, ts, event_type, round(lead(ts) OVER (PARTITION BY video_id, handedness ORDER BY seq) - ts, 4) AS duration_to_next FROM e WHERE event_type IS NOT NULL""")
def grasp_events(spark, d):
    return tracks.grasp_events(tracks.grasp_signal(_wrist(spark, d), "pinch"))


@query(f"{H_SQL}, {_MOTION_CTES} SELECT video_id, handedness, n_samples, round(path_length, 4) AS path_length, round(max_velocity, 4) AS max_velocity FROM pth")
def track_summary(spark, d):
    return tracks.path_summary(_motion(spark, d)).select("video_id", "handedness", "n_samples", F.round("path_length", 4).alias("path_length"), F.round("max_velocity", 4).alias("max_velocity"))


# --- segments ---------------------------------------------------------------

_MERGE_SQL = f"""{L_SQL}, isl AS (SELECT *, CASE WHEN action IS NOT DISTINCT FROM lag(action) OVER (PARTITION BY video_id ORDER BY start, seq) THEN 0 ELSE 1 END AS new FROM labels_v),
runs AS (SELECT *, CAST(sum(new) OVER (PARTITION BY video_id ORDER BY start, seq) AS BIGINT) AS group_id FROM isl),
grp AS (SELECT video_id, group_id, min(action) AS action, min(start) AS start, arg_max("end", seq) AS "end" FROM runs GROUP BY 1, 2),
abs AS (SELECT *, CAST(sum(CASE WHEN group_id = 1 OR "end" - start >= 0.5e0 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY group_id) AS BIGINT) AS segment FROM grp),
named AS (SELECT *, first_value(action) OVER (PARTITION BY video_id, segment ORDER BY group_id) AS segment_action FROM abs),
lab AS (SELECT r.*, n.segment, n.segment_action FROM runs r JOIN named n ON r.video_id = n.video_id AND r.group_id = n.group_id)"""


@query(f"""{_MERGE_SQL} SELECT video_id, segment, min(segment_action) AS action, min(start) AS start, arg_max("end", seq) AS "end", round(avg(confidence), 6) AS confidence, count(*) AS n FROM lab GROUP BY 1, 2""")
def segments_from_labels(spark, d):
    m = segments.merge_labels(v.labels(spark, d))
    out = m.groupBy("video_id", "segment").agg(F.min("segment_action").alias("action"), F.min("start").alias("start"), F.max_by("end", F.struct("start", "seq")).alias("end"), F.avg("confidence").alias("confidence"), F.count("*").alias("n"))
    return out.withColumn("confidence", F.round("confidence", 6))


@query(f"""{_DEDUP_SQL}, {v.LABELS_SQL}, runs AS (SELECT *, sum(CASE WHEN verdict = 'transition' THEN 0 ELSE 1 END) OVER (PARTITION BY video_id ORDER BY seq) AS run FROM verdicts WHERE verdict IN ('good', 'transition')),
tr AS (SELECT video_id, min(ts) AS start, max(ts) AS "end" FROM runs WHERE verdict = 'transition' GROUP BY video_id, run),
isl AS (SELECT *, CASE WHEN action IS NOT DISTINCT FROM lag(action) OVER (PARTITION BY video_id ORDER BY start, seq) THEN 0 ELSE 1 END AS new FROM labels_v),
lr AS (SELECT *, sum(new) OVER (PARTITION BY video_id ORDER BY start, seq) AS group_id FROM isl),
grp AS (SELECT video_id, group_id, min(action) AS action, min(start) AS start, arg_max("end", seq) AS "end", 0 AS kind FROM lr GROUP BY 1, 2 UNION ALL SELECT video_id, NULL, 'transition', start, "end", 1 FROM tr)
SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY start, kind, group_id) AS place, action, start, "end" FROM grp""")
def insert_transitions(spark, d):
    ranges = frames.transition_ranges(frames.filter_frames(v.frames(spark, d)))
    groups = segments.groups_of(segments.group_labels(v.labels(spark, d)))
    return segments.insert_transitions(groups, ranges).select("video_id", "place", "action", "start", "end")


_SPLIT_SQL = f"""{_MERGE_SQL.replace("WITH ", "WITH RECURSIVE ", 1)},
num AS (SELECT *, row_number() OVER (PARTITION BY video_id, segment ORDER BY start, seq) AS i, min(start) OVER (PARTITION BY video_id, segment) AS s0, last_value("end") OVER (PARTITION BY video_id, segment ORDER BY start, seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS e1 FROM lab),
fold AS (SELECT video_id, segment, i, seq, start AS at, CAST(0 AS BIGINT) AS chunk FROM num WHERE i = 1
  UNION ALL SELECT n.video_id, n.segment, n.i, n.seq, CASE WHEN n.segment_action = 'idle' AND n.e1 - n.s0 > 2 AND n."end" - f.at > 2 THEN n.start ELSE f.at END, CASE WHEN n.segment_action = 'idle' AND n.e1 - n.s0 > 2 AND n."end" - f.at > 2 THEN f.chunk + 1 ELSE f.chunk END
  FROM fold f JOIN num n ON n.video_id = f.video_id AND n.segment = f.segment AND n.i = f.i + 1),
chunks AS (SELECT n.*, f.chunk FROM num n JOIN fold f ON n.video_id = f.video_id AND n.segment = f.segment AND n.i = f.i)"""


@query(f"{_SPLIT_SQL} SELECT video_id, segment, seq, chunk FROM chunks WHERE segment_action = 'idle'")
def idle_split(spark, d):
    idle = segments.merge_labels(v.labels(spark, d)).where("segment_action = 'idle'")
    return segments.split_idle(idle).select("video_id", "segment", "seq", "chunk")


_ORDER = ", ".join(f"'{p}'" for p in segments.PHASES)
_SEG_SQL = f"""{_SPLIT_SQL}, raw AS (SELECT video_id, segment, chunk, min(segment_action) AS action, min(start) AS start_time, arg_max("end", i) AS end_time, avg(confidence) AS confidence_avg, min(confidence) AS confidence_min, count(*) AS frames_analyzed,
  arg_min(hand, i) AS hand_used, arg_min(grasp, i) AS grasp_type, flatten(list(objects ORDER BY i)) AS objs, list_filter(list(phase ORDER BY i), lambda p: p <> '') AS phs, avg(CASE WHEN hand = 'none' THEN 1e0 ELSE 0 END) AS hidden FROM chunks GROUP BY 1, 2, 3),
dis AS (SELECT *, list_filter(objs, lambda o, j: list_position(objs, o) = j) AS objects, list_filter(phs, lambda o, j: list_position(phs, o) = j) AS phases FROM raw),
val AS (SELECT *, list_filter(list_transform(phases, lambda p: coalesce(list_position([{_ORDER}], p), 0)), lambda q: q > 0) AS pos FROM dis),
seg AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY start_time, segment, chunk) AS segment_id, end_time - start_time AS duration,
  CASE WHEN round(confidence_avg, 4) < 0.4e0 THEN 'low_confidence' WHEN pos <> list_sort(pos) THEN 'phase_sequence_broken' WHEN hidden > 0.5e0 THEN 'hand_not_visible' END AS review_reason FROM val)"""


def _segments(spark, d):
    return segments.segments(v.labels(spark, d))


@query(f"""{_SEG_SQL} SELECT video_id, segment_id, action, start_time, end_time, round(confidence_avg, 6) AS confidence_avg, confidence_min, frames_analyzed, hand_used, grasp_type,
array_to_string(objects, '; ') AS objects, array_to_string(phases, ' -> ') AS phases, review_reason FROM seg""")
def segment_enrich(spark, d):
    s = _segments(spark, d)
    return s.select("video_id", "segment_id", "action", "start_time", "end_time", r6("confidence_avg"), "confidence_min", "frames_analyzed", "hand_used", "grasp_type", F.array_join("objects", "; ").alias("objects"), F.array_join("phases", " -> ").alias("phases"), "review_reason")


@query(f"{_SEG_SQL} SELECT s.video_id, s.segment_id, count(*) AS n_frames, round(avg(f.brightness), 6) AS brightness FROM seg s JOIN frames f ON f.video_id = s.video_id AND f.ts BETWEEN s.start_time AND s.end_time GROUP BY 1, 2")
def segment_frames_interval(spark, d):
    s = _segments(spark, d).select("video_id", "segment_id", "start_time", "end_time")
    out = segments.frames_in(s, v.frames(spark, d).select("video_id", "ts", "brightness"))
    return out.groupBy("video_id", "segment_id").agg(F.count("*").alias("n_frames"), F.round(F.avg("brightness"), 6).alias("brightness"))


@query(f"{_SEG_SQL} SELECT s.video_id, s.segment_id, round(0.7e0 * least(1, avg(f.lapvar) / 200) + 0.3e0 * greatest(0, 1 - stddev_pop(f.brightness) / 80), 9) AS frame_quality FROM seg s JOIN frames f ON f.video_id = s.video_id AND f.ts BETWEEN s.start_time AND s.end_time GROUP BY 1, 2")
def quality_frame(spark, d):
    q = scoring.frame_quality(_segments(spark, d), v.frames(spark, d).select("video_id", "ts", "brightness", "lapvar"))
    return q.withColumn("frame_quality", F.round("frame_quality", 9))


@query(f"{_SEG_SQL} SELECT action, count(*) AS n_segments, sum(duration) AS total_duration, round(avg(confidence_avg), 6) AS mean_confidence FROM seg GROUP BY 1")
def action_summary(spark, d):
    return segments.action_summary(_segments(spark, d)).select("action", "n_segments", "total_duration", r6("mean_confidence"))


@query(f"""{_SEG_SQL}, per AS (SELECT video_id, 100 * avg(CASE WHEN hand_used = 'both' THEN 1e0 ELSE 0 END) AS bi, 100 * sum(CASE WHEN action = 'idle' THEN duration ELSE 0 END) / CASE WHEN sum(duration) > 0 THEN sum(duration) ELSE 1 END AS idle FROM seg GROUP BY 1),
h AS (SELECT video_id, hand_used FROM seg WHERE hand_used <> 'none' GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY count(*) DESC, min(segment_id)) = 1),
gr AS (SELECT video_id, grasp_type FROM seg WHERE grasp_type <> 'none' GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY count(*) DESC, min(segment_id)) = 1)
SELECT per.video_id, round(bi, 6) AS bimanual_pct, round(idle, 6) AS idle_pct, hand_used AS dominant_hand, grasp_type AS dominant_grasp FROM per LEFT JOIN h ON h.video_id = per.video_id LEFT JOIN gr ON gr.video_id = per.video_id""")
def manipulation_profile(spark, d):
    return segments.manipulation_profile(_segments(spark, d)).select("video_id", r6("bimanual_pct"), r6("idle_pct"), "dominant_hand", "dominant_grasp")


def _clock(c: str) -> str:
    return f"(lpad(CAST(CAST(floor({c}) AS BIGINT) // 60 AS VARCHAR), CAST(greatest(2, length(CAST(CAST(floor({c}) AS BIGINT) // 60 AS VARCHAR))) AS INT), '0') || ':' || lpad(CAST(CAST(floor({c}) AS BIGINT) % 60 AS VARCHAR), 2, '0'))"


@query(f"""{_SEG_SQL} SELECT video_id, segment_id, '[' || {_clock("start_time")} || ' - ' || {_clock("end_time")} || '] ' || CASE WHEN action = 'transition' THEN '(transition)' WHEN review_reason IS NOT NULL THEN action || ' | REVIEW: ' || review_reason ELSE action || ' | ' || hand_used || ' | ' || array_to_string(objects, ', ') END AS line FROM seg""")
def timeline_lines(spark, d):
    return segments.timeline(_segments(spark, d))


@query(f"""{_SEG_SQL}, todo AS (SELECT * FROM seg WHERE review_reason IS NOT NULL), n AS (SELECT s.video_id, s.segment_id, count(*) AS n_frames, min(frame_path) AS first_frame, max(frame_path) AS last_frame FROM todo s JOIN frames f ON f.video_id = s.video_id AND f.ts BETWEEN s.start_time AND s.end_time GROUP BY 1, 2)
SELECT t.video_id, t.segment_id, action, review_reason, coalesce(n_frames, 0) AS n_frames, first_frame, last_frame, 5 * count(*) OVER (PARTITION BY t.video_id) AS review_minutes FROM todo t LEFT JOIN n ON n.video_id = t.video_id AND n.segment_id = t.segment_id""")
def review_queue(spark, d):
    return segments.review_queue(_segments(spark, d), v.frames(spark, d))


@query(f"""{_SEG_SQL}, st AS (SELECT s.video_id, s.segment_id, f.seq, row_number() OVER (PARTITION BY s.video_id, s.segment_id ORDER BY f.ts, f.seq) - 1 AS step, count(*) OVER (PARTITION BY s.video_id, s.segment_id) AS n FROM seg s JOIN frames f ON f.video_id = s.video_id AND f.ts BETWEEN s.start_time AND s.end_time)
SELECT video_id, segment_id, seq, step, step = 0 AS is_first, step = n - 1 AS is_last FROM st""")
def episode_steps(spark, d):
    s = _segments(spark, d).select("video_id", "segment_id", "start_time", "end_time")
    return segments.steps(s, v.frames(spark, d).select("video_id", "seq", "ts")).select("video_id", "segment_id", "seq", "step", "is_first", "is_last")


# --- training and evaluation ------------------------------------------------

_TRAIN_SQL = f"{_SEG_SQL}, kept AS (SELECT * FROM seg WHERE round(confidence_avg, 4) >= 0.4e0 AND action NOT IN ('idle', 'transition', 'unknown'))"


@query(f"{_TRAIN_SQL} SELECT video_id, segment_id, action, dense_rank() OVER (ORDER BY action) - 1 AS class_id, round(confidence_avg, 6) AS confidence_avg FROM kept")
def train_samples(spark, d):
    return evaluate.training_samples(_segments(spark, d), 0.4).select("video_id", "segment_id", "action", "class_id", r6("confidence_avg"))


@query(f"{_TRAIN_SQL}, n AS (SELECT action, count(*) AS n FROM kept GROUP BY 1), w AS (SELECT *, sum(n) OVER () / CAST(count(*) OVER () * n AS DOUBLE) AS w FROM n) SELECT action, n, round(w / avg(w) OVER (), 6) AS weight FROM w")
def class_weights(spark, d):
    return evaluate.class_weights(evaluate.training_samples(_segments(spark, d), 0.4)).select("action", "n", r6("weight"))


@query()
def train_val_split(spark, d):
    return evaluate.train_val_split(evaluate.training_samples(_segments(spark, d), 0.4).select("video_id", "segment_id", "action"), "video_id", "segment_id")


_CM_SQL = f"""WITH {v.PREDICTIONS_SQL}, cls AS (SELECT true_cls AS c FROM preds UNION SELECT pred_cls FROM preds),
cm AS (SELECT a.c AS true_cls, b.c AS pred_cls, (SELECT count(*) FROM preds p WHERE p.true_cls = a.c AND p.pred_cls = b.c) AS n FROM cls a, cls b)"""


@query(f"{_CM_SQL} SELECT true_cls, pred_cls, n FROM cm")
def confusion_matrix(spark, d):
    return evaluate.confusion_matrix(v.predictions(spark, d))


@query(f"""{_CM_SQL}, m AS (SELECT c AS cls, CAST((SELECT sum(n) FROM cm WHERE true_cls = c) AS BIGINT) AS support, CAST((SELECT sum(n) FROM cm WHERE pred_cls = c) AS BIGINT) AS predicted, (SELECT n FROM cm WHERE true_cls = c AND pred_cls = c) AS hit FROM cls),
pr AS (SELECT cls, support, hit / CAST(greatest(predicted, 1) AS DOUBLE) AS p, hit / CAST(greatest(support, 1) AS DOUBLE) AS r FROM m)
SELECT cls, support, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM pr""")
def class_metrics(spark, d):
    return evaluate.class_metrics(evaluate.confusion_matrix(v.predictions(spark, d))).select("cls", "support", r6("precision"), r6("recall"), r6("f1"))


@query(f"{_CM_SQL}, x AS (SELECT *, n / CAST(greatest(sum(n) OVER (PARTITION BY true_cls), 1) AS DOUBLE) AS rate FROM cm) SELECT true_cls AS class_a, pred_cls AS class_b, round(rate, 6) AS rate FROM x WHERE true_cls <> pred_cls AND rate > 0.1e0")
def confused_pairs(spark, d):
    return evaluate.confused_pairs(evaluate.confusion_matrix(v.predictions(spark, d))).select("class_a", "class_b", r6("rate"))
