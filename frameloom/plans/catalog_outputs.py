"""Queries over what a run hands on: documents, training clips, classified vectors, isolated stages and progress, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from frameloom.functions import rasters
from frameloom.operators import classify, clips, documents, segments, stages
from frameloom.sources import media, sinks
from frameloom.sources import views as v

from . import catalog as c
from .catalog import query

# --- documents ----------------------------------------------------------------

_READ = """video_file string, video_type string, fps double, processing_stats struct<total_frames:bigint>, segments array<struct<segment_id:bigint,start_time:double,end_time:double,duration:double,action:string,action_description:string,task_hierarchy:struct<low_level:string>,
objects_involved:array<string>,grasp_type:string,hand_used:string,manipulation_phases:array<string>,trajectory_summary:struct<grasp_events:bigint>,confidence_min:double,frames_analyzed:bigint,frames_skipped:bigint,labelling_method:string,needs_review:boolean,review_reason:string,quality_score:double>>,
action_summary array<struct<action:string,count:bigint,total_duration:double>>, manipulation_profile struct<dominant_hand:string,bimanual_pct:double,idle_pct:double,most_used_grasp:string,grasp_distribution:map<string,bigint>,hand_distribution:map<string,bigint>,total_segments:bigint,total_duration:double>,
quality_aggregate struct<min:double,max:double,n:bigint>"""


@query(f"""{c._SEG_SQL}, f0 AS (SELECT video_id, segment, chunk, arg_min(seq, i) AS seq FROM chunks GROUP BY ALL),
sg AS (SELECT s.*, l.action AS label, l.objects[1] AS object, l.phase AS low FROM seg s JOIN f0 USING (video_id, segment, chunk) JOIN labels_v l ON l.video_id = s.video_id AND l.seq = f0.seq),
st AS (SELECT video_id, count(*) AS n_segments, string_agg(printf('%d %.4f %.4f %.4f %s "Do %s with %s" %s %s %s %s %s %d %.2f %s %s %s', segment_id, start_time, end_time, duration, action, label, object, low, array_to_string(objects, '+'), grasp_type, hand_used, array_to_string(phases, '+'),
  frames_analyzed, confidence_min, CASE WHEN label = 'idle' THEN 'rule' ELSE 'vlm' END, coalesce(review_reason, '-'), CASE WHEN segment_id % 5 = 0 THEN '-' ELSE printf('%.2f', confidence_min) END), '; ' ORDER BY segment_id) AS segments FROM sg GROUP BY 1),
ac AS (SELECT video_id, string_agg(printf('%s %d %.2f', action, n, d), '; ' ORDER BY d DESC, first) AS actions FROM (SELECT video_id, action, count(*) AS n, sum(duration) AS d, min(segment_id) AS first FROM seg GROUP BY ALL) GROUP BY 1),
hn AS (SELECT video_id, string_agg(hand_used || '=' || n, ' ' ORDER BY first) AS hands, arg_max(hand_used, (n, -first)) AS hand FROM (SELECT video_id, hand_used, count(*) AS n, min(segment_id) AS first FROM seg WHERE hand_used <> 'none' GROUP BY ALL) GROUP BY 1),
gn AS (SELECT video_id, string_agg(grasp_type || '=' || n, ' ' ORDER BY first) AS grasps, arg_max(grasp_type, (n, -first)) AS grasp FROM (SELECT video_id, grasp_type, count(*) AS n, min(segment_id) AS first FROM seg WHERE grasp_type <> 'none' GROUP BY ALL) GROUP BY 1),
pr AS (SELECT video_id, round(100 * count(*) FILTER (hand_used = 'both') / count(*), 1) AS bimanual_pct, round(100 * coalesce(sum(duration) FILTER (action = 'idle'), 0) / CASE WHEN sum(duration) > 0 THEN sum(duration) ELSE 1 END, 1) AS idle_pct, round(CASE WHEN sum(duration) > 0 THEN sum(duration) ELSE 1 END, 2) AS total_duration,
  min(confidence_min) FILTER (segment_id % 5 <> 0) AS lowest, max(confidence_min) FILTER (segment_id % 5 <> 0) AS highest, count(*) FILTER (segment_id % 5 <> 0) AS scored FROM seg GROUP BY 1),
vd AS (SELECT video_id, count(*) AS total_frames FROM frames GROUP BY 1)
SELECT video_id, 'video_' || video_id || '.mp4' AS video_file, 'egocentric' AS video_type, 2e0 AS fps, total_frames, coalesce(n_segments, 0) AS n_segments, coalesce(segments, '') AS segments, coalesce(actions, '') AS actions, coalesce(hand, 'unknown') AS dominant_hand, coalesce(grasp, 'none') AS most_used_grasp,
  coalesce(hands, '') AS hands, coalesce(grasps, '') AS grasps, bimanual_pct, idle_pct, total_duration, lowest, highest, scored FROM vd LEFT JOIN st USING (video_id) LEFT JOIN ac USING (video_id) LEFT JOIN hn USING (video_id) LEFT JOIN gn USING (video_id) LEFT JOIN pr USING (video_id)""")
def video_documents(spark, d):
    """Each video's document, read back from its JSON."""
    segs = segments.segments(v.described_labels(spark, d))
    scores = segs.where("segment_id % 5 <> 0").select("video_id", "segment_id", F.col("confidence_min").alias("quality_score"))
    stats = v.frames(spark, d).groupBy("video_id").agg(F.count("*").alias("total_frames"))
    videos = stats.select("video_id", F.concat(F.lit("video_"), F.col("video_id").cast("string"), F.lit(".mp4")).alias("video_file"), F.lit(2.0).alias("fps"))
    made = documents.documents(videos, segs, scores, stats).select("video_id", F.from_json("document", _READ).alias("d")).select("video_id", "d.*")
    lined = lambda s: F.format_string('%d %.4f %.4f %.4f %s "%s" %s %s %s %s %s %d %.2f %s %s %s', s["segment_id"], s["start_time"], s["end_time"], s["duration"], s["action"], s["action_description"], s["task_hierarchy"]["low_level"], F.array_join(s["objects_involved"], "+"), s["grasp_type"], s["hand_used"], F.array_join(s["manipulation_phases"], "+"), s["frames_analyzed"], s["confidence_min"], s["labelling_method"], F.coalesce(s["review_reason"], F.lit("-")), F.when(s["quality_score"].isNull(), "-").otherwise(F.format_string("%.2f", s["quality_score"])))
    p = lambda x: F.col(f"manipulation_profile.{x}")
    pairs = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), " ")
    actions = F.array_join(F.transform("action_summary", lambda a: F.format_string("%s %d %.2f", a["action"], a["count"], a["total_duration"])), "; ")
    return made.select(
        "video_id", "video_file", "video_type", "fps", F.col("processing_stats.total_frames").alias("total_frames"), F.size("segments").cast("long").alias("n_segments"), F.array_join(F.transform("segments", lined), "; ").alias("segments"), actions.alias("actions"),
        p("dominant_hand").alias("dominant_hand"), p("most_used_grasp").alias("most_used_grasp"), pairs(p("hand_distribution")).alias("hands"), pairs(p("grasp_distribution")).alias("grasps"), p("bimanual_pct").alias("bimanual_pct"), p("idle_pct").alias("idle_pct"), p("total_duration").alias("total_duration"),
        F.col("quality_aggregate.min").alias("lowest"), F.col("quality_aggregate.max").alias("highest"), F.col("quality_aggregate.n").alias("scored"),
    )


_TWO = lambda x: f"printf('%.2f', round({x}, 4) + 1e-9)"


@query(f"""{c._SEG_SQL}, f0 AS (SELECT video_id, segment, chunk, arg_min(seq, i) AS seq FROM chunks GROUP BY ALL), sg AS (SELECT s.*, 'Do ' || l.action || ' with ' || l.objects[1] AS told FROM seg s JOIN f0 USING (video_id, segment, chunk) JOIN labels_v l ON l.video_id = s.video_id AND l.seq = f0.seq)
SELECT video_id, segment_id AS place, {c._clock("start_time")} || ' - ' || {c._clock("end_time")} || '  ' || CASE WHEN action = 'transition' THEN '[---]  TRANSITION -- Head movement / walking' WHEN review_reason IS NOT NULL THEN '[' || {_TWO("confidence_avg")} || '] ' || action || ' -- NEEDS REVIEW (' || review_reason || ')'
  ELSE '[' || {_TWO("confidence_avg")} || '] ' || action || ' -- ' || told || ' (' || hand_used || CASE WHEN len(phases) > 0 THEN ', ' || array_to_string(phases, ' -> ') ELSE '' END || ')' END AS line FROM sg
UNION ALL SELECT video_id, unnest([-3, -2, -1, n + 1, n + 2]), unnest(['Annotation Timeline', repeat('=', 80), '', '', repeat('=', 80)]) FROM (SELECT video_id, max(segment_id) AS n FROM seg GROUP BY 1)""")
def timeline_text(spark, d):
    return segments.timeline_text(segments.segments(v.described_labels(spark, d)))


@query(f"""{c._SEG_SQL}, todo AS (SELECT * FROM seg WHERE review_reason IS NOT NULL), n AS (SELECT s.video_id, s.segment_id, string_agg(frame_path, ',' ORDER BY ts) AS paths FROM todo s JOIN frames f ON f.video_id = s.video_id AND f.ts BETWEEN s.start_time AND s.end_time GROUP BY 1, 2)
SELECT t.video_id, t.segment_id, start_time, end_time, review_reason AS reason, action AS suggested_action, coalesce(paths, '') AS frame_paths FROM todo t LEFT JOIN n USING (video_id, segment_id)""")
def review_clips(spark, d):
    """The review queue with the paths of each clip's frames, in order."""
    todo = c._segments(spark, d).where("needs_review").select("video_id", "segment_id", "action", "review_reason", "start_time", "end_time")
    made = sinks.review_documents(todo, v.frames(spark, d))
    return made.select("video_id", "segment_id", "start_time", "end_time", F.col("review_reason").alias("reason"), F.col("action").alias("suggested_action"), F.array_join("frame_paths", ",").alias("frame_paths"))


@query("""SELECT event_id, CASE WHEN k % 30 > 0 THEN round(k * 10 / (k % 30), 6) ELSE 0 END AS duration, (640 + k) || 'x480' AS resolution, chr(CAST(97 + k % 26 AS INT)) || 'vc1' AS codec FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""")
def counted_metadata(spark, d):
    """Facts of videos that can't be probed, from their counts of frames."""
    k = F.get_json_object("props", "$.k").cast("long")
    rows = v.table(spark, d, "events").select("event_id", (k * 10).alias("frame_count"), (k % 30).cast("double").alias("fps"), (k + 640).alias("width"), F.lit(480).alias("height"), (97 + k % 26 + 256 * ord("v") + 65536 * ord("c") + 16777216 * ord("1")).cast("int").alias("code"))
    return media.counted_metadata(rows).select("event_id", F.round("duration", 6).alias("duration"), "resolution", "codec")


# --- training clips -------------------------------------------------------------

_U = lambda *parts: "(CAST('0x' || substr(sha256('7/=' || " + " || '/=' || ".join(f"CAST({p} AS VARCHAR)" for p in parts) + "), 1, 12) AS BIGINT) / 281474976710656e0)"


@query(f"""{c._SEG_SQL}, cl AS (SELECT video_id, segment_id, CAST(floor(start_time * 30) AS BIGINT) AS s, CAST(floor(end_time * 30) AS BIGINT) AS e FROM seg),
ix AS (SELECT video_id, segment_id, i, CASE WHEN e - s >= 16 THEN CAST(floor(s + i * (e - 1 - s) / 15e0) AS BIGINT) ELSE least(s + i, e - 1) END AS f FROM cl, (SELECT unnest(range(16)) AS i) WHERE e > s)
SELECT video_id, segment_id, i AS place, greatest(least(f + CAST(floor({_U("video_id", "segment_id", "i")} * 5) AS BIGINT) - 2, 899), 0) AS frame FROM ix""")
def jittered_clips(spark, d):
    cut = segments.clip_frames(c._segments(spark, d).select("video_id", "segment_id", "start_time", "end_time"))
    moved = clips.jitter(cut, ["video_id", "segment_id"], most=2, total=900, seed=7)
    return moved.select("video_id", "segment_id", F.posexplode("frame_indices").alias("place", "frame")).withColumn("place", F.col("place").cast("long"))


_D = lambda name: f"{_U('video_id', 'segment_id', chr(39) + name + chr(39))}"


@query(f"""{c._SEG_SQL}, dr AS (SELECT video_id, segment_id, hand_used, {_D("do rotate")} < 0.5e0 AS rotate, {_D("do crop")} < 0.5e0 AS crop, {_D("flip")} < 0.5e0 AS flip, {_D("blur")} < 0.2e0 AS blur, 0.8e0 + 0.2e0 * {_D("scale")} AS scale FROM seg)
SELECT video_id, segment_id, CASE WHEN rotate THEN round(-15 + 30 * {_D("angle")}, 6) ELSE 0 END AS angle, CASE WHEN crop THEN CAST(floor(640 * scale) AS INT) ELSE 640 END AS crop_width, CASE WHEN crop THEN CAST(floor(480 * scale) AS INT) ELSE 480 END AS crop_height, flip,
  CASE WHEN blur THEN 3 + 2 * CAST(floor({_D("kernel")} * 3) AS INT) ELSE 0 END AS kernel, CASE WHEN flip AND hand_used = 'left' THEN 'right' WHEN flip AND hand_used = 'right' THEN 'left' ELSE hand_used END AS hand_used FROM dr""")
def clip_parameters(spark, d):
    made = clips.parameters(c._segments(spark, d).select("video_id", "segment_id", "hand_used"), ["video_id", "segment_id"], v.WIDTH, v.HEIGHT, seed=7)
    a = lambda x: F.col(f"augment.{x}")
    return made.select("video_id", "segment_id", F.round(a("angle"), 6).alias("angle"), a("crop_width").alias("crop_width"), a("crop_height").alias("crop_height"), a("flip").alias("flip"), a("kernel").alias("kernel"), clips.mirrored(F.col("hand_used"), a("flip")).alias("hand_used"))


# --- classified vectors ---------------------------------------------------------

_CLS = """WITH x AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), m AS (SELECT label AS cls, i, avg(CAST(x AS DOUBLE)) AS m FROM x WHERE label % 2 = 0 GROUP BY 1, 2),
lg AS (SELECT vec_id, label, cls, sum(CAST(x.x AS DOUBLE) * m) - (SELECT sum(n.m * n.m) / 2 FROM m n WHERE n.cls = y.cls) AS logit FROM x JOIN m y USING (i) GROUP BY vec_id, label, cls),
pb AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY vec_id)) AS e FROM lg), pr AS (SELECT *, e / sum(e) OVER (PARTITION BY vec_id) AS p, row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, cls) AS r FROM pb),
cl AS (SELECT vec_id, any_value(label) AS label, max(CASE WHEN r = 1 THEN cls END) AS class_id, max(CASE WHEN r = 1 THEN p END) AS confidence, string_agg(cls, ',' ORDER BY r) FILTER (r <= 5) AS best, -ln(max(CASE WHEN cls = label THEN p END)) AS loss FROM pr GROUP BY 1)"""


def _classified(spark, d):
    rows = v.table(spark, d, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    return classify.classified(rows, classify.nearest_mean(rows.where("label % 2 = 0"), "label", "vector", 64), "vector", "label")


@query(f"{_CLS} SELECT vec_id, CAST(class_id AS BIGINT) AS class_id, round(confidence, 6) AS confidence, best, round(loss, 6) AS loss FROM cl")
def classify_vectors(spark, d):
    return _classified(spark, d).select("vec_id", "class_id", c.r6("confidence"), F.array_join("best", ",").alias("best"), c.r6("loss"))


@query(f"{_CLS} SELECT vec_id // 100 AS epoch, count(*) AS n, round(avg(loss), 4) AS loss, round(avg(CASE WHEN class_id = label THEN 1e0 ELSE 0 END), 4) AS accuracy FROM cl WHERE loss IS NOT NULL GROUP BY 1")
def epoch_measures(spark, d):
    return classify.epoch(_classified(spark, d).withColumn("epoch", F.floor(F.col("vec_id") / 100)), ["epoch"], "label")


@query(f"{c.F_SQL} SELECT video_id, count(*) AS n_frames, round(sum(k * 7) / 1000, 1) AS total_s, round(avg(k * 7), 1) AS avg_ms FROM frames GROUP BY 1")
def frame_timing(spark, d):
    return classify.processing_time(v.frames(spark, d).withColumn("processing_time_ms", F.col("k") * 7.0), ["video_id"])


# --- stages and progress ----------------------------------------------------------


def _vision() -> list[stages.Stage]:
    """Stages of which some fail: rasters that can't be read, rasters without sharpness."""

    def raster(data):
        if (r := rasters.of_bytes(data, v.SIDE, v.SIDE)) is None:
            raise ValueError("cannot read the raster")
        return r

    return [
        stages.Stage("light", ("raster",), "double", lambda data: [float(raster(x).mean()) for x in data]),
        stages.Stage("sharpness", ("raster",), "double", lambda data: [rasters.laplacian_variance(raster(x)) for x in data], needs=("raster",)),
        stages.Stage("ratio", ("light", "sharpness"), "double", lambda a, b: [x / y if y >= 50 else 1 // 0 for x, y in zip(a, b, strict=True)], needs=("light", "sharpness")),
    ]


_STAGES = f"""{c.H_SQL}, {v.RASTERS_SQL}, four AS (SELECT g.video_id, g.seq, sum(CASE WHEN (o.r, o.c) IN ((abs(g.r - 1), g.c), (7 - abs(7 - (g.r + 1)), g.c), (g.r, abs(g.c - 1)), (g.r, 7 - abs(7 - (g.c + 1)))) THEN CASE WHEN o.r <> g.r AND g.r IN (0, 7) OR o.c <> g.c AND g.c IN (0, 7) THEN 2 ELSE 1 END * o.v ELSE 0 END) - 4 * any_value(g.v) AS lap, any_value(g.v) AS v
  FROM grey g JOIN grey o ON o.video_id = g.video_id AND o.seq = g.seq GROUP BY g.video_id, g.seq, g.r, g.c), ms AS (SELECT video_id, seq, avg(v) AS light, var_pop(lap) AS sharpness FROM four GROUP BY 1, 2),
al AS (SELECT f.video_id, f.seq, light, sharpness FROM rep f LEFT JOIN ms USING (video_id, seq))"""


@query(f"{_STAGES} SELECT video_id, seq, round(light, 6) AS light, round(sharpness, 6) AS sharpness, CASE WHEN sharpness >= 50 THEN round(light / sharpness, 6) END AS ratio, CASE WHEN light IS NULL THEN 'light' WHEN sharpness < 50 THEN 'ratio' ELSE '' END AS failed FROM al")
def isolated_stages(spark, d):
    done = stages.run(v.raster_frames(spark, d).select("video_id", "seq", "raster"), _vision())
    return done.select("video_id", "seq", *[c.r6(x) for x in ("light", "sharpness", "ratio")], F.array_join(F.transform("errors", lambda e: e["stage"]), ",").alias("failed"))


@query(f"""{_STAGES} SELECT 'light' AS stage, count(light) AS n_ok, count(*) FILTER (light IS NULL) AS n_failed, 0 AS n_passed_over FROM al UNION ALL SELECT 'sharpness', count(light), 0, count(*) FILTER (light IS NULL) FROM al
UNION ALL SELECT 'ratio', count(*) FILTER (sharpness >= 50), count(*) FILTER (sharpness < 50), count(*) FILTER (light IS NULL) FROM al""")
def stage_counts(spark, d):
    work = _vision()
    return stages.counts(stages.run(v.raster_frames(spark, d).select("video_id", "seq", "raster"), work), work)


@query(f"""{c.F_SQL}, dn AS (SELECT video_id, CAST(round(ts * 1000) AS BIGINT) AS ms FROM frames WHERE k % 3 = 0 UNION SELECT video_id, CAST(round(ts * 1000) AS BIGINT) FROM frames WHERE k % 5 = 0)
SELECT f.video_id, count(*) AS n_frames, count(dn.ms) AS n_done, coalesce(string_agg(dn.ms, ',' ORDER BY dn.ms), '') AS done_ms FROM frames f LEFT JOIN dn ON dn.video_id = f.video_id AND dn.ms = CAST(round(f.ts * 1000) AS BIGINT) GROUP BY 1""")
def processed_union(spark, d):
    """The union of two sets of processed frames by milliseconds, in order, beside each video's frames."""
    f = v.frames(spark, d).select("video_id", F.round(F.col("ts") * 1000).cast("long").alias("ms"), "k")
    done = f.where("k % 3 = 0").select("video_id", "ms").union(f.where("k % 5 = 0").select("video_id", "ms")).distinct()
    sets = done.groupBy("video_id").agg(F.count("*").alias("n_done"), F.array_join(F.transform(F.array_sort(F.collect_list("ms")), lambda x: x.cast("string")), ",").alias("done_ms"))
    return f.groupBy("video_id").agg(F.count("*").alias("n_frames")).join(sets, "video_id", "left").fillna({"n_done": 0, "done_ms": ""})
