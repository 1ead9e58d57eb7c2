"""One nested document a video: its facts, segments, summaries and scores, as a row, built from tables of segments; frames are never gathered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .segments import score_summary

#: The fields of a segment, in order; what a document says of a video that nothing is known of.
SEGMENT = (
    "segment_id", "start_time", "end_time", "duration", "action", "action_description", "task_hierarchy", "objects_involved", "grasp_type", "hand_used",
    "manipulation_phases", "trajectory_summary", "confidence_avg", "confidence_min", "frames_analyzed", "frames_skipped", "labelling_method", "needs_review", "review_reason", "quality_score",
)
VIDEO = {"video_file": "", "video_type": "egocentric", "camera_mount": "helmet", "duration": 0.0, "fps": 0.0, "vlm_backend": ""}
KEY = ["video_id", "segment_id"]


def _in_order(c: str | Column, *by: str) -> Column:
    """Values of a group as an array, in order of by."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*by, F.col(c).alias("_v") if isinstance(c, str) else c.alias("_v")))), lambda x: x["_v"])


def segment_fields(segs: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """(video_id, segment_id, segment): the twenty fields of each segment. Columns that segs lacks have their defaults; scores is (video_id, segment_id, quality_score)."""
    if scores is not None:
        segs = segs.join(scores.select(*KEY, "quality_score"), KEY, "left")
    has = lambda c, default: F.col(c) if c in segs.columns else default
    four = lambda c: F.round(c, 4)
    summary = F.struct(*[F.coalesce(has(c, F.lit(None).cast(t)), F.lit(0).cast(t)).alias(c) for c, t in (("path_length", "double"), ("max_velocity", "double"), ("grasp_events", "long"))])
    none = F.lit(None).cast("string")
    made = {
        "start_time": four("start_time"), "end_time": four("end_time"), "duration": four(F.col("end_time") - F.col("start_time")), "confidence_avg": four("confidence_avg"), "confidence_min": four("confidence_min"),
        "action_description": F.coalesce(has("action_description", none), F.lit("")), "task_hierarchy": has("task_hierarchy", F.struct(*[none.alias(c) for c in ("high_level", "mid_level", "low_level")])),
        "objects_involved": F.col("objects"), "manipulation_phases": F.col("phases"), "trajectory_summary": summary, "frames_skipped": F.coalesce(has("frames_skipped", F.lit(None).cast("long")), F.lit(0).cast("long")),
        "labelling_method": F.coalesce(has("labelling_method", none), F.lit("unknown")), "quality_score": has("quality_score", F.lit(None).cast("double")),
    }
    return segs.select(*KEY, F.struct(*[made.get(c, F.col(c)).alias(c) for c in SEGMENT]).alias("segment"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _met(values: Column) -> Column:
    """The distinct values of an array in the order that they were met, each as (n, place, value): how often it occurs, minus its place."""
    distinct = F.array_distinct(values)
    return F.transform(distinct, lambda v, i: F.struct(F.size(F.filter(values, lambda x: x.eqNullSafe(v))).cast("long").alias("n"), (-i).alias("place"), v.alias("value")))


def action_totals(segs: Column) -> Column:
    """By action of an array of segments: count, total duration and mean confidence; the longest first, equals by their first segment."""
    actions = F.array_distinct(F.transform(segs, lambda s: s["action"]))

    def one(action: Column, place: Column) -> Column:
        own = F.filter(segs, lambda s: s["action"].eqNullSafe(action))
        time, sure = _sum(F.transform(own, lambda s: s["duration"])), _sum(F.transform(own, lambda s: s["confidence_avg"]))
        told = F.struct(action.alias("action"), F.size(own).cast("long").alias("count"), F.round(time, 2).alias("total_duration"), F.round(sure / F.size(own), 4).alias("avg_confidence"))
        return F.struct((-time).alias("by"), place.alias("place"), told.alias("told"))

    return F.transform(F.array_sort(F.transform(actions, one)), lambda x: x["told"])


def profile(segs: Column) -> Column:
    """Of an array of segments: dominant hand and grasp (the commonest but none, of equals the one met first), shares of both hands and of idle time, distributions in the order that they were met, totals. Null of no segments."""

    def of(field: str, default: str) -> tuple[Column, Column]:
        met = _met(F.filter(F.transform(segs, lambda s: s[field]), lambda x: x != "none"))
        return F.coalesce(F.array_max(met)["value"], F.lit(default)), F.map_from_entries(F.transform(met, lambda m: F.struct(m["value"].alias("key"), m["n"].alias("value"))))

    (hand, hands), (grasp, grasps) = of("hand_used", "unknown"), of("grasp_type", "none")
    time = _sum(F.transform(segs, lambda s: s["duration"]))
    total = F.when(time != 0, time).otherwise(1.0)
    idle = _sum(F.transform(F.filter(segs, lambda s: s["action"] == "idle"), lambda s: s["duration"]))
    both = F.size(F.filter(segs, lambda s: s["hand_used"] == "both"))
    parts = [
        hand.alias("dominant_hand"), F.round(100.0 * both / F.size(segs), 1).alias("bimanual_pct"), F.round(100 * idle / total, 1).alias("idle_pct"), grasp.alias("most_used_grasp"),
        grasps.alias("grasp_distribution"), hands.alias("hand_distribution"), F.size(segs).cast("long").alias("total_segments"), F.round(total, 2).alias("total_duration"),
    ]
    return F.when(F.size(segs) > 0, F.struct(*parts))


def documents(videos: DataFrame, segs: DataFrame, scores: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """(video_id, document): JSON of one document a video, with video facts, processing stats, segments in order, summaries and the scores' aggregate.

    videos is (video_id, and of VIDEO what is known); a video without segments has empty lists. segs is what
    segments.enrich gives, stats (video_id, ...) whatever the processing tells. Only a video's segments, never its
    frames, come together in a row, once; summaries are made of them there. Null fields are written as null.
    """
    if "quality_score" in segs.columns:
        raise ValueError("scores are given apart")
    one = segment_fields(segs, scores).groupBy("video_id").agg(_in_order("segment", "segment_id").alias("segments"))
    rows = videos.join(one, "video_id", "left")
    if scores is not None:
        total = score_summary(scores, "quality_score")
        rows = rows.join(total.select("video_id", F.struct(*[c for c in total.columns if c != "video_id"]).alias("quality_aggregate")), "video_id", "left")
    if stats is not None:
        rows = rows.join(stats.select("video_id", F.struct(*[c for c in stats.columns if c != "video_id"]).alias("processing_stats")), "video_id", "left")
    known = [F.coalesce(F.col(c) if c in videos.columns else F.lit(None), F.lit(d)).alias(c) for c, d in VIDEO.items()]
    own = F.coalesce("segments", F.array()).alias("segments")
    about = [action_totals(F.col("segments")).alias("action_summary"), profile(F.col("segments")).alias("manipulation_profile")]
    rows = rows.select(*[c for c in rows.columns if c != "segments"], own)
    parts = [*known, *(["processing_stats"] if stats is not None else []), "segments", *about, *(["quality_aggregate"] if scores is not None else [])]
    return rows.select("video_id", F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}).alias("document"))
