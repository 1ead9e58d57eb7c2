"""Quality scores of segments: how complete the hand's pose is, objects, track, label, frames and depth, and their weighted sum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .segments import frames_in, phases_valid

#: The weights of the parts, what a full hand has, and the least score that is kept.
WEIGHTS = {"pose": 0.25, "objects_seen": 0.20, "smoothness": 0.20, "clarity": 0.15, "frame_quality": 0.10, "depth_steady": 0.10}
HAND_POINTS, SHARP, BRIGHT_SPREAD, DEPTH_JUMP, DISCARD = 21, 200.0, 80.0, 0.5, 0.2
KEY = ["video_id", "segment_id"]


def _visible() -> Column:
    """How sure the objects in a frame are, less where expected ones are missing."""
    names = F.transform("found", lambda o: o["class_name"])
    mean = F.aggregate("found", F.lit(0.0), lambda a, o: a + o["confidence"]) / F.size("found")
    share = F.when(F.size("objects") > 0, 0.5 + 0.5 * F.size(F.filter("objects", lambda e: F.array_contains(names, e))) / F.size("objects")).otherwise(1.0)
    return F.when(F.size("found") > 0, F.least(F.lit(1.0), mean * share)).otherwise(0.0)


def _of_seen(seen: Column) -> list[Column]:
    """Aggregates of a segment's rows that tell what was seen."""
    return [
        F.avg(F.when(seen, F.least(F.lit(1.0), F.col("n_points") / float(HAND_POINTS)))).alias("pose"),
        F.avg(F.when(seen, _visible())).alias("objects_seen"),
        (1 - F.count_if(F.col("_step") > DEPTH_JUMP) / F.nullif(F.count("_step"), F.lit(0))).alias("depth_steady"),
    ]


def _with_step(at: DataFrame) -> DataFrame:
    """at with _step: how far depth is from the one known before, in a segment."""
    before = Window.partitionBy(*KEY).orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return at.withColumn("_step", F.abs(F.col("depth") - F.last("depth", ignorenulls=True).over(before)))


def _of_frames() -> Column:
    """Sharpness, and how even the brightness is."""
    return (0.7 * F.least(F.lit(1.0), F.avg("lapvar") / SHARP) + 0.3 * F.greatest(F.lit(0.0), 1 - F.stddev_pop("brightness") / BRIGHT_SPREAD)).alias("frame_quality")


def pose_and_objects(segs: DataFrame, seen: DataFrame) -> DataFrame:
    """segs (..., objects) with pose, objects_seen and depth_steady from what was seen in their frames.

    seen: (video_id, ts, seq, n_points of the best hand, found: array of (class_name, confidence), depth). A frame without
    objects counts 0; expected objects that aren't found halve its confidence at most. Segments without frames have no
    pose and no objects; depth is half sure with fewer than two values.
    """
    at = frames_in(segs.select(*KEY, "start_time", "end_time", "objects"), seen)
    per = _with_step(at).groupBy(*KEY).agg(*_of_seen(F.lit(True)))
    return segs.join(per, KEY, "left").fillna({"pose": 0.0, "objects_seen": 0.0, "depth_steady": 0.5})


def frame_quality(segs: DataFrame, frames: DataFrame) -> DataFrame:
    """(video_id, segment_id, frame_quality) of frames (video_id, ts, brightness, lapvar): sharpness, and how even the brightness is. Segments without readable frames are missing: they count a half."""
    at = frames_in(segs.select(*KEY, "start_time", "end_time"), frames.where("lapvar is not null and brightness is not null"))
    return at.groupBy(*KEY).agg(_of_frames())


def parts(segs: DataFrame, seen: DataFrame, frames: DataFrame) -> DataFrame:
    """segs with what pose_and_objects() and frame_quality() give, a half where a segment has no readable frames: what was seen and the frames go as one table through one join by time and one aggregate."""
    what = seen.select("video_id", "ts", "seq", "n_points", "found", "depth", F.lit(None).cast("double").alias("brightness"), F.lit(None).cast("double").alias("lapvar"), F.lit(True).alias("_seen"))
    kinds = {f.name: f.dataType for f in what.schema}
    none = {c: F.lit(None).cast(kinds[c]) for c in ("n_points", "found", "depth", "seq")} | {"_seen": F.lit(False)}
    bare = frames.where("lapvar is not null and brightness is not null").select("video_id", "ts", F.col("brightness").cast("double").alias("brightness"), F.col("lapvar").cast("double").alias("lapvar")).withColumns(none)
    at = frames_in(segs.select(*KEY, "start_time", "end_time", "objects"), what.unionByName(bare))
    per = _with_step(at).groupBy(*KEY).agg(*_of_seen(F.col("_seen")), _of_frames())
    return segs.join(per, KEY, "left").fillna({"pose": 0.0, "objects_seen": 0.0, "depth_steady": 0.5, "frame_quality": 0.5})


def track_of_segment(segs: DataFrame, smooth: DataFrame) -> DataFrame:
    """segs (..., hand_used) with the smoothness of their hand's track: both hands take the right one's, else the left's; a half where there is none."""
    side = lambda h: F.max(F.when(F.col("handedness") == h, F.col("smoothness"))).alias(f"_{h}")
    both = segs.join(smooth.groupBy("video_id").agg(side("left"), side("right")), "video_id", "left")
    pick = F.when(F.col("hand_used") == "left", F.col("_left")).when(F.col("hand_used") == "right", F.col("_right")).when(F.col("hand_used") == "both", F.coalesce("_right", "_left"))
    return both.withColumn("smoothness", F.coalesce(pick, F.lit(0.5))).drop("_left", "_right")


def clarity(segs: DataFrame) -> DataFrame:
    """segs with clarity: the label's confidence, a tenth more where its phases are in order."""
    return segs.withColumn("clarity", F.when(phases_valid(F.col("phases")), F.least(F.lit(1.0), F.col("confidence_avg") + 0.1)).otherwise(F.col("confidence_avg")))


def composite(scored: DataFrame) -> DataFrame:
    """scored (the parts of WEIGHTS) with composite, the weighted sum to nine digits and then to four, so that the order of a sum doesn't decide, and may_discard."""
    total = sum((w * F.col(c) for c, w in WEIGHTS.items()), F.lit(0.0))
    out = scored.withColumn("composite", F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.round(total, 9))), 4))
    return out.withColumn("may_discard", F.col("composite") < DISCARD)
