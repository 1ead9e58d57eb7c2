"""Labels to segments: islands, absorption, idle splitting, transitions, enrichment, and the joins and sums around them.

Every operator keeps video_id as its first partition key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.geometry import dist
from frameloom.operators.folds import fold_in_order

#: The order of phases.
PHASES = ("reach", "grasp", "manipulate", "hold", "release", "retract")
MIN_SEGMENT, IDLE_SPLIT, LOW_CONFIDENCE = 0.5, 2.0, 0.4
#: What a label may say of itself beside its action; a segment has it from its first label.
DESCRIBED = ("action_description", "task_hierarchy", "labelling_method")


def _ordered() -> Window:
    return Window.partitionBy("video_id").orderBy("start", "seq")


def group_labels(labels: DataFrame) -> DataFrame:
    """labels with group_id: runs of equal action in order of start."""
    w = _ordered()
    new = F.when(F.col("action").eqNullSafe(F.lag("action").over(w)), 0).otherwise(1)
    return labels.withColumn("_new", new).withColumn("group_id", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_new")


def groups_of(grouped: DataFrame) -> DataFrame:
    """(video_id, group_id, action, start, end, kind): one row per run; its end is its last label's."""
    return grouped.groupBy("video_id", "group_id").agg(F.first("action").alias("action"), F.min("start").alias("start"), F.max_by("end", F.struct("start", "seq")).alias("end")).withColumn("kind", F.lit(0))


def insert_transitions(groups: DataFrame, ranges: DataFrame) -> DataFrame:
    """groups and transition ranges (video_id, start, end) by start; on a tie the group is first. place counts them."""
    more = ranges.select("video_id", F.lit(None).cast("long").alias("group_id"), F.lit("transition").alias("action"), "start", "end", F.lit(1).alias("kind"))
    both = groups.unionByName(more)
    return both.withColumn("place", F.row_number().over(Window.partitionBy("video_id").orderBy("start", "kind", "group_id")).cast("long"))


def absorb_short(placed: DataFrame, least: float = MIN_SEGMENT) -> DataFrame:
    """placed with merged_id: a run shorter than least joins the one before it; the first stays. Whether a run is absorbed depends on its own length alone, so a running count is exact."""
    w = Window.partitionBy("video_id").orderBy("place")
    starts = F.when((F.row_number().over(w) == 1) | (F.col("end") - F.col("start") >= least), 1).otherwise(0)
    return placed.withColumn("_s", starts).withColumn("merged_id", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_s")


def merge_labels(labels: DataFrame, ranges: DataFrame | None = None, least: float = MIN_SEGMENT) -> DataFrame:
    """labels with segment (the merged run) and segment_action, that of the run which absorbed the others."""
    grouped = group_labels(labels)
    groups = groups_of(grouped)
    placed = insert_transitions(groups, ranges) if ranges is not None else groups.withColumn("place", F.col("group_id"))
    merged = absorb_short(placed, least)
    named = merged.withColumn("segment_action", F.first("action").over(Window.partitionBy("video_id", "merged_id").orderBy("place")))
    return grouped.join(named.where("kind = 0").select("video_id", "group_id", F.col("merged_id").alias("segment"), "segment_action"), ["video_id", "group_id"])


def split_idle(labels: DataFrame, threshold: float = IDLE_SPLIT) -> DataFrame:
    """labels (video_id, segment, start, end, seq) with chunk: a chunk ends before the label that would make it longer than threshold.

    Each chunk starts where the one before ended, so this is a fold over the labels of a run in order; a run that is no
    longer than threshold stays whole. One shuffle: the fold takes the window's partitions and order.
    """
    key = ["video_id", "segment"]
    w = Window.partitionBy(*key).orderBy("start", "seq")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = labels.withColumn("_long", F.last("end").over(whole) - F.first("start").over(whole) > threshold)

    def step(state: tuple, start: float, end: float, long: bool) -> tuple:
        at, chunk = state
        if at is None:
            at = start
        elif long and end - at > threshold:
            at, chunk = start, chunk + 1
        return (at, chunk), chunk

    return fold_in_order(rows, key, ["start", "seq"], ["start", "end", "_long"], (None, 0), step, "chunk", "long").drop("_long")


def phases_valid(phases: Column) -> Column:
    """Whether known phases never go backward; unknown ones are passed over."""
    at = F.filter(F.transform(phases, lambda p: F.array_position(F.array(*map(F.lit, PHASES)), p)), lambda i: i > 0)
    return at == F.array_sort(at)


def enrich(chunks: DataFrame) -> DataFrame:
    """One row per (video_id, segment, chunk) of labels: times, confidences, first values (of a description, a hierarchy and a method too, if labels have them), ordered distinct objects and phases, review flags and a running id."""
    o = F.struct("start", "seq")
    first = lambda c: F.min_by(c, o)
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("start", "seq", c))), lambda x: x[c])
    seg = chunks.groupBy("video_id", "segment", "chunk").agg(
        first("segment_action").alias("action"), F.min("start").alias("start_time"), F.max_by("end", o).alias("end_time"),
        F.avg("confidence").alias("confidence_avg"), F.min("confidence").alias("confidence_min"), F.count("*").alias("frames_analyzed"),
        first("hand").alias("hand_used"), first("grasp").alias("grasp_type"), *[first(c).alias(c) for c in DESCRIBED if c in chunks.columns],
        F.array_distinct(F.flatten(in_order("objects"))).alias("objects"),
        F.array_distinct(F.filter(in_order("phase"), lambda p: p != "")).alias("phases"),
        F.avg(F.when(F.col("hand") == "none", 1.0).otherwise(0.0)).alias("_hidden"),
    )
    reason = F.when(F.round("confidence_avg", 4) < LOW_CONFIDENCE, "low_confidence").when(~phases_valid(F.col("phases")), "phase_sequence_broken").when(F.col("_hidden") > 0.5, "hand_not_visible")
    w = Window.partitionBy("video_id").orderBy("start_time", "segment", "chunk")
    return seg.withColumn("segment_id", F.row_number().over(w).cast("long")).withColumn("duration", F.col("end_time") - F.col("start_time")).withColumn("review_reason", reason).withColumn("needs_review", F.col("review_reason").isNotNull()).drop("_hidden")


def segments(labels: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Labels all the way to segments; idle runs are split."""
    merged = merge_labels(labels, ranges)
    is_idle = F.col("segment_action").eqNullSafe("idle")
    idle = split_idle(merged.where(is_idle))
    rest = merged.where(~is_idle).withColumn("chunk", F.lit(0).cast("long"))
    return enrich(idle.unionByName(rest))


def frames_in(segs: DataFrame, frames: DataFrame, width: float = 60.0) -> DataFrame:
    """Interval join, closed at both ends: frames (video_id, ts, ...) of each segment. Both sides meet in time buckets, so one long video is many join keys and no frame meets segments of another time."""
    bucket = lambda c: F.floor(c / width).cast("long")
    s = segs.withColumn("_b", F.explode(F.sequence(bucket(F.col("start_time")), bucket(F.col("end_time")))))
    f = frames.withColumn("_b", bucket(F.col("ts")))
    return s.join(f, ["video_id", "_b"]).where((F.col("ts") >= F.col("start_time")) & (F.col("ts") <= F.col("end_time"))).drop("_b")


def action_summary(segs: DataFrame) -> DataFrame:
    out = segs.groupBy("action").agg(F.count("*").alias("n_segments"), F.sum("duration").alias("total_duration"), F.avg("confidence_avg").alias("mean_confidence"))
    return out.orderBy(F.desc("total_duration"), "action")


def most_common(segs: DataFrame, value: str, other_than: str) -> DataFrame:
    """(video_id, value): the commonest, of equals the one met first."""
    n = segs.where(F.col(value) != other_than).groupBy("video_id", value).agg(F.count("*").alias("_n"), F.min("segment_id").alias("_first"))
    return n.groupBy("video_id").agg(F.max_by(value, F.struct("_n", -F.col("_first"))).alias(value))


def manipulation_profile(segs: DataFrame) -> DataFrame:
    """(video_id, dominant_hand, dominant_grasp, bimanual_pct, idle_pct): shares of segments and of time."""
    per = segs.groupBy("video_id").agg((100 * F.avg(F.when(F.col("hand_used") == "both", 1.0).otherwise(0.0))).alias("bimanual_pct"), F.sum(F.when(F.col("action") == "idle", F.col("duration")).otherwise(0.0)).alias("_idle"), F.sum("duration").alias("_all"))
    per = per.withColumn("idle_pct", 100 * F.col("_idle") / F.when(F.col("_all") > 0, F.col("_all")).otherwise(1.0)).drop("_idle", "_all")
    hand, grasp = most_common(segs, "hand_used", "none").withColumnRenamed("hand_used", "dominant_hand"), most_common(segs, "grasp_type", "none").withColumnRenamed("grasp_type", "dominant_grasp")
    return per.join(hand, "video_id", "left").join(grasp, "video_id", "left")


def clock(seconds: Column) -> Column:
    """MM:SS; minutes are not bounded."""
    s = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d", F.floor(s / 60).cast("long"), s % 60)


def timeline(segs: DataFrame) -> DataFrame:
    """(video_id, segment_id, line): what a reader sees of each segment."""
    span = F.concat(F.lit("["), clock(F.col("start_time")), F.lit(" - "), clock(F.col("end_time")), F.lit("] "))
    line = F.when(F.col("action") == "transition", F.lit("(transition)")).when(F.col("needs_review"), F.concat("action", F.lit(" | REVIEW: "), "review_reason")).otherwise(F.concat("action", F.lit(" | "), "hand_used", F.lit(" | "), F.array_join("objects", ", ")))
    return segs.select("video_id", "segment_id", F.concat(span, line).alias("line"))


#: A timeline's rule and what it says of a transition.
RULE, MOVING = "=" * 80, "[---]  TRANSITION -- Head movement / walking"


def timeline_text(segs: DataFrame, title: str = "Annotation Timeline") -> DataFrame:
    """(video_id, place, line): a video's whole timeline, with heading and end; places count from -3, segments by their ids. Segments may have an action_description."""
    two = lambda c: F.format_string("%.2f", c + 1e-9)  # noqa: E731  what lies between two goes up
    described = F.coalesce(F.col("action_description"), F.lit("")) if "action_description" in segs.columns else F.lit("")
    span = F.concat(clock(F.col("start_time")), F.lit(" - "), clock(F.col("end_time")), F.lit("  "))
    sure = F.concat(F.lit("["), two(F.round("confidence_avg", 4)), F.lit("] "), F.coalesce("action", F.lit("")), F.lit(" -- "))
    phases = F.when(F.size("phases") > 0, F.concat(F.lit(", "), F.array_join("phases", " -> "))).otherwise("")
    body = F.when(F.col("action") == "transition", F.lit(MOVING)).when(F.col("needs_review"), F.concat(sure, F.lit("NEEDS REVIEW ("), "review_reason", F.lit(")"))).otherwise(F.concat(sure, described, F.lit(" ("), F.coalesce("hand_used", F.lit("")), phases, F.lit(")")))
    rows = segs.select("video_id", F.col("segment_id").alias("place"), F.concat(span, body).alias("line"))
    around = F.array(*[F.struct(F.lit(i).cast("long").alias("place"), F.lit(t).alias("line")) for i, t in ((-3, title), (-2, RULE), (-1, ""))])
    last = F.array(*[F.struct((F.col("_n") + i).alias("place"), F.lit(t).alias("line")) for i, t in ((1, ""), (2, RULE))])
    ends = segs.groupBy("video_id").agg(F.max("segment_id").alias("_n")).select("video_id", F.explode(F.concat(around, last)).alias("x")).select("video_id", "x.place", "x.line")
    return rows.unionByName(ends)


def review_queue(segs: DataFrame, frames: DataFrame, minutes_each: int = 5) -> DataFrame:
    """Segments for review with how many frames they show and the minutes that a reviewer needs for the video."""
    todo = segs.where("needs_review")
    shown = frames_in(todo.select("video_id", "segment_id", "start_time", "end_time"), frames.select("video_id", "ts", "frame_path")).groupBy("video_id", "segment_id").agg(F.count("*").alias("n_frames"), F.min("frame_path").alias("first_frame"), F.max("frame_path").alias("last_frame"))
    per = todo.groupBy("video_id").agg((F.count("*") * minutes_each).alias("review_minutes"))
    return todo.select("video_id", "segment_id", "action", "review_reason").join(shown, ["video_id", "segment_id"], "left").join(per, "video_id").fillna({"n_frames": 0})


#: The least score of each band; what is below them all is to be discarded.
SCORE_BANDS = (("excellent", 0.8), ("good", 0.6), ("fair", 0.4), ("poor", 0.2))


def score_summary(scores: DataFrame, score: str) -> DataFrame:
    """One row per video: mean, median, min, max, std (population) of its scores and how many are in each band. Null scores are left out."""
    band, above = [], F.lit(False)
    for name, least in SCORE_BANDS:
        band.append(F.count_if(~above & (F.col(score) >= least)).alias(name))
        above = above | (F.col(score) >= least)
    stats = [f(score).alias(k) for k, f in (("mean", F.avg), ("median", F.median), ("min", F.min), ("max", F.max), ("std", F.stddev_pop))]
    return scores.where(F.col(score).isNotNull()).groupBy("video_id").agg(*stats, *band, F.count_if(~above).alias("discard"), F.count("*").alias("n"))


def steps(segs: DataFrame, frames: DataFrame) -> DataFrame:
    """Frames of each segment as an episode's steps: step (from 0, by time), is_first and is_last. Frames of equal time keep the order of their seq."""
    w = Window.partitionBy("video_id", "segment_id")
    out = frames_in(segs, frames).withColumn("step", F.row_number().over(w.orderBy("ts", "seq")).cast("long") - 1)
    return out.withColumn("is_first", F.col("step") == 0).withColumn("is_last", F.col("step") == F.count("*").over(w) - 1)


def actions(episode: DataFrame) -> DataFrame:
    """Steps of episodes (video_id, segment_id, step, handedness, pixels, missing, depth) with the action since the step before: dx, dy of the wrist if both show the same hand, dz of depth where both have it, and grasp (1 closed). A first step is all zeros."""
    w = Window.partitionBy("video_id", "segment_id").orderBy("step")
    was = lambda c: F.lag(c).over(w)
    rows = episode.withColumns({"_p": was("pixels"), "_m": was("missing"), "_h": was("handedness"), "_d": was("depth")})
    later, seen = F.col("step") > 0, ~F.col("missing")
    same = later & seen & ~F.col("_m") & (F.col("_h") == F.col("handedness"))
    wrist, before = F.get("pixels", F.lit(0)), F.get("_p", F.lit(0))
    tips = dist(F.get("pixels", F.lit(4)), F.get("pixels", F.lit(8)))
    or_zero = lambda when, c: F.coalesce(F.when(when, c), F.lit(0.0))
    out = rows.withColumns({"dx": or_zero(same, wrist["x"] - before["x"]), "dy": or_zero(same, wrist["y"] - before["y"]), "dz": or_zero(later & seen & ~F.col("_m"), F.col("depth") - F.col("_d")), "grasp": or_zero(later & seen, 1 - F.least(tips / 100, F.lit(1.0)))})
    return out.drop("_p", "_m", "_h", "_d")


def clip_frames(segs: DataFrame, n: int = 16, fps: float = 30.0) -> DataFrame:
    """segs with frame_indices: n evenly spaced frames from start to end; a shorter segment repeats its last. One without a frame has none."""
    s, e = F.floor(F.col("start_time") * fps).cast("long"), F.floor(F.col("end_time") * fps).cast("long")
    at = lambda i: F.when(e - s >= n, F.floor(s + i * (e - 1 - s) / float(max(1, n - 1))).cast("long")).otherwise(F.least(s + i, e - 1))
    return segs.withColumn("frame_indices", F.when(e > s, F.transform(F.sequence(F.lit(0), F.lit(n - 1)), at)).otherwise(F.expr("cast(array() as array<bigint>)")))
