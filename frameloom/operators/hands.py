"""Frames with any number of hands: matched to the frame before by their label, activity, actions and contacts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.geometry import area, centre, contact_score, dist, iou, tips_inside

from .trajectories import INDEX, THUMB, WHOLE, WRIST

#: Weights of presence, wrist, key points and box, of the whole score and the light one; what counts as full motion.
WEIGHTS, LIGHT = (0.4, 0.3, 0.2, 0.1), (0.4, 0.35, 0.25, 0.0)
WRIST_PX, POINTS_PX, GROWTH = 50.0, 30.0, 0.3
#: The least score of the classes above idle.
ACTIVE, POSSIBLE = 0.6, 0.2
#: Which hand's wrist moves an episode; the distance of thumb and index that counts as open.
PREFERRED, OPEN_PX = ("right", "left"), 100.0


def matched(now: Column, before: Column) -> Column:
    """Pairs (now, before) of hands with a label that both frames have; the last hand of a label stands for it."""
    labels = lambda hands: F.transform(hands, lambda h: h["handedness"])
    last = lambda hands, label: F.element_at(F.filter(hands, lambda h: h["handedness"].eqNullSafe(label)), -1)
    both = F.array_intersect(labels(now), labels(before))
    return F.transform(both, lambda label: F.struct(last(now, label).alias("now"), last(before, label).alias("before")))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def activity(frames: DataFrame, weights: tuple[float, ...] = WEIGHTS, hands: str = "hands") -> DataFrame:
    """frames (video_id, seq, hands) with activity, from 0 to 1: presence, and the motion of wrists, key points and boxes of the hands that the frame before shows too.

    hands is an array of structs (handedness, pixels, box). A frame whose hands are null could not be read: its activity
    is null and the next frame is compared with the one before it. An empty array is a frame without hands: 0.
    """
    readable = frames.where(F.col(hands).isNotNull())
    rows = readable.withColumn("_was", F.lag(hands).over(Window.partitionBy("video_id").orderBy("seq")))
    rows = rows.withColumn("_pairs", F.coalesce(matched(F.col(hands), F.col("_was")), F.array()))
    n, pairs = F.size(hands), F.col("_pairs")
    presence = F.when(n == 0, 0.0).when(n == 1, 0.5).otherwise(1.0)
    wrist = total(F.transform(pairs, lambda p: dist(F.get(p["now"]["pixels"], F.lit(WRIST)), F.get(p["before"]["pixels"], F.lit(WRIST))))) / F.greatest(F.size(pairs), F.lit(1))
    # points without a partner are left out
    steps = F.filter(F.flatten(F.transform(pairs, lambda p: F.zip_with(p["now"]["pixels"], p["before"]["pixels"], dist))), lambda x: x.isNotNull())
    grown = F.transform(F.filter(pairs, lambda p: area(p["before"]["box"]) > 0), lambda p: F.abs(area(p["now"]["box"]) - area(p["before"]["box"])) / area(p["before"]["box"]))
    eps, one = 1e-8, F.lit(1.0)
    parts = (presence, F.least(one, wrist / WRIST_PX), F.least(one, total(steps) / (F.size(steps) + eps) / POINTS_PX), F.least(one, total(grown) / (F.size(grown) + eps) / GROWTH))
    score = F.when(F.size(pairs) == 0, weights[0] * presence).otherwise(F.least(one, sum(w * p for w, p in zip(weights, parts, strict=True) if w)))
    scored = rows.withColumn("activity", score).drop("_was", "_pairs")
    return scored.unionByName(frames.where(F.col(hands).isNull()).withColumn("activity", F.lit(None).cast("double")))


def activity_class(score: Column) -> Column:
    """Class of an activity score; frames that could not be read are idle."""
    return F.when(score >= ACTIVE, "active_manipulation").when(score >= POSSIBLE, "possible_activity").otherwise("idle_or_observing")


def routed(scored: DataFrame) -> DataFrame:
    """One row per video of scored frames: n_sent (to the labeller), n_idle, n_scored, their percentages of all frames, and the mean activity of those that have one. One pass; a video's unreadable frames are idle."""
    idle = activity_class(F.col("activity")) == "idle_or_observing"
    n = scored.groupBy("video_id").agg(F.count("*").alias("total"), F.count_if(~idle).alias("n_sent"), F.count_if(idle).alias("n_idle"), F.count("activity").alias("n_scored"), F.avg("activity").alias("mean_activity"))
    return n.withColumns({f"{k}_pct": F.round(100.0 * F.col(f"n_{k}") / F.col("total"), 1) for k in ("sent", "idle")})


def actions(episode: DataFrame, depth: str, look_up: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """Steps of episodes (video_id, segment_id, step, hands, a depth map or null) with the seven numbers of the action since the step before: dx, dy, dz, droll, dpitch, dyaw, grasp.

    dx and dy are of the right wrist if both steps show it, else of the left one; dz is of the depths under each step's
    own preferred wrist, where both have a map; turns are zero. grasp is of the first hand with all its points. A first step is all zeros.
    """
    w = Window.partitionBy("video_id", "segment_id").orderBy("step")
    wrist = lambda side: F.get(F.get(F.filter("hands", lambda h: h["handedness"] == side), F.lit(0))["pixels"], F.lit(WRIST))
    rows = episode.withColumns({f"_{s}": wrist(s) for s in PREFERRED})
    any_ = F.coalesce(*[F.col(f"_{s}") for s in PREFERRED])
    rows = rows.withColumn("_z", F.when(F.col(depth).isNotNull(), look_up(F.col(depth), any_["x"], any_["y"])))
    first = F.get(F.filter("hands", lambda h: F.size(h["pixels"]) >= WHOLE), F.lit(0))["pixels"]
    rows = rows.withColumn("_pinch", dist(F.get(first, F.lit(THUMB)), F.get(first, F.lit(INDEX))))
    rows = rows.withColumns({f"{c}0": F.lag(c).over(w) for c in ("_z", *[f"_{s}" for s in PREFERRED])})
    later = F.col("step") > 0
    moved = lambda axis: F.coalesce(*[F.col(f"_{s}")[axis] - F.col(f"_{s}0")[axis] for s in PREFERRED])
    out = {"dx": moved("x"), "dy": moved("y"), "dz": F.col("_z") - F.col("_z0"), "droll": F.lit(0.0), "dpitch": F.lit(0.0), "dyaw": F.lit(0.0), "grasp": 1 - F.least(F.col("_pinch") / OPEN_PX, F.lit(1.0))}
    rows = rows.withColumns({k: F.coalesce(F.when(later, c), F.lit(0.0)) for k, c in out.items()})
    return rows.drop("_z", "_z0", "_pinch", *[f"_{s}{x}" for s in PREFERRED for x in ("", "0")])


def contacts(frames: DataFrame, depth: str, look_up: Callable[[Column, Column, Column], Column], least: float = 0.3) -> DataFrame:
    """Pairs of a hand and an object in one frame (video_id, seq, hands, objects, a depth map or null): hand_no, object_no, handedness, class_name, iou, tips, depth_diff, contact_score, contact_rank in the frame, centre of the object. Pairs are made inside a row, so nothing is shuffled for them; weak ones are dropped."""
    pair = frames.select("video_id", "seq", F.col(depth).alias("_map"), "objects", F.posexplode("hands").alias("hand_no", "_h")).select("video_id", "seq", "_map", "hand_no", "_h", F.posexplode("objects").alias("object_no", "_o"))
    wrist, middle = F.get("_h.pixels", F.lit(WRIST)), centre(F.col("_o.bbox"))
    deep = F.when(F.col("_map").isNotNull() & wrist.isNotNull(), F.abs(look_up(F.col("_map"), wrist["x"], wrist["y"]) - look_up(F.col("_map"), middle["x"], middle["y"])))
    pair = pair.withColumns({"iou": iou(F.col("_h.box"), F.col("_o.bbox")), "tips": tips_inside(F.col("_h.pixels"), F.col("_o.bbox")), "depth_diff": deep})
    pair = pair.withColumn("contact_score", contact_score(F.col("iou"), F.col("depth_diff"), F.col("tips"))).where(F.col("contact_score") >= least)
    rank = F.row_number().over(Window.partitionBy("video_id", "seq").orderBy(F.desc("contact_score"), "hand_no", "object_no"))
    return pair.select("video_id", "seq", F.col("hand_no").cast("long").alias("hand_no"), F.col("object_no").cast("long").alias("object_no"), F.col("_h.handedness").alias("handedness"), F.col("_o.class_name").alias("class_name"), "iou", "tips", "depth_diff", "contact_score", rank.cast("long").alias("contact_rank"), centre(F.col("_o.bbox")).alias("centre"))


def confident(frames: DataFrame, objects: str = "objects", least: float = 0.3) -> DataFrame:
    """frames with the detections of confidence `least` or more, surest first, equals in their order; null confidences go."""
    order = lambda a, b: F.when(a["confidence"] > b["confidence"], -1).when(a["confidence"] < b["confidence"], 1).otherwise(0)
    return frames.withColumn(objects, F.array_sort(F.filter(objects, lambda o: o["confidence"] >= least), order))
