"""Whole trajectories of both hands: position in the plane or in space, orientation, motion, grasp and tool tip, and how the two hands relate.

Samples have one row for each frame and each of the two hands, whether the hand is seen or not, so gaps are rows. All
steps are windows over (video_id, handedness): one exchange for everything.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.geometry import dist, orientation

from . import tracks

#: The hands that can have a trajectory, in the order of their events; points of the wrist, the thumb's and the index finger's tip; points of a whole hand.
SIDES, WRIST, THUMB, INDEX, WHOLE = ("left", "right"), 0, 4, 8, 21
#: Fixed value: sightings, and samples after small gaps are filled, that make a trajectory.
LEAST = 2
ANGLES, TIP = ("roll", "pitch", "yaw"), ("tx", "ty", "tz")


def samples(frames: DataFrame, depth: str | None = None, look_up: Callable[[Column, Column, Column], Column] | None = None) -> DataFrame:
    """One row per frame (video_id, seq, ts, hands) and side: handedness, sightings, deep, and of the first such hand x, y, z, tx, ty, tz, roll, pitch, yaw, pinch.

    hands is an array of structs with handedness and pixels; null is no hand. depth is a column that is null for frames
    without a map, look_up(map, x, y) its value at a point. z is 0 for a hand in a frame without a map, tz null. Hands of
    fewer than 21 points have a wrist only.
    """
    rows = frames.withColumn("handedness", F.explode(F.array(*map(F.lit, SIDES))))
    own = F.filter("hands", lambda h: h["handedness"] == F.col("handedness"))
    rows = rows.withColumn("_own", F.coalesce(own, F.expr("slice(hands, 1, 0)"))).withColumn("_p", F.get("_own", F.lit(0))["pixels"])
    p = lambda i: F.get("_p", F.lit(i))
    whole = lambda c: F.when(F.size("_p") >= WHOLE, c)
    map_ = F.col(depth) if depth else F.lit(None).cast("double")
    z = lambda at: look_up(map_, at["x"], at["y"]) if look_up else F.lit(None).cast("double")
    x = {"sightings": F.coalesce(F.when(F.size("_own") > 0, F.size("_own")), F.lit(0)), "deep": map_.isNotNull(), "x": p(WRIST)["x"].cast("double"), "y": p(WRIST)["y"].cast("double")}
    x |= {"z": F.when(p(WRIST).isNotNull(), F.when(map_.isNotNull(), z(p(WRIST))).otherwise(0.0)), "tx": whole(p(INDEX)["x"].cast("double")), "ty": whole(p(INDEX)["y"].cast("double")), "tz": F.when(map_.isNotNull(), whole(z(p(INDEX))))}
    turned = orientation(F.col("_p"))
    x |= {a: turned[a] for a in ANGLES} | {"pinch": whole(dist(p(THUMB), p(INDEX)))}
    return rows.select("video_id", "handedness", "seq", "ts", *[c.alias(k) for k, c in x.items()])


def gated(rows: DataFrame) -> DataFrame:
    """samples with tracked: true for hands seen often enough, before and after small gaps are filled."""
    whole = Window.partitionBy("video_id", "handedness")
    rows = tracks.gap_sizes(rows, "x")
    # a gap is filled if it is small and has a neighbour
    there = F.col("x").isNotNull() | (F.col("_n") <= tracks.MAX_GAP) & F.col("_near")
    enough = (F.sum("sightings").over(whole) >= LEAST) & (F.count_if(there).over(whole) >= LEAST)
    return rows.withColumn("tracked", enough).drop("_n", "_near")


def trajectories(rows: DataFrame) -> DataFrame:
    """One row per frame of each tracked hand of gated samples: position (x, y smoothed, z where the video has depth), orientation, pose6 (both, where both are), velocity, acceleration, grasp, tool tip, coordinate_frame, path_length and max_velocity.

    dt is the median step of the video's frames. Position means space if any frame of the video has depth, else the
    plane: motion, path and speed follow. Repeated seq or ts are steps of no length; a null ts takes no part in dt.
    """
    w, whole = tracks.series(), Window.partitionBy("video_id", "handedness")
    rows = rows.where("tracked").drop("tracked")
    rows = rows.withColumns({"deep": F.max("deep").over(whole), "_turned": F.count("roll").over(whole) > 0, "_tips": F.count("tx").over(whole) >= LEAST, "_frames": F.count("*").over(whole), "_d": F.col("ts") - F.lag("ts").over(w)})
    rows = rows.withColumns({"z": F.when(F.col("deep"), F.col("z")), "dt": tracks.step_of(F.percentile("_d", F.lit(0.5)).over(whole))})
    rows = rows.withColumns({c: F.when(F.col("_tips") & (F.col("deep") if c == "tz" else F.lit(True)), F.col(c)) for c in TIP})
    smoothed = ("x", "y", "z", *ANGLES, *TIP)
    rows = tracks.fill_gaps(tracks.fill_gaps(rows, *smoothed, max_gap=None), "pinch")
    # a long series without any sample of a kind that its hand has counts as zeros
    rows = rows.withColumn("tz", F.when(F.col("_tips") & F.col("deep") & (F.col("_frames") >= 5), F.coalesce("tz", F.lit(0.0))).otherwise(F.col("tz")))
    rows = tracks.motion(tracks.smooth(rows, *smoothed), F.col("dt"), ("x", "y", "z"))
    square = lambda *c: sum((F.coalesce(F.col(k) * F.col(k), F.lit(0.0)) for k in c[2:]), F.col(c[0]) * F.col(c[0]) + F.col(c[1]) * F.col(c[1]))
    rows = rows.withColumns({f"_{c}": F.col(c) - F.lag(c).over(w) for c in "xyz"}).withColumn("_step", F.sqrt(square("_x", "_y", "_z"))).withColumn("_speed", F.sqrt(square("vx", "vy", "vz")))
    rows = rows.withColumns({"path_length": F.round(F.coalesce(F.sum("_step").over(whole), F.lit(0.0)), 2), "max_velocity": F.round(F.coalesce(F.max("_speed").over(whole), F.lit(0.0)), 2)})
    rows = rows.withColumns({"grasp": grasp(whole), "coordinate_frame": F.when(F.col("deep"), "camera_relative").otherwise("pixel")})
    rows = rows.withColumn("pose6", F.when(F.col("deep") & F.col("_turned"), F.array("x", "y", "z", *ANGLES)))
    return rows.select("video_id", "handedness", "seq", "ts", "x", "y", "z", *ANGLES, "pose6", *[k + c for k in "va" for c in "xyz"], "grasp", *TIP, "coordinate_frame", "path_length", "max_velocity")


def grasp(whole: Window) -> Column:
    """0 (open) to 1 (closed) from the pinch: see tracks.grasp_signal, here as windows over the series."""
    at = F.percentile("pinch", F.array(F.lit(0.05), F.lit(0.95))).over(whole)
    lo, hi = F.get(at, F.lit(0)), F.get(at, F.lit(1))
    v = F.coalesce(F.least(F.greatest((hi - F.col("pinch")) / F.nullif(hi - lo, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    flat = (F.count("pinch").over(whole) < 2) | (hi - lo < 1e-6)
    return F.when(flat, 0.0).otherwise(1 / (1 + F.exp(-6 * (v - 0.5))))


def events(moving: DataFrame) -> DataFrame:
    """(video_id, event_no, handedness, ts, event_type, duration_to_next) of trajectories: the left hand's events, then the right hand's, numbered from 0 in a video."""
    found = tracks.grasp_events(moving)
    w = Window.partitionBy("video_id").orderBy("handedness", "ts", F.desc("duration_to_next"))
    return found.withColumn("event_no", F.row_number().over(w).cast("long") - 1)


def bimanual(rows: DataFrame) -> DataFrame:
    """(video_id, has_left, has_right, bimanual) of gated samples, one row for every video that has frames."""
    has = lambda h: F.max(F.col("tracked") & (F.col("handedness") == h))
    out = rows.groupBy("video_id").agg(has("left").alias("has_left"), has("right").alias("has_right"))
    return out.withColumn("bimanual", F.col("has_left") & F.col("has_right"))
