"""Plane geometry of key points and boxes, as functions from Columns to Columns.

Points are structs with x and y, boxes structs with x1, y1, x2 and y2; a hand is an array of 21 points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-8
#: The joints of each finger, from the palm to the tip, and the finger tips.
FINGERS = {"thumb": (1, 2, 3, 4), "index": (5, 6, 7, 8), "middle": (9, 10, 11, 12), "ring": (13, 14, 15, 16), "pinky": (17, 18, 19, 20)}
TIPS = (4, 8, 12, 16, 20)


def clamp(v: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.least(F.greatest(v, F.lit(lo)), F.lit(hi))


def dist(a: Column, b: Column) -> Column:
    """Euclidean distance of two points."""
    dx, dy = a["x"] - b["x"], a["y"] - b["y"]
    return F.sqrt(dx * dx + dy * dy)


def segment_distance(p: Column, a: Column, b: Column) -> Column:
    """Distance of a point from the segment from a to b; from a, if they coincide."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    length2 = dx * dx + dy * dy
    t = clamp(((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy) / F.nullif(length2, F.lit(0.0)))
    t = F.coalesce(t, F.lit(0.0))
    ex, ey = p["x"] - (a["x"] + t * dx), p["y"] - (a["y"] + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def joint_angle(a: Column, b: Column, c: Column) -> Column:
    """Angle at b between a and c."""
    ax, ay, cx, cy = a["x"] - b["x"], a["y"] - b["y"], c["x"] - b["x"], c["y"] - b["y"]
    cos = (ax * cx + ay * cy) / (F.sqrt(ax * ax + ay * ay) * F.sqrt(cx * cx + cy * cy) + EPS)
    return F.acos(clamp(cos, -1.0, 1.0))


def finger_curl(hand: Column, finger: str) -> Column:
    """0 for a straight finger, towards 1 for a bent one: by the angles at its two middle joints."""
    p = [F.get(hand, F.lit(i)) for i in FINGERS[finger]]
    return clamp(1 - (joint_angle(p[0], p[1], p[2]) + joint_angle(p[1], p[2], p[3])) / (2 * math.pi))


def grasp_measures(hand: Column) -> Column:
    """Struct of what grasp_rules() looks at: the five curls, and distances in units of the hand."""
    p = lambda i: F.get(hand, F.lit(i))
    scale = dist(p(0), p(12)) + 1e-6
    return F.struct(
        *[finger_curl(hand, f).alias(f) for f in FINGERS],
        (dist(p(4), p(8)) / scale).alias("tips"),
        ((dist(p(8), p(12)) + dist(p(12), p(16)) + dist(p(16), p(20))) / (3 * scale)).alias("spread"),
        (segment_distance(p(4), p(5), p(6)) / scale).alias("side"),
        F.coalesce(F.size(hand), F.lit(0)).alias("n_points"),
    )


def grasp_rules(m: dict[str, Column]) -> Column:
    """Struct (grasp_type, confidence) from grasp_measures(); unknown at 0 for fewer than 21 points. The thresholds are fixed values."""
    mean = (m["index"] + m["middle"] + m["ring"] + m["pinky"]) / 4
    others = (m["middle"] + m["ring"] + m["pinky"]) / 3
    of = lambda name, v: F.struct(F.lit(name).alias("grasp_type"), v.cast("double").alias("confidence"))
    sure = lambda v: F.greatest(F.lit(0.4), F.least(F.lit(1.0), v))
    return (
        F.when(m["n_points"] < 21, of("unknown", F.lit(0.0)))
        .when((mean < 0.3) & (m["spread"] > 0.25), of("no_contact", F.least(F.lit(1.0), 0.5 + (0.3 - mean) + m["spread"])))
        .when((m["tips"] < 0.25) & (others < 0.6), of("pinch", sure((0.25 - m["tips"]) * 4)))
        .when((mean > 0.7) & (m["thumb"] > 0.5), of("power", sure(mean)))
        .when((m["side"] < 0.12) & (m["index"] > 0.4), of("lateral", sure((0.12 - m["side"]) * 8)))
        .when((mean > 0.5) & (m["thumb"] < 0.3), of("hook", sure(mean * 0.8)))
        .when((mean > 0.3) & (m["spread"] > 0.2), of("spherical", sure(m["spread"] * 2)))
        .otherwise(of("unknown", F.lit(0.3)))
    )


def with_grasp(rows: DataFrame, hand: str) -> DataFrame:
    """rows with the curls thumb to pinky, grasp_type and confidence of a hand. The measures come from a generator, so each is worked out once and not copied into every rule."""
    names = [*FINGERS, "tips", "spread", "side", "n_points"]
    out = rows.select(*[c for c in rows.columns if c not in (*names, "grasp_type", "confidence")], F.inline(F.array(grasp_measures(F.col(hand)))))
    return out.select(*[c for c in out.columns if c not in names[5:]], F.inline(F.array(grasp_rules({n: F.col(n) for n in names}))))


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def box_of(points: Column, width: int, height: int, margin: int = 10) -> Column:
    """The points' bounding box with a margin, inside the image."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return box(F.greatest(F.array_min(xs) - margin, F.lit(0)), F.greatest(F.array_min(ys) - margin, F.lit(0)), F.least(F.array_max(xs) + margin, F.lit(width)), F.least(F.array_max(ys) + margin, F.lit(height)))


def area(b: Column) -> Column:
    """0 for boxes that are turned inside out."""
    return F.greatest(b["x2"] - b["x1"], F.lit(0)) * F.greatest(b["y2"] - b["y1"], F.lit(0))


def centre(b: Column) -> Column:
    half = lambda v: F.floor(v / 2).cast("int")
    return F.struct(half(b["x1"] + b["x2"]).alias("x"), half(b["y1"] + b["y2"]).alias("y"))


def normalised(b: Column, width: int, height: int, digits: int = 4) -> Column:
    return box(F.round(b["x1"] / width, digits), F.round(b["y1"] / height, digits), F.round(b["x2"] / width, digits), F.round(b["y2"] / height, digits))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes, 0 where both are empty."""
    both = F.greatest(F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]), F.lit(0)) * F.greatest(F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]), F.lit(0))
    return F.coalesce(both / F.nullif((area(a) + area(b) - both).cast("double"), F.lit(0.0)), F.lit(0.0))


def tips_inside(points: Column, b: Column) -> Column:
    """How many finger tips are in the box, its edges included."""
    tips = F.transform(F.array(*map(F.lit, TIPS)), lambda i: F.get(points, i))
    return F.size(F.filter(tips, lambda p: p["x"].between(b["x1"], b["x2"]) & p["y"].between(b["y1"], b["y2"]))).cast("long")


def contact_score(overlap: Column, depth_diff: Column, tips: Column) -> Column:
    """Weighted overlap, depth and finger tips (without depth, the other two weigh more), raised to a floor where one of them is telling."""
    o = F.least(F.lit(1.0), overlap / 0.3)
    d = F.greatest(F.lit(0.0), 1 - depth_diff / 0.1)
    t = F.least(F.lit(1.0), tips / 3)
    score = F.round(F.when(depth_diff.isNull(), 0.525 * o + 0.475 * t).otherwise(0.4 * o + 0.25 * d + 0.35 * t), 4)
    score = F.when(overlap > 0.3, F.greatest(score, F.lit(0.5))).otherwise(score)
    score = F.when((overlap > 0.1) & (depth_diff < 0.05), F.greatest(score, F.lit(0.6))).otherwise(score)
    return F.when(tips >= 1, F.greatest(score, F.lit(0.4))).otherwise(score)


def ncc(a: Column, b: Column) -> Column:
    """Normalised cross-correlation of two arrays of equal length, clipped to [0, 1]: by sums that one pass over both gathers."""
    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("a", "b", "aa", "bb", "ab")])
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))

    def add(s: Column, p: Column) -> Column:
        x, y = p["x"], p["y"]
        return F.struct((s["a"] + x).alias("a"), (s["b"] + y).alias("b"), (s["aa"] + x * x).alias("aa"), (s["bb"] + y * y).alias("bb"), (s["ab"] + x * y).alias("ab"))

    n = F.size(a)
    std = lambda sq, v: F.greatest(F.sqrt(F.greatest(sq / n - (v / n) * (v / n), F.lit(0.0))), F.lit(EPS))
    return F.aggregate(pairs, zero, add, lambda s: clamp((s["ab"] / n - (s["a"] / n) * (s["b"] / n)) / (std(s["aa"], s["a"]) * std(s["bb"], s["b"]))))


def orientation(hand: Column) -> Column:
    """Struct (roll, pitch, yaw) of a hand of 21 points, from the wrist, the knuckles of index, middle and little finger; null for fewer points."""
    p = lambda i: F.get(hand, F.lit(i))
    wrist = p(0)
    to = lambda i: (p(i)["x"] - wrist["x"], p(i)["y"] - wrist["y"])
    (ix, iy), (px, py), (mx, my) = to(5), to(17), to(9)
    norm = lambda x, y: F.sqrt(x * x + y * y) + EPS
    roll = F.acos(clamp(ix / norm(ix, iy) * (px / norm(px, py)) + iy / norm(ix, iy) * (py / norm(px, py)), -1.0, 1.0))
    rpy = F.struct(roll.alias("roll"), F.atan2(ix * py - iy * px, norm(mx, my)).alias("pitch"), F.atan2(my, mx).alias("yaw"))
    return F.when(F.size(hand) >= 21, rpy)
