"""Frames with any number of hands: activity, actions, contacts, whole trajectories."""

import math

import pytest
from pyspark.sql import functions as F

from frameloom.operators import hands, trajectories
from frameloom.sources import views

HAND = "struct<handedness:string,pixels:array<struct<x:double,y:double>>,box:struct<x1:double,y1:double,x2:double,y2:double>>"
FRAME = f"video_id long, seq long, ts double, hands array<{HAND}>, depth array<double>"


def hand(side, x, y, n=21, size=100.0):
    return (side, [(x, y)] + [(x + i, y + 1.0) for i in range(1, n)], (x, y, x + size, y + size))


def frames(spark, *rows, video=1, depth=None):
    return spark.createDataFrame([(video, i, 0.5 * i, h, depth(i) if depth else None) for i, h in enumerate(rows)], FRAME)


def scores(spark, *rows, weights=hands.WEIGHTS):
    return [r["activity"] for r in hands.activity(frames(spark, *rows), weights).orderBy("seq").collect()]


def test_activity_of_one_and_two_hands(spark):
    one, two = [hand("right", 0.0, 0.0)], [hand("right", 0.0, 0.0), hand("left", 9.0, 9.0)]
    moved = [hand("right", 50.0, 0.0)]
    got = scores(spark, one, moved, [], two, [hand("left", 9.0, 9.0)])
    assert got == pytest.approx([0.2, 0.7, 0.0, 0.4, 0.2])
    assert scores(spark, one, moved, weights=hands.LIGHT) == pytest.approx([0.2, 0.8])


def test_unreadable_frames_are_skipped_and_the_last_of_equal_labels_counts(spark):
    a, b = hand("right", 0.0, 0.0), hand("right", 25.0, 0.0)
    got = scores(spark, [a], None, [hand("right", 400.0, 0.0), b])
    # two hands; the last right one moved 25 pixels since the frame before the unreadable one
    assert got[1] is None and got[2] == pytest.approx(0.4 + 0.3 * 0.5 + 0.2 * 25 / 30)
    kinds = hands.activity(frames(spark, [a], None)).select(hands.activity_class(F.col("activity")).alias("k")).collect()
    assert sorted(r["k"] for r in kinds) == ["idle_or_observing", "possible_activity"]
    r = hands.routed(hands.activity(frames(spark, [a], None, [a]))).first()
    assert (r["total"], r["n_sent"], r["n_idle"], r["n_scored"], r["idle_pct"]) == (3, 2, 1, 2, 33.3)


def test_growth_of_a_box_and_points_without_a_partner(spark):
    small, large = [hand("right", 0.0, 0.0, size=10.0)], [hand("right", 0.0, 0.0, n=5, size=20.0)]
    assert scores(spark, small, large)[1] == pytest.approx(0.2 + 0.1)


def test_actions_prefer_the_right_hand_that_both_steps_show(spark):
    r, left = lambda x: hand("right", x, 0.0), lambda x: hand("left", x, 0.0)
    steps = frames(spark, [left(1.0), r(10.0)], [r(13.0), left(3.0)], [left(8.0)], [], depth=lambda i: [0.1 * i] * 4 if i != 2 else None)
    look = lambda m, x, y: F.get(m, F.lit(0))
    episode = steps.withColumnRenamed("seq", "step").withColumn("segment_id", F.lit(1))
    got = hands.actions(episode, "depth", look).orderBy("step").collect()
    assert [x["dx"] for x in got] == [0.0, 3.0, 5.0, 0.0]
    assert [round(x["dz"], 6) for x in got] == [0.0, 0.1, 0.0, 0.0]
    assert [round(x["grasp"], 4) for x in got] == [0.0, 0.96, 0.96, 0.0] and {x["droll"] for x in got} == {0.0}


def test_contacts_use_depth_where_a_frame_has_it(spark):
    kinds = "video_id long, seq long, hands array<" + HAND + ">, objects array<struct<class_name:string,bbox:struct<x1:bigint,y1:bigint,x2:bigint,y2:bigint>>>, depth array<double>"
    near = ("nut", (0, 0, 100, 100))
    rows = [(1, 0, [hand("left", 0.0, 0.0), hand("right", 900.0, 900.0)], [near], [0.5] * 64), (1, 1, [hand("left", 0.0, 0.0)], [near], None), (1, 2, None, [near], None), (1, 3, [], None, None)]
    got = hands.contacts(spark.createDataFrame(rows, kinds), "depth", views.map_at).orderBy("seq").collect()
    assert [(r["seq"], r["handedness"], r["depth_diff"], r["contact_rank"]) for r in got] == [(0, "left", 0.0, 1), (1, "left", None, 1)]
    assert got[0]["contact_score"] == 1.0


def demo(spark):
    def points(i):
        x, y = 300.0 + int(100 * math.sin(0.3 * i)), 400.0 + int(50 * math.cos(0.2 * i))
        p = [(0.0, 0.0)] * 21
        p[0], p[4], p[8] = (x, y), (x + int(30 * math.cos(0.5 * i)), y - 20), (x + int(30 * math.cos(0.5 * i + 1.5)), y - 40)
        p[5], p[9], p[17] = (x + 20, y - 30), (x + 5, y - 35), (x - 25, y - 20)
        return p

    return frames(spark, *[[("right", points(i), None)] for i in range(30)])


def test_trajectory_of_the_demo(spark):
    rows = trajectories.gated(trajectories.samples(demo(spark)))
    t = trajectories.trajectories(rows).orderBy("seq").collect()
    assert {r["handedness"] for r in t} == {"right"} and t[0]["coordinate_frame"] == "pixel"
    assert (t[0]["path_length"], t[0]["max_velocity"]) == pytest.approx((578.52, 61.10), abs=0.01)
    assert sum(r["vx"] is not None for r in t) == 29 and sum(r["ax"] is not None for r in t) == 28
    assert (min(r["grasp"] for r in t), max(r["grasp"] for r in t)) == pytest.approx((0.0474, 0.9526), abs=1e-4)
    e = trajectories.events(trajectories.trajectories(rows)).orderBy("event_no").collect()
    assert [r["ts"] for r in e] == [2.0, 3.5, 5.0, 6.5, 8.0, 9.5, 11.5, 13.0, 14.5] and [r["event_type"] for r in e] == ["close", "open"] * 4 + ["close"]
    assert [r["duration_to_next"] for r in e] == [1.5] * 5 + [2.0, 1.5, 1.5, None]
    assert tuple(trajectories.bimanual(rows).first()) == (1, False, True, False)
    assert all(r["pose6"] is None and r["z"] is None and r["roll"] is not None for r in t)


def test_space_follows_from_depth_in_any_frame(spark):
    seen = [[hand("left", 10.0 * i, 0.0)] if i % 4 else [] for i in range(12)]
    rows = trajectories.gated(trajectories.samples(frames(spark, *seen, depth=lambda i: [0.25] * 64 if i == 5 else None), "depth", views.map_at))
    t = trajectories.trajectories(rows).where("handedness = 'left'").orderBy("seq").collect()
    assert len(t) == 12 and t[0]["coordinate_frame"] == "camera_relative" and len(t[0]["pose6"]) == 6
    # the tip's depth is known in one frame and fills the others; the wrist's is 0 in frames without a map
    assert {round(r["tz"], 9) for r in t} == {0.25} and t[11]["z"] == pytest.approx(0.0, abs=1e-9) and max(r["z"] for r in t) > 0.1


def test_hands_seen_too_seldom_have_no_track(spark):
    one = frames(spark, [hand("left", 0.0, 0.0)], [], [hand("right", 1.0, 1.0)], [hand("right", 2.0, 2.0)], None)
    rows = trajectories.gated(trajectories.samples(one))
    assert tuple(trajectories.bimanual(rows).first()) == (1, False, True, False)
    t = trajectories.trajectories(rows).orderBy("seq").collect()
    assert [r["x"] for r in t][:1] == pytest.approx([33 / 35]) and len(t) == 5
    # two hands of one label in a single frame are two sightings, and small gaps count as seen
    twice = trajectories.gated(trajectories.samples(frames(spark, [hand("left", 0.0, 0.0), hand("left", 5.0, 5.0)], [])))
    got = trajectories.trajectories(twice).orderBy("seq").collect()
    assert [(r["handedness"], r["x"], r["vx"]) for r in got] == [("left", 0.0, None), ("left", 0.0, 0.0)]
    assert trajectories.trajectories(trajectories.gated(trajectories.samples(frames(spark, [])))).count() == 0


def test_a_trajectory_has_one_exchange(spark):
    plan = trajectories.trajectories(trajectories.gated(trajectories.samples(demo(spark))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
