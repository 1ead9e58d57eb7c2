"""What a run hands on: documents, resumed output, progress, clips, classified vectors, isolated stages."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from frameloom.functions import chance
from frameloom.operators import classify, clips, documents, segments, stages
from frameloom.streaming import resume

LABEL = "video_id long, seq long, start double, end double, action string, confidence double, phase string, hand string, grasp string, objects array<string>"


def label(i, action, start, end, confidence=0.8, phase="manipulate", hand="right", grasp="power", objects=("wrench",), video=1):
    return (video, i, float(start), float(end), action, confidence, phase, hand, grasp, list(objects))


# --- segments and documents ---------------------------------------------------------


def test_labels_without_an_action_keep_their_segments(spark):
    rows = [label(i, a, i, i + 1) for i, a in enumerate(["pick_up", "pick_up", None, None, "place"])]
    got = segments.segments(spark.createDataFrame(rows, LABEL)).orderBy("segment_id").collect()
    assert [(r["action"], r["start_time"], r["end_time"]) for r in got] == [("pick_up", 0.0, 2.0), (None, 2.0, 4.0), ("place", 4.0, 5.0)]


def document_rows(spark):
    smoke = [label(i, "pick_up", i, i + 1, 0.82 + 0.02 * i, "reach" if i <= 1 else "manipulate") for i in range(5)]
    smoke += [label(5 + i, "tighten_bolt", 5 + i, 6 + i, 0.78 + 0.03 * i, objects=("wrench", "bolt")) for i in range(3)]
    smoke += [label(8 + i, "idle", 8 + i, 9 + i, 0.95, "", "none", "none", ()) for i in range(2)]
    told = F.struct(F.lit("work").alias("high_level"), F.col("action").alias("mid_level"), F.lit("low").alias("low_level"))
    rows = spark.createDataFrame(smoke, LABEL).withColumns({"action_description": F.concat(F.lit("Do "), "action"), "task_hierarchy": told, "labelling_method": F.lit("vlm")})
    return segments.segments(rows)


def test_document_of_a_video(spark):
    segs = document_rows(spark)
    scores = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.5)], "video_id long, segment_id long, quality_score double")
    videos = spark.createDataFrame([(1, "a.mp4", 10.0), (2, None, None)], "video_id long, video_file string, duration double")
    stats = spark.createDataFrame([(1, 10)], "video_id long, total_frames long")
    got = {r["video_id"]: json.loads(r["document"]) for r in documents.documents(videos, segs, scores, stats).collect()}
    d = got[1]
    assert list(d) == ["video_file", "video_type", "camera_mount", "duration", "fps", "vlm_backend", "processing_stats", "segments", "action_summary", "manipulation_profile", "quality_aggregate"]
    assert (d["video_file"], d["camera_mount"], d["duration"], d["processing_stats"]) == ("a.mp4", "helmet", 10.0, {"total_frames": 10})
    assert [list(s) for s in d["segments"]] == [list(documents.SEGMENT)] * 3
    first, last = d["segments"][0], d["segments"][2]
    assert (first["segment_id"], first["action"], first["confidence_avg"], first["confidence_min"], first["frames_analyzed"], first["manipulation_phases"]) == (1, "pick_up", 0.86, 0.82, 5, ["reach", "manipulate"])
    assert (first["action_description"], first["labelling_method"], first["task_hierarchy"]["mid_level"], first["quality_score"]) == ("Do pick_up", "vlm", "pick_up", 0.9)
    assert first["trajectory_summary"] == {"path_length": 0.0, "max_velocity": 0.0, "grasp_events": 0}
    assert (last["quality_score"], last["review_reason"], last["objects_involved"], last["frames_skipped"]) == (None, "hand_not_visible", [], 0)
    assert d["action_summary"] == [{"action": "pick_up", "count": 1, "total_duration": 5.0, "avg_confidence": 0.86}, {"action": "tighten_bolt", "count": 1, "total_duration": 3.0, "avg_confidence": 0.81}, {"action": "idle", "count": 1, "total_duration": 2.0, "avg_confidence": 0.95}]
    assert d["manipulation_profile"] == {"dominant_hand": "right", "bimanual_pct": 0.0, "idle_pct": 20.0, "most_used_grasp": "power", "grasp_distribution": {"power": 2}, "hand_distribution": {"right": 2}, "total_segments": 3, "total_duration": 10.0}
    assert d["quality_aggregate"]["n"] == 2 and d["quality_aggregate"]["max"] == 0.9
    empty = got[2]
    assert (empty["video_file"], empty["segments"], empty["action_summary"], empty["manipulation_profile"], empty["quality_aggregate"]) == ("", [], [], None, None)
    assert documents.documents(videos.limit(0), segs).count() == 0


def test_ties_in_a_document_go_to_what_was_met_first(spark):
    rows = [label(0, "b", 0, 1, hand="left", grasp="hook"), label(1, "a", 1, 2, hand="both", grasp="pinch"), label(2, "c", 2, 3, hand="none", grasp="none")]
    segs = segments.segments(spark.createDataFrame(rows, LABEL))
    d = json.loads(documents.documents(spark.createDataFrame([(1,)], "video_id long"), segs).first()["document"])
    assert [a["action"] for a in d["action_summary"]] == ["b", "a", "c"]
    p = d["manipulation_profile"]
    assert (p["dominant_hand"], p["most_used_grasp"], list(p["hand_distribution"]), p["bimanual_pct"]) == ("left", "hook", ["left", "both"], 33.3)


# --- resume -----------------------------------------------------------------------

FRAMES = "video_id long, ms long, x string"


def put(spark, folder, rows):
    spark.createDataFrame(rows, FRAMES).coalesce(1).write.mode("append").parquet(str(folder))


class Dies(resume.Ledger):
    """Stops between the rows and the commit of a batch."""

    at = 1

    def commit(self, batch_id):
        if batch_id == self.at:
            raise RuntimeError("stopped before the commit")
        super().commit(batch_id)


def test_a_query_that_is_killed_before_its_commit_writes_each_row_once(spark, tmp_path):
    folder, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    folder.mkdir()
    stream = lambda: spark.readStream.schema(FRAMES).option("maxFilesPerTrigger", 1).parquet(str(folder))
    put(spark, folder, [(1, 0, "a"), (1, 500, "b"), (1, 500, "b")])
    q = Dies(spark, out).stream(stream(), check)
    q.processAllAvailable()
    put(spark, folder, [(1, 500, "again"), (1, 1000, "c"), (2, 0, "d")])
    with pytest.raises(Exception, match="stopped before the commit"):
        q.processAllAvailable()
    ledger = resume.Ledger(spark, out)
    # rows of the second batch are on disk, but nobody sees them
    assert spark.read.parquet(f"{out}/rows").count() == 4 and sorted(map(tuple, ledger.rows().collect())) == [(1, 0, "a"), (1, 500, "b")]
    q = ledger.stream(stream(), check)
    q.processAllAvailable()
    q.stop()
    want = [(1, 0, "a"), (1, 500, "b"), (1, 1000, "c"), (2, 0, "d")]
    assert sorted(map(tuple, ledger.rows().collect())) == want
    assert sorted(map(tuple, ledger.processed().collect())) == [w[:2] for w in want]
    # a new checkpoint reads all files again and adds only what is new
    put(spark, folder, [(2, 0, "late"), (3, 0, "e")])
    second = resume.Ledger(spark, out, run="second")
    q = second.stream(stream(), str(tmp_path / "check2"))
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, second.rows().collect())) == [*want, (3, 0, "e")]
    left = second.unprocessed(spark.createDataFrame([(1, 0, "x"), (1, 7, "y"), (None, 0, "z")], FRAMES)).collect()
    assert sorted((r["x"] for r in left)) == ["y", "z"]


def test_an_empty_ledger(spark, tmp_path):
    ledger = resume.Ledger(spark, str(tmp_path / "none"))
    frames = spark.createDataFrame([(1, 0, "a")], FRAMES)
    assert ledger.rows() is None and ledger.processed() is None and ledger.unprocessed(frames).count() == 1
    ledger.add(frames.limit(0), 0)
    assert ledger.rows().count() == 0 and ledger.unprocessed(frames).count() == 1


def test_progress_of_stages(spark, tmp_path):
    p = resume.Progress(spark, str(tmp_path / "progress"))
    videos = spark.createDataFrame([(1,), (2,), (3,)], "video_id long")
    assert p.completed("filter").count() == 0 and p.remaining(videos, "filter").count() == 3
    p.complete(videos.where("video_id < 3"), "filter")
    p.complete(videos.where("video_id = 1"), "label")
    assert sorted(r["video_id"] for r in p.completed("filter").collect()) == ["1", "2"]
    assert [r["video_id"] for r in p.remaining(videos, "filter").collect()] == [3]
    assert {r["video_id"]: r["stage"] for r in p.current_stage().collect()} == {"1": "label", "2": "filter"}
    for value in ("old", "new"):
        p.save(spark.createDataFrame([(1, "note", value)], "video_id long, key string, value string"))
    assert [tuple(r) for r in p.results().collect()] == [("1", "note", "new")]
    (tmp_path / "progress" / "broken.parquet").write_bytes(b"no table")
    p.reset(videos.where("video_id = 1"))
    assert [r["video_id"] for r in p.completed("filter").collect()] == ["2"] and p.results().count() == 0
    p.complete(videos.where("video_id = 1"), "filter")
    assert p.completed("filter").count() == 2


def test_finished_videos(spark):
    files = spark.createDataFrame([("file:/o/video_id=7/annotations.json",), ("/o/video_id=8/part/annotations.json",), ("/o/video_id=9/annotations.csv",), ("/o/annotations.json",)], "path string")
    assert sorted(r["video_id"] for r in resume.finished_videos(files).collect()) == ["7", "8"]


# --- clips --------------------------------------------------------------------------


def test_random_numbers_do_not_depend_on_partitions(spark):
    rows = spark.range(300).selectExpr("id", "if(id % 7 = 0, null, id % 5) as k", "array(0, id, 500, 899, cast(null as bigint)) as frame_indices")

    def made(n):
        out = clips.parameters(clips.jitter(rows.repartition(n), ["id", "k"], total=900), ["id", "k"], 640, 480)
        return sorted((tuple(r) for r in out.collect()), key=lambda r: r[0])

    one = made(1)
    assert one == made(200)
    moves = [b - a for r in one for a, b in zip((r[0], 500), r[2][1:3], strict=True) if 2 <= a < 898]
    assert set(moves) == {-2, -1, 0, 1, 2} and all(r[2][4] is None and 0 <= min(r[2][:4]) and max(r[2][:4]) <= 899 for r in one)
    u = [r["u"] for r in spark.range(4000).select(chance.uniform(3, "id").alias("u")).collect()]
    assert 0.47 < np.mean(u) < 0.53 and min(u) >= 0 and max(u) < 1 and abs(np.var(u) - 1 / 12) < 0.01
    g = [r["g"] for r in spark.range(4000).select(chance.normal(5.0, 2.0, chance.uniform(3, "id", F.lit("a")), chance.uniform(3, "id", F.lit("b"))).alias("g")).collect()]
    assert abs(np.mean(g) - 5) < 0.15 and abs(np.std(g) - 2) < 0.15


def test_crops_stay_inside(spark):
    a = [r["augment"] for r in clips.parameters(spark.range(500), ["id"], 64, 48).collect()]
    assert all(0 <= x["crop_x"] and x["crop_x"] + x["crop_width"] <= 64 and 0 <= x["crop_y"] and x["crop_y"] + x["crop_height"] <= 48 for x in a)
    assert {x["kernel"] for x in a} == {0, 3, 5, 7} and any(x["crop_width"] == 64 and x["angle"] == 0.0 for x in a) and {x["flip"] for x in a} == {True, False}
    assert {x["contrast"] == 1.0 for x in a if x["brightness"] == 0.0} == {True}
    h = spark.createDataFrame([("left", True), ("right", True), ("both", True), ("left", False)], "h string, f boolean").select(clips.mirrored(F.col("h"), F.col("f"))).collect()
    assert [r[0] for r in h] == ["right", "left", "both", "left"]


# --- classified vectors ---------------------------------------------------------------


def test_classes_ties_and_vectors_without_one(spark):
    model = classify.Classes(np.array([2, 5, 9]), np.array([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0]]), np.zeros(3))
    rows = [(1, [1.0, 0.0], 5), (2, [0.0, 2.0], 9), (3, None, 2), (4, [1.0], 2), (5, [math.nan, 0.0], 2), (6, [1000.0, -1000.0], 9), (7, [0.0, 0.0], 7), (8, [0.0, 0.0], None)]
    got = {r["id"]: r for r in classify.classified(spark.createDataFrame(rows, "id long, v array<double>, truth long"), model, "v", "truth").collect()}
    assert [got[i]["class_id"] for i in range(1, 9)] == [2, 9, None, None, None, 2, 2, 2]
    assert got[1]["best"] == [2, 5, 9] and got[7]["best"] == [2, 5, 9] and got[3]["best"] is None
    assert got[1]["confidence"] == pytest.approx(math.e / (2 * math.e + 1)) and got[6]["confidence"] == pytest.approx(0.5) and got[6]["loss"] > 700
    assert got[7]["loss"] is None and got[8]["loss"] is None
    e = classify.epoch(classify.classified(spark.createDataFrame(rows, "id long, v array<double>, truth long"), model, "v", "truth").withColumn("e", F.lit(1)), ["e"], "truth").first()
    assert e["n"] == 3 and e["accuracy"] == 0.3333
    nothing = classify.nearest_mean(spark.createDataFrame([], "c long, v array<double>"), "c", "v", 2)
    assert len(nothing.ids) == 0 and classify.classified(spark.createDataFrame([(1, [1.0, 2.0])], "id long, v array<double>"), nothing, "v").first()["class_id"] is None
    with pytest.raises(ValueError, match="too many"):
        classify.Classes(np.array([1]), np.broadcast_to(np.float64(0), (1, classify.MOST_WEIGHTS + 1)), np.zeros(1))


# --- stages ---------------------------------------------------------------------------


def test_poisoned_rows_fail_alone(spark):
    calls = []
    work = [
        stages.Stage("half", ("n",), "double", lambda n: [10 / x for x in n]),
        stages.Stage("text", ("half",), "string", lambda h: [f"{x:.1f}" for x in h], needs=("half",)),
        stages.Stage("odd", ("n",), "long", lambda n: [x if x != 3 else "three" for x in n], needs=("n",)),
    ]
    rows = spark.createDataFrame([(i, i % 5 if i % 11 else None) for i in range(100)], "id long, n long").repartition(3)
    done = stages.run(rows, work)
    got = {r["id"]: r for r in done.collect()}
    for i in range(100):
        n = i % 5 if i % 11 else None
        assert got[i]["half"] == (10 / n if n else None) and got[i]["text"] == (f"{10 / n:.1f}" if n else None) and got[i]["odd"] == (n if n != 3 else None)
        assert [e["stage"] for e in got[i]["errors"]] == (["half"] if not n else []) + (["odd"] if n == 3 else [])
    assert "ZeroDivisionError" in got[5]["errors"][0]["error"] and "TypeError" in got[11]["errors"][0]["error"]
    n = {r["stage"]: tuple(r)[1:] for r in stages.counts(done, work).collect()}
    failed = sum(not r["half"] for r in got.values())
    assert n["half"] == (100 - failed, failed, 0) and n["text"] == (100 - failed, 0, failed) and sum(n["odd"]) == 100
    assert stages.failures(done, "id").where("stage = 'half'").count() == failed
    assert [r[0] for r in stages.counts(stages.run(rows.limit(0), work), work).collect()] == []
    with pytest.raises(ValueError, match="names"):
        stages.run(rows, [stages.Stage("id", ("n",), "long", list)])
    # few bad rows cost few calls
    found, errors = stages.attempt(lambda v: calls.append(len(v)) or [1 / x for x in v], [[1] * 500 + [0] + [1] * 523], lambda v: v)
    assert sum(e is not None for e in errors) == 1 and found[500] is None and len(calls) < 25
    assert stages.attempt(lambda v: v[:1], [[1, 2]], lambda v: v) == ([1, 2], [None, None])
