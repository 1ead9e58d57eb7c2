"""Sources around videos, sinks, and small functions, on worked examples."""

import json
import os

import pytest
from pyspark.sql import functions as F

from frameloom.functions import values
from frameloom.operators import labels, segments
from frameloom.sources import media, sinks


def test_label_files_take_the_video_beside_them(spark, tmp_path):
    for name, doc in (("a/x_labels.json", {"segments": [{"start_time": 1.0, "end_time": 2.5, "action": "pick_up", "confidence": 0.7}, {"action": "place", "confidence_avg": 0.9, "confidence": 0.1}]}), ("b/y_labels.json", {"video_path": "/v/y.mov", "segments": [{"start_time": 0.0, "end_time": 1.0}]}), ("b/other.json", {"segments": [{}]})):
        os.makedirs(tmp_path / name.split("/")[0], exist_ok=True)
        (tmp_path / name).write_text(json.dumps(doc, indent=1))
    (tmp_path / "b/broken_labels.json").write_text("{")
    for name in ("a/m.mov", "a/m.avi", "a/n.txt"):
        (tmp_path / name).write_bytes(b"x")
    got = sorted((r["video_path"].rsplit("/", 1)[-1], r["start_time"], r["end_time"], r["action"], r["confidence"]) for r in media.label_samples(spark, str(tmp_path)).collect())
    assert got == [("m.avi", 0.0, 0.0, "place", 0.9), ("m.avi", 1.0, 2.5, "pick_up", 0.7), ("y.mov", 0.0, 1.0, "unknown", 0.0)]


def test_video_files(spark):
    files = spark.createDataFrame([("/d/b.MP4",), ("/d/a.mkv",), ("/d/c.txt",), ("/d.mp4/e",)], "path string")
    assert [r["path"] for r in media.video_files(files).collect()] == ["/d/a.mkv", "/d/b.MP4"]


def test_sizes_and_codecs(spark):
    rows = spark.createDataFrame([(0.0,), (1023.0,), (1536.0,), (5.0 * 1024**3,), (3.0 * 1024**4,)], "n double")
    assert [r[0] for r in rows.select(values.size_text(F.col("n"))).collect()] == ["0.0 B", "1023.0 B", "1.5 KB", "5.0 GB", "3.0 TB"]
    code = int.from_bytes(b"avc1", "little")
    assert spark.range(1).select(values.fourcc(F.lit(code))).first()[0] == "avc1"


def test_flat_depth_is_zero(spark):
    rows = spark.createDataFrame([([2.0, 2.0],), ([1.0, 3.0],)], "m array<double>").select(values.spread_depth(F.col("m")).alias("m"))
    assert [r["m"] for r in rows.collect()] == [[0.0, 0.0], [0.0, 1.0]]


def test_clips_of_short_and_empty_segments(spark):
    rows = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 0.1), (3, 2.0, 2.0)], "segment_id long, start_time double, end_time double")
    got = {r["segment_id"]: r["frame_indices"] for r in segments.clip_frames(rows, 5).collect()}
    assert got == {1: [0, 7, 14, 21, 29], 2: [0, 1, 2, 2, 2], 3: []}


@pytest.mark.parametrize(("text", "error", "action"), [("```\n{\"actions\": []}\n```", None, "unknown"), ("{\"actions\": [{\"action\": \"place\"}]}", None, "place"), ("nothing", "not_json", None), ("[1]", "not_object", None), ("{}", "missing_fields", None), (None, "not_json", None)])
def test_responses(spark, text, error, action):
    r = labels.parse_responses(spark.createDataFrame([(text,)], "response string")).first()
    assert (r["error"], r["action"]) == (error, action)


def test_sinks_write_in_order(spark, tmp_path):
    lines = spark.createDataFrame([(1, k, f"line {k}") for k in (3, 1, 2)], "video_id long, segment_id long, line string")
    sinks.write_timeline(lines, f"{tmp_path}/t")
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/t/video_id=1").collect()] == ["line 1", "line 2", "line 3"]
    queue = spark.createDataFrame([(1, 1, "place", "low_confidence", 0.0, 1.0), (1, 2, "place", "low_confidence", 9.0, 9.5)], "video_id long, segment_id long, action string, review_reason string, start_time double, end_time double")
    frames = spark.createDataFrame([(1, 0.5, "b"), (1, 0.0, "a"), (1, 1.0, "c"), (1, 1.5, "d")], "video_id long, ts double, frame_path string")
    sinks.write_json(sinks.review_documents(queue, frames), f"{tmp_path}/r")
    assert sorted((r["segment_id"], r["frame_paths"]) for r in spark.read.json(f"{tmp_path}/r").collect()) == [(1, ["a", "b", "c"]), (2, [])]
    steps = spark.createDataFrame([(1, 1, 1), (1, 1, 0)], "video_id long, segment_id long, step long")
    sinks.write_steps(steps, f"{tmp_path}/s")
    assert [r["step"] for r in spark.read.parquet(f"{tmp_path}/s").collect()] == [0, 1]
