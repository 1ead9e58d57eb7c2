"""Frame folders and camera manifests as a source: what is filtered is neither listed nor opened."""

import json

import pytest
from pyspark.sql import functions as F

from frameloom.operators import rasters
from frameloom.sources import frame_folders


@pytest.fixture
def folder(tmp_path):
    for video in ("a", "b"):
        (tmp_path / video).mkdir()
        for i in range(6):
            (tmp_path / video / f"frame_{i * 500:010d}.pgm").write_bytes(b"P5\n# grey\n3 2\n255\n" + bytes([40 * i] * 6))
        (tmp_path / video / "notes.txt").write_text("x")
    (tmp_path / "b" / "frame_0000003000.jpg").write_bytes(b"\xff\xd8")
    (tmp_path / "_tmp").mkdir()
    (tmp_path / "manifest.json").write_text(json.dumps({"cameras": [{"file": "a", "mount": "helmet", "type": "egocentric"}, {"file": "gone"}, {"file": "b"}], "sync_offset_ms": [0, 7]}))
    return tmp_path


@pytest.fixture
def read(spark, folder):
    spark.dataSource.register(frame_folders.FrameFolders)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return lambda **o: spark.read.format("frame_folders").option("path", str(folder)).options(**o).load()


def test_frames_of_folders(read):
    got = read().orderBy("video_id", "seq").collect()
    assert [(r["video_id"], r["seq"], r["ms"], r["ts"]) for r in got[:3]] == [("a", 0, 0, 0.0), ("a", 1, 500, 0.5), ("a", 2, 1000, 1.0)] and len(got) == 13
    assert (got[2]["raster"], got[2]["height"], got[2]["width"]) == (bytes([80] * 6), 2, 3)
    assert got[12]["raster"] is None and got[12]["content"] == b"\xff\xd8"
    few = read(content="false", files=2)
    assert few.where("content is not null").count() == 0 and few.rdd.getNumPartitions() == 7


def test_duration_video_and_stride_reach_the_listing(read, folder):
    df = read(stride=2).where((F.col("ts") < 2.0) & (F.col("video_id") == "b") & (F.length("frame_path") > 1))
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PushedFilters: [LessThan(ts,2.0), EqualTo(video_id,b)]" in plan
    assert [r["seq"] for r in df.orderBy("seq").collect()] == [0, 2]
    r = frame_folders.FolderReader({"path": str(folder), "stride": "2"})
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNotNull, LessThan, LessThanOrEqual

    left = list(r.pushFilters([LessThan(("ts",), 2.0), LessThanOrEqual(("ts",), 2.0), GreaterThan(("ts",), 0.0), EqualTo(("video_id",), "b"), IsNotNull(("ts",)), EqualTo(("seq",), 1)]))
    assert left == [IsNotNull(("ts",)), EqualTo(("seq",), 1)]
    assert [(p.video_id, [x[1] for x in p.paths]) for p in r.partitions()] == [("b", [1000])]


def test_cameras_of_a_manifest(read):
    got = read(manifest="manifest.json").groupBy("camera", "mount", "kind").agg(F.min("ms").alias("first"), F.count("*").alias("n")).orderBy("camera").collect()
    assert [tuple(r) for r in got] == [(0, "helmet", "egocentric", 0, 6), (2, "cam2", "", 0, 7)]


def test_offsets_move_times_before_filters(read, folder):
    (folder / "manifest.json").write_text(json.dumps({"cameras": [{"file": "a"}, {"file": "b"}], "sync_offset_ms": [0, 600]}))
    got = read(manifest="manifest.json").where("ts < 1.0").orderBy("camera", "ms").collect()
    assert [(r["camera"], r["ms"]) for r in got] == [(0, 0), (0, 500), (1, 600)]


def test_nothing_to_read(read, folder):
    (folder / "none.json").write_text("{}")
    assert read(manifest="none.json").count() == 0
    assert read().where("video_id = 'gone'").count() == 0


def test_frames_go_on_to_the_filter(read):
    frames = read().select(F.col("video_id"), "seq", "raster", "height", "width")
    out = rasters.stateless(rasters.measured(frames)).where("video_id = 'a'").orderBy("seq").collect()
    assert [r["dark_reason"] for r in out] == ["too_dark"] + ["occluded"] * 5


def test_files_that_are_no_grey_maps():
    assert frame_folders.grey(b"P5 2 1 255\nab") == (b"ab", 1, 2)
    for bad in (None, b"", b"P6 1 1 255\nabc", b"P5 2 2 255\nabc", b"P5 1 1 65535\nab", b"P5 0 0 255\n"):
        assert frame_folders.grey(bad) == (None, None, None)
