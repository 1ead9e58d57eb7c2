"""Rasters: kernels against slow restatements, and the filter as a batch, as a plain loop and as a stream out of order."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from frameloom.functions import rasters as k
from frameloom.operators import rasters
from frameloom.sources import views

FRAME = "video_id long, seq long, raster binary, height int, width int"


def noise(h, w, seed=0, low=0, high=256):
    return np.random.default_rng(seed).integers(low, high, (h, w), dtype=np.uint8)


def test_laplacian_mirrors_at_the_edges():
    r = noise(5, 7)
    f, at = r.astype(float), lambda i, n: -i if i < 0 else 2 * (n - 1) - i if i >= n else i
    lap = [sum(f[at(y + dy, 5), at(x + dx, 7)] for dy, dx in ((0, 1), (1, 0), (0, -1), (-1, 0))) - 4 * f[y, x] for y in range(5) for x in range(7)]
    assert k.laplacian_variance(r) == pytest.approx(np.var(lap))
    assert k.laplacian_variance(np.full((1, 1), 9, np.uint8)) == 0.0 and k.laplacian_variance(noise(1, 6)) > 0


def test_shrinking_keeps_areas():
    r = noise(12, 9)
    assert (k.shrunk(r, (4, 3)) == np.rint(r.reshape(4, 3, 3, 3).mean((1, 3)))).all()
    assert k.shrunk(r, (12, 9)) is r and k.shrunk(r, (100, 5)).shape == (12, 5)
    assert k.shrunk(np.full((13, 17), 77, np.uint8), (5, 4)).tolist() == [[77] * 4] * 5
    row = np.array([[0, 90, 30]], np.uint8)
    assert k.shrunk(row, (1, 2)).tolist() == [[30, 50]]


def test_similarity_of_windows():
    a, b = noise(9, 8, 1), noise(9, 8, 2)
    c1, c2, found = (0.01 * 255) ** 2, (0.03 * 255) ** 2, []
    for y in range(3):
        for x in range(2):
            p, q = a[y : y + 7, x : x + 7].astype(float).ravel(), b[y : y + 7, x : x + 7].astype(float).ravel()
            v = np.cov(p, q)
            found.append((2 * p.mean() * q.mean() + c1) * (2 * v[0, 1] + c2) / ((p.mean() ** 2 + q.mean() ** 2 + c1) * (v[0, 0] + v[1, 1] + c2)))
    assert k.similarity(a, b) == pytest.approx(np.mean(found)) and k.similarity(a, a) == pytest.approx(1.0)
    assert k.similarity(a, b[:, :7]) == 0.0 and 0.0 <= k.similarity(a[:3], b[:3]) <= 1.0


def test_motion_of_a_shifted_raster():
    r = noise(60, 80, 4)
    assert k.motion(r, r, 80) == 0.0
    moved = k.motion(r, np.roll(r, 3, axis=1), 80)
    assert moved == pytest.approx(3 * 4, rel=0.15) and k.motion(r, r[:, :40], 80) == 0.0
    flat = np.full((8, 8), 5, np.uint8)
    assert k.motion(flat, flat, 8) == 0.0


def by_hand(rows):
    """(seq, raster or None) of one video in order -> verdicts."""
    out, accepted, last, flows = [], None, None, []
    for _, r in rows:
        if r is None or r.mean() < 30 or r.mean() > 240 or k.entropy(k.histogram(r)) < 3:
            out.append("dark")
        elif k.laplacian_variance(r) < 50:
            out.append("blur")
        elif accepted is not None and k.similarity(r, accepted) > 0.95:
            out.append("duplicate")
        else:
            flows = ([k.motion(last, r, r.shape[1])] if last is not None else []) + flows
            last = r
            if len(flows) >= 2 and min(flows[:2]) > 15:
                out.append("transition")
            else:
                out.append("good")
                accepted = r
    return out


def test_the_filter_equals_a_plain_loop(spark, tiny):
    frames = views.raster_frames(spark, tiny)
    got = {(r["video_id"], r["seq"]): r["verdict"] for r in rasters.filter_rasters(rasters.stateless(rasters.measured(frames))).collect()}
    videos, want = {}, {}
    for r in frames.collect():
        videos.setdefault(r["video_id"], []).append((r["seq"], k.of_bytes(r["raster"], r["height"], r["width"])))
    for video, rows in videos.items():
        rows.sort(key=lambda x: x[0])
        want |= {(video, s): verdict for (s, _), verdict in zip(rows, by_hand(rows), strict=True)}
    assert got == want and set(want.values()) == {"good", "dark", "blur", "duplicate", "transition"}


def test_rasters_that_cannot_be_read(spark):
    good = noise(9, 9, 5, 60, 200).tobytes()
    rows = [(1, 0, None, 9, 9), (1, 1, good, 9, 8), (1, 2, b"", 0, 0), (1, 3, good, None, 9), (1, 4, good, 9, 9), (1, 5, good, 9, 9), (None, 0, good, 9, 9)]
    df = spark.createDataFrame(rows, FRAME).withColumn("note", F.lit("x"))
    out = rasters.filter_rasters(rasters.stateless(rasters.measured(df)))
    assert [(r["seq"], r["verdict"]) for r in out.where("video_id = 1").orderBy("seq").collect()] == [(i, "dark") for i in range(4)] + [(4, "good"), (5, "duplicate")]
    assert "note" in out.columns and "thumb" not in out.columns
    assert rasters.filter_rasters(rasters.stateless(rasters.measured(df.limit(0)))).count() == 0


def test_the_measures_need_no_shuffle(spark, tiny):
    frames = spark.createDataFrame([(1, 0, b"a", 1, 1)], FRAME)
    assert "Exchange" not in rasters.stateless(rasters.measured(frames))._jdf.queryExecution().executedPlan().toString()


def test_a_stream_out_of_order_gives_the_batch_result(spark, tiny, tmp_path):
    from frameloom.streaming import rasters as streaming

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    frames = views.raster_frames(spark, tiny).where("video_id < 4").withColumn("at", F.timestamp_millis(F.col("seq") * 500 + 1_000_000))
    want = {(r["video_id"], r["seq"]): r["verdict"] for r in rasters.filter_rasters(rasters.stateless(rasters.measured(frames))).collect()}
    rows = frames.select("video_id", "seq", "at", "raster", "height", "width").collect()
    random.Random(1).shuffle(rows)
    folder = tmp_path / "in"
    folder.mkdir()
    schema = "video_id long, seq long, at timestamp, raster binary, height int, width int"
    third = -(-len(rows) // 3)
    far = [(-1, 0, rows[0]["at"].replace(year=2000), None, 8, 8)]
    parts = [rows[:third], rows[third : 2 * third], rows[2 * third :], far, [(-1, 1, far[0][2].replace(year=2001), None, 8, 8)]]
    out = streaming.filter_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder)), late="1 hour")
    q = None
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(folder))
        if q is None:
            q = out.writeStream.format("memory").queryName("judged").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
        q.processAllAvailable()
        if i == 2:
            assert spark.table("judged").count() == 0
    got = [((r["video_id"], r["seq"]), r["verdict"]) for r in spark.table("judged").where("video_id >= 0").collect()]
    rows_kept = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    q.stop()
    assert len(got) == len(want) and dict(got) == want
    assert rows_kept < 30  # the idle videos are forgotten
