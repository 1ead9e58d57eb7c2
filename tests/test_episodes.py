"""Episode files: checksums, framing and wire format against independent readers; publication all at once."""

import os
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frameloom.functions import rasters, records
from frameloom.sources import episodes


def crc_bitwise(data):
    c = 0xFFFFFFFF
    for b in data:
        c ^= b
        for _ in range(8):
            c = c >> 1 ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


@settings(deadline=None, max_examples=60)
@given(st.binary(max_size=9000))
def test_checksum(data):
    assert records.crc32c(data) == crc_bitwise(data)


def test_known_checksums():
    assert records.crc32c(b"123456789") == 0xE3069283
    assert records.crc32c(b"\0" * 32) == 0x8A9136AA and records.crc32c(b"") == 0
    big = os.urandom(70_001)
    assert records.crc32c(big) == crc_bitwise(big)


def read_varint(data, i):
    v = shift = 0
    while True:
        v |= (data[i] & 127) << shift
        shift, i = shift + 7, i + 1
        if data[i - 1] < 128:
            return v, i


def fields(data):
    i = 0
    while i < len(data):
        tag, i = read_varint(data, i)
        assert tag & 7 == 2
        n, i = read_varint(data, i)
        yield tag >> 3, data[i : i + n]
        i += n
    assert i == len(data)


def parse(data):
    """An example's features, read without the code that wrote them."""
    out = {}
    for _, features in fields(data):
        for _, entry in fields(features):
            parts = dict(fields(entry))
            values = []
            for kind, group in fields(parts[2]):
                for _, v in fields(group):
                    if kind == 1:
                        values.append(v)
                    elif kind == 2:
                        values += struct.unpack(f"<{len(v) // 4}f", v)
                    else:
                        i = 0
                        while i < len(v):
                            x, i = read_varint(v, i)
                            values.append(x - (1 << 64) if x >> 63 else x)
            out[parts[1].decode()] = values
    return out


def read_records(path):
    data, i, out = open(path, "rb").read(), 0, []
    unmask = lambda m: ((m - 0xA282EAD8) & 0xFFFFFFFF) << 15 & 0xFFFFFFFF | ((m - 0xA282EAD8) & 0xFFFFFFFF) >> 17
    while i < len(data):
        (n,) = struct.unpack_from("<Q", data, i)
        assert unmask(struct.unpack_from("<I", data, i + 8)[0]) == crc_bitwise(data[i : i + 8])
        body = data[i + 12 : i + 12 + n]
        assert unmask(struct.unpack_from("<I", data, i + 12 + n)[0]) == records.crc32c(body)
        out.append(parse(body))
        i += 16 + n
    return out


def test_examples_read_back():
    row = {"b": b"\0\xff", "s": "é", "f": [1.5, -2.0], "i": -7, "t": True, "many": list(range(300)), "none": None, "empty": []}
    assert parse(records.example(row)) == {"b": [b"\0\xff"], "s": ["é".encode()], "f": [1.5, -2.0], "i": [-7], "t": [1], "many": list(range(300)), "none": [], "empty": []}
    assert records.example(row) == records.example(dict(reversed(row.items())))


def test_resizing():
    r = np.array([[0, 100], [200, 60]], np.uint8)
    assert rasters.resized(r, (2, 2)).tolist() == r.tolist() and rasters.resized(np.full((1, 1), 7, np.uint8), (3, 2)).tolist() == [[7, 7]] * 3
    assert rasters.resized(r, (2, 4)).tolist() == [[0, 25, 75, 100], [200, 165, 95, 60]]


STEP = "video_id long, segment_id long, step long, raster binary, height int, width int, depth array<double>, action array<double>, instruction string, is_first boolean, is_last boolean"


def steps(spark):
    rows = [(v, s, k, bytes([10 * k] * 6) if k != 1 else None, 2, 3, [0.5] * 4 if k else None, [float(k)] * 7, f"do {s}" if s else None, k == 0, k == 3) for v in (1, 2) for s in (0, 12) for k in range(4)]
    return spark.createDataFrame(rows, STEP).repartition(3)


def test_episodes_are_written_and_read_back(spark, tmp_path):
    out = str(tmp_path / "out")
    features = episodes.step_features(steps(spark))
    episodes.write_episodes(features, out)
    assert sorted(os.listdir(out)) == ["_SUCCESS", "video_id=1", "video_id=2"] and open(f"{out}/_SUCCESS").read() == "12"
    got = read_records(f"{out}/video_id=2/episode_0012.tfrecord")
    assert [g["action"][0] for g in got] == [0.0, 2.0, 3.0]  # the unreadable step is left out
    assert [(g["is_first"], g["is_last"], g["is_terminal"]) for g in got] == [([1], [0], [0]), ([0], [0], [0]), ([0], [1], [1])]
    assert got[0]["language_instruction"] == [b"do 12"] and [len(g["observation/image"][0]) for g in got] == [256 * 256 * 3] * 3
    assert set(got[1]["observation/image"][0]) == {20} and got[0]["observation/depth"] == [b""]
    assert np.frombuffer(got[1]["observation/depth"][0], np.float32).tolist() == [0.5] * 65536
    assert read_records(f"{out}/video_id=1/episode_0000.tfrecord")[0]["language_instruction"] == [b""]
    # again with one video: overwriting leaves only that, appending adds
    episodes.write_episodes(features.where("video_id = 1"), out)
    assert sorted(os.listdir(out)) == ["_SUCCESS", "video_id=1"]
    episodes.write_episodes(features.where("video_id = 2"), out, "append")
    assert sorted(os.listdir(out)) == ["_SUCCESS", "video_id=1", "video_id=2"]
    episodes.write_episodes(features.limit(0), out)
    assert os.listdir(out) == ["_SUCCESS"]


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    good = episodes.step_features(steps(spark))
    episodes.write_episodes(good.where("video_id = 1"), out)
    bad = good.withColumn("is_first", F.when((F.col("video_id") == 2) & (F.col("step") == 3), F.raise_error(F.lit("broken")).cast("boolean")).otherwise(F.col("is_first")))
    with pytest.raises(Exception, match="broken"):
        episodes.write_episodes(bad, out)
    assert sorted(os.listdir(out)) == ["_SUCCESS", "video_id=1"] and len(read_records(f"{out}/video_id=1/episode_0000.tfrecord")) == 3


def test_a_failed_attempt_is_not_published(tmp_path):
    from pyspark.sql import Row
    from pyspark.sql.types import _parse_datatype_string

    w = episodes.EpisodeWriter(_parse_datatype_string("struct<video_id:bigint,segment_id:bigint,x:bigint>"), str(tmp_path / "o"), False)
    row = lambda s, x: Row(video_id=1, segment_id=s, x=x)

    def breaks():
        yield row(1, 1)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        w.write(breaks())
    with pytest.raises(ValueError, match="together"):
        w.write(iter([row(1, 1), row(2, 1), row(1, 2)]))
    w.commit([w.write(iter([row(1, 5), row(1, 6)])), None])
    assert sorted(os.listdir(tmp_path / "o")) == ["_SUCCESS", "video_id=1"]
    assert [g["x"] for g in read_records(tmp_path / "o/video_id=1/episode_0001.tfrecord")] == [[5], [6]]
