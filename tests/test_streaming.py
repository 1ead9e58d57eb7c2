"""Streams give what the batch operators give."""

from frameloom.operators import frames
from frameloom.sources import views
from frameloom.streaming import segments as streaming


def test_stateful_filter_equals_the_fold(spark, tiny, tmp_path):
    batch = views.frames(spark, tiny).select("video_id", "seq", "ts", "brightness", "lapvar", "flow")
    path = str(tmp_path / "frames")
    batch.coalesce(1).write.parquet(path)
    q = streaming.filter_stream(spark.readStream.schema(batch.schema).parquet(path)).writeStream.format("memory").queryName("verdicts").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    got = sorted(map(tuple, spark.table("verdicts").collect()))
    want = sorted(map(tuple, frames.filter_frames(batch).select("video_id", "seq", "verdict").collect()))
    assert got == want
