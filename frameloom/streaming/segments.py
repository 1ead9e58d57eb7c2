"""Streaming forms: sessions of labels under a watermark, and the order-dependent frame filter as a stateful operator."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.operators.frames import BLUR, BRIGHT_HIGH, BRIGHT_LOW, judge


def sessions(labels: DataFrame, gap: str = "10 seconds", late: str = "1 minute") -> DataFrame:
    """(video_id, action, start, end, n, confidence) of labels (video_id, ts TIMESTAMP or TIMESTAMP_NTZ, action, confidence): runs without a gap. A watermark needs TIMESTAMP, so ts is cast."""
    timed = labels.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    out = timed.groupBy("video_id", "action", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.avg("confidence").alias("confidence"))
    return out.select("video_id", "action", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "confidence")


def filter_stream(frames: DataFrame, scale: float = 100.0) -> DataFrame:
    """(video_id, seq, verdict) of a stream of frames (video_id, seq, brightness, lapvar, flow).

    State for each video is the last accepted frame's brightness and the last flows, so it does not grow with the video;
    rows of a micro-batch are taken in order of seq.
    """

    passed = judge(scale)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, flows = state.get if state.exists else (None, "")
        now = last, tuple(float(x) for x in flows.split(",") if x)
        rows = pd.concat(list(batches)).sort_values("seq")
        out = []
        for r in rows.itertuples(index=False):
            if pd.isna(r.brightness) or r.brightness < BRIGHT_LOW or r.brightness > BRIGHT_HIGH:
                verdict = "dark"
            elif r.lapvar < BLUR:
                verdict = "blur"
            else:
                now, verdict = passed(now, float(r.brightness), 0.0 if pd.isna(r.flow) else float(r.flow))
            out.append((key[0], r.seq, verdict))
        state.update((now[0], ",".join(map(str, now[1]))))
        yield pd.DataFrame(out, columns=["video_id", "seq", "verdict"])

    kept = frames.select("video_id", "seq", "brightness", "lapvar", "flow")
    return kept.groupBy("video_id").applyInPandasWithState(step, "video_id long, seq long, verdict string", "last double, flows string", "append", "NoTimeout")
