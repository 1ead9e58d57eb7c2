"""The raster filter as a stream: frames of a video are judged in order of time, in whatever order they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from frameloom.operators import rasters

OUT = "video_id long, seq long, at timestamp, verdict string"
_BOX = lambda x: f"{x} binary, {x}_height int, {x}_width int"
_WAITING = f"at_ms long, seq long, verdict string, {_BOX('thumb')}, {_BOX('grid')}"


class RasterFilter(StatefulProcessor):
    """Rows wait in keyed state until the watermark has passed their time, when a timer judges them in order of (time, seq); a later timer forgets a video that has been idle for `idle_ms`.

    State of a video: the rows that wait, the last accepted thumb, the last surviving grid and the last flows.
    """

    def __init__(self, idle_ms: int):
        self.idle_ms, self.judge = idle_ms, rasters.judge()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at_ms long, seq long", _WAITING)
        self.seen = handle.getValueState("seen", f"{_BOX('thumb')}, {_BOX('grid')}, flows string, last_ms long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for b in rows:
            for r in b.itertuples(index=False):
                at = int(r.at_ms)
                whole = lambda x: None if x is None or pd.isna(x) else int(x)
                self.waiting.updateValue((at, int(r.seq)), (at, int(r.seq), r.verdict, r.thumb, whole(r.thumb_height), whole(r.thumb_width), r.grid, whole(r.grid_height), whole(r.grid_width)))
                self.handle.registerTimer(at)
        yield pd.DataFrame(columns=["video_id", "seq", "at", "verdict"])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        due = sorted((k for k in self.waiting.keys() if k[0] <= now)) if self.waiting.exists() else []
        state, last = self.state()
        out = []
        for k in due:
            at, seq, verdict, *boxes = self.waiting.getValue(k)
            self.waiting.removeKey(k)
            if verdict == "good":
                state, verdict = self.judge(state, *boxes)
            last = max(last, at)
            out.append((key[0], seq, pd.Timestamp(at, unit="ms"), verdict))
        if due:
            self.keep(state, last)
            self.handle.registerTimer(last + self.idle_ms)
        elif last + self.idle_ms <= now and not self.waiting.exists():
            self.seen.clear()
        yield pd.DataFrame(out, columns=["video_id", "seq", "at", "verdict"])

    def state(self) -> tuple[tuple, int]:
        if not self.seen.exists():
            return rasters.START, 0
        *boxes, flows, last = self.seen.get()
        accepted, grid = (tuple(x) if x[0] is not None else None for x in (boxes[:3], boxes[3:]))
        return (accepted, grid, tuple(float(x) for x in flows.split(",") if x)), last

    def keep(self, state: tuple, last: int) -> None:
        accepted, grid, flows = state
        none = (None, None, None)
        self.seen.update((*(accepted or none), *(grid or none), ",".join(map(repr, flows)), last))

    def close(self) -> None:
        pass


def filter_stream(frames: DataFrame, late: str = "1 minute", idle: int = 600) -> DataFrame:
    """(video_id, seq, at, verdict) of a stream of frames (video_id, seq, at TIMESTAMP, raster, height, width): what filter_rasters gives, whatever the order of arrival within `late`.

    Later rows than that are dropped, and so are times up to 1970, where watermarks begin. A video without frames for `idle` seconds is forgotten: its next frame is a first
    one. Needs the RocksDB state store. Measures are made before the shuffle, so state and shuffle hold shrunk rasters.
    """
    timed = rasters.stateless(rasters.measured(frames)).withWatermark("at", late).withColumn("at_ms", F.unix_millis("at"))
    kept = timed.select("video_id", "seq", "at", "at_ms", "verdict", *rasters.SEEN)
    return kept.groupBy("video_id").transformWithStateInPandas(RasterFilter(1000 * idle), OUT, "append", "eventTime")
