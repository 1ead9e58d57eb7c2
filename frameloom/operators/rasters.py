"""Frames with grey rasters: measured in one pass without a shuffle, then filtered against the last accepted frame's raster."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.functions import rasters as k

from .folds import fold_in_order
from .frames import BLUR, DUPLICATE, FLOW, FLOW_WINDOW, darkness

_MADE = "brightness double, entropy double, lapvar double, thumb binary, thumb_height int, thumb_width int, grid binary, grid_height int, grid_width int"
#: What the fold needs of a frame.
SEEN = [c.split()[0] for c in _MADE.split(", ")[3:]]


def measured(frames: DataFrame, raster: str = "raster", height: str = "height", width: str = "width", histogram: bool = False) -> DataFrame:
    """frames without their raster, with brightness, entropy, lapvar, and the raster shrunk for comparing (thumb) and for motion (grid).

    A raster that is null or whose length isn't height x width can't be read: all measures are null. With histogram,
    the counts of the 256 greys come along. Other columns stay; those named like a measure must be renamed before.
    """
    rest = [f for f in frames.schema.fields if f.name not in (raster, height, width)]
    made = _MADE + (", histogram array<bigint>" if histogram else "")
    names = [f.name for f in rest]

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.float64()] * 3 + [pa.binary(), pa.int32(), pa.int32()] * 2 + [pa.list_(pa.int64())] * histogram
        for b in batches:
            out = []
            for data, h, w in zip(*(b.column(c).to_pylist() for c in (raster, height, width)), strict=True):
                if (r := k.of_bytes(data, h, w)) is None:
                    out.append((None,) * len(kinds))
                    continue
                counts, small, grid = k.histogram(r), k.shrunk(r, k.THUMB), k.shrunk(r, k.GRID)
                out.append((float(r.mean()), k.entropy(counts), k.laplacian_variance(r), small.tobytes(), *small.shape, grid.tobytes(), *grid.shape, *([counts.tolist()] if histogram else [])))
            columns = zip(*out, strict=True) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), *(pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True))], [*names, *(x.split()[0] for x in made.split(", "))])

    return frames.mapInArrow(work, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), made]))


def stateless(frames: DataFrame) -> DataFrame:
    """measured frames with dark_reason and verdict: dark (unreadable, too dark, overexposed or occluded), blur or good."""
    reason = darkness(F.col("brightness"), F.col("entropy"))
    verdict = F.when(F.col("brightness").isNull() | (reason != ""), "dark").when(F.col("lapvar") < BLUR, "blur").otherwise("good")
    return frames.withColumn("dark_reason", reason).withColumn("verdict", verdict)


#: Nothing accepted and nothing seen yet.
START = (None, None, ())


def judge() -> Callable:
    """A step over frames that passed the stateless checks: state is the last accepted thumb, the last surviving grid and the last flows, so one raster of each kind a video."""

    def step(state: tuple, thumb: bytes, thumb_height: int, thumb_width: int, grid: bytes, grid_height: int, grid_width: int) -> tuple:
        accepted, last, flows = state
        own, now = (thumb, thumb_height, thumb_width), (grid, grid_height, grid_width)
        if accepted is not None and k.similarity(k.of_bytes(*own), k.of_bytes(*accepted)) > DUPLICATE:
            return state, "duplicate"
        flows = (k.motion(k.of_bytes(*last), k.of_bytes(*now), grid_width) if last else 0.0, *flows)[:FLOW_WINDOW]
        if len(flows) == FLOW_WINDOW and all(x > FLOW for x in flows[: FLOW_WINDOW - 1]):
            return (accepted, now, flows), "transition"
        return (own, now, flows), "good"

    return step


def filter_rasters(frames: DataFrame) -> DataFrame:
    """stateless frames (video_id, seq, ...) with their whole verdict: duplicates of the last accepted frame by structural similarity, and transitions by motion between surviving frames.

    Only frames that passed, and of those only the shrunk rasters, are shuffled; a video's are folded in order of seq
    with one raster in memory. seq must be unique in a video. The shrunk rasters are dropped.
    """
    judged = frames.drop(*SEEN)
    rows = frames.where("verdict = 'good'").select("video_id", "seq", *SEEN)
    folded = fold_in_order(rows.repartition("video_id"), ["video_id"], ["seq"], SEEN, START, judge(), "_v", "string").select("video_id", "seq", "_v")
    return judged.join(folded, ["video_id", "seq"], "left").withColumn("verdict", F.coalesce("_v", "verdict")).drop("_v")
