"""Frames: sampling, names, quality verdicts, order-dependent deduplication, batches, costs and resuming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.operators.folds import fold_in_order

#: Price in INR of a batch, by backend; the first is taken for unknown ones.
PRICES = {"gemini": 0.05, "claude_haiku": 0.08, "openai": 0.10, "claude_sonnet": 0.35}
BRIGHT_LOW, BRIGHT_HIGH, ENTROPY_LOW, BLUR, DUPLICATE, FLOW, FLOW_WINDOW = 30.0, 240.0, 3.0, 50.0, 0.95, 15.0, 3


def by_time() -> Window:
    return Window.partitionBy("video_id").orderBy("ts")


def sample_fps(frames: DataFrame, fps: float, duration: float | None = None) -> DataFrame:
    """The first frame of each 1/fps seconds; a prefix of the video if duration is given (the filter reaches the scan)."""
    if duration is not None:
        frames = frames.where(F.col("ts") < duration)
    first = F.row_number().over(Window.partitionBy("video_id", F.floor(F.col("ts") * fps)).orderBy("ts"))
    return frames.withColumn("_r", first).where("_r = 1").drop("_r")


def sample_stride(frames: DataFrame, source_fps: float, fps: float, duration: float | None = None) -> DataFrame:
    """Every interval-th frame by seq, with ts from the source's rate (30 if it has none)."""
    source = source_fps or 30.0
    interval = max(1, round(source / fps))
    out = frames.where(F.col("seq") % interval == 0)
    if duration is not None:
        out = out.where(F.col("seq") < int(duration * source))
    return out.withColumn("ts", F.col("seq") / source)


def name_frames(files: DataFrame, fps: float, offset: float = 0.0) -> DataFrame:
    """files (video_id, file) named by sequence number, with ts and the name by milliseconds; other names are skipped."""
    n = F.regexp_extract("file", r"^frame_(\d+)\.jpg$", 1)
    named = files.where(n != "").withColumn("ts", (n.cast("long") - 1) / fps + offset)
    return named.withColumn("ts_ms", F.bround(F.col("ts") * 1000).cast("long")).withColumn("frame_name", F.format_string("frame_%010d.jpg", "ts_ms"))


def darkness(brightness: Column, entropy: Column | None = None) -> Column:
    """too_dark, overexposed, occluded or "", tested in this order."""
    out = F.when(brightness < BRIGHT_LOW, "too_dark").when(brightness > BRIGHT_HIGH, "overexposed")
    return (out.when(entropy < ENTROPY_LOW, "occluded") if entropy is not None else out).otherwise("")


def stateless_verdict(frames: DataFrame) -> DataFrame:
    """frames (brightness, lapvar) with dark_reason and verdict: dark before blur before good. An unreadable frame (null brightness) is dark."""
    reason = darkness(F.col("brightness"))
    return frames.withColumn("dark_reason", reason).withColumn("verdict", F.when(F.col("brightness").isNull() | (reason != ""), "dark").when(F.col("lapvar") < BLUR, "blur").otherwise("good"))


def judge(scale: float) -> Callable:
    """A step over frames that passed the stateless checks: state is the last accepted brightness and the last flows."""

    def step(state: tuple, brightness: float, flow: float) -> tuple:
        last, flows = state
        if last is not None and 1 - abs(brightness - last) / scale > DUPLICATE:
            return state, "duplicate"
        flows = (flow, *flows)[:FLOW_WINDOW]
        if len(flows) == FLOW_WINDOW and all(x > FLOW for x in flows[: FLOW_WINDOW - 1]):
            return (last, flows), "transition"
        return (brightness, flows), "good"

    return step


def filter_frames(frames: DataFrame, scale: float = 100.0) -> DataFrame:
    """stateless_verdict, then duplicates of the last accepted frame and transitions; seq is unique in a video.

    Whether a frame is a duplicate depends on which one was accepted last, and that on the verdicts before: a fold over
    the frames that passed, in order, whose state is a few numbers. Similarity is 1 - |difference| / scale of
    brightness; a transition has FLOW_WINDOW surviving frames in its window, all with flow over FLOW. A flow that is
    null or no number is 0.
    """
    judged = stateless_verdict(frames)
    flow = F.nanvl(F.coalesce(F.col("flow").cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = judged.where("verdict = 'good'").select("video_id", "seq", F.col("brightness").cast("double").alias("brightness"), flow.alias("flow"))
    folded = fold_in_order(rows.repartition("video_id"), ["video_id"], ["seq"], ["brightness", "flow"], (None, ()), judge(scale), "v", "string")
    return judged.join(folded.select("video_id", "seq", "v"), ["video_id", "seq"], "left").withColumn("verdict", F.coalesce("v", "verdict")).drop("v")


def transition_ranges(verdicts: DataFrame) -> DataFrame:
    """(video_id, start, end): first and last ts of each run of transition frames among the frames that aren't dark, blurred or duplicate."""
    kept = verdicts.where(F.col("verdict").isin("transition", "good"))
    w = Window.partitionBy("video_id").orderBy("seq")
    is_t = F.col("verdict") == "transition"
    run = kept.withColumn("_run", F.sum(F.when(is_t, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.where(is_t).groupBy("video_id", "_run").agg(F.min("ts").alias("start"), F.max("ts").alias("end")).drop("_run")


def filter_stats(verdicts: DataFrame) -> DataFrame:
    """By video: frames, how many are good, dark, blurred or duplicates, transitions (in ranges, see transition_ranges), and each as a percentage of all frames. One pass over the verdicts: a range is counted where it begins."""
    names = ("good", "dark", "blur", "duplicate")
    kept = F.col("verdict").isin("transition", "good")
    before = F.lag("verdict").over(Window.partitionBy("video_id", kept).orderBy("seq"))
    begins = (F.col("verdict") == "transition") & ~before.eqNullSafe("transition")
    out = verdicts.withColumn("_begins", begins).groupBy("video_id").agg(F.count("*").alias("total"), *[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in names], F.count_if("_begins").alias("n_transition"))
    return out.select("*", *[F.round(100.0 * F.col(f"n_{v}") / F.col("total"), 1).alias(f"{v}_pct") for v in (*names, "transition")])


def batches(frames: DataFrame, size: int = 5) -> DataFrame:
    """(video_id, batch_id, n_frames, start, end): frames in order, size at a time."""
    at = F.floor((F.row_number().over(by_time()) - 1) / size).cast("long")
    return frames.withColumn("batch_id", at).groupBy("video_id", "batch_id").agg(F.count("*").alias("n_frames"), F.min("ts").alias("start"), F.max("ts").alias("end"))


def estimate_cost(counts: DataFrame, backend: str = "gemini", size: int = 5) -> DataFrame:
    """counts (video_id, total, kept) with n_batches, keep_ratio, cost_inr, what the filter saved, and each backend's cost."""
    n = F.ceil(F.col("kept") / size).cast("long")
    price = PRICES.get(backend, PRICES["gemini"])
    ratio = F.round(F.coalesce(F.col("kept") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0)), 3)
    return counts.withColumn("n_batches", n).withColumn("keep_ratio", ratio).withColumn("cost_inr", F.round(F.col("n_batches") * price, 2)).withColumn("saved_inr", F.round(F.ceil(F.col("total") / size).cast("long") * price - F.col("n_batches") * price, 2)).select("*", *[F.round(F.col("n_batches") * p, 2).alias(f"cost_{k}") for k, p in PRICES.items()])


def unprocessed(frames: DataFrame, done: DataFrame) -> DataFrame:
    """Frames whose (video_id, seq) isn't done: what a resumed run has left."""
    return frames.join(done.select("video_id", "seq").distinct(), ["video_id", "seq"], "left_anti")


def carry_forward(rows: DataFrame, value: str = "depth") -> DataFrame:
    """rows with value's last non-null as carried, by video in order of seq."""
    w = Window.partitionBy("video_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("carried", F.last(value, ignorenulls=True).over(w))
