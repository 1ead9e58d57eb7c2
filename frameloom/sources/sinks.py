"""Sinks of segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.operators.segments import frames_in

#: The file's columns, in order.
CSV_COLUMNS = (
    "segment_id", "start_time", "end_time", "duration", "action", "description", "objects", "grasp_type", "hand",
    "manipulation_phases", "confidence_avg", "quality_score", "needs_review", "review_reason", "labelling_method",
)


def csv_rows(segs: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """video_id and the columns of the CSV file, one row per segment.

    scores: (video_id, segment_id, quality_score). Lists are joined; what a segment doesn't have is an empty string.
    """
    if scores is None:
        segs = segs.withColumn("quality_score", F.lit(None).cast("double"))
    else:
        segs = segs.join(scores.select("video_id", "segment_id", "quality_score"), ["video_id", "segment_id"], "left")
    given = {
        "objects": F.array_join("objects", "; "),
        "hand": F.col("hand_used"),
        "manipulation_phases": F.array_join("phases", " -> "),
        **{c: F.col(c) if c in segs.columns else F.lit("") for c in ("description", "labelling_method")},
    }
    return segs.select("video_id", *[F.coalesce(given.get(c, F.col(c)).cast("string"), F.lit("")).alias(c) for c in CSV_COLUMNS])


def write_csv(segs: DataFrame, path: str, scores: DataFrame | None = None) -> None:
    """CSV files with a header under path, a folder per video; rows of a file are in the order of segments."""
    rows = csv_rows(segs, scores).repartition("video_id").sortWithinPartitions("video_id", F.col("segment_id").cast("long"))
    rows.write.partitionBy("video_id").option("header", True).option("escape", '"').option("emptyValue", "").mode("overwrite").csv(path)


def write_timeline(lines: DataFrame, path: str) -> None:
    """Text files of a timeline, a folder per video: lines (video_id, segment_id, line) in the order of segments, or (video_id, place, line) of segments.timeline_text()."""
    rows = lines.repartition("video_id").sortWithinPartitions("video_id", "place" if "place" in lines.columns else "segment_id")
    rows.select("video_id", F.col("line").alias("value")).write.partitionBy("video_id").mode("overwrite").text(path)


def review_documents(queue: DataFrame, frames: DataFrame) -> DataFrame:
    """queue (video_id, segment_id, action, review_reason, start_time, end_time) as rows for JSON, each with the paths of its frames in order of time."""
    shown = frames_in(queue.select("video_id", "segment_id", "start_time", "end_time"), frames.select("video_id", "ts", "frame_path"))
    paths = shown.groupBy("video_id", "segment_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "frame_path"))), lambda x: x["frame_path"]).alias("frame_paths"))
    return queue.join(paths, ["video_id", "segment_id"], "left").withColumn("frame_paths", F.coalesce("frame_paths", F.expr("cast(array() as array<string>)")))


def write_json(rows: DataFrame, path: str) -> None:
    """JSON lines under path, a folder per video where rows have a video_id. For review_documents(), confused pairs and class mappings."""
    (rows.write.partitionBy("video_id") if "video_id" in rows.columns else rows.write).option("ignoreNullFields", False).mode("overwrite").json(path)


def write_steps(steps: DataFrame, path: str) -> None:
    """Episode steps as Parquet, a folder per video, in order within it."""
    steps.repartition("video_id").sortWithinPartitions("video_id", "segment_id", "step").write.partitionBy("video_id").mode("overwrite").parquet(path)
