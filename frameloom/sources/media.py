"""Sources around videos: camera manifests, probe output, label files, and which files are videos."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions.values import fourcc

#: Video files by extension, in order of preference for the first four.
VIDEO_EXTENSIONS = ("mp4", "avi", "mkv", "mov", "webm", "flv")
PROBE = "struct<streams:array<struct<codec_type:string,r_frame_rate:string,duration:string,width:int,height:int,codec_name:string>>,format:struct<duration:string>>"
SEGMENT = "struct<start_time:double,end_time:double,action:string,confidence_avg:double,confidence:double>"


def camera_frames(manifest: DataFrame, frames: DataFrame) -> DataFrame:
    """manifest (cameras: array of (video_id, mount), sync_offset_ms: array) and frames: the frames of all cameras with camera, mount and ts moved by the offset; missing offsets are 0, cameras without frames are left out."""
    cams = manifest.select("sync_offset_ms", F.posexplode("cameras").alias("camera", "c"))
    cams = cams.select(F.col("camera").cast("long").alias("camera"), "c.video_id", F.coalesce("c.mount", F.concat(F.lit("cam"), F.col("camera").cast("string"))).alias("mount"), (F.coalesce(F.get("sync_offset_ms", "camera"), F.lit(0)) / 1000.0).alias("_offset"))
    return frames.join(F.broadcast(cams), "video_id").withColumn("ts", F.col("ts") + F.col("_offset")).drop("_offset")


def probe_metadata(rows: DataFrame, column: str = "probe") -> DataFrame:
    """rows with the first video stream's duration, fps, width, height, resolution and codec; error where there is none."""
    p = rows.withColumn("_p", F.from_json(column, PROBE))
    v = p.withColumn("_v", F.get(F.filter("_p.streams", lambda s: s["codec_type"] == "video"), F.lit(0)))
    rate = F.split(F.coalesce("_v.r_frame_rate", F.lit("0/1")), "/")
    num, den = F.get(rate, F.lit(0)).cast("double"), F.get(rate, F.lit(1)).cast("double")
    there = F.col("_v").isNotNull()
    w, h = F.coalesce("_v.width", F.lit(0)), F.coalesce("_v.height", F.lit(0))
    made = {
        "duration": F.coalesce(F.col("_v.duration").cast("double"), F.col("_p.format.duration").cast("double"), F.lit(0.0)),
        "fps": F.round(F.when(den == 0, 0.0).otherwise(F.try_divide(num, den)), 2), "width": w.cast("long"), "height": h.cast("long"),
        "resolution": F.concat(w.cast("string"), F.lit("x"), h.cast("string")), "codec": F.coalesce("_v.codec_name", F.lit("unknown")),
    }
    return v.select(*rows.columns, *[F.when(there, c).alias(k) for k, c in made.items()], F.when(~there, "no video stream").alias("error"))


def counted_metadata(rows: DataFrame) -> DataFrame:
    """rows (frame_count, fps, width, height, code) of videos that can't be probed, with duration (0 without a rate), resolution and codec, the code's four characters."""
    made = {"duration": F.when(F.col("fps") > 0, F.col("frame_count") / F.col("fps")).otherwise(0.0), "resolution": F.concat(F.col("width").cast("string"), F.lit("x"), F.col("height").cast("string")), "codec": fourcc(F.col("code"))}
    return rows.withColumns(made)


def video_files(files: DataFrame) -> DataFrame:
    """files (path) that are videos by their extension, in order of path."""
    return files.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*VIDEO_EXTENSIONS)).orderBy("path")


def label_samples(spark: SparkSession, folder: str) -> DataFrame:
    """One row per segment of all *_labels.json files below folder: video_path, start_time, end_time, action, confidence.

    Files that can't be read are left out. A file without video_path takes the video beside it, the first by extension.
    """
    schema = f"video_path string, segments array<{SEGMENT}>"
    files = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).option("pathGlobFilter", "*_labels.json").json(folder)
    rows = files.withColumn("_file", F.input_file_name()).withColumn("_dir", F.regexp_replace("_file", "/[^/]+$", ""))
    beside = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    rank = F.array_position(F.array(*map(F.lit, VIDEO_EXTENSIONS[:4])), ext)
    beside = beside.where(rank > 0).groupBy(F.regexp_replace("path", "/[^/]+$", "").alias("_dir")).agg(F.min_by("path", F.struct(rank, "path")).alias("_beside"))
    found = rows.join(beside, F.regexp_replace(rows["_dir"], "^file:/+", "/") == F.regexp_replace(beside["_dir"], "^file:/+", "/"), "left")
    seg = found.select(F.coalesce("video_path", "_beside").alias("video_path"), F.explode("segments").alias("s"))
    return seg.select("video_path", F.coalesce("s.start_time", F.lit(0.0)).alias("start_time"), F.coalesce("s.end_time", F.lit(0.0)).alias("end_time"), F.coalesce("s.action", F.lit("unknown")).alias("action"), F.coalesce("s.confidence_avg", "s.confidence", F.lit(0.0)).alias("confidence"))
