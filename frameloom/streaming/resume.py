"""Exactly-once output that survives a stop at any point, and the progress of stages, as tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys are filed in so many folders by video, and a batch reads those of its own videos only.
BUCKETS = 256


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _bucket(video: str) -> Column:
    return F.pmod(F.xxhash64(video), F.lit(BUCKETS)).cast("int")


class Ledger:
    """A table below path that batches are added to whole and once: rows, the keys that they cover, and a commit for each batch.

    A batch is written to a folder named by its run and id, which a repeated batch overwrites, and counts only when its
    commit is there, which comes last. So a query that is stopped between the two, and started again from its
    checkpoint, writes the batch again. Rows whose key an earlier commit covers are left out, so a run with a new
    checkpoint (under a new run name) adds only what is missing. key begins with the video; of equal keys in a batch any one row stays.
    """

    def __init__(self, spark: SparkSession, path: str, key: tuple[str, ...] = ("video_id", "ms"), run: str = "first"):
        self.spark, self.path, self.key, self.run = spark, path.rstrip("/"), key, run

    def _committed(self, table: str) -> DataFrame | None:
        """Rows of committed batches, with run and batch_id."""
        rows, commits = _read(self.spark, f"{self.path}/{table}"), _read(self.spark, f"{self.path}/commits")
        if rows is None or commits is None:
            return None
        return rows.withColumns({"run": F.col("run").cast("string"), "batch_id": F.col("batch_id").cast("long")}).join(commits.select(F.col("run").cast("string").alias("run"), F.col("batch_id").cast("long").alias("batch_id")), ["run", "batch_id"], "left_semi")

    def rows(self) -> DataFrame | None:
        """All rows of committed batches; None before the first."""
        found = self._committed("rows")
        return None if found is None else found.drop("run", "batch_id")

    def processed(self) -> DataFrame | None:
        """The union of all committed keys, each once."""
        found = self._committed("keys")
        return None if found is None else found.select(*self.key).distinct()

    def unprocessed(self, frames: DataFrame, but: tuple[str, int] | None = None) -> DataFrame:
        """frames whose key no commit covers (not counting the batch `but`). Only the folders of the frames' videos are read; at most BUCKETS numbers come to the driver."""
        found = self._committed("keys")
        if found is None:
            return frames
        if but:
            found = found.where(~((F.col("run") == but[0]) & (F.col("batch_id") == but[1])))
        own = [r["b"] for r in frames.select(_bucket(self.key[0]).alias("b")).distinct().collect()]
        return frames.join(found.where(F.col("bucket").isin(own)).select(*self.key).distinct(), list(self.key), "left_anti")

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """For foreachBatch: writes the batch's new rows and their keys, then its commit."""
        at = f"run={self.run}/batch_id={batch_id}"
        new = self.unprocessed(batch.dropDuplicates(list(self.key)), (self.run, batch_id))
        new.write.mode("overwrite").parquet(f"{self.path}/rows/{at}")
        written = self.spark.read.schema(new.schema).parquet(f"{self.path}/rows/{at}")
        keys = written.select(*self.key, _bucket(self.key[0]).alias("bucket"))
        keys.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/keys/{at}")
        self.commit(batch_id)

    def commit(self, batch_id: int) -> None:
        self.spark.range(1).select(F.current_timestamp().alias("at")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/run={self.run}/batch_id={batch_id}")

    def stream(self, frames: DataFrame, checkpoint: str):
        """Starts a query that adds the stream's rows."""
        return frames.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint).start()


class Progress:
    """What has been done to each video: completed stages and partial results, as rows that are only ever added. The latest row of a key counts; files that can't be read are passed over."""

    SCHEMA = "video_id string, kind string, key string, value string, at timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _add(self, rows: DataFrame) -> None:
        rows.select(F.col("video_id").cast("string").alias("video_id"), "kind", "key", "value", F.current_timestamp().alias("at")).write.mode("append").parquet(self.path)

    def _latest(self) -> DataFrame:
        """One row for each video, kind and key, of all since its last reset."""
        try:
            rows = self.spark.read.schema(self.SCHEMA).option("ignoreCorruptFiles", True).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], self.SCHEMA)
        resets = rows.where("kind = 'reset'").groupBy("video_id").agg(F.max("at").alias("_reset"))
        kept = rows.where("kind <> 'reset'").join(resets, "video_id", "left").where("_reset is null or at > _reset")
        return kept.groupBy("video_id", "kind", "key").agg(F.max_by("value", "at").alias("value"), F.max("at").alias("at"))

    def complete(self, videos: DataFrame, stage: str) -> None:
        """All videos (video_id) have passed the stage."""
        self._add(videos.select("video_id", F.lit("stage").alias("kind"), F.lit(stage).alias("key"), F.lit("").alias("value")).distinct())

    def completed(self, stage: str) -> DataFrame:
        return self._latest().where((F.col("kind") == "stage") & (F.col("key") == stage)).select("video_id")

    def current_stage(self) -> DataFrame:
        """(video_id, stage): the stage that a video has completed last."""
        return self._latest().where("kind = 'stage'").groupBy("video_id").agg(F.max_by("key", F.struct("at", "key")).alias("stage"))

    def remaining(self, rows: DataFrame, stage: str) -> DataFrame:
        """rows of videos that have not passed the stage."""
        done = self.completed(stage).withColumnRenamed("video_id", "_done")
        return rows.join(done, F.col("video_id").cast("string") == F.col("_done"), "left_anti")

    def save(self, results: DataFrame) -> None:
        """results (video_id, key, value): partial results; a later value of a key takes its place."""
        self._add(results.select("video_id", F.lit("result").alias("kind"), "key", F.col("value").cast("string").alias("value")))

    def results(self) -> DataFrame:
        return self._latest().where("kind = 'result'").select("video_id", "key", "value")

    def reset(self, videos: DataFrame) -> None:
        """What was done to these videos no longer counts."""
        self._add(videos.select("video_id", F.lit("reset").alias("kind"), F.lit("").alias("key"), F.lit("").alias("value")).distinct())


def finished_videos(files: DataFrame, name: str = "annotations.json") -> DataFrame:
    """(video_id) of an output listing (path): videos whose folder video_id=<id> has that file."""
    return files.select(F.regexp_extract("path", rf"(?:^|/)video_id=([^/]+)/(?:.*/)?{name.replace('.', '[.]')}$", 1).alias("video_id")).where("video_id <> ''").distinct()
