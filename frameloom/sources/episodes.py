"""Episodes for training as record files: a sink that tasks fill and the driver publishes at once, or not at all."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from frameloom.functions import rasters, records

#: Side of an episode's images and depth maps.
SIDE = 256
KEYS = ("video_id", "segment_id")


@dataclass
class Files(WriterCommitMessage):
    """What one task has written: paths below the job's own folder, and their places below the target."""

    places: tuple[str, ...]
    attempt: str
    records: int


class EpisodeWriter(DataSourceWriter):
    """Each task writes one file an episode into a folder of the job and the attempt; only commit() moves files to where readers look.

    A failed, repeated or speculative attempt leaves nothing that is seen: its folder goes with the job's. Rows of an
    episode must come together (see write_episodes). Paths are those of pyarrow's file systems, so they may be local,
    in HDFS or in an object store; there a move is a copy, as for other committers without a rename.
    """

    def __init__(self, schema: StructType, path: str, overwrite: bool):
        self.schema, self.path, self.overwrite, self.job = schema, path, overwrite, f"_temporary-{uuid.uuid4().hex}"

    def _fs(self):
        from pyarrow import fs

        at = self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}"
        return fs.FileSystem.from_uri(at.replace("file:/", "file:///") if at.startswith("file:/") and not at.startswith("file://") else at)

    def write(self, rows: Iterator[Row]) -> Files:
        fs, base = self._fs()
        context = TaskContext.get()
        attempt = f"{context.partitionId()}-{context.taskAttemptId()}" if context else uuid.uuid4().hex
        places, n, at, out = [], 0, None, None
        names = [f.name for f in self.schema.fields if f.name not in KEYS]
        try:
            for row in rows:
                key = tuple(row[k] for k in KEYS)
                if key != at:
                    if out:
                        out.close()
                    folder = f"video_id={key[0]}"
                    place = f"{folder}/episode_{key[1]:04d}.tfrecord"
                    if place in places:
                        raise ValueError(f"rows of {place} do not come together")
                    fs.create_dir(f"{base}/{self.job}/{attempt}/{folder}")
                    out = fs.open_output_stream(f"{base}/{self.job}/{attempt}/{place}")
                    places.append(place)
                    at = key
                out.write(records.framed(records.example({k: row[k] for k in names})))
                n += 1
        finally:
            if out:
                out.close()
        return Files(tuple(places), attempt, n)

    def commit(self, messages: list[Files | None]) -> None:
        from pyarrow.fs import FileSelector, FileType

        fs, base = self._fs()
        done = [m for m in messages if m is not None]
        if self.overwrite and fs.get_file_info(base).type == FileType.Directory:
            for old in fs.get_file_info(FileSelector(base)):
                if not old.base_name.startswith("_temporary-"):
                    (fs.delete_dir if old.type == FileType.Directory else fs.delete_file)(old.path)
        for folder in sorted({p.rsplit("/", 1)[0] for m in done for p in m.places}):
            fs.create_dir(f"{base}/{folder}")
        for m in done:
            for p in m.places:
                fs.move(f"{base}/{self.job}/{m.attempt}/{p}", f"{base}/{p}")
        fs.create_dir(base)
        with fs.open_output_stream(f"{base}/_SUCCESS") as f:
            f.write(str(sum(m.records for m in done)).encode())
        self._forget(fs, base)

    def abort(self, messages: list[Files | None]) -> None:
        self._forget(*self._fs())

    def _forget(self, fs, base: str) -> None:
        from pyarrow.fs import FileType

        if fs.get_file_info(f"{base}/{self.job}").type == FileType.Directory:
            fs.delete_dir(f"{base}/{self.job}")


class EpisodeSource(DataSource):
    """Sink "episodes": option path; rows have video_id, segment_id and one column for each feature."""

    @classmethod
    def name(cls) -> str:
        return "episodes"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return EpisodeWriter(schema, self.options["path"], overwrite)


def step_features(steps: DataFrame, raster: str = "raster", height: str = "height", width: str = "width", depth: str = "depth") -> DataFrame:
    """Steps of episodes (video_id, segment_id, step, raster and its size, an 8 x 8 or other square depth map or null, action ARRAY, instruction, is_first, is_last) as features.

    Images are 256 x 256 x 3 bytes (greys thrice), depth is 256 x 256 floats or nothing. Steps whose raster can't be read
    are left out; the others keep their step, is_first and is_last. is_terminal is is_last.
    """
    made = "observation/image", "observation/depth"
    rest = ["video_id", "segment_id", "step", "action", "instruction", "is_first", "is_last"]
    rows = steps.select(*rest, raster, height, width, depth)

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            keep, images, maps = [], [], []
            for i, (data, h, w, m) in enumerate(zip(*(b.column(c).to_pylist() for c in (raster, height, width, depth)), strict=True)):
                if (r := rasters.of_bytes(data, h, w)) is None:
                    continue
                keep.append(i)
                images.append(np.repeat(rasters.resized(r, (SIDE, SIDE))[:, :, None], 3, axis=2).tobytes())
                side = int(len(m) ** 0.5) if m else 0
                maps.append(rasters.resized(np.array(m, dtype=np.float32).reshape(side, side), (SIDE, SIDE)).tobytes() if side and side * side == len(m) else b"")
            part = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(images, pa.binary()), pa.array(maps, pa.binary())], [*rest, *made])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = rows.mapInArrow(work, ", ".join([*(f"{c} {kinds[c]}" for c in rest), *(f"`{c}` binary" for c in made)]))
    return out.select("video_id", "segment_id", "step", *[F.col(f"`{c}`") for c in made], F.col("action").cast("array<float>").alias("action"), F.coalesce("instruction", F.lit("")).alias("language_instruction"), "is_first", "is_last", F.col("is_last").alias("is_terminal"))


def write_episodes(features: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One record file an episode below path, a folder a video: steps in order. An episode is written by one task, with one record in memory."""
    spark: SparkSession = features.sparkSession
    spark.dataSource.register(EpisodeSource)
    rows = features.repartition(*KEYS).sortWithinPartitions(*KEYS, "step").drop("step")
    rows.write.format("episodes").mode(mode).option("path", path).save()
