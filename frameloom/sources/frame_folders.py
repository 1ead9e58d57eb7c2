"""Frames from folders of files named by their time, alone or as the cameras of a manifest: a source that filters before it reads."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

#: Fixed value: how a frame's file is named, by milliseconds.
NAME = re.compile(r"frame_(\d+)\.(jpg|jpeg|png|pgm)$")
SCHEMA = "video_id string, camera int, mount string, kind string, seq long, ms long, ts double, frame_path string, content binary, raster binary, height int, width int"
#: Files that one task reads, unless option files says otherwise.
FILES = 2000


def grey(data: bytes) -> tuple[bytes | None, int | None, int | None]:
    """Raster, height and width of a plain grey map (PGM, one byte a pixel); Nones for anything else."""
    head = re.match(rb"P5(?:\s+(?:#[^\n]*\n)?)+(\d+)\s+(\d+)\s+(\d+)\s", data or b"")
    if not head or int(head[3]) > 255:
        return None, None, None
    w, h = int(head[1]), int(head[2])
    body = bytes(data[head.end() : head.end() + w * h])
    return (body, h, w) if w and h and len(body) == w * h else (None, None, None)


@dataclass
class Part(InputPartition):
    """Some files of one camera."""

    video_id: str
    camera: int
    mount: str
    kind: str
    offset: int
    paths: list[tuple[int, int, str]] = field(default_factory=list)


class FolderReader(DataSourceReader):
    """Lists each camera's folder once, on the driver: names and times only. What is pushed down drops videos before they are listed and files before they are opened."""

    def __init__(self, options: dict):
        self.path, self.options = options["path"].rstrip("/"), options
        self.stride, self.files = max(1, int(options.get("stride", 1))), max(1, int(options.get("files", FILES)))
        self.load = options.get("content", "true").lower() == "true"
        self.videos: set[str] | None = None
        self.low, self.high = float("-inf"), float("inf")
        self.open_low = self.open_high = False

    def _fs(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path if "://" in self.path else "file://" + self.path.removeprefix("file:"))

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes comparisons of ts and equality of video_id; hands the others back."""
        for f in filters:
            name = ".".join(f.attribute) if hasattr(f, "attribute") else None
            if name == "video_id" and isinstance(f, (EqualTo, In)):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.videos = wanted if self.videos is None else self.videos & wanted
            elif name == "ts" and isinstance(f, (LessThan, LessThanOrEqual)) and (f.value, isinstance(f, LessThanOrEqual)) < (self.high, not self.open_high):
                self.high, self.open_high = f.value, isinstance(f, LessThan)
            elif name == "ts" and isinstance(f, (GreaterThan, GreaterThanOrEqual)) and (f.value, isinstance(f, GreaterThan)) > (self.low, self.open_low):
                self.low, self.open_low = f.value, isinstance(f, GreaterThan)
            elif not (name == "ts" and isinstance(f, (LessThan, LessThanOrEqual, GreaterThan, GreaterThanOrEqual))):
                yield f

    def _wanted(self, ms: int) -> bool:
        ts = ms / 1000
        return (self.low < ts or self.low == ts and not self.open_low) and (ts < self.high or ts == self.high and not self.open_high)

    def _cameras(self, fs, base: str) -> Iterator[tuple[str, str, int, str, str, int]]:
        """(folder, video_id, camera, mount, kind, offset) of each camera: those of the manifest, or every folder below the path."""
        from pyarrow.fs import FileSelector, FileType

        if name := self.options.get("manifest"):
            with fs.open_input_stream(f"{base}/{name}") as f:
                manifest = json.loads(f.read())
            offsets = manifest.get("sync_offset_ms") or []
            for i, cam in enumerate(manifest.get("cameras") or []):
                yield f"{base}/{cam['file']}", cam["file"], i, cam.get("mount") or f"cam{i}", cam.get("type") or "", int(offsets[i]) if i < len(offsets) and offsets[i] is not None else 0
            return
        for x in sorted(fs.get_file_info(FileSelector(base)), key=lambda x: x.base_name):
            if x.type == FileType.Directory and not x.base_name.startswith(("_", ".")):
                yield x.path, x.base_name, 0, "", "", 0

    def partitions(self) -> list[Part]:
        from pyarrow.fs import FileSelector, FileType

        fs, base = self._fs()
        out = []
        for folder, video, camera, mount, kind, offset in self._cameras(fs, base):
            if self.videos is not None and video not in self.videos:
                continue
            if fs.get_file_info(folder).type != FileType.Directory:
                continue  # a camera that isn't there has no frames
            found = sorted((int(m[1]), x.path) for x in fs.get_file_info(FileSelector(folder)) if x.type == FileType.File and (m := NAME.search(x.base_name)))
            kept = [(seq, ms, path) for seq, (ms, path) in enumerate(found) if seq % self.stride == 0 and self._wanted(ms + offset)]
            for at in range(0, len(kept), self.files):
                out.append(Part(video, camera, mount, kind, offset, kept[at : at + self.files]))
        return out or [Part("", 0, "", "", 0)]

    def read(self, part: Part) -> Iterator[tuple]:
        fs, _ = self._fs()
        for seq, ms, path in part.paths:
            data = None
            if self.load:
                try:
                    with fs.open_input_stream(path) as f:
                        data = f.read()
                except OSError:
                    data = None  # a file that went away, or can't be read, is a frame that can't be read
            yield part.video_id, part.camera, part.mount, part.kind, seq, ms + part.offset, (ms + part.offset) / 1000, path, data, *grey(data)


class FrameFolders(DataSource):
    """Source "frame_folders". Options: path (a folder with one folder of frames a video), manifest (a file below path that names the cameras' folders and their offsets in ms), stride (every n-th frame), content (false: names and times only), files (most files of a task).

    Frames are named frame_<ms>.<type>; other files are passed over. Set spark.sql.python.filterPushdown.enabled so that
    conditions on ts (a duration, say) and video_id reach the listing.
    """

    @classmethod
    def name(cls) -> str:
        return "frame_folders"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FolderReader(self.options)
