"""Landed frame files as a batch and a stream source, so that raw frames are replayed without loss or repeats."""

from __future__ import annotations

import gzip
import io
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ticklake.sources.line_files import write_lines

FRAMES = "venue string, raw string, recv_ns bigint, mono_ns bigint, arrival_seq bigint, tier string"
NAME = re.compile(r"frames-(\d+)\.jsonl(\.gz|\.zst)?$")
#: Frames that one Arrow batch takes.
BATCH = 10_000


class LandedFile(InputPartition):
    def __init__(self, name: str):
        self.name = name


class FrameReader(DataSourceReader):
    """A partition for each landed file; its lines are read as a stream."""

    def __init__(self, options: dict):
        self.root, self.venue, self.tier = options["path"], options["venue"], options.get("tier", "all")

    def _files(self) -> list[str]:
        """Names of the landed files in landing order: numbers in names grow."""
        store, base = fs.FileSystem.from_uri(self.root)
        found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
        return sorted((f.base_name for f in found if f.type == fs.FileType.File and NAME.match(f.base_name)), key=number)

    def partitions(self) -> list[InputPartition]:
        return [LandedFile(name) for name in self._files()] or [LandedFile("")]

    def read(self, part: LandedFile) -> Iterator[pa.RecordBatch]:
        return frames_of(self.root, part.name, self.venue, self.tier) if part.name else iter(())


class FrameStreamReader(DataSourceStreamReader):
    """As ``FrameReader``, from one offset to another; an offset is the number of the last file taken (-1: none).

    A file is taken whole by one micro-batch. Files must be moved into the folder
    complete, with growing numbers.
    """

    def __init__(self, options: dict):
        self.files = FrameReader(options)

    def initialOffset(self) -> dict:
        return {"file": -1}

    def latestOffset(self) -> dict:
        return {"file": max(map(number, self.files._files()), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [LandedFile(name) for name in self.files._files() if start["file"] < number(name) <= end["file"]]

    def read(self, part: LandedFile) -> Iterator[pa.RecordBatch]:
        return self.files.read(part)

    def commit(self, end: dict) -> None:
        """Landed files stay; retention removes them."""


def number(name: str) -> int:
    return int(NAME.match(name)[1])


def frames_of(root: str, name: str, venue: str, tier: str) -> Iterator[pa.RecordBatch]:
    """Frames of one file; ``arrival_seq`` is the file's number and the line. A line that isn't a frame raises with its place."""
    store, base = fs.FileSystem.from_uri(root)
    schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("bigint") else pa.string()) for c in FRAMES.split(", ")])
    with store.open_input_stream(f"{base}/{name}", compression=None) as raw:
        if name.endswith(".zst"):
            import zstandard

            stream = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
        else:
            stream = gzip.open(raw) if name.endswith(".gz") else raw
        rows: list[tuple] = []
        for line, text in enumerate(io.TextIOWrapper(stream, "utf-8")):
            try:
                frame = json.loads(text)
                rows.append((venue, frame["raw"], int(frame["recv_ns"]), int(frame.get("mono_ns") or 0), (number(name) << 32) + line, tier))
            except (KeyError, TypeError, ValueError) as error:
                raise ValueError(f"{root}/{name}, line {line + 1}: not a frame") from error
            if len(rows) == BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class FrameFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "frame_files"

    def schema(self) -> str:
        return FRAMES

    def reader(self, schema) -> FrameReader:
        return FrameReader(self.options)

    def streamReader(self, schema) -> FrameStreamReader:
        return FrameStreamReader(self.options)


def read_frames(spark: SparkSession, root: str, venue: str, tier: str = "all", stream: bool = False) -> DataFrame:
    """Frames of the files ``frames-N.jsonl`` (plain, .gz or .zst) landed in ``root``, for ``normalize.normalized``."""
    spark.dataSource.register(FrameFiles)
    reader = spark.readStream if stream else spark.read
    return reader.format("frame_files").option("venue", venue).option("tier", tier).option("path", root).load()


def land_frames(frames: DataFrame, root: str, per_file: int) -> None:
    """Write frames (raw, recv_ns, mono_ns, arrival_seq) of one venue as landed files of ``per_file`` arrival numbers each."""
    name = F.concat(F.lit("frames-"), F.expr(f"arrival_seq div {per_file}").cast("string"), F.lit(".jsonl.gz"))
    lines = frames.select(name.alias("path"), F.to_json(F.struct("recv_ns", "mono_ns", "raw")).alias("line"), "arrival_seq")
    write_lines(lines.repartition("path").sortWithinPartitions("path", "arrival_seq"), root)
