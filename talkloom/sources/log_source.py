"""A data source of line logs: files of lines that are still written to, in batch and as a stream.

``spark.read.format("linelog")`` splits files into byte ranges; a line belongs
to the range in which it starts.  Files keep the order in which they are given.
As a stream, a file's offset is the number of bytes up to its last finished
line, so a log may grow while it is read: an unfinished line waits for its end.
A line that isn't UTF-8 comes with a word about the damage and what can be read
of it, and costs no other line.

Options: ``paths`` (a JSON list) or ``path``; ``split``, the bytes of a range.
Files are opened where Arrow's file systems reach: local paths, HDFS, S3, GCS.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "file_number int, file string, start long, line string, damage string"
SPLIT = 64 << 20
#: Bytes that are read at once, and lines that are handed on at once.
BLOCK, LINES = 1 << 20, 4096


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it; Hadoop's names of S3 are Arrow's own."""
    scheme, found, rest = path.partition("://")
    if not found:
        return (fs.LocalFileSystem(), path.removeprefix("file:"))
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


def listed(paths: list[str]) -> list[tuple[int, str, int]]:
    """(number of the given path, file, bytes); a folder stands for its files by name, without hidden ones."""
    out = []
    for number, path in enumerate(paths):
        files, where = opened(path)
        info = files.get_file_info(where)
        prefix = path[: len(path) - len(where)] if path.endswith(where) else ""
        if info.type == fs.FileType.Directory:
            inside = [i for i in files.get_file_info(fs.FileSelector(where)) if i.type == fs.FileType.File and i.base_name[0] not in "._"]
            out += [(number, prefix + i.path, i.size) for i in sorted(inside, key=lambda i: i.path)]
        elif info.type == fs.FileType.File:
            out.append((number, path, info.size))
        else:
            raise FileNotFoundError(path)
    return out


class Lines(InputPartition):
    """A byte range of a file; ``end`` is that of the file as far as it is to be read."""

    def __init__(self, number: int, path: str, low: int, high: int, end: int):
        self.number, self.path, self.low, self.high, self.end = number, path, low, high, end


def ranges(number: int, path: str, low: int, end: int, split: int) -> list[Lines]:
    return [Lines(number, path, at, min(at + split, end), end) for at in range(low, end, split)]


def lines_of(part: Lines, first: int) -> Iterator[tuple[int, bytes]]:
    """(start, line) of the lines that start in the range; ``first`` is a place where a line is known to start."""
    files, where = opened(part.path)
    with files.open_input_file(where) as f:
        # a line starts at the range's first byte if the byte before ends one
        skip = part.low > first
        at = part.low - skip
        f.seek(at)
        pieces, held = [], 0
        while block := f.read(min(BLOCK, part.end - at - held)):
            *whole, last = block.split(b"\n")
            for line in whole:
                if pieces:
                    line, pieces, held = b"".join([*pieces, line]), [], 0
                if not skip:
                    yield at, line
                skip = False
                at += len(line) + 1
                if at >= part.high:
                    return
            if last:
                pieces.append(last)
                held += len(last)
            if skip and at + held >= part.high:
                return  # the range lies within one line
        if pieces and not skip:
            yield at, b"".join(pieces)


def batches(found: Iterator[tuple[int, bytes]], part: Lines) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file_number", pa.int32()), ("file", pa.string()), ("start", pa.int64()), ("line", pa.string()), ("damage", pa.string())])
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for start, raw in found:
        raw = raw.removesuffix(b"\r")
        try:
            line, damage = raw.decode(), None
        except UnicodeDecodeError as e:
            line, damage = raw.decode(errors="replace"), f"not UTF-8 at byte {e.start}"
        rows.append((part.number, part.path, start, line, damage))
        if len(rows) == LINES:
            yield out()
            rows.clear()
    if rows:
        yield out()


class LineLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "linelog"

    def schema(self) -> str:
        return SCHEMA

    def given(self) -> list[str]:
        return json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]

    def split(self) -> int:
        return int(self.options.get("split", SPLIT))

    def reader(self, schema) -> DataSourceReader:
        return LineReader(self.given(), self.split())

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return LineStream(self.given(), self.split())


class LineReader(DataSourceReader):
    """All lines of the files; the last one counts without an end too."""

    def __init__(self, paths: list[str], split: int):
        self.paths, self.split = paths, split

    def partitions(self) -> list[Lines]:
        return [r for number, path, size in listed(self.paths) for r in ranges(number, path, 0, size, self.split)]

    def read(self, partition: Lines) -> Iterator[pa.RecordBatch]:
        return batches(lines_of(partition, 0), partition)


class LineStream(DataSourceStreamReader):
    """Finished lines as they come; offsets are bytes by file, in the order given."""

    def __init__(self, paths: list[str], split: int):
        self.paths, self.split = paths, split

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        return {path: [number, finished(path, size)] for number, path, size in listed(self.paths)}

    def partitions(self, start: dict, end: dict) -> list[Lines]:
        out = []
        for path, (number, upto) in end.items():
            low = start[path][1] if path in start else 0
            if upto < low:
                raise ValueError(f"{path} has shrunk")
            parts = ranges(number, path, low, upto, self.split)
            for p in parts:
                p.first = low
            out += parts
        return out

    def read(self, partition: Lines) -> Iterator[pa.RecordBatch]:
        return batches(lines_of(partition, partition.first), partition)

    def commit(self, end: dict) -> None:
        pass


def finished(path: str, size: int) -> int:
    """Bytes up to the end of the last finished line."""
    files, where = opened(path)
    with files.open_input_file(where) as f:
        at = size
        while at > 0:
            low = max(0, at - BLOCK)
            f.seek(low)
            place = f.read(at - low).rfind(b"\n")
            if place >= 0:
                return low + place + 1
            at = low
    return 0


def read_lines(spark: SparkSession, paths: str | list[str], split: int = SPLIT, stream: bool = False) -> DataFrame:
    """(file_number, file, start, line, damage), in batch or as a stream; order is by file number, file and start."""
    spark.dataSource.register(LineLog)
    given = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.readStream if stream else spark.read
    return reader.format("linelog").option("paths", json.dumps(given)).option("split", str(split)).load()


def parsed(lines: DataFrame, schema: str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of the lines that are JSON objects (and have the key), with ``pos``; and the others
    (pos, line, damage) that aren't blank, with what is wrong with them."""
    from .jsonl import is_object, strip

    pos = F.struct("file_number", "file", "start").alias("pos")
    told = lines.where(strip("line") != "").select(pos, "line", "damage", is_object("line").alias("_object"), F.from_json("line", schema).alias("_row"))
    lacking = F.lit(False) if key is None else F.col("_row")[key].isNull()
    wrong = F.when(F.col("damage").isNotNull(), F.col("damage")).when(~F.col("_object"), "no JSON object").when(lacking, f"no {key}")
    judged = told.withColumn("_wrong", wrong)
    rows = judged.where("_wrong is null").select("pos", "_row.*")
    return rows, judged.where("_wrong is not null").select("pos", "line", F.col("_wrong").alias("damage"))
