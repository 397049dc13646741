"""Growing recordings as streams: folders of point cloud files, and text tables that are appended to.

Both are Python data sources on storage that driver and executors mount alike.
Offsets are durable positions (a file name, a byte), so Spark's checkpoint can
plan the same batch again after a restart.
"""

from __future__ import annotations

import io
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import FloatType, StructField, StructType

from ..sources.pcd import PcdReader, _Range, read_header

SCANS = "session_id long, index long, x array<float>, y array<float>, z array<float>, ends boolean"
_XYZ = StructType([StructField(a, FloatType()) for a in "xyz"])
#: Bytes of a growing table that one task reads.
RANGE = 32 << 20


class _Scan(InputPartition):
    def __init__(self, path: str, name: str):
        self.path, self.name = path, name


class _ScanFiles:
    """Files of a folder in the order of their names, and one row for each."""

    def __init__(self, folder: str, session: int):
        self.folder, self.session = folder, session

    def names(self) -> list[str]:
        return sorted(n for n in os.listdir(self.folder) if n.endswith(".pcd")) if os.path.isdir(self.folder) else []

    def row(self, part: _Scan) -> pa.RecordBatch:
        number = re.search(r"(\d+)\D*$", part.name)
        if number is None:
            raise ValueError(f"{part.name}: a scan's file name ends in its number")
        head = read_header(part.path)
        points = list(PcdReader([part.path], _XYZ).read(_Range(part.path, 0, head["n"]))) if head["n"] else []
        of = {a: np.concatenate([b.column(k).to_numpy() for b in points]) if points else np.zeros(0, np.float32) for k, a in enumerate("xyz")}
        columns = {"session_id": pa.array([self.session], pa.int64()), "index": pa.array([int(number[1])], pa.int64())}
        columns |= {a: pa.array([v.astype(np.float32)], pa.list_(pa.float32())) for a, v in of.items()}
        return pa.RecordBatch.from_pydict({**columns, "ends": pa.array([False])})


class ScanReader(_ScanFiles, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return [_Scan(os.path.join(self.folder, n), n) for n in self.names()]

    def read(self, partition: _Scan) -> Iterator[pa.RecordBatch]:
        yield self.row(partition)


class ScanStreamReader(_ScanFiles, DataSourceStreamReader):
    """The offset is the name of the last file taken; a file must appear whole (by renaming) and after those before it in name."""

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        return {"after": max(self.names(), default="")}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Scan(os.path.join(self.folder, n), n) for n in self.names() if start["after"] < n <= end["after"]]

    def read(self, partition: _Scan) -> Iterator[pa.RecordBatch]:
        yield self.row(partition)


class ScanDataSource(DataSource):
    """``format("scans")``: one row for each point cloud file of the folder ``path``; option ``session`` (0) is its session's number.

    The number at the end of a file's name is the scan's index. A batch read
    gives the same rows as a stream.
    """

    @classmethod
    def name(cls) -> str:
        return "scans"

    def schema(self) -> str:
        return SCANS

    def _of(self) -> tuple[str, int]:
        return self.options["path"].removeprefix("file://"), int(self.options.get("session", "0"))

    def reader(self, schema: StructType) -> DataSourceReader:
        return ScanReader(*self._of())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return ScanStreamReader(*self._of())


class _Bytes(InputPartition):
    def __init__(self, begin: int, end: int):
        self.begin, self.end = begin, end


class _GrowingFile:
    def __init__(self, path: str, schema: StructType, header: bool, span: int):
        self.path, self.wanted, self.header, self.span = path, schema, header, span

    def whole_lines(self) -> int:
        """Bytes up to the end of the last whole line; a line that is being written stays for later."""
        if not os.path.exists(self.path):
            return 0
        with open(self.path, "rb") as file:
            at = file.seek(0, os.SEEK_END)
            while at > 0:
                begin = max(0, at - (1 << 16))
                file.seek(begin)
                found = file.read(at - begin).rfind(b"\n")
                if found >= 0:
                    return begin + found + 1
                at = begin
        return 0

    def cut(self, begin: int, end: int) -> list[InputPartition]:
        return [_Bytes(at, min(at + self.span, end)) for at in range(begin, end, self.span)]

    def lines(self, part: _Bytes) -> Iterator[pa.RecordBatch]:
        """The lines that begin in a range, read to the end of the last of them."""
        from pyspark.sql.pandas.types import to_arrow_schema

        with open(self.path, "rb") as file:
            file.seek(max(part.begin - 1, 0))
            if part.begin:
                file.readline()  # ends where the first line of this range begins
            elif self.header:
                file.readline()
            begin = file.tell()
            if begin >= part.end:
                return
            data = file.read(part.end - begin)
            if not data.endswith(b"\n"):
                data += file.readline()
        schema = to_arrow_schema(self.wanted)
        read = pacsv.ReadOptions(column_names=schema.names, block_size=1 << 24)
        convert = pacsv.ConvertOptions(column_types={f.name: f.type for f in schema})
        yield from pacsv.read_csv(io.BytesIO(data), read, pacsv.ParseOptions(ignore_empty_lines=True), convert).to_batches()


class TailReader(_GrowingFile, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return self.cut(0, self.whole_lines())

    def read(self, partition: _Bytes) -> Iterator[pa.RecordBatch]:
        yield from self.lines(partition)


class TailStreamReader(_GrowingFile, DataSourceStreamReader):
    """The offset is a byte at the begin of a line."""

    def initialOffset(self) -> dict:
        return {"byte": 0}

    def latestOffset(self) -> dict:
        return {"byte": self.whole_lines()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.cut(start["byte"], end["byte"])

    def read(self, partition: _Bytes) -> Iterator[pa.RecordBatch]:
        yield from self.lines(partition)


class TailDataSource(DataSource):
    """``format("growing_csv")`` with a schema: the whole lines of one text table that is appended to.

    Options: ``path``, ``header`` (true), ``span`` (bytes of a task). A line
    that does not fit the schema fails the read. Long files are cut into ranges
    of bytes that agree on lines.
    """

    @classmethod
    def name(cls) -> str:
        return "growing_csv"

    def schema(self) -> StructType:
        raise ValueError("growing_csv needs a schema")

    def _of(self, schema: StructType) -> tuple:
        return self.options["path"].removeprefix("file://"), schema, self.options.get("header", "true").lower() == "true", int(self.options.get("span", str(RANGE)))

    def reader(self, schema: StructType) -> DataSourceReader:
        return TailReader(*self._of(schema))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return TailStreamReader(*self._of(schema))
