"""Point cloud files (PCD 0.7) as a Spark data source, read and written.

``spark.dataSource.register(PcdDataSource)``, then ``format("pcd")``. Binary
files are read in byte ranges, one task each; text files as a whole.
"""

from __future__ import annotations

import glob
import os
import shutil
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from ..functions.sequence import dense_ids

#: Bytes of one task's range.
RANGE = 64 << 20
#: Points that a task writes at once.
BLOCK = 1 << 18
_KINDS = {("F", 4): FloatType(), ("F", 8): DoubleType(), ("I", 4): IntegerType(), ("U", 4): LongType(), ("U", 1): IntegerType(), ("U", 2): IntegerType(), ("I", 1): IntegerType(), ("I", 2): IntegerType(), ("I", 8): LongType()}
_CODES = {("F", 4): "<f4", ("F", 8): "<f8", ("I", 1): "<i1", ("I", 2): "<i2", ("I", 4): "<i4", ("I", 8): "<i8", ("U", 1): "<u1", ("U", 2): "<u2", ("U", 4): "<u4", ("U", 8): "<u8"}


def read_header(path: str) -> dict:
    """Fields with their kinds and sizes, number of points, encoding, and where the data begin."""
    found: dict = {}
    with open(path, "rb") as file:
        for line in file:
            key, _, value = line.decode("ascii", "replace").strip().partition(" ")
            if key == "DATA":
                found["data"], found["start"] = value.strip(), file.tell()
                break
            if key and not key.startswith("#"):
                found[key.lower()] = value.split()
    if "data" not in found:
        raise ValueError(f"{path}: no PCD header")
    names, sizes, kinds = found["fields"], list(map(int, found["size"])), found["type"]
    counts = list(map(int, found.get("count", ["1"] * len(names))))
    found["layout"] = list(zip(names, kinds, sizes, counts))
    found["n"] = int(found["points"][0])
    return found


def has_color(path: str) -> bool:
    """Whether a file holds a packed colour."""
    return any(name in ("rgb", "rgba") for name, *_ in read_header(path)["layout"])


def _schema(layout) -> StructType:
    out = [StructField("point_id", LongType())]
    for name, kind, size, _ in layout:
        if name in ("rgb", "rgba"):
            out += [StructField(c, IntegerType()) for c in "rgb"]
        elif name != "_":
            out.append(StructField(name, _KINDS[kind, size]))
    return StructType(out)


class _Range(InputPartition):
    def __init__(self, path: str, first: int, count: int):
        self.path, self.first, self.count = path, first, count


class PcdReader(DataSourceReader):
    def __init__(self, paths: list[str], schema: StructType):
        self.paths, self.wanted = paths, schema

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for path in self.paths:
            head = read_header(path)
            width = sum(s * c for _, _, s, c in head["layout"])
            step = head["n"] if head["data"] == "ascii" else max(RANGE // max(width, 1), 1)
            out += [_Range(path, at, min(step, head["n"] - at)) for at in range(0, head["n"], max(step, 1))]
        return out

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        head = read_header(partition.path)
        layout = head["layout"]
        kind = np.dtype([(f"{n}{i}", _CODES[k, s], (c,) if c > 1 else ()) for i, (n, k, s, c) in enumerate(layout)])
        with open(partition.path, "rb") as file:
            if head["data"] == "binary":
                file.seek(head["start"] + partition.first * kind.itemsize)
                rows = np.frombuffer(file.read(partition.count * kind.itemsize), kind)
                columns = {n: rows[f"{n}{i}"] for i, (n, *_) in enumerate(layout)}
            elif head["data"] == "ascii":
                file.seek(head["start"])
                cells = [line.split() for line in file.read().decode().splitlines() if line.strip()]
                columns = {n: np.array([row[i] for row in cells]).astype(_CODES[k, s]) for i, (n, k, s, _) in enumerate(layout)}
            else:
                raise ValueError(f"{partition.path}: encoding {head['data']} is not supported")
        n = len(next(iter(columns.values()))) if columns else 0
        for name in ("rgb", "rgba"):
            if name in columns:
                packed = np.ascontiguousarray(columns[name]).view(np.uint32)
                columns |= {c: (packed >> shift & 255).astype(np.int32) for c, shift in zip("rgb", (16, 8, 0))}
        columns["point_id"] = np.arange(partition.first, partition.first + n)
        from pyspark.sql.pandas.types import to_arrow_type

        arrays = [pa.array(np.ascontiguousarray(columns[f.name])).cast(to_arrow_type(f.dataType)) for f in self.wanted]
        yield pa.record_batch(arrays, [f.name for f in self.wanted])


def _header(n: int, color: bool, text: bool) -> bytes:
    names, more = "x y z" + " rgb" * color, int(color)
    return (
        f"# .PCD v0.7\nVERSION 0.7\nFIELDS {names}\nSIZE 4 4 4{' 4' * more}\nTYPE F F F{' U' * more}\nCOUNT 1 1 1{' 1' * more}\n"
        f"WIDTH {n}\nHEIGHT 1\nVIEWPOINT 0 0 0 1 0 0 0\nPOINTS {n}\nDATA {'ascii' if text else 'binary'}\n"
    ).encode()


def _kind(color: bool, text: bool) -> np.dtype:
    """A row of a file; in text each number is padded to the longest, so that rows have one length."""
    if not text:
        return np.dtype([(a, "<f4") for a in "xyz"] + [("rgb", "<u4")] * color)
    names = ["x", "y", "z", *["rgb"] * color]
    return np.dtype([f for k, a in enumerate(names) for f in ((a, "S10" if a == "rgb" else "S15"), (f"end{k}", "S1"))])


def _rows(columns: dict[str, np.ndarray], color: bool, text: bool) -> np.ndarray:
    """Rows as they stand in a file; a missing number is NaN."""
    rows = np.zeros(len(columns["x"]), _kind(color, text))
    values = {a: columns[a].astype(np.float32) for a in "xyz"}
    if color:
        r, g, b = (columns[c].astype(np.uint32) for c in "rgb")
        values["rgb"] = r << 16 | g << 8 | b
    for k, (name, value) in enumerate(values.items()):
        if text:
            form = "%10d" if name == "rgb" else "%15.9g"
            rows[name] = [(form % v).encode() for v in value.tolist()]
            rows[f"end{k}"] = b"\n" if k == len(values) - 1 else b" "
        else:
            rows[name] = value
    return rows


def write_cloud(points: DataFrame, path: str, text: bool = False, overwrite: bool = False, block: int = BLOCK) -> int:
    """Writes ``points`` (point_id, x, y, z and perhaps r, g, b) as one file in order of ``point_id``; returns their number.

    All rows of a file have one length, so a point's number tells its place:
    each task writes blocks of points into one file on shared storage, and none
    pass through the driver. A task that runs again writes the same bytes at
    the same place. The file gets its name when every block is in it; after a
    failure nothing is left. Null coordinates become NaN, null colours 0;
    points of equal ``point_id`` are all written; no points give a file without
    any; other columns are ignored.
    """
    if os.path.exists(path) and not overwrite:
        raise FileExistsError(path)
    color = all(c in points.columns for c in "rgb")
    picked = points.select("point_id", *(F.col(a).cast("float").alias(a) for a in "xyz"), *(F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c) for c in "rgb" * color))
    numbered = dense_ids(picked, ["point_id"], "place")
    n, width, target = numbered.count(), _kind(color, text).itemsize, f"{path}.{uuid.uuid4().hex}.part"
    head = _header(n, color, text)

    def put(part: pa.Table) -> pa.Table:
        part = part.sort_by("place")
        with open(target, "r+b") as file:
            file.seek(len(head) + part["place"][0].as_py() * width)
            file.write(_rows({c: part[c].to_numpy() for c in part.column_names}, color, text).tobytes())
        return pa.table({"n": [part.num_rows]})

    try:
        with open(target, "wb") as file:
            file.write(head)
            file.truncate(len(head) + n * width)
        written = numbered.groupBy(F.floor(F.col("place") / block)).applyInArrow(put, "n long").agg(F.sum("n")).first()[0] or 0
        if written != n:
            raise OSError(f"{path}: {written} of {n} points written")
        os.replace(target, path)
    finally:
        if os.path.exists(target):
            os.remove(target)
    return n


class _Part(WriterCommitMessage):
    def __init__(self, path: str, first: float, n: int):
        self.path, self.first, self.n = path, first, n


class PcdWriter(DataSourceArrowWriter):
    """Tasks write bodies beside the target; the commit joins them in order behind one header.

    Rows should come sorted by ``point_id`` over the partitions
    (``repartitionByRange`` and ``sortWithinPartitions``).
    """

    def __init__(self, path: str, ascii_: bool, color: bool, overwrite: bool):
        self.path, self.ascii, self.color = path, ascii_, color
        if os.path.exists(path) and not overwrite:
            raise FileExistsError(path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        part = f"{self.path}.{uuid.uuid4().hex}.part"
        first, n = float("inf"), 0
        with open(part, "wb") as file:
            for batch in iterator:
                columns = {name: batch.column(k).to_numpy(zero_copy_only=False) for k, name in enumerate(batch.schema.names)}
                if batch.num_rows and "point_id" in columns:
                    first = min(first, float(columns["point_id"][0]))
                n += batch.num_rows
                file.write(_rows(columns, self.color, self.ascii).tobytes())
        return _Part(part, first, n)

    def commit(self, messages) -> None:
        parts = sorted((m for m in messages if m), key=lambda m: m.first)
        n = sum(m.n for m in parts)
        with open(self.path, "wb") as out:
            out.write(_header(n, self.color, self.ascii))
            for m in parts:
                with open(m.path, "rb") as file:
                    shutil.copyfileobj(file, out)
        self.abort(messages)

    def abort(self, messages) -> None:
        for m in messages:
            if m and os.path.exists(m.path):
                os.remove(m.path)


class PcdDataSource(DataSource):
    """Options: ``path`` (a file or pattern on shared storage); for writing ``ascii``."""

    @classmethod
    def name(cls) -> str:
        return "pcd"

    def _paths(self) -> list[str]:
        path = self.options["path"].removeprefix("file://")
        return sorted(glob.glob(path)) or [path]

    def schema(self) -> StructType:
        return _schema(read_header(self._paths()[0])["layout"])

    def reader(self, schema: StructType) -> DataSourceReader:
        return PcdReader(self._paths(), schema)

    def writer(self, schema: StructType, overwrite: bool) -> PcdWriter:
        color = all(c in schema.names for c in "rgb")
        return PcdWriter(self.options["path"].removeprefix("file://"), self.options.get("ascii", "false").lower() == "true", color, overwrite)


def pack_rgb(r: int, g: int, b: int) -> float:
    """A packed colour in the bits of a float, as older files hold it."""
    return struct.unpack("<f", struct.pack("<I", r << 16 | g << 8 | b))[0]
