"""A sink for frames that are numbered by what was saved, not by what was tried.

Every n-th message of a session is a frame. Its image is encoded and written;
one that fails takes no number, so the files ``prefix_000000.png``,
``prefix_000001.png``, ... have no gap. An epoch works in two phases: tasks
write each image under a name of its own and report whether that went well;
then successes are numbered after those of the epochs before, and files get
their names by renaming. What an epoch starts from is the state that the epoch
before it left, so a repeated epoch gives the same names and rows.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import settled
from ..functions.color import frame_name
from ..functions.sequence import dense_ids
from ..sources import tables
from ..sources.png import encode_png

STATE = "session_id long, seen long, saved long"
#: What a frame's image may be: raw bytes of rows of pixels, with 1 (grey) or 3 (colour) channels.
FRAMES = "session_id long, index long, timestamp_sec long, timestamp_nanosec long, width int, height int, encoding string, data binary"


def encoded_frame(width: int, height: int, encoding: str, data: bytes) -> bytes:
    """A frame as an uncompressed image file; raises where its bytes do not fit its size or its encoding is unknown."""
    channels = {"rgb8": 3, "bgr8": 3, "mono8": 1}[encoding]
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return encode_png(pixels[:, :, 0] if channels == 1 else pixels[:, :, ::-1] if encoding == "bgr8" else pixels)


class NumberedSink:
    """Keeps every ``interval``-th message of each session in tables below ``path``; ``update`` is for ``foreachBatch``.

    ``index/<epoch>`` holds the kept messages with their number ``saved``,
    ``state/<epoch>`` one row for each session: messages seen and saved so far.
    """

    columns: tuple[str, ...] = ()

    def __init__(self, path: str, interval: int):
        if interval < 1:
            raise ValueError("interval must be at least 1")
        self.path, self.interval = path, interval

    def _state(self, spark: SparkSession, epoch: int) -> DataFrame:
        return spark.read.schema(STATE).parquet(f"{self.path}/state/{epoch}") if epoch >= 0 else spark.createDataFrame([], STATE)

    def _save(self, chosen: DataFrame, epoch: int) -> DataFrame:
        """The rows of ``chosen`` that were saved."""
        return chosen

    def _finish(self, numbered: DataFrame, epoch: int) -> None:
        """Called with the saved rows and their numbers before they are recorded."""

    def _named(self, numbered: DataFrame) -> DataFrame:
        return numbered

    def update(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = self._state(spark, epoch - 1)
        placed = dense_ids(batch, ["index"], "__place", partition_by=["session_id"])
        known = placed.join(before, "session_id", "left").na.fill(0, ["seen", "saved"])
        chosen = known.where((F.col("seen") + F.col("__place") + 1) % self.interval == 0)
        done = settled(self._save(chosen, epoch))
        numbered = dense_ids(done, ["index"], "__number", partition_by=["session_id"])
        numbered = settled(numbered.withColumn("saved", F.col("saved") + F.col("__number")).drop("__place", "__number", "seen"))
        self._finish(numbered, epoch)
        self._named(numbered).select("session_id", "index", "saved", *self.columns).write.mode("overwrite").parquet(f"{self.path}/index/{epoch}")
        counts = batch.groupBy("session_id").agg(F.count("*").alias("seen")).withColumn("saved", F.lit(0).cast("long"))
        new = numbered.groupBy("session_id").agg(F.lit(0).cast("long").alias("seen"), F.count("*").alias("saved"))
        both = before.unionByName(counts).unionByName(new).groupBy("session_id").agg(F.sum("seen").alias("seen"), F.sum("saved").alias("saved"))
        both.write.mode("overwrite").parquet(f"{self.path}/state/{epoch}")

    def saved(self, spark: SparkSession, epoch: int) -> DataFrame:
        """All kept messages up to an epoch."""
        return spark.read.parquet(*[f"{self.path}/index/{e}" for e in range(epoch + 1)])


class OdomSink(NumberedSink):
    """Every n-th pose message; the final table is written only if there is one."""

    columns = ("timestamp_sec", "timestamp_nanosec", "px", "py", "pz", "qx", "qy", "qz", "qw")

    def export(self, spark: SparkSession, epoch: int, session: int, path: str) -> bool:
        rows = self.saved(spark, epoch).where(F.col("session_id") == session).withColumn("index", F.col("saved").cast("int"))
        if rows.isEmpty():
            return False
        tables.write_odom(rows.orderBy("index").coalesce(1), path)
        return True


class FrameSink(NumberedSink):
    """Every n-th frame as ``images/<session>/<prefix>_<number>.png``, on storage that executors share."""

    columns = ("filename", "timestamp_sec", "timestamp_nanosec")

    def __init__(self, path: str, interval: int, prefix: str = "frame", encode: Callable[..., bytes] = encoded_frame):
        super().__init__(path, interval)
        self.prefix, self.encode = prefix, encode

    def _folder(self, session: int) -> str:
        return os.path.join(self.path.removeprefix("file://"), "images", str(session))

    def _save(self, chosen: DataFrame, epoch: int) -> DataFrame:
        encode, folder = self.encode, self._folder

        def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in batches:
                went = []
                for row in part.itertuples(index=False):
                    os.makedirs(folder(row.session_id), exist_ok=True)
                    name = os.path.join(folder(row.session_id), f".{epoch}-{row.at}")
                    try:
                        data = encode(row.width, row.height, row.encoding, bytes(row.data))
                        with open(f"{name}.{os.getpid()}", "wb") as file:
                            file.write(data)
                        os.replace(f"{name}.{os.getpid()}", name)
                        went.append(True)
                    except (KeyError, ValueError, TypeError, OSError):  # this frame is not saved, the others are
                        went.append(False)
                yield part[["session_id", "at", "timestamp_sec", "timestamp_nanosec", "saved"]].assign(went=went)

        renamed = chosen.withColumnRenamed("index", "at")  # a tuple has a method ``index``
        needed = renamed.select("session_id", "at", "timestamp_sec", "timestamp_nanosec", "saved", "width", "height", "encoding", "data")
        kinds = "session_id long, at long, timestamp_sec long, timestamp_nanosec long, saved long, went boolean"
        found = needed.mapInPandas(write, kinds).where("went").withColumnRenamed("at", "index")
        return found.select("session_id", "index", "timestamp_sec", "timestamp_nanosec", "saved", F.lit(0).alias("seen"), F.lit(0).alias("__place"))

    def _finish(self, numbered: DataFrame, epoch: int) -> None:
        folder = self._folder

        def rename(rows: Iterator[Row]) -> None:
            for row in rows:
                old, new = (os.path.join(folder(row.session_id), n) for n in (f".{epoch}-{row['index']}", row["filename"]))
                if os.path.exists(old):  # else a task before this one renamed it
                    os.replace(old, new)

        self._named(numbered).select("session_id", "index", "filename").foreachPartition(rename)

    def _named(self, numbered: DataFrame) -> DataFrame:
        return numbered.withColumn("filename", frame_name(self.prefix, F.col("saved")))

    def update(self, batch: DataFrame, epoch: int) -> None:
        super().update(batch.select(*(c.split()[0] for c in FRAMES.split(", "))), epoch)

    def export(self, spark: SparkSession, epoch: int, session: int, path: str) -> bool:
        """Writes the table of saved frames of a session; none if there are none."""
        rows = self.saved(spark, epoch).where(F.col("session_id") == session).withColumn("index", F.col("saved").cast("int"))
        if rows.isEmpty():
            return False
        tables.write_image_index(rows.orderBy("index").coalesce(1), path)
        return True
