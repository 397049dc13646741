"""A whole capture: five chained streaming queries under one manager.

scans -> accumulator -> table of batches -> live map; odometry -> paths and
saved poses; frames -> numbered images. Each query has its own checkpoint and
goes on from it after a restart; the table between accumulator and map is a
Parquet table written exactly once, so the two need not run at the same time.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.sequence import dense_ids
from ..sources.config import CaptureConfig
from ..sources.pcd import PcdDataSource
from . import accumulate, capture
from .frames import FrameSink, OdomSink
from .sources import SCANS

ODOM = "session_id long, index long, timestamp_sec long, timestamp_nanosec long, px double, py double, pz double, qx double, qy double, qz double, qw double"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def finished_epochs(spark: SparkSession, folder: str) -> list[int]:
    """Epochs whose table below ``folder`` was written to its end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath() for s in fs.listStatus(path)]
    return sorted(int(p.getName()) for p in names if p.getName().isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


class Capture:
    """The five queries of a capture below ``config.output_dir``, which driver and executors share.

    ``scans``, ``odom`` and ``frames`` are streaming DataFrames with the
    columns of ``SCANS``, ``ODOM`` and ``FRAMES``. A capture made again with
    the same folder goes on where the one before it stopped.
    """

    NAMES = ("accumulator", "map", "path", "frames", "odom")

    def __init__(self, spark: SparkSession, config: CaptureConfig, scans: DataFrame, odom: DataFrame, frames: DataFrame, drop_tail: bool = False, encode: Callable | None = None):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
        spark.dataSource.register(PcdDataSource)
        self.spark, self.config, self.root = spark, config, config.output_dir
        spark.createDataFrame([], SCANS).write.mode("append").parquet(f"{self.root}/ends")
        markers = spark.readStream.schema(SCANS).parquet(f"{self.root}/ends")
        columns = [c.split()[0] for c in SCANS.split(", ")]
        self.batches = accumulate.gathered(scans.select(*columns).unionByName(markers), config.accumulator_max_points, config.accumulator_publish_interval, config.leaf_size, drop_tail)
        self.map = capture.MapTable(f"{self.root}/map", config.leaf_size, config.global_max_points)
        self.paths = capture.paths(odom, config.max_path_length)
        more = {"encode": encode} if encode else {}
        self.frames = FrameSink(f"{self.root}/frames", config.image_save_interval, config.image_prefix, **more)
        self.odom = OdomSink(f"{self.root}/odom", config.odom_save_interval)
        self._inputs = {"frames": frames, "odom": odom}
        self.running: dict[str, StreamingQuery] = {}

    def _writer(self, name: str):
        if name == "accumulator":
            return self.batches.writeStream.format("parquet").option("path", f"{self.root}/batches").outputMode("append")
        if name == "path":
            return self.paths.writeStream.format("parquet").option("path", f"{self.root}/path").outputMode("append")
        if name == "map":
            arrived = self.spark.readStream.schema(accumulate.BATCHES).parquet(f"{self.root}/batches")
            return arrived.select("x", "y", "z").writeStream.foreachBatch(self.map.update)
        return self._inputs[name].writeStream.foreachBatch(getattr(self, name).update)

    def start(self, names: Iterable[str] = NAMES, **trigger) -> None:
        """Starts queries; ``trigger`` is that of a stream writer, such as processingTime="5 seconds"."""
        for name in names:
            writer = self._writer(name).queryName(f"capture-{name}").option("checkpointLocation", f"{self.root}/state/{name}")
            self.running[name] = writer.trigger(**trigger).start()

    def stop(self) -> None:
        """Stops all queries; what they have not finished is done after the next start."""
        for query in self.running.values():
            query.stop()
        self.running = {}

    def run_available(self) -> None:
        """Works off all that is there, the map after the batches that it reads. A failed query stops the others and raises."""
        try:
            for names in (("accumulator", "path", "frames", "odom"), ("map",)):
                self.start(names, availableNow=True)
                for name in names:
                    self.running[name].awaitTermination()
        finally:
            self.stop()

    def end_sessions(self, sessions: Iterable[int]) -> None:
        """Says that no more scans of these sessions come, so that their last batches close."""
        rows = [(s, None, None, None, None, True) for s in sessions]
        self.spark.createDataFrame(rows, SCANS).coalesce(1).write.mode("append").parquet(f"{self.root}/ends")

    def finish(self, sessions: Iterable[int]) -> dict[str, bool]:
        """Ends sessions, works off the rest and writes final files: the map, and of each session the saved poses and frames.

        Returns which files there are; a table without rows is not written.
        """
        sessions = list(sessions)
        self.end_sessions(sessions)
        self.run_available()
        done = {"map": self._write_map()}
        for session in sessions:
            for name, file in (("frames", "image"), ("odom", "odom")):
                sink = getattr(self, name)
                epochs = finished_epochs(self.spark, f"{sink.path}/state")
                done[f"{file}-{session}"] = bool(epochs) and sink.export(self.spark, epochs[-1], session, f"{self.root}/timestamps/{session}/{file}.csv")
        return done

    def _write_map(self) -> bool:
        epochs = finished_epochs(self.spark, f"{self.map.path}/manifest")
        if not epochs:
            return False
        cloud = dense_ids(self.map.snapshot(self.spark, epochs[-1]), ["level", "ix", "iy", "iz"], "point_id")
        if cloud.isEmpty():
            return False
        folder = os.path.join(self.root.removeprefix("file://"), "pcd")
        os.makedirs(folder, exist_ok=True)
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        ordered = cloud.select("point_id", *(F.col(a).cast("float") for a in "xyz")).repartitionByRange(parts, "point_id").sortWithinPartitions("point_id")
        ordered.write.format("pcd").mode("overwrite").save(os.path.join(folder, "input.pcd"))
        return True
