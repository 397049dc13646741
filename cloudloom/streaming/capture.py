"""The capture side as Structured Streaming queries, keyed by recording session.

Every query starts from a streaming DataFrame with ``session_id`` and an
increasing ``index``; the batch twins in :mod:`cloudloom.operators.batches` give
the same rows for the same input.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..checkpoints import settled
from ..operators import levels
from ..operators.cloud import voxel_sums


def stream_table(spark: SparkSession, path: str, schema: str, files: int = 1) -> DataFrame:
    """New Parquet files of a folder, ``files`` in a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def decimated(stream: DataFrame, n: int) -> DataFrame:
    """(session_id, index, saved): every n-th message of each session, numbered from 0 by what was saved."""
    if n < 1:
        raise ValueError("n must be at least 1")

    def keep(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = state.get[0] if state.exists else 0
        rows = pd.concat([part[["index"]] for part in parts]).sort_values("index")
        count = seen + 1 + pd.RangeIndex(len(rows))
        taken = rows[count % n == 0]
        state.update((seen + len(rows),))
        yield pd.DataFrame({"session_id": key[0], "index": taken["index"], "saved": count[count % n == 0] // n - 1})

    return stream.groupBy("session_id").applyInPandasWithState(
        keep, "session_id long, index long, saved long", "seen long", "append", GroupStateTimeout.NoTimeout
    )


def accumulated(stream: DataFrame, max_points: int, every: int) -> DataFrame:
    """(session_id, batch, first_index, last_index, n_points, by_size): scans gathered into batches.

    ``stream`` has one row for each scan: session_id, index, n_points. A batch
    closes when it holds ``max_points`` points, tested first, or ``every`` scans
    (0: never by count). :mod:`cloudloom.streaming.accumulate` gives the points.
    """
    if every < 0:
        raise ValueError("every must not be negative")

    def gather(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch, first, scans, points = state.get if state.exists else (0, -1, 0, 0)
        out = []
        for row in pd.concat(list(parts)).sort_values("at").itertuples(index=False):
            first = row.at if scans == 0 else first
            scans, points = scans + 1, points + row.n_points
            if points >= max_points or (every and scans >= every):
                out.append((key[0], batch, first, row.at, points, points >= max_points))
                batch, scans, points = batch + 1, 0, 0
        state.update((batch, int(first), scans, int(points)))
        yield pd.DataFrame(out, columns=["session_id", "batch", "first_index", "last_index", "n_points", "by_size"])

    renamed = stream.select("session_id", F.col("index").alias("at"), "n_points")  # a tuple has a method ``index``
    return renamed.groupBy("session_id").applyInPandasWithState(
        gather, "session_id long, batch long, first_index long, last_index long, n_points long, by_size boolean",
        "batch long, first long, scans long, points long", "append", GroupStateTimeout.NoTimeout,
    )


POSE = "index long, px double, py double, pz double, qx double, qy double, qz double, qw double"


def paths(stream: DataFrame, most: int, whole: bool = False) -> DataFrame:
    """(session_id, index, first_index, n_poses): at each pose, the bounded history that ends there.

    With ``whole`` the history itself comes too, as ``path``: structs of index,
    position and quaternion, oldest first; ``stream`` then has these columns.
    A session's state is its last ``most`` poses.
    """
    if most < 1:
        raise ValueError("most must be at least 1")
    names = [c.split()[0] for c in POSE.split(", ")] if whole else ["index"]

    def trace(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = deque(map(tuple, state.get[0]) if state.exists else [], maxlen=most)
        out = []
        arrived = pd.concat([part[names] for part in parts]).sort_values("index", kind="stable")
        for pose in arrived.itertuples(index=False, name=None):
            held.append((int(pose[0]), *map(float, pose[1:])))
            row = (key[0], held[-1][0], held[0][0], len(held))
            out.append((*row, [dict(zip(names, p)) for p in held]) if whole else row)
        state.update(([tuple(p) for p in held],))
        yield pd.DataFrame(out, columns=["session_id", "index", "first_index", "n_poses", *["path"] * whole])

    kind = f"array<struct<{POSE.replace(' ', ':').replace(',:', ',')}>>" if whole else "array<struct<index:long>>"
    return stream.select("session_id", *names).groupBy("session_id").applyInPandasWithState(
        trace, "session_id long, index long, first_index long, n_poses long" + (f", path {kind}" if whole else ""), f"held {kind}", "append", GroupStateTimeout.NoTimeout
    )


def global_map(stream: DataFrame, size: float) -> DataFrame:
    """Voxel sums over the whole session as a streaming aggregate; use output mode ``complete`` or ``update``."""
    return voxel_sums(stream, size)


class MapTable:
    """A global map under a budget (see :mod:`cloudloom.operators.levels`), updated by ``foreachBatch``.

    Cells are dealt to ``buckets`` by a hash of the cell of level ``deepest``
    that they lie in, so a cell and all that may cover it share a bucket. A
    micro-batch reads and writes only the buckets that its points fall into; a
    manifest, written last, says in which epoch each bucket was last written
    and how many cells it has. Epochs that begin from a manifest never change
    what it names, so a repeated epoch gives the same map once more.
    """

    MANIFEST = "bucket int, epoch long, n long, lowest int, highest int"

    def __init__(self, path: str, size: float, most: int, deepest: int = 1, buckets: int = 64):
        self.path, self.size, self.most, self.deepest, self.buckets = path, size, most, deepest, buckets

    def _bucket(self) -> Column:
        over = [F.call_function("shiftright", F.col(c), F.lit(self.deepest) - F.col("level")) for c in levels.CELL[1:]]
        return F.pmod(F.xxhash64(*over), F.lit(self.buckets)).cast("int")

    def manifest(self, spark: SparkSession, epoch: int) -> list[Row]:
        """One row for each bucket that holds cells; none before the first epoch."""
        return spark.read.schema(self.MANIFEST).parquet(f"{self.path}/manifest/{epoch}").collect() if epoch >= 0 else []

    def _cells(self, spark: SparkSession, rows: list[Row]) -> DataFrame | None:
        paths = [f"{self.path}/cells/{r.epoch}/bucket={r.bucket}" for r in rows]
        return spark.read.parquet(*paths).select(*levels.CELL, *levels.SUMS) if paths else None

    def update(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = self.manifest(spark, epoch - 1)
        arrived = settled(levels.batch_sums(batch, self.size).withColumn("bucket", self._bucket()))
        touched = {r.bucket for r in arrived.select("bucket").distinct().collect()}
        old = self._cells(spark, [r for r in before if r.bucket in touched])
        after = levels.folded(old, arrived.drop("bucket"), self.deepest)
        after = settled(after.withColumn("bucket", self._bucket()))
        known = {r.bucket: r for r in before} | {r.bucket: r for r in self._sizes(after, epoch)}
        total = sum(r.n for r in known.values())
        target = None
        if total > self.most:
            target = levels.next_level(min(r.lowest for r in known.values()), max(r.highest for r in known.values()), self.deepest)
        if target is not None:
            rest = self._cells(spark, [r for r in before if r.bucket not in touched])
            whole = after.drop("bucket") if rest is None else after.drop("bucket").unionByName(rest)
            after = settled(levels.coarser(whole, target).withColumn("bucket", self._bucket()))
            known = {r.bucket: r for r in self._sizes(after, epoch)}
        after.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/cells/{epoch}")
        spark.createDataFrame(list(known.values()), self.MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{epoch}")

    def _sizes(self, cells: DataFrame, epoch: int) -> list[Row]:
        of = cells.groupBy("bucket").agg(F.count("*").alias("n"), F.min("level").alias("lowest"), F.max("level").alias("highest"))
        return of.select("bucket", F.lit(epoch).cast("long").alias("epoch"), "n", "lowest", "highest").collect()

    def cells(self, spark: SparkSession, epoch: int) -> DataFrame:
        found = self._cells(spark, self.manifest(spark, epoch))
        if found is None:
            kinds = ["level int", *(f"{c} long" for c in levels.CELL[1:]), "n long", *(f"{c} double" for c in levels.SUMS[1:])]
            return spark.createDataFrame([], ", ".join(kinds))
        return found

    def snapshot(self, spark: SparkSession, epoch: int) -> DataFrame:
        """The map after an epoch as a cloud."""
        return levels.cell_centroids(self.cells(spark, epoch))


def event_windows(events: DataFrame, width: str = "10 minutes", late: str = "5 minutes") -> DataFrame:
    """An extension beyond the capture nodes: event counts in tumbling windows with a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
