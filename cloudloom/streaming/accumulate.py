"""Scans gathered into batches of points, with all their points.

A batch closes when it holds ``max_points`` points, tested first, or after
``every`` scans (0: never by count). A batch closed by its size is filtered to
one centroid a voxel; one closed by count, or left at the end, stays as it is.
A row with ``ends`` closes its session: the rest comes out as a last batch, or
is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.geometry import finite, voxel_index
from ..operators.batches import scan_batches

BATCHES = "session_id long, batch long, last_index long, by_size boolean, n bigint, x double, y double, z double"
#: Points of a frame that is given out at a time.
SLICE = 100_000


def voxel_means(points: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of the occupied voxels, in the order of their indices, and how many points each has."""
    points = points[np.isfinite(points).all(axis=1)]
    if not len(points):
        return points, np.zeros(0, np.int64)
    _, group, n = np.unique(np.floor(points * (1.0 / size)), axis=0, return_inverse=True, return_counts=True)
    group = group.ravel()
    return np.stack([np.bincount(group, points[:, k], len(n)) for k in range(3)], axis=1) / n[:, None], n


class Gather(StatefulProcessor):
    """The points of a session's open batch as a list of scans, and where the batch stands.

    Scans are appended to the list one by one, so a micro-batch writes only
    what it brings; the list is read and cleared when the batch closes.
    """

    def __init__(self, max_points: int, every: int, size: float, drop_tail: bool):
        self.max_points, self.every, self.size, self.drop_tail = max_points, every, size, drop_tail

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.scans = handle.getListState("scans", "x array<float>, y array<float>, z array<float>")
        self.place = handle.getValueState("place", "batch long, scans long, points long, last long")

    def _flush(self, session: int, batch: int, last: int, by_size: bool) -> Iterator[pd.DataFrame]:
        held = [np.stack([np.asarray(a, np.float32) for a in scan], axis=1).reshape(-1, 3) for scan in self.scans.get()]
        points = np.concatenate(held).astype(np.float64) if held else np.zeros((0, 3))
        self.scans.clear()
        points, n = voxel_means(points, self.size) if by_size else (points, np.ones(len(points), np.int64))
        for at in range(0, len(points), SLICE):
            part = points[at : at + SLICE]
            head = {"session_id": session, "batch": batch, "last_index": last, "by_size": by_size, "n": n[at : at + SLICE]}
            yield pd.DataFrame({**head, **{a: part[:, k] for k, a in enumerate("xyz")}})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch, scans, points, last = self.place.get() if self.place.exists() else (0, 0, 0, -1)
        arrived = pd.concat(list(rows))
        ends = bool(arrived["ends"].fillna(False).any())
        arrived = arrived[~arrived["ends"].fillna(False).astype(bool)].sort_values("index", kind="stable")
        for index, *xyz in zip(arrived["index"], arrived["x"], arrived["y"], arrived["z"]):
            xyz = tuple([] if a is None else [float(v) for v in a] for a in xyz)
            self.scans.appendValue(xyz)
            scans, points, last = scans + 1, points + len(xyz[0]), int(index)
            by_size = points >= self.max_points
            if by_size or (self.every and scans >= self.every):
                yield from self._flush(key[0], batch, last, by_size)
                batch, scans, points = batch + 1, 0, 0
        if ends and scans:
            if self.drop_tail:
                self.scans.clear()
            else:
                yield from self._flush(key[0], batch, last, False)
                batch += 1
            scans = points = 0
        self.place.update((int(batch), int(scans), int(points), int(last)))

    def close(self) -> None:
        pass


def gathered(scans: DataFrame, max_points: int, every: int, size: float, drop_tail: bool = False) -> DataFrame:
    """A stream of scans (session_id, index, x, y, z, ends) as a stream of the points of their batches.

    Needs the RocksDB state store. Scans of a session must arrive in the order
    of ``index`` over the micro-batches; a session's open batch is all that is
    held of it. What has come out is not given out again: a second end without
    scans in between adds nothing.
    """
    if every < 0 or max_points < 1:
        raise ValueError("every must not be negative, and max_points positive")
    return scans.groupBy("session_id").transformWithStateInPandas(
        statefulProcessor=Gather(max_points, every, size, drop_tail), outputStructType=BATCHES, outputMode="Append", timeMode="None"
    )


def gathered_batch(scans: DataFrame, max_points: int, every: int, size: float, drop_tail: bool = False) -> DataFrame:
    """The same rows from a table of scans: batches from the sizes of the scans alone, then points joined to them and averaged in SQL."""
    kept = scans.where("not coalesce(ends, false)")
    sizes = kept.select("session_id", "index", F.coalesce(F.size("x"), F.lit(0)).cast("long").alias("n_points"))
    of_scans = scan_batches(sizes, max_points, every, drop_tail).select("session_id", "index", "batch", "last_index", "by_size")
    points = kept.select("session_id", "index", F.explode(F.arrays_zip("x", "y", "z")).alias("p"))
    points = points.select("session_id", "index", *(F.col(f"p.{a}").cast("double").alias(a) for a in "xyz"))
    # Both sides look smaller than they are (lists of points, groups of scans), so neither may be broadcast on an estimate.
    met = points.join(of_scans.hint("merge"), ["session_id", "index"])
    raw = met.where("not by_size").select("session_id", "batch", "last_index", "by_size", F.lit(1).cast("long").alias("n"), "x", "y", "z")
    cells = met.where("by_size").where(finite(F.col("x"), F.col("y"), F.col("z"))).withColumns({f"i{a}": voxel_index(F.col(a), size) for a in "xyz"})
    means = cells.groupBy("session_id", "batch", "last_index", "by_size", "ix", "iy", "iz").agg(F.count("*").alias("n"), *(F.avg(a).alias(a) for a in "xyz"))
    return raw.unionByName(means.drop("ix", "iy", "iz"))
