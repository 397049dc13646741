"""Batch twins of the capture operators: decimation, batching, bounded history."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.color import frame_name
from ..functions.sequence import dense_ids


def every_nth(messages: DataFrame, n: int, order: list[str], partition_by: list[str] | None = None, prefix: str = "frame") -> DataFrame:
    """Messages n, 2n, 3n, ... in ``order``; ``saved`` numbers them from 0 and names the frame."""
    if n < 1:
        raise ValueError("n must be at least 1")
    numbered = dense_ids(messages, order, "__seq", partition_by=partition_by).where((F.col("__seq") + 1) % n == 0)
    saved = F.floor(F.col("__seq") / n).cast("long")
    return numbered.withColumn("saved", saved).withColumn("frame", frame_name(prefix, saved)).drop("__seq")


def batch_id(messages: DataFrame, every: int, order: list[str], partition_by: list[str] | None = None) -> DataFrame:
    """Adds ``batch``: the number of the count-triggered batch that a message falls in."""
    if every < 1:
        raise ValueError("every must be at least 1")
    numbered = dense_ids(messages, order, "__seq", partition_by=partition_by)
    return numbered.withColumn("batch", F.floor(F.col("__seq") / every).cast("long")).drop("__seq")


def path_history(poses: DataFrame, most: int, order: list[str], id_col: str) -> DataFrame:
    """(id, first_id, n_poses): the bounded history that ends at each pose, by its first pose and its length.

    The first pose is looked up by its number, so no history is built;
    :func:`~cloudloom.functions.sequence.last_rows` builds them.
    """
    if most < 1:
        raise ValueError("most must be at least 1")
    numbered = dense_ids(poses, order, "seq").select("seq", id_col)
    asked = numbered.withColumn("first", F.greatest(F.col("seq") - (most - 1), F.lit(0)))
    firsts = numbered.select(F.col("seq").alias("first"), F.col(id_col).alias("first_id"))
    return asked.join(firsts, "first").select(id_col, "first_id", F.least(F.col("seq") + 1, F.lit(most)).cast("int").alias("n_poses"))


def scan_batches(scans: DataFrame, max_points: int, every: int, drop_tail: bool = False) -> DataFrame:
    """(session_id, index, batch, first_index, last_index, n_points, by_size): the batch that each scan falls in.

    A batch closes at ``max_points`` points, tested first, or after ``every``
    scans (0: never by count). The unfinished rest of a session is a last
    batch, unless ``drop_tail``. ``scans`` has session_id, index and n_points;
    only these three numbers of a session's scans meet in a task, not their
    points.
    """
    if every < 0:
        raise ValueError("every must not be negative")

    def gather(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        ordered = part.sort_values("index", kind="stable")
        index, sizes = ordered["index"].tolist(), ordered["n_points"].tolist()
        out, begin, points = [], 0, 0

        def close(end: int, by_size: bool) -> None:
            number = out[-1][2] + 1 if out else 0
            out.extend((key[0], k, number, index[begin], index[end - 1], points, by_size) for k in index[begin:end])

        for at, size in enumerate(sizes, 1):
            points += size
            if points >= max_points or (every and at - begin >= every):
                close(at, points >= max_points)
                begin, points = at, 0
        if begin < len(index) and not drop_tail:
            close(len(index), False)
        return pd.DataFrame(out, columns=["session_id", "index", "batch", "first_index", "last_index", "n_points", "by_size"])

    kinds = "session_id long, index long, batch long, first_index long, last_index long, n_points long, by_size boolean"
    return scans.select("session_id", "index", "n_points").groupBy("session_id").applyInPandas(gather, kinds)


def accumulate(scans: DataFrame, max_points: int, every: int, drop_tail: bool = False) -> DataFrame:
    """(session_id, batch, first_index, last_index, n_points, by_size): one row for each batch of :func:`scan_batches`."""
    found = scan_batches(scans, max_points, every, drop_tail)
    return found.groupBy("session_id", "batch").agg(*(F.first(c).alias(c) for c in ("first_index", "last_index", "n_points", "by_size")))
