"""Global numbering and look-back windows without moving all rows to one task.

``row_number()`` over an unpartitioned window sends everything to one task.
Here the rows are cut into ranges of the whole order, numbered within their
range, and the small table of range sizes gives the offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import settled

#: A row's number within its range is held in these many bits of ``monotonically_increasing_id``.
_BITS = 33


def dense_ids(df: DataFrame, order: list[str], name: str = "seq", ranges: int | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... in ``order`` (ascending, nulls first; a total order by choice of columns).

    With ``partition_by`` each group is numbered by itself, however many rows
    it has. ``ranges`` is the number of ranges, by default that of the
    session's shuffle partitions; ranges are cut by all columns of the order.
    Repeated values of all order columns are numbered in an unspecified order.
    The numbered rows are settled, so that all who read them see the same.
    """
    groups = partition_by or []
    parts = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = df.repartitionByRange(parts, *groups, *order).sortWithinPartitions(*groups, *order)
    place = F.monotonically_increasing_id()
    numbered = settled(sorted_.withColumns({"__range": F.shiftright(place, _BITS), "__row": place.bitwiseAND((1 << _BITS) - 1)}))
    sizes = numbered.groupBy("__range").agg(F.count("*").alias("n"))  # at most ``parts`` rows
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    joined = numbered.join(F.broadcast(offsets), "__range")
    whole = joined.withColumn(name, (F.col("__row") + F.col("__offset")).cast("long")).drop("__range", "__row", "__offset")
    if not groups:
        return whole
    names = [f"__g{k}" for k in range(len(groups))]
    first = whole.groupBy(*groups).agg(F.min(name).alias("__first")).toDF(*names, "__first")
    same = [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(groups, names)]
    return whole.join(first, same).withColumn(name, F.col(name) - F.col("__first")).drop(*names, "__first")


def last_rows(df: DataFrame, seq: str, columns: list[str], n: int, name: str = "history", block: int | None = None) -> DataFrame:
    """``df`` with ``name``: structs of ``columns`` of the last ``n`` rows up to this one, in order of ``seq``.

    ``seq`` is a dense number. Rows are cut into blocks; the last ``n - 1`` rows
    of a block are sent to the next one too, so each block is a task's work.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    size = block or max(4 * n, 10_000)
    own = F.floor(F.col(seq) / size)
    follows = F.when(F.col(seq) % size >= size - (n - 1), F.array(own, own + 1)).otherwise(F.array(own))
    if n - 1 > size:
        raise ValueError("block must not be smaller than n - 1")
    sent = df.withColumn("__block", F.explode(follows))
    window = Window.partitionBy("__block").orderBy(seq).rowsBetween(-(n - 1), 0)
    seen = sent.withColumn(name, F.collect_list(F.struct(*columns)).over(window))
    return seen.where(F.col("__block") == F.floor(F.col(seq) / size)).drop("__block")
