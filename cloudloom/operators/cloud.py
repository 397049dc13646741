"""Point clouds: cleaning, voxels, neighbours, background."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import settled
from ..functions.geometry import finite, voxel_index

_CELL = ["ix", "iy", "iz"]


def finite_points(points: DataFrame) -> DataFrame:
    """Points whose coordinates are all finite numbers."""
    return points.where(finite(F.col("x"), F.col("y"), F.col("z")))


def with_voxel(points: DataFrame, size: float) -> DataFrame:
    """Adds the voxel indices ix, iy, iz."""
    return points.withColumns({f"i{a}": voxel_index(F.col(a), size) for a in "xyz"})


def voxel_sums(points: DataFrame, size: float) -> DataFrame:
    """(ix, iy, iz, n, sx, sy, sz): sums that can be added up over batches in any order."""
    return with_voxel(points, size).groupBy(*_CELL).agg(F.count("*").alias("n"), *(F.sum(a).alias(f"s{a}") for a in "xyz"))


def merge_sums(*parts: DataFrame) -> DataFrame:
    """Sums of several batches as if they were one."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*_CELL).agg(*(F.sum(c).alias(c) for c in ("n", "sx", "sy", "sz")))


def coarsened(sums: DataFrame) -> DataFrame:
    """The same sums at twice the voxel size."""
    return merge_sums(sums.withColumns({c: F.floor(F.col(c) / 2).cast("long") for c in _CELL}))


def centroids(sums: DataFrame) -> DataFrame:
    return sums.select(*_CELL, "n", *((F.col(f"s{a}") / F.col("n")).alias(a) for a in "xyz"))


def voxel_downsample(points: DataFrame, size: float) -> DataFrame:
    """One centroid for each occupied voxel; points that are not finite are left out."""
    return centroids(voxel_sums(finite_points(points), size))


def budget_cap(sums: DataFrame, most: int) -> DataFrame:
    """``sums``, or one pass at twice the voxel size where they are more than ``most``. Decides in one job."""
    return coarsened(sums) if sums.count() > most else sums


def replayed_map(batches: list[DataFrame], size: float, every: int) -> DataFrame:
    """The map as unweighted refiltering makes it: batch centroids appended, all refiltered at every ``every``-th batch.

    The result depends on the batching, unlike :func:`merge_sums`; it is there
    to replay a recording as it was captured.
    """
    if every < 1:
        raise ValueError("every must be at least 1")
    held = None
    for k, batch in enumerate(batches, 1):
        part = voxel_downsample(batch, size).select("x", "y", "z")
        held = part if held is None else held.unionByName(part)
        if k % every == 0:
            held = settled(voxel_downsample(held, size).select("x", "y", "z"))
    return held


def first_per_voxel(points: DataFrame, size: float, order: list[str]) -> DataFrame:
    """The first point of each voxel in ``order``, which should be total.

    An aggregate, not a window: it is combined before the shuffle.
    """
    rows = with_voxel(points, size)
    best = rows.groupBy(*_CELL).agg(F.min(F.struct(*order, *[c for c in points.columns if c not in order])).alias("p"))
    return best.select(*_CELL, *(F.col(f"p.{c}").alias(c) for c in points.columns))


def centroid(points: DataFrame) -> DataFrame:
    """One row: the mean of all points and their number."""
    return points.agg(F.count("*").alias("n"), *(F.avg(a).alias(f"c{a}") for a in "xyz"))


def z_range(points: DataFrame) -> DataFrame:
    """One row: least and largest finite z, and their distance (1 if there is next to none)."""
    found = points.where(finite(F.col("z"))).agg(F.min("z").alias("z_min"), F.max("z").alias("z_max"))
    span = F.col("z_max") - F.col("z_min")
    return found.withColumn("z_span", F.when(span < 1e-6, F.lit(1.0)).otherwise(span))


def sphere_points(spark, n: int, radius: float, center: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> DataFrame:
    """(ordinal, x, y, z): ``n`` points spread evenly over a sphere along a golden-angle spiral."""
    k = F.col("id") + 0.5
    up, around = F.acos(F.lit(1.0) - k * 2.0 / n), k * (math.pi * (1.0 + math.sqrt(5.0)))
    axes = (F.cos(around) * F.sin(up), F.sin(around) * F.sin(up), F.cos(up))
    columns = [(a * radius + c).alias(name) for a, c, name in zip(axes, center, "xyz")]
    return spark.range(n).select(F.col("id").alias("ordinal"), *columns)


def append(*clouds: tuple[str, DataFrame]) -> DataFrame:
    """Clouds one after the other; ``source`` names where a point came from."""
    whole = None
    for name, cloud in clouds:
        part = cloud.select("x", "y", "z").withColumn("source", F.lit(name))
        whole = part if whole is None else whole.unionByName(part)
    return whole


#: Points of a cell of the first round of k-NN, at most about, for each neighbour that is asked for.
CELL_SHARE = 16


def _first_at_each_place(points: DataFrame, most: int) -> DataFrame:
    """The ``most`` least ids at each position, in two steps, so that a position with very many points is no single task's work."""
    part = F.pmod(F.xxhash64("id"), F.lit(64))
    rank = lambda *by: F.row_number().over(Window.partitionBy("x", "y", "z", *by).orderBy("id"))
    some = points.withColumn("part", part).withColumn("rank", rank("part")).where(F.col("rank") <= most)
    return some.withColumn("rank", rank()).where(F.col("rank") <= most).select("id", "x", "y", "z")


def _fullest(points: DataFrame, size: float) -> int:
    return with_voxel(points, size).groupBy(*_CELL).count().agg(F.max("count")).first()[0]


def knn(points: DataFrame, k: int, cell: float | None = None, id_col: str = "point_id") -> DataFrame:
    """(point_id, neighbour, dist2, rank) of the ``k`` nearest other points; ties by id. Exact for any ``cell``.

    Points are hashed into cells and compared with the 27 cells around them.
    Points whose k-th distance is not certain within that ring are asked again
    with larger cells, until all are certain or the cells hold all points.
    Without ``cell`` the first cells are so small that even the fullest holds
    few points, so dense places are settled first; of points at one place only
    the first k + 1 can be neighbours. Fewer than ``k`` other points give fewer
    rows; an empty table gives none.
    """
    pts = points.select(F.col(id_col).alias("id"), "x", "y", "z")
    near = settled(_first_at_each_place(pts, k + 1))
    box = near.agg(F.count("*").alias("n"), *(F.min(a).alias(f"lo{a}") for a in "xyz"), *(F.max(a).alias(f"hi{a}") for a in "xyz")).first()
    span = max([box[f"hi{a}"] - box[f"lo{a}"] for a in "xyz"]) if box.n else 0.0
    size = cell or (max(span, 1e-9) / max((box.n / max(k, 1)) ** (1 / 3), 1.0))
    if cell is None and box.n:
        while size > span / 2**40 and (most := _fullest(near, size)) > CELL_SHARE * (k + 1):
            size /= max(2.0, (most / (CELL_SHARE * (k + 1))) ** (1 / 3))
    around = F.array(*[F.struct(*(F.lit(d).alias(f"d{a}") for d, a in zip(o, "xyz"))) for o in [(i, j, m) for i in (-1, 0, 1) for j in (-1, 0, 1) for m in (-1, 0, 1)]])
    asking, found, left = pts, None, None
    while True:
        cells = with_voxel(near, size).select(*_CELL, F.col("id").alias("neighbour"), *(F.col(a).alias(f"n{a}") for a in "xyz"))
        asked = with_voxel(asking, size).withColumn("o", F.explode(around))
        asked = asked.withColumns({f"i{a}": F.col(f"i{a}") + F.col(f"o.d{a}") for a in "xyz"})
        dist2 = sum(((F.col(a) - F.col(f"n{a}")) * (F.col(a) - F.col(f"n{a}")) for a in "xyz"), F.lit(0.0))
        pairs = asked.join(cells, _CELL).where("id <> neighbour").select("id", "neighbour", dist2.alias("dist2"))
        nearest = Window.partitionBy("id").orderBy("dist2", "neighbour")
        ranked = settled(pairs.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k))
        whole = size > span
        sure = ranked.groupBy("id").agg(F.count("*").alias("n"), F.max("dist2").alias("far"))
        sure = sure.where(F.lit(whole) | ((F.col("n") == k) & (F.col("far") <= size * size))).select("id")
        good = ranked.join(sure, "id", "left_semi")
        found = good if found is None else found.unionByName(good)
        if whole:
            break
        asking = settled(asking.join(sure, "id", "left_anti"))
        rest = asking.count()
        if not rest:
            break
        size *= 2 if left is None or rest < left else 8  # faster through empty space
        left = rest
    return found.select(F.col("id").alias(id_col), "neighbour", "dist2", "rank")


def statistical_outliers(points: DataFrame, k: int = 10, deviations: float = 1.0, id_col: str = "point_id") -> DataFrame:
    """Points whose mean distance to their ``k`` nearest is at most mean + ``deviations`` * sigma over all points."""
    means = knn(points, k, id_col=id_col).groupBy(id_col).agg(F.avg(F.sqrt("dist2")).alias("mean_dist"))
    limit = means.agg((F.avg("mean_dist") + F.lit(deviations) * F.stddev_samp("mean_dist")).alias("limit"))  # one row
    kept = means.join(F.broadcast(limit)).where(F.col("limit").isNull() | (F.col("mean_dist") <= F.col("limit"))).select(id_col)
    return points.join(kept, id_col, "left_semi")
