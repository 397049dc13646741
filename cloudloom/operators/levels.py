"""A voxel map under a budget: sums at several cell sizes in one map.

A cell is (level, ix, iy, iz), with sides of ``size * 2**level``; its parent
at the next level has half its indices. No cell of a map lies inside another.
What arrives goes into the cell that covers it, whatever its level, or into a
new cell of level 0. When the map holds more cells than its budget, one pass
raises all cells to the next level. Sums add up exactly as counts do, so a map
depends on where its batches end only through the times of those passes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoints import settled
from .cloud import finite_points, voxel_sums

CELL = ["level", "ix", "iy", "iz"]
SUMS = ["n", "sx", "sy", "sz"]


def raised(index: str, by: Column | int) -> Column:
    """The index of the cell ``by`` levels above; shifting rounds towards minus infinity, as cells do."""
    return F.expr(f"shiftright({index}, {by})") if isinstance(by, int) else F.call_function("shiftright", F.col(index), by)


def batch_sums(points: DataFrame, size: float) -> DataFrame:
    """Sums of a batch at level 0; points that are not finite are left out."""
    return voxel_sums(finite_points(points), size).select(F.lit(0).alias("level"), *CELL[1:], *SUMS)


def merged(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*CELL).agg(*(F.sum(c).alias(c) for c in SUMS))


def folded(held: DataFrame | None, batch: DataFrame, deepest: int = 1) -> DataFrame:
    """``held`` with the sums of a batch (level 0) added, each to the cell that covers it."""
    if held is None:
        return merged(batch)
    coarse = held.where("level > 0").select(F.col("level").alias("at"), *(F.col(c).alias(f"c{c}") for c in CELL[1:]))
    above = batch.withColumn("at", F.explode(F.sequence(F.lit(1), F.lit(deepest)))).withColumns({f"c{c}": raised(c, F.col("at")) for c in CELL[1:]})
    covered = above.join(coarse, ["at", "cix", "ciy", "ciz"], "left_semi")
    inside = covered.select(F.col("at").alias("level"), *(F.col(f"c{c}").alias(c) for c in CELL[1:]), *SUMS)
    outside = batch.join(covered.select(*CELL[1:]), CELL[1:], "left_anti")
    return merged(held.unionByName(inside).unionByName(outside))


def coarser(cells: DataFrame, level: int) -> DataFrame:
    """All cells at ``level``, which is at or above their own."""
    by = F.lit(level) - F.col("level")
    return merged(cells.select(F.lit(level).alias("level"), *(raised(c, by).alias(c) for c in CELL[1:]), *SUMS))


def next_level(lowest: int, highest: int, deepest: int) -> int | None:
    """The level that one pass over a map with cells from ``lowest`` to ``highest`` raises it to; None if it is there already."""
    target = max(1, highest) if lowest < max(1, highest) else highest + 1
    return target if target <= deepest else None


def capped(cells: DataFrame, most: int, deepest: int = 1) -> DataFrame:
    """``cells``, or one pass of coarsening where they are more than ``most``."""
    found = cells.agg(F.count("*").alias("n"), F.min("level").alias("lo"), F.max("level").alias("hi")).first()
    target = next_level(found.lo, found.hi, deepest) if found.n > most else None
    return cells if target is None else coarser(cells, target)


def replayed(batches: Iterable[DataFrame], size: float, most: int, deepest: int = 1) -> DataFrame | None:
    """The map after all batches of points, each followed by a look at the budget; None without batches.

    ``deepest`` is the highest level; 1 is one doubling of the leaf and no
    more. Each step is settled, as its size decides on the next.
    """
    held = None
    for batch in batches:
        held = settled(capped(settled(folded(held, batch_sums(batch, size), deepest)), most, deepest))
    return held


def cell_centroids(cells: DataFrame) -> DataFrame:
    """The map as a cloud: (level, ix, iy, iz, n, x, y, z)."""
    return cells.select(*CELL, "n", *((F.col(f"s{a}") / F.col("n")).alias(a) for a in "xyz"))
