"""The map under a budget: many epochs over the cap, streamed, replayed and against a plain version."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cloudloom.operators import levels
from cloudloom.streaming import capture

POINTS = "x double, y double, z double"


def plain_map(batches, size, most, deepest=1):
    held = {}
    for batch in batches:
        for p in batch:
            if not all(map(math.isfinite, p)):
                continue
            cell = tuple(math.floor(v / size) for v in p)
            key = next(((k, *(c >> k for c in cell)) for k in range(deepest, 0, -1) if (k, *(c >> k for c in cell)) in held), (0, *cell))
            n, sums = held.get(key, (0, (0.0, 0.0, 0.0)))
            held[key] = (n + 1, tuple(s + v for s, v in zip(sums, p)))
        if len(held) > most:
            lo, hi = min(k[0] for k in held), max(k[0] for k in held)
            target = max(1, hi) if lo < max(1, hi) else hi + 1
            if target <= deepest:
                up = {}
                for (k, *cell), (n, sums) in held.items():
                    at = (target, *(c >> (target - k) for c in cell))
                    m, other = up.get(at, (0, (0.0, 0.0, 0.0)))
                    up[at] = (m + n, tuple(a + b for a, b in zip(other, sums)))
                held = up
    return sorted((*k, n, *(round(s, 6) for s in sums)) for k, (n, sums) in held.items())


def rows_of(cells):
    return sorted((r.level, r.ix, r.iy, r.iz, r.n, *(round(v, 6) for v in (r.sx, r.sy, r.sz))) for r in cells.collect())


def some_batches(seed, n=6):
    rng = random.Random(seed)
    return [[tuple(rng.uniform(-8, 8 if k % 2 else 20) for _ in "xyz") for _ in range(60)] + [(math.nan, 0.0, 0.0), (0.5, 0.5, math.inf)] for k in range(n)]


def test_the_case_that_mixed_scales(spark):
    first, second = [(x, 0.0, 0.0) for x in (0.5, 2.5, 4.5, 6.5, 8.5)], [(4.5, 0.0, 0.0)]
    found = levels.replayed([spark.createDataFrame(b, POINTS) for b in (first, second)], 1.0, 3)
    assert rows_of(found) == plain_map([first, second], 1.0, 3)
    assert {(r.level, r.ix): r.n for r in found.collect()}[(1, 2)] == 2


@pytest.mark.parametrize(("most", "deepest"), [(1000, 1), (150, 1), (40, 1), (40, 3)])
def test_stream_replay_and_plain_version_agree(spark, tmp_path, most, deepest):
    batches = some_batches(most + deepest)
    for b in batches:
        spark.createDataFrame(b, POINTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    frames = [spark.createDataFrame(b, POINTS) for b in batches]
    assert rows_of(levels.replayed(frames, 1.5, most, deepest)) == plain_map(batches, 1.5, most, deepest)
    table = capture.MapTable(str(tmp_path / "map"), 1.5, most, deepest, buckets=5)
    for epoch, frame in enumerate(frames):
        table.update(frame, epoch)
        if epoch in (1, 4):  # a repeated epoch changes nothing
            table.update(frame, epoch)
        assert rows_of(table.cells(spark, epoch)) == plain_map(batches[: epoch + 1], 1.5, most, deepest)
    streamed = capture.MapTable(str(tmp_path / "streamed"), 1.5, most, deepest)
    stream = capture.stream_table(spark, str(tmp_path / "in"), POINTS)
    for _ in range(2):  # nothing new the second time
        stream.writeStream.foreachBatch(streamed.update).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert rows_of(streamed.cells(spark, 5))[0:0] == [] and streamed.cells(spark, 5).agg(F.sum("n")).first()[0] == sum(len(b) - 2 for b in batches)


def test_only_touched_parts_are_written(spark, tmp_path):
    table = capture.MapTable(str(tmp_path / "map"), 1.0, 10_000, buckets=16)
    table.update(spark.createDataFrame([(float(k), 0.0, 0.0) for k in range(0, 400, 2)], POINTS), 0)
    table.update(spark.createDataFrame([(4.5, 0.0, 0.0)], POINTS), 1)
    assert sorted(r.epoch for r in table.manifest(spark, 1)) == [0] * 15 + [1]
    assert table.cells(spark, 1).count() == 200 and table.snapshot(spark, 1).where("n = 2").first().x == 4.25


def test_empty_batches(spark, tmp_path):
    table = capture.MapTable(str(tmp_path / "map"), 1.0, 10)
    none = spark.createDataFrame([], POINTS)
    table.update(none, 0)
    table.update(spark.createDataFrame([(0.5, 0.5, 0.5)], POINTS), 1)
    table.update(none, 2)
    assert table.cells(spark, 0).count() == 0 and rows_of(table.cells(spark, 2)) == [(0, 0, 0, 0, 1, 0.5, 0.5, 0.5)]
