"""Plans that must hold when tables grow: what is broadcast, and what is shuffled once a pixel."""

import contextlib
import io

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cloudloom.operators import camera, raster, visibility
from cloudloom.queries import ORACLE_SQL, QUERIES


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.mark.parametrize("name", ["edge_lookup", "bilinear_sample", "raster_gather"])
def test_images_are_not_broadcast_on_an_estimate(spark, sf_dir, name):
    """Images explode from few cameras, so that their pixels look like a small table."""
    text = plan(QUERIES[name](spark, sf_dir))
    for line in text.splitlines():
        assert not ("Broadcast" in line and "iv#" in line), line
    assert "MapFromEntries" not in text and "map_from_entries" not in text


def test_points_of_scans_are_not_broadcast(spark, sf_dir):
    assert "BroadcastHashJoin" not in plan(QUERIES["accumulated_points"](spark, sf_dir))


@pytest.mark.parametrize(
    "name",
    ["zbuffer", "encode_inverse_depth", "normalize_depth", "depth_summary", "depth_png16", "depth_png_pixels", "dilate", "weighted_depth", "densify_guided",
     "densify_morphological", "edge_candidates", "canny_edges", "point2d_index"],
)
def test_rows_of_an_image_are_not_moved_again(spark, sf_dir, name):
    """Whatever an image's rows go through, they are shuffled as points by groups of cameras, and never by image or pixel."""
    text = plan(QUERIES[name](spark, sf_dir))
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning(cam_id" in line or "Exchange hashpartitioning(view_group" in line and "cam_id" in line.split("hashpartitioning")[1]]
    assert not moved, moved
    assert text.count("Exchange hashpartitioning(view_group#") >= 1


def test_groups_of_many_cameras_are_divided(spark, monkeypatch):
    monkeypatch.setattr(camera, "GROUP_CAMERAS", 2)
    points = spark.range(50).select(F.col("id").alias("point_id"), F.lit(0.1).alias("x"), F.lit(0.2).alias("y"), (F.col("id") * 0.01).alias("z"))
    cams = spark.createDataFrame([(k, 0.0, 0.0, -10.0, 0.0, 0.0, 0.0, 1.0) for k in range(9)], "cam_id long, px double, py double, pz double, qx double, qy double, qz double, qw double")
    found = camera.grouped_views(points, cams)
    assert found.count() == 450 and found.select("cam_id", "point_id").distinct().count() == 450
    assert found.select(camera.GROUP).distinct().count() > 1
    assert found.groupBy("cam_id").agg(F.count_distinct(camera.GROUP).alias("n")).where("n > 1").count() == 0


def test_colours_beside_the_depths_need_no_join(spark):
    rng = np.random.default_rng(4)
    rows = [(1, int(v), int(u), float(rng.random() * 9) if rng.random() < 0.4 else 0.0, *map(int, rng.integers(0, 9, 3))) for v in range(30) for u in range(25) if rng.random() < 0.7]
    whole = spark.createDataFrame(rows, "cam_id long, iv int, iu int, depth double, r int, g int, b int")
    joined = raster.weighted_depth(whole.select("cam_id", "iv", "iu", "depth"), whole.drop("depth"))
    alone = raster.weighted_depth(whole)
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, joined.collect()))
    held = {r[1:3]: r for r in rows}
    for r in alone.collect():
        v, u, _, *own = held[r.iv, r.iu][1:]
        total = share = 0.0
        for dv in range(-4, 5):
            for du in range(-4, 5):
                other = held.get((v + dv, u + du))
                if other and other[3] > 0:
                    apart = sum((a - b) ** 2 for a, b in zip(own, other[4:]))
                    w = np.exp(-(dv * dv + du * du) / 18) * np.exp(-apart / 18) if apart < 82 else 0.0
                    total, share = total + w * other[3], share + w
        assert abs(r.depth - total / share) < 1e-9


def test_hulls_by_tiles_and_at_once_agree(spark):
    rng = np.random.default_rng(6)
    rows = [(k % 2, k, float(x * z), float(y * z), float(z)) for k, (x, y, z) in enumerate(zip(rng.uniform(-0.5, 0.5, 600), rng.uniform(-0.4, 0.4, 600), rng.uniform(2, 40, 600)))]
    seen = spark.createDataFrame(rows, "cam_id long, point_id long, cx double, cy double, cz double")
    once, tiled = visibility.visible_points(seen), visibility.visible_points(seen, whole=0)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, tiled.collect()))
    assert once.columns == seen.columns


def test_names_of_long_numbers_are_those_of_the_sql(spark, tmp_path):
    spark.createDataFrame([(7,), (999_999,), (1_000_000,), (12_345_678,)], "event_id long").write.parquet(str(tmp_path / "events.parquet"))
    duck = duckdb.connect()
    duck.sql(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    want = sorted(map(tuple, duck.sql(ORACLE_SQL["frame_name"]).fetchall()))
    assert sorted(map(tuple, QUERIES["frame_name"](spark, str(tmp_path)).collect())) == want


def shuffled_rows(df):
    """Rows that each shuffle of a query writes, as its plan counts them."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        kids = node.children()
        todo += [kids.apply(k) for k in range(kids.size())]
        todo += [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.plan()] if name.endswith("QueryStageExec") else []
    return out


def test_pixels_are_packed_before_they_are_shuffled(spark):
    """Some 49,000 pixels of three images, of which a tile's go as one row, and a few points that look them up."""
    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(c) for n, c in ((128, "iv"), (128, "iu"))]
    pixels = spark.range(3).select(F.col("id").alias("cam_id"), every[0]).select("cam_id", "iv", every[1]).withColumn("grey", (F.col("iv") * 3 + F.col("iu")) % 256)
    rows = spark.createDataFrame([(k % 3, k, k * 3, k * 2) for k in range(40)], "cam_id long, point_id long, iv int, iu int")
    found = raster.gather(rows, pixels, ["grey"])
    assert "Exchange" in plan(found) and sum(shuffled_rows(found)) < 1000
    assert sorted((r.point_id, r.grey) for r in found.collect()) == [(k, (k * 9 + k * 2) % 256) for k in range(40)]


@pytest.mark.parametrize("kind, value", [("tinyint", -7), ("int", 70_000), ("bigint", 2**40 + 1), ("float", 0.1), ("double", 1 / 3), ("decimal(10,2)", 4.25), ("string", "blue"), ("boolean", True)])
def test_packed_channels_are_as_they_were(spark, kind, value):
    """Of any type, with nulls, over the borders of tiles and in several batches of rows."""
    places = [(0, 0), (0, 255), (0, 256), (255, 255), (256, 0), (256, 256), (700, 3)]
    pixels = spark.createDataFrame([(1, v, u) for v, u in places] + [(1, 9, 9)], "cam_id long, iv int, iu int").withColumn("c", F.when(F.col("iv") != 9, F.lit(value)).cast(kind))
    rows = spark.createDataFrame([(1, k, v, u) for k, (v, u) in enumerate([*places, (9, 9), (8, 8)])], "cam_id long, point_id long, iv int, iu int")
    want = spark.range(1).select(F.lit(value).cast(kind)).first()[0]
    found = raster.gather(rows, pixels, ["c"])
    assert found.schema["c"].dataType.simpleString() == kind
    assert sorted((r.point_id, r.c) for r in found.collect()) == [*((k, want) for k in range(len(places))), (len(places), None)]


def test_colours_are_shuffled_before_their_medians(spark, monkeypatch):
    """Buffers of medians are larger than the colours themselves, of which hardly two are equal."""
    from cloudloom.plans import reconstruct

    monkeypatch.setattr(reconstruct.fusion, "dense_reid", lambda rows: rows)
    points = spark.createDataFrame([(1, 0.0, 0.0, 0.0)], "point_id long, x double, y double, z double")
    seen = spark.createDataFrame([(7, 1, 0.1, 0.2, 0.3), (8, 1, 0.3, 0.4, 0.5)], "cam_id long, point_id long, r double, g double, b double")
    found = reconstruct.colored_cloud(points, seen)
    (row,) = found.collect()
    assert (row.r, row.g, row.b) == (51, 76, 102)
    lines = plan(found).splitlines()
    partial = [k for k, line in enumerate(lines) if "partial_median" in line or "partial_percentile" in line]
    assert partial and not any("Exchange" in lines[k - 1] for k in partial)
