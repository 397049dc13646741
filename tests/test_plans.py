"""The end-to-end chains on a small made-up recording."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloudloom.plans import reconstruct
from cloudloom.sources.config import Config
from cloudloom.streaming import capture

SETTINGS = Config(
    focal_length=40.0, principal_x=32.0, principal_y=24.0, image_width=64, image_height=48, max_depth=60.0, voxel_size=0.5, sphere_radius=50.0,
    sphere_num_points=30, sor_neighbors=4, sor_std_ratio=3.0, poses_are_body_frame=False, edge_canny_low=50.0, edge_canny_high=120.0, edge_dilation_px=1,
    edge_voxel_size=0.02,
)
LENS = SETTINGS.camera


@pytest.fixture(scope="module")
def wall(spark):
    """A flat wall ten units ahead of two cameras."""
    xs, ys = np.meshgrid(np.arange(-6, 6.1, 0.5), np.arange(-4, 4.1, 0.5))
    rows = [(k, float(x), float(y), 10.0) for k, (x, y) in enumerate(zip(xs.ravel(), ys.ravel()))]
    return spark.createDataFrame(rows, "point_id long, x double, y double, z double")


@pytest.fixture(scope="module")
def poses(spark):
    rows = [(1, "a.png", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0), (2, "b.png", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)]
    return spark.createDataFrame(rows, "cam_id long, filename string, px double, py double, pz double, qx double, qy double, qz double, qw double")


@pytest.fixture(scope="module")
def pixels(spark, poses):
    """Left half dark, right half bright."""
    grid = poses.select("cam_id", F.explode(F.sequence(F.lit(0), F.lit(47))).alias("iv")).select("cam_id", "iv", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("iu"))
    value = F.when(F.col("iu") < 32, F.lit(10)).otherwise(F.lit(200))
    return grid.withColumns({"r": value, "g": value, "b": value, "grey": value.cast("double")})


def test_registration_cloud_is_numbered_in_order(wall):
    found = reconstruct.registration_cloud(wall, SETTINGS).collect()
    assert sorted(r.point_id for r in found) == list(range(len(found)))
    ordered = sorted(found, key=lambda r: r.point_id)
    assert [r.source for r in ordered] == sorted(r.source for r in found) and sum(r.source for r in found) == 30


def test_colours_of_a_wall(wall, poses, pixels):
    seen = reconstruct.observe_colors(wall, poses, pixels, LENS)
    colored = reconstruct.colored_cloud(wall, seen).collect()
    assert colored and {r.point3d_id for r in colored} == set(range(len(colored)))
    assert {r.r for r in colored if r.x < -1} <= {9, 10} and {r.r for r in colored if r.x > 2} <= {199, 200}
    hidden = reconstruct.observe_colors(wall, poses, pixels, LENS, radius=1000.0)
    assert 0 < hidden.count() <= seen.count()


def test_edge_points_lie_on_the_border(wall, poses, pixels):
    found = reconstruct.edge_points(wall, poses.where("cam_id = 1"), pixels.where("cam_id = 1"), SETTINGS, hidden=False).collect()
    assert found and all(abs(r.x) <= 0.75 for r in found)


def test_models_and_depth(wall, poses, pixels):
    colored = reconstruct.colored_cloud(wall, reconstruct.observe_colors(wall, poses, pixels, LENS))
    images, points = reconstruct.export_records(colored, poses, LENS)
    assert images.count() == 2 and points.count() == colored.count()
    sparse = reconstruct.depth_images(wall, poses, LENS)
    assert {r.depth for r in sparse.collect()} == {10.0} and {r.code for r in sparse.collect()} == {6554}
    for guide in (pixels.where("cam_id = 1"), None):
        filled = reconstruct.depth_images(wall, poses, LENS, guide, fill=True)
        assert filled.select("cam_id").distinct().count() == 2 and filled.count() > sparse.count()


def test_late_events_are_windowed(spark, tmp_path):
    events = spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id,0) ts, 'view' event_type, 1.0d value from range(30)")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = capture.stream_table(spark, str(tmp_path / "in"), "ts timestamp, event_type string, value double")
    query = capture.event_windows(stream).writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.n for r in spark.table("windows").collect()) == [10, 10, 10]
