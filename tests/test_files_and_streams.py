import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloudloom.functions.geometry import Camera
from cloudloom.operators.cloud import voxel_sums
from cloudloom.sources import colmap, config, pcd, png, tables
from cloudloom.streaming import capture


def test_pcd_round_trip(spark, tmp_path):
    spark.dataSource.register(pcd.PcdDataSource)
    points = spark.range(1000).select(F.col("id").alias("point_id"), *(F.col("id").cast("float").alias(a) for a in "xyz"), *((F.col("id") % 256).cast("int").alias(c) for c in "rgb"))
    ordered = points.repartitionByRange(4, "point_id").sortWithinPartitions("point_id")
    for ascii_ in ("false", "true"):
        path = str(tmp_path / f"cloud_{ascii_}.pcd")
        ordered.write.format("pcd").option("ascii", ascii_).mode("append").save(path)
        back = spark.read.format("pcd").load(path)
        assert pcd.has_color(path) and back.columns == ["point_id", "x", "y", "z", "r", "g", "b"]
        assert back.exceptAll(points).count() == 0 and back.count() == 1000
    plain = str(tmp_path / "plain.pcd")
    ordered.select("point_id", "x", "y", "z").write.format("pcd").mode("append").save(plain)
    assert not pcd.has_color(plain) and spark.read.format("pcd").load(plain).agg(F.sum("x")).first()[0] == 499500.0
    assert [f for f in os.listdir(tmp_path) if f.endswith(".part")] == []


@pytest.mark.parametrize("text", [False, True])
def test_cloud_written_by_tasks_at_their_places(spark, tmp_path, text):
    """Unordered rows in small blocks come back in order; a failing task leaves no file behind."""
    spark.dataSource.register(pcd.PcdDataSource)
    ids = spark.range(0, 3000, 3, 5).orderBy(F.xxhash64("id")).withColumnRenamed("id", "point_id")
    points = ids.select("point_id", (F.col("point_id") / -7).cast("float").alias("x"), F.when(F.col("point_id") > 0, F.col("point_id") * 1e-30).alias("y"), F.lit(2.5).alias("z"), *((F.col("point_id") % 256).alias(c) for c in "rgb"), F.lit(1).alias("place"))
    path = str(tmp_path / "c.pcd")
    assert pcd.write_cloud(points, path, text=text, block=64) == 1000
    back = spark.read.format("pcd").load(path).orderBy("point_id").collect()
    want = points.orderBy("point_id").collect()
    assert [(r.point_id, r.x, r.z, r.r, r.b) for r in back] == [(k, w.x, 2.5, w.r, w.b) for k, w in enumerate(want)]
    assert np.isnan(back[0].y) and all(r.y == np.float32(w.y) for r, w in zip(back[1:], want[1:]))
    with pytest.raises(FileExistsError):
        pcd.write_cloud(points, path)
    broken = points.withColumn("x", F.when(F.col("point_id") == 30, F.raise_error(F.lit("no"))).otherwise(F.col("x")))
    with pytest.raises(Exception):
        pcd.write_cloud(broken, path, overwrite=True)
    assert pcd.write_cloud(points.where("false").drop("r"), str(tmp_path / "none.pcd"), text=text) == 0
    assert sorted(os.listdir(tmp_path)) == ["c.pcd", "none.pcd"] and spark.read.format("pcd").load(path).count() == 1000


def test_tables_round_trip(spark, tmp_path):
    poses = spark.createDataFrame([(0, "a.png", 1.5, *[k / 8 for k in range(7)])], tables.POSES)
    tables.write_poses(poses, str(tmp_path / "poses"))
    assert tables.read_poses(spark, str(tmp_path / "poses")).collect() == poses.collect()
    obs = spark.createDataFrame([(3, 0.5, 0.25, 1.0)], tables.OBSERVATIONS)
    tables.write_observations(obs, str(tmp_path / "obs"))
    assert tables.read_observations(spark, str(tmp_path / "obs")).collect() == obs.collect()
    (tmp_path / "bad.csv").write_text("index,filename,timestamp_sec,timestamp_nanosec\n0,a.png,x,1\n")
    with pytest.raises(Exception):
        tables.read_image_index(spark, str(tmp_path / "bad.csv")).collect()


SETTINGS = """# a camera of another make
time_delay: 0.033 # seconds
focal_length: 600.0
image_width: 1280
image_height: 720
principal_x: 640
principal_y: 360.0
voxel_size: 2e-1
max_depth: 200.0
filter_outliers: true
sor_neighbors: 12
sor_std_ratio: 1.5
edge_dilation_px: 1
fill_background: false
sphere_num_points: 700
jbf_sigma_c: 12.5
depth_render_hpr_radius: 30000.0
depth_sphere_num_points: 9
poses_file: other.csv
"""


def test_config_by_the_keys_of_the_files(tmp_path):
    (tmp_path / "c.cfg").write_text(SETTINGS)
    found = config.load_config(str(tmp_path / "c.cfg"))
    lens = found.camera
    assert (lens.focal, lens.width, lens.height, lens.center_x, lens.center_y, lens.max_depth) == (600.0, 1280, 720, 640.0, 360.0, 200.0)
    assert (found.time_delay, found.voxel_size, found.sor_neighbors, found.sor_std_ratio, found.edge_dilation_px) == (0.033, 0.2, 12, 1.5, 1)
    assert (found.fill_background, found.sphere_num_points, found.jbf_sigma_c, found.depth_render_hpr_radius, found.depth_sphere_num_points, found.poses_file) == (False, 700, 12.5, 30000.0, 9, "other.csv")
    assert found.trans_mat == config.BODY_AXES == lens.body_to_camera and found.edge_voxel_size == 0.01 and found.hpr_radius == 20_000.0


def test_config_defaults_of_each_step(tmp_path):
    (tmp_path / "c.cfg").write_text("min_depth: 2\n")
    assert config.load_config(str(tmp_path / "c.cfg"), "export").hpr_radius == 100_000.0
    depth = config.load_config(str(tmp_path / "c.cfg"), "depth")
    assert (depth.fill_background, depth.sphere_radius, depth.images_dir, depth.min_depth) == (False, 50.0, "distorted/images", 2.0)


@pytest.mark.parametrize("text", [None, "a: [1", "- 1\n- 2\n", "just words"])
def test_config_of_unreadable_files(tmp_path, text):
    if text is not None:
        (tmp_path / "c.cfg").write_text(text)
    with pytest.warns(UserWarning):
        assert config.load_config(str(tmp_path / "c.cfg")) == config.Config()


def test_config_reports_what_it_does_not_take(tmp_path):
    (tmp_path / "c.cfg").write_text("focal: 500\nimage_width: 12.5\nvoxel_size: wide\nfilter_outliers: 3\ntrans_mat: [1, 2]\n")
    with pytest.warns(UserWarning) as told:
        found = config.load_config(str(tmp_path / "c.cfg"))
    assert len(told) == 4 and found == config.Config(trans_mat=config.IDENTITY)
    (tmp_path / "d.cfg").write_text("")
    assert config.load_config(str(tmp_path / "d.cfg")) == config.Config()
    with pytest.raises(ValueError):
        config.Config(trans_mat=(1.0, 2.0))


def test_capture_config(tmp_path):
    names = {"output_dir": "/out", "image_save_interval": 10, "image_prefix": "frame", "odom_save_interval": 1, "leaf_size": 0.03, "max_path_length": 10000, "accumulator_max_points": 500000,
             "accumulator_publish_interval": 0, "global_downsample_interval": 5, "global_max_points": 5000000, "lidar_topic": "/l", "odom_topic": "/o", "image_topic": "/i", "frame_id": "World"}
    (tmp_path / "l.cfg").write_text("".join(f"{k}: {v}\n" for k, v in names.items()))
    assert vars(config.load_capture_config(str(tmp_path / "l.cfg"))) == {**names, "bag_output_dir": ""}
    (tmp_path / "m.cfg").write_text("output_dir: /out\n")
    with pytest.raises(KeyError):
        config.load_capture_config(str(tmp_path / "m.cfg"))


def test_png_round_trip(spark, tmp_path):
    rng = np.random.default_rng(0)
    for image in (rng.integers(0, 65536, (7, 5)).astype(np.uint16), rng.integers(0, 256, (4, 6, 3)).astype(np.uint8)):
        assert (png.decode_png(png.encode_png(image)) == image).all()
    assert png.decode_png(b"none") is None
    (tmp_path / "a.png").write_bytes(png.encode_png(image))
    (tmp_path / "b.png").write_bytes(b"broken")
    rows = png.read_images(spark, str(tmp_path)).collect()
    assert {r.filename for r in rows} == {"a.png"} and len(rows) == 24 and rows[0].r == image[0, 0, 0]
    codes = spark.createDataFrame([(1, 2, 3, 65535)], "cam_id long, iv int, iu int, code int")
    named = png.depth_pngs(codes, 8, 8).select(F.lit("d.png").alias("name"), "png")
    assert png.write_files(named, str(tmp_path / "out"), "name", "png").first().size > 0
    back = png.decode_png((tmp_path / "out" / "d.png").read_bytes())
    assert back[2, 3] == 65535 and back.sum() == 65535


def test_model_round_trip(spark, tmp_path):
    images = spark.createDataFrame([(1, "a.png", *[float(k) for k in range(7)]), (2, "b.png", *[0.0] * 7)], "image_id long, filename string, qw double, qx double, qy double, qz double, tx double, ty double, tz double")
    obs = spark.createDataFrame([(1, 1, 3.0, 4.0, 9), (1, 0, 1.0, 2.0, 8)], "image_id long, point2d_idx int, u double, v double, point3d_id long")
    points = spark.createDataFrame([(0, 1.0, 2.0, 3.0, 4, 5, 6, [(1, 0)]), (1, 1.0, 2.0, 3.0, 4, 5, 255, [])], "point3d_id long, x double, y double, z double, r int, g int, b int, track array<struct<image_id:long,point2d_idx:int>>")
    colmap.write_model(str(tmp_path), Camera(), colmap.image_records(images, obs), colmap.point_records(points))
    found = colmap.parse_images((tmp_path / "images.bin").read_bytes())
    assert [(i["image_id"], i["name"], i["points"]) for i in found] == [(1, "a.png", [(1.0, 2.0, 8), (3.0, 4.0, 9)]), (2, "b.png", [])]
    assert [p["track"] for p in colmap.parse_points((tmp_path / "points3D.bin").read_bytes())] == [[(1, 0)], [(1, 0)]]
    assert len((tmp_path / "cameras.bin").read_bytes()) == 8 + 4 + 4 + 16 + 24
    colmap.write_model(str(tmp_path), Camera(), colmap.image_records(images, obs, True), colmap.point_records(points, True), True)
    assert (tmp_path / "images.txt").read_text().splitlines()[3:5] == ["# Number of images: 2", "1 " + " ".join(f"{k:.12f}" for k in range(7)) + " 1 a.png"]
    assert "# Number of points: 2, mean track length: 1.0000\n" in (tmp_path / "points3D.txt").read_text()
    colmap.write_model(str(tmp_path), Camera(), colmap.image_records(images, obs), colmap.point_records(points), joined=False)
    for name in ("images", "points3D"):
        parts = tmp_path / f"{name}.bin.parts"
        names = ["head", *sorted(p.name for p in parts.iterdir() if p.name.startswith("part-"))]
        assert b"".join((parts / n).read_bytes() for n in names) == (tmp_path / f"{name}.bin").read_bytes()
    assert "a.png" in (tmp_path / "images.txt").read_text() and "SIMPLE_PINHOLE 640 480" in (tmp_path / "cameras.txt").read_text()


def run(spark, frame, mode="append"):
    query = frame.writeStream.format("memory").queryName("found").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table("found")


def scans(spark, tmp_path):
    for k in range(3):
        spark.range(k * 7, k * 7 + 7).select(F.lit(1).cast("long").alias("session_id"), F.col("id").alias("index"), F.lit(10).cast("long").alias("n_points")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return capture.stream_table(spark, str(tmp_path / "in"), "session_id long, index long, n_points long")


def test_every_nth_message_over_batches(spark, tmp_path):
    rows = run(spark, capture.decimated(scans(spark, tmp_path), 5)).collect()
    assert sorted((r["index"], r["saved"]) for r in rows) == [(4, 0), (9, 1), (14, 2), (19, 3)]


def test_batches_close_by_size_or_count(spark, tmp_path):
    rows = run(spark, capture.accumulated(scans(spark, tmp_path), 40, 3)).collect()
    assert sorted((r["batch"], r["first_index"], r["last_index"], r["by_size"]) for r in rows) == [(k, 3 * k, 3 * k + 2, False) for k in range(7)]


def test_size_wins_on_the_same_frame(spark, tmp_path):
    rows = run(spark, capture.accumulated(scans(spark, tmp_path), 30, 3)).collect()
    assert all(r["by_size"] for r in rows) and len(rows) == 7


def test_paths_are_bounded(spark, tmp_path):
    rows = run(spark, capture.paths(scans(spark, tmp_path).drop("n_points"), 4)).collect()
    assert sorted((r["index"], r["first_index"], r["n_poses"]) for r in rows) == [(k, max(0, k - 3), min(k + 1, 4)) for k in range(21)]


def test_streamed_map_is_the_batch_map(spark, tmp_path):
    for k in range(3):
        spark.range(k * 50, k * 50 + 50).select(*((F.col("id") * s % 17).cast("double").alias(a) for a, s in zip("xyz", (1, 3, 7)))).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    batch = voxel_sums(spark.read.parquet(str(tmp_path / "in")), 4.0)
    stream = capture.stream_table(spark, str(tmp_path / "in"), "x double, y double, z double")
    assert run(spark, capture.global_map(stream, 4.0), "complete").exceptAll(batch).count() == 0
    table = capture.MapTable(str(tmp_path / "map"), 4.0, 1_000)
    query = stream.writeStream.foreachBatch(table.update).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert table.snapshot(spark, 2).where("level = 0").select("ix", "iy", "iz", "n").exceptAll(batch.select("ix", "iy", "iz", "n")).count() == 0
