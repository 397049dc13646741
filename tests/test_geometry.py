import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloudloom.functions import geometry as geo
from cloudloom.functions.hull import hull_vertices
from cloudloom.functions.sequence import dense_ids, last_rows
from cloudloom.operators import batches, camera, cloud, fusion, pose, raster, tracks, visibility

ODOM = "odom_id long, t double, px double, py double, pz double, qx double, qy double, qz double, qw double"


def sample(i, t, px=0.0, q=(0.0, 0.0, 0.0, 1.0)):
    return (i, float(t), float(px), 0.0, 0.0, *q)


def brackets(spark, times, odom, **options):
    images = spark.createDataFrame([(k, float(t)) for k, t in enumerate(times)], "image_id long, t double")
    found = pose.asof_bracket(images, spark.createDataFrame(odom, ODOM), **options)
    return {r.image_id: r for r in found.collect()}, found


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_brackets_at_the_edges(spark, ranges):
    odom = [sample(1, 1), sample(2, 2), sample(3, 7), sample(4, 7)]
    found, _ = brackets(spark, [0.5, 1, 1.5, 2, 6.9, 7, 8], odom, ranges=ranges)
    ids = [(r.before and r.before.odom_id, r.after and r.after.odom_id) for _, r in sorted(found.items())]
    assert ids == [(None, 1), (None, 1), (1, 2), (1, 2), (2, 3), (2, 3), (4, None)]


def test_brackets_of_a_fleet_in_one_hour(spark):
    """Vehicles (one without a name) whose times lie together, with ties and missing times, against a plain search."""
    rng = np.random.default_rng(5)
    cars = ["a", "b", None]
    odom = [(cars[k % 3], *sample(k, rng.integers(0, 40) / 4)) for k in range(300)] + [("a", 900, None, *sample(0, 0)[2:])]
    asked = [(cars[k % 3], k, float(rng.integers(-4, 48)) / 4) for k in range(200)] + [("b", 900, None), ("c", 901, 1.0)]
    images = spark.createDataFrame(asked, "car string, image_id long, t double")
    samples = spark.createDataFrame(odom, "car string, " + ODOM)
    for ranges in (1, 7):
        found = {r.image_id: r for r in pose.asof_bracket(images, samples, ranges=ranges, partition_by=["car"]).collect()}
        assert len(found) == len(asked)
        for car, k, t in asked:
            own = sorted((o[2], o[1]) for o in odom if o[0] == car and o[2] is not None) if t is not None else []
            before, after = [o for o in own if o[0] < t], [o for o in own if o[0] >= t]
            r = found[k]
            assert (r.car, r.t) == (car, t)
            assert (r.before and r.before.odom_id, r.after and r.after.odom_id) == (before[-1][1] if before else None, after[0][1] if after else None)


def test_ranges_of_one_hour_are_even(spark):
    """All rows within an hour: no range holds much more than its share."""
    odom = spark.range(20_000).selectExpr("id odom_id", "id * 0.1 t", *(f"0d {c}" for c in ("px", "py", "pz", "qx", "qy", "qz")), "1d qw")
    images = spark.range(2_000).selectExpr("id image_id", "id + 0.05 t")
    found = pose.asof_bracket(images, odom, ranges=8)
    assert found.where("before.odom_id = floor(t * 10) and after.odom_id = floor(t * 10) + 1").count() == 2_000
    per_range = found.groupBy(F.floor(F.col("t") / 250)).count().collect()
    assert len(per_range) == 8


def test_no_odometry_drops_no_image(spark):
    found, _ = brackets(spark, [1.0], [])
    assert found[0].before is None and found[0].after is None


def test_interpolation_is_on_the_unit_sphere_and_takes_the_short_way(spark):
    half = math.sqrt(0.5)
    for q in ((0.0, 0.0, half, half), (-0.0, -0.0, -half, -half)):
        _, table = brackets(spark, [0.5], [sample(1, 0, 0), sample(2, 1, 4, q)])
        r = pose.interpolated(table).first()
        assert r.px == 2.0 and r.matched
        assert math.isclose(r.qz, math.sin(math.pi / 8), abs_tol=1e-12) and math.isclose(r.qw, math.cos(math.pi / 8), abs_tol=1e-12)


def test_equal_quaternions_and_endpoints(spark):
    _, table = brackets(spark, [0.5, 1.0], [sample(1, 0), sample(2, 1, 3)])
    rows = {r.image_id: r for r in pose.interpolated(table).collect()}
    assert rows[0].qw == 1.0 and rows[1].px == 3.0


def test_pixels_round_half_away(spark):
    df = spark.createDataFrame([(-0.5,), (0.5,), (1.5,), (638.5,), (639.9,)], "u double")
    assert [r[0] for r in df.select(geo.pixel(F.col("u"), 640)).collect()] == [0, 1, 2, 639, 639]
    assert [r[0] for r in df.select(geo.half_away(F.col("u")).cast("int")).collect()] == [-1, 1, 2, 639, 640]


def test_frustum_join_is_the_cross_product_filtered(spark):
    rng = np.random.default_rng(3)
    points = spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(rng.normal(0, 30, (400, 3)))], "point_id long, x double, y double, z double")
    cams = spark.createDataFrame([(k, *map(float, p), *map(float, q)) for k, (p, q) in enumerate(zip(rng.normal(0, 10, (5, 3)), rng.normal(0, 1, (5, 4))))], "cam_id long, px double, py double, pz double, qx double, qy double, qz double, qw double")
    lens = geo.Camera(max_depth=40.0)
    posed = pose.with_rotation(cams).crossJoin(points)
    c = geo.into_camera(F.col("x"), F.col("y"), F.col("z"), lens)
    want = posed.select("cam_id", "point_id", *(v.alias(f"c{a}") for v, a in zip(c, "xyz"))).where(geo.in_frustum(F.col("cx"), F.col("cy"), F.col("cz"), lens))
    for cells in (1, 2, 3):
        found = camera.frustum_join(points, cams, lens, cells=cells)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    moved = geo.Camera(max_depth=40.0, body_to_camera=(0, 0, 1, 0.5, -1, 0, 0, 0.1, 0, -1, 0, 0.2, 0, 0, 0, 1))
    c = geo.into_camera(F.col("x"), F.col("y"), F.col("z"), moved)
    want = posed.select("cam_id", "point_id", *(v.alias(f"c{a}") for v, a in zip(c, "xyz"))).where(geo.in_frustum(F.col("cx"), F.col("cy"), F.col("cz"), moved))
    assert sorted(map(tuple, camera.frustum_join(points, cams, moved).collect())) == sorted(map(tuple, want.collect()))
    inverse = np.linalg.inv(np.array(moved.body_to_camera, float).reshape(4, 4))
    r = camera.frustum_join(points, cams, moved).first()
    p = points.where(F.col("point_id") == r.point_id).first()
    body = pose.with_rotation(cams).where(F.col("cam_id") == r.cam_id).first()
    rotation = np.array([[body[f"r{i}{j}"] for j in range(3)] for i in range(3)])
    local = rotation.T @ (np.array([p.x, p.y, p.z]) - [body.px, body.py, body.pz])
    assert np.allclose(inverse @ [*local, 1], [r.cx, r.cy, r.cz, 1])


def test_full_cells_are_divided(spark, monkeypatch):
    monkeypatch.setattr(camera, "CELL_POINTS", 7)
    points = spark.range(200).select(F.col("id").alias("point_id"), F.lit(0.1).alias("x"), F.lit(0.2).alias("y"), (F.col("id") * 0.01).alias("z"))
    cams = spark.createDataFrame([(k, 0.0, 0.0, -10.0 - k, 0.0, 0.0, 0.0, 1.0) for k in range(3)], "cam_id long, px double, py double, pz double, qx double, qy double, qz double, qw double")
    assert camera.frustum_join(points, cams, geo.Camera(max_depth=40.0)).select("cam_id", "point_id").distinct().count() == 600


def test_hull_keeps_corners_and_drops_the_inside():
    rng = np.random.default_rng(1)
    cube = np.array([(x, y, z) for x in (0, 1) for y in (0, 1) for z in (0, 1)], float)
    cloud_ = np.vstack([rng.uniform(0.05, 0.95, (500, 3)), cube, cube])
    assert set(hull_vertices(cloud_)) == set(range(500, 508))
    ball = rng.normal(size=(300, 3))
    ball /= np.linalg.norm(ball, axis=1, keepdims=True)
    assert len(hull_vertices(np.vstack([ball, ball * 0.5]))) == 300
    order = rng.permutation(300)
    assert len(hull_vertices(ball[order])) == 300
    assert len(hull_vertices(np.zeros((6, 3)))) == 1


def test_an_occluder_hides_what_lies_behind(spark):
    near = [(0, k, x * 0.1, y * 0.1, 2.0) for k, (x, y) in enumerate((x, y) for x in range(-10, 11) for y in range(-10, 11))]
    far = [(0, 1000 + k, x * 0.3, 0.0, 20.0) for k, x in enumerate(range(-5, 6))]
    df = spark.createDataFrame(near + far, "cam_id long, point_id long, cx double, cy double, cz double")
    seen = {r.point_id for r in visibility.visible_points(df, 1000.0).collect()}
    assert not {p for p in seen if p >= 1000} and len(seen) > 200
    assert visibility.visible_points(df.where("point_id = 1000"), 1000.0).count() == 1


def test_voxels_floor_below_zero_and_skip_what_is_not_finite(spark):
    df = spark.createDataFrame([(1, -0.1, 0.0, 0.0), (2, -1.0, 0.0, 0.0), (3, float("nan"), 0.0, 0.0), (4, 0.0, float("inf"), 0.0), (5, None, 0.0, 0.0)], "point_id long, x double, y double, z double")
    assert {(r.ix, r.n) for r in cloud.voxel_downsample(df, 1.0).collect()} == {(-1, 2)}


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    xyz = np.round(np.vstack([rng.normal(0, 1, (80, 3)), rng.normal(30, 0.1, (10, 3))]), 2)
    df = spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(xyz)], "point_id long, x double, y double, z double")
    found = {(r.point_id, r["rank"]): r.neighbour for r in cloud.knn(df, 6).collect()}
    for k, p in enumerate(xyz):
        d = ((xyz - p) ** 2)
        order = sorted((j for j in range(len(xyz)) if j != k), key=lambda j: (0.0 + d[j][0] + d[j][1] + d[j][2], j))[:6]
        assert [found[k, r] for r in range(1, 7)] == order


def test_numbers_and_histories_without_one_task(spark):
    df = spark.createDataFrame([(float(k % 7), k) for k in range(300)], "t double, id long")
    ids = {r.id: r.seq for r in dense_ids(df, ["t", "id"], ranges=9).collect()}
    assert [k for k, _ in sorted(ids.items(), key=lambda x: x[1])] == sorted(range(300), key=lambda k: (k % 7, k))
    assert sorted(ids.values()) == list(range(300))
    held = last_rows(spark.range(50).withColumnRenamed("id", "seq"), "seq", ["seq"], 4, block=5).collect()
    assert {(r.seq, tuple(h.seq for h in r.history)) for r in held} == {(k, tuple(range(max(0, k - 3), k + 1))) for k in range(50)}
    with pytest.raises(ValueError):
        batches.every_nth(df, 0, ["id"])


def test_medians_in_single_precision(spark):
    df = spark.createDataFrame([(1, 0.1, 0.0, 0.0), (1, 0.2, 0.0, 0.0), (2, 0.3, 1.0, 0.0)], "point_id long, r float, g float, b float")
    rows = {r.point_id: r for r in fusion.median_color_f32(df).collect()}
    assert np.float32(rows[1].r) == (np.float32(0.1) + np.float32(0.2)) * np.float32(0.5) and rows[2].g == 1.0


def test_tracks_of_points_that_nothing_saw(spark):
    points = spark.createDataFrame([(1,), (2,)], "point_id long")
    seen = spark.createDataFrame([(7, 1, 0), (3, 1, 2)], "cam_id long, point_id long, point2d_idx int")
    rows = {r.point_id: r for r in tracks.attach_tracks(points, tracks.build_tracks(seen)).collect()}
    assert [tuple(t) for t in rows[1].track] == [(3, 2), (7, 0)] and [tuple(t) for t in rows[2].track] == [(1, 0)] and rows[2].track_length == 0


def test_depth_codes(spark):
    from cloudloom.functions.color import inverse_depth

    df = spark.createDataFrame([(0.0,), (-1.0,), (1.0,), (2.0,), (200.0,)], "d double")
    assert [r[0] for r in df.select(inverse_depth(F.col("d"))).collect()] == [0, 0, 65535, 32768, 328]


def test_filled_depth_keeps_what_was_measured(spark):
    z = spark.createDataFrame([(1, 5, 5, 3.0), (1, 5, 8, 4.0)], "cam_id long, iv int, iu int, depth float")
    guide = spark.range(1).select(F.lit(1).cast("long").alias("cam_id"), F.explode(F.sequence(F.lit(0), F.lit(19))).alias("iv")).select("cam_id", "iv", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("iu"), F.lit(9).alias("r"), F.lit(9).alias("g"), F.lit(9).alias("b"))
    for filled in (raster.densify_guided(z, guide, 20, 20), raster.densify_morphological(z, 20, 20)):
        rows = {(r.iv, r.iu): r.depth for r in filled.collect()}
        assert rows[5, 5] == 3.0 and rows[5, 8] == 4.0 and len(rows) > 20


def test_canny_finds_the_border_of_a_square(spark):
    rows = [(1, y, x, 200.0 if 5 <= x < 15 and 5 <= y < 15 else 0.0) for y in range(20) for x in range(20)]
    df = spark.createDataFrame(rows, "cam_id long, iv int, iu int, grey double")
    edges = {(r.iv, r.iu) for r in raster.canny_edges(df, 20, 20).collect()}
    assert edges and all(min(abs(y - 5), abs(y - 14), abs(x - 5), abs(x - 14)) <= 1 for y, x in edges)
    assert raster.canny_edges(df.withColumn("grey", F.lit(7.0)), 20, 20).count() == 0


def test_bilinear_of_a_constant_is_constant(spark):
    p = spark.createDataFrame([(1, 1, 3.25, 4.75), (1, 2, 9.0, 9.0)], "cam_id long, point_id long, u double, v double")
    pixels = spark.createDataFrame([(1, y, x, 51) for y in range(10) for x in range(10)], "cam_id long, iv int, iu int, grey int")
    assert {r.grey for r in raster.bilinear(p, pixels, 10, 10, ["grey"]).collect()} == {0.2}


def test_replayed_maps_are_unweighted(spark):
    one = spark.createDataFrame([(0.0, 0.0, 0.0), (0.2, 0.0, 0.0), (0.4, 0.0, 0.0)], "x double, y double, z double")
    two = spark.createDataFrame([(0.8, 0.0, 0.0)], "x double, y double, z double")
    assert abs(cloud.replayed_map([one, two], 1.0, 2).first().x - 0.5) < 1e-12
    assert cloud.replayed_map([one, two], 1.0, 3).count() == 2
    exact = cloud.centroids(cloud.merge_sums(cloud.voxel_sums(one, 1.0), cloud.voxel_sums(two, 1.0)))
    assert abs(exact.first().x - 0.35) < 1e-12


def _plain_neighbours(rows, k):
    out = set()
    for a in rows:
        near = sorted((sum((p - q) ** 2 for p, q in zip(a[1:], b[1:])), b[0]) for b in rows if b[0] != a[0])[:k]
        out |= {(a[0], b, r + 1) for r, (_, b) in enumerate(near)}
    return out


@pytest.mark.parametrize("cell", [None, 1e-4, 3.0, 500.0])
def test_neighbours_are_exact_for_any_cell(spark, cell):
    rng = np.random.default_rng(5)
    half = rng.normal(0, 0.01, (60, 3))  # half of all points in one small place, some at one position
    half[:20] = half[0]
    rows = [(k, *map(float, p)) for k, p in enumerate(np.vstack([half, rng.uniform(-100, 100, (60, 3))]))]
    df = spark.createDataFrame(rows, "point_id long, x double, y double, z double")
    found = {(r.point_id, r.neighbour, r.rank) for r in cloud.knn(df, 4, cell).collect()}
    assert found == _plain_neighbours(rows, 4)


def test_neighbours_of_few_points(spark):
    shape = "point_id long, x double, y double, z double"
    rows = [(1, 0.0, 0.0, 0.0), (2, 50.0, 0.0, 0.0), (3, 0.0, 90.0, 0.0)]
    assert cloud.knn(spark.createDataFrame(rows, shape), 2, cell=1e-4).count() == 6
    assert cloud.knn(spark.createDataFrame(rows[:1], shape), 2).count() == 0
    assert cloud.knn(spark.createDataFrame([], shape), 2).count() == 0


def test_groups_are_numbered_each_by_itself(spark):
    rows = [(g, v) for g in (None, 1, 2, 3) for v in range(37 * (g or 1))]
    df = spark.createDataFrame(rows, "g int, v int").repartition(5)
    assert all(r.seq == r.v for r in dense_ids(df, ["v"], partition_by=["g"]).collect())
    same = spark.range(1000).select(F.lit(7).alias("t"), "id")  # one value in the first column
    assert all(r.seq == r.id for r in dense_ids(same, ["t", "id"], ranges=6).collect())
