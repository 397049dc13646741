"""The offline chains as one lazy plan each, from recordings to coloured clouds, models and depth images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoints import settled
from ..functions.geometry import Camera, rotation_to_quaternion
from ..functions.sequence import dense_ids
from ..operators import camera as cams
from ..operators import cloud, fusion, pose, raster, tracks
from ..operators.visibility import visible_points
from ..sources import colmap
from ..sources.config import Config


def estimate_poses(images: DataFrame, odom: DataFrame, config: Config) -> DataFrame:
    """A pose for every image, at its delayed time."""
    return pose.interpolated(pose.asof_bracket(images, odom, config.time_delay))


def clean_cloud(points: DataFrame, config: Config) -> DataFrame:
    """Finite points without outliers, (point_id, x, y, z)."""
    kept = cloud.finite_points(points)
    if not config.filter_outliers:
        return kept
    return cloud.statistical_outliers(kept, config.sor_neighbors, config.sor_std_ratio)


def registration_cloud(points: DataFrame, config: Config, edges: DataFrame | None = None) -> DataFrame:
    """Voxel centroids, then background points around them, then kept edge points; numbered in that order.

    ``source`` is 0 for voxels, 1 for the sphere, 2 for edges.
    """
    cleaned = clean_cloud(points, config)
    voxels = settled(cloud.voxel_downsample(cleaned, config.voxel_size))
    parts = {0: dense_ids(voxels, ["ix", "iy", "iz"], "ordinal")}
    center = cloud.centroid(voxels).first()
    if config.fill_background and config.sphere_num_points and center.n:
        parts[1] = cloud.sphere_points(points.sparkSession, config.sphere_num_points, config.sphere_radius, (center.cx, center.cy, center.cz))
    if edges is not None:
        parts[2] = dense_ids(edges.select("point_id", "x", "y", "z"), ["point_id"], "ordinal")
    whole, begin = None, 0
    for source, part in parts.items():
        # Each part is numbered already; it begins where those before it end.
        rows = part.select(F.lit(source).alias("source"), "ordinal", "x", "y", "z", (F.col("ordinal") + begin).cast("long").alias("point_id"))
        whole = rows if whole is None else whole.unionByName(rows)
        begin += part.count()
    return whole


def edge_points(points: DataFrame, poses: DataFrame, grey: DataFrame, config: Config, hidden: bool = True) -> DataFrame:
    """Points of the full cloud that lie on image edges, one for each fine voxel."""
    lens = config.camera
    seen = cams.grouped_views(points, poses, lens)
    seen = visible_points(seen, config.hpr_radius) if hidden else seen
    mask = raster.canny_edges(grey, lens.width, lens.height, config.edge_canny_low, config.edge_canny_high)
    if config.edge_dilation_px:
        grown = raster.dilate(mask.withColumn("depth", F.lit(1.0)), 2 * config.edge_dilation_px + 1, lens.width, lens.height)
        mask = grown.select("cam_id", "iv", "iu")
    return raster.keep_edges(raster.edge_lookup(cams.projected(seen, lens), mask), points, config.edge_voxel_size)


def observe_colors(points: DataFrame, poses: DataFrame, pixels: DataFrame, lens: Camera, radius: float | None = None) -> DataFrame:
    """(cam_id, point_id, r, g, b): colours of the points that each image sees; ``radius`` switches hidden points off."""
    seen = cams.grouped_views(points, poses, lens)
    seen = visible_points(seen, radius) if radius else seen
    return raster.bilinear(cams.projected(seen, lens), pixels, lens.width, lens.height, ["r", "g", "b"])


def colored_cloud(points: DataFrame, observations: DataFrame) -> DataFrame:
    """(point3d_id, point_id, x, y, z, r, g, b): points with the median of their colours, 0..255."""
    # Colours are shuffled as they are: the buffers of their medians, in which hardly two are equal, take over twice as much.
    colors = fusion.quantized(fusion.median_color(observations.select("point_id", *"rgb").repartition("point_id")))
    return fusion.dense_reid(fusion.attach_geometry(colors, points))


def export_records(colored: DataFrame, poses: DataFrame, lens: Camera, radius: float | None = None, text: bool = False) -> tuple[DataFrame, DataFrame]:
    """Image and point records of a model; ``poses`` has cam_id, filename and a pose. The full image counts, without margin."""
    # Points go by their numbers in the model, which follow the order of their ids, so that nothing is joined to get them.
    seen = cams.grouped_views(colored.select(F.col("point3d_id").alias("point_id"), "x", "y", "z"), poses, lens)
    seen = visible_points(seen, radius) if radius else seen
    indexed = tracks.point2d_index(cams.projected(seen, lens, 0.0)).withColumnRenamed("point_id", "point3d_id")
    posed = pose.with_rotation(poses)
    turned = {f"r{i}{j}": F.col(f"r{j}{i}") for i in range(3) for j in range(3)}
    quaternion = [q.alias(n) for q, n in zip(rotation_to_quaternion(turned), ("qw", "qx", "qy", "qz"))]
    shift = [(-sum((F.col(f"r{k}{i}") * F.col(f"p{a}") for k, a in enumerate("xyz")), F.lit(0.0))).alias(f"t{n}") for i, n in enumerate("xyz")]
    images = posed.select(F.col("cam_id").alias("image_id"), "filename", *quaternion, *shift)
    numbered = tracks.build_tracks(indexed.withColumnRenamed("point3d_id", "point_id"))
    points = tracks.attach_tracks(colored.withColumn("point_id", F.col("point3d_id")), numbered)
    observed = indexed.select(F.col("cam_id").alias("image_id"), "point2d_idx", "u", "v", "point3d_id")
    return colmap.image_records(images, observed, text), colmap.point_records(points, text)


def depth_images(points: DataFrame, poses: DataFrame, lens: Camera, guide: DataFrame | None = None, fill: bool = False, radius: float | None = None) -> DataFrame:
    """(cam_id, iv, iu, depth, code): sparse depth of each image, completed along ``guide`` or without one if ``fill``."""
    seen = cams.grouped_views(points, poses, lens)
    seen = visible_points(seen, radius) if radius else seen
    depths = raster.zbuffer(cams.projected(seen, lens))
    if not fill:
        return raster.encoded(depths.drop(cams.GROUP))
    if guide is None:
        return raster.encoded(raster.densify_morphological(depths, lens.width, lens.height))
    guided = guide.select("cam_id").distinct()
    along = raster.densify_guided(depths.join(guided, "cam_id", "left_semi"), guide, lens.width, lens.height)
    alone = raster.densify_morphological(depths.join(guided, "cam_id", "left_anti"), lens.width, lens.height)
    return raster.encoded(along.unionByName(alone))
