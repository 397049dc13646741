"""Which points each camera sees, and where."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Camera, in_frustum, in_image, into_camera, pixel, project
from .pose import with_rotation

_POSE = ["px", "py", "pz", *(f"r{i}{j}" for i in range(3) for j in range(3))]


#: Most points of a space cell that one task deals out to cameras; fuller cells are divided.
CELL_POINTS = 20_000
#: Column that names the neighbouring cameras that one task works out together.
GROUP = "view_group"
#: Most cameras (about) in such a group.
GROUP_CAMERAS = 64


def image_keys(rows: DataFrame, id_col: str = "cam_id") -> list[str]:
    """Columns by which rows of one image are grouped. Rows from :func:`grouped_views` lie by their group of cameras already, so nothing is moved."""
    return [GROUP, id_col] if GROUP in rows.columns else [id_col]


def frustum_join(points: DataFrame, cameras: DataFrame, camera: Camera = Camera(), id_col: str = "cam_id", cells: int = 16) -> DataFrame:
    """(cam_id, point_id, cx, cy, cz) of the points in each camera's view; see :func:`grouped_views`."""
    return grouped_views(points, cameras, camera, id_col, cells).drop(GROUP)


def grouped_views(points: DataFrame, cameras: DataFrame, camera: Camera = Camera(), id_col: str = "cam_id", cells: int = 16) -> DataFrame:
    """(view_group, cam_id, point_id, cx, cy, cz) of the points in each camera's view, lying by groups of neighbouring cameras.

    Each camera is sent to the coarse cells (half the reach of a view) that it
    can touch, where it meets the fine cells that hold points; those that its
    view touches are kept. A fine cell is a ``cells``-th of the reach. Cameras
    that stand within two of them are a group, or several if they are many:
    the larger a group, the fewer copies of a point. A point goes once
    to each group whose views touch its cell, and meets the group's cameras
    there, where the exact test follows. So points are shuffled once a group
    and not once an image, and steps that group by :func:`image_keys` find all
    rows of an image in one partition. Neither side is broadcast by hand, no
    point meets a camera out of reach; a group's cameras are held, its points
    stream by.
    """
    reach, _ = _stretch(camera)
    wide, fine = reach / 2, reach / cells
    posed = with_rotation(cameras.select(id_col, "px", "py", "pz", "qx", "qy", "qz", "qw")).select(id_col, *_POSE)
    home = [f"h{a}" for a in "xyz"]
    posed = posed.withColumns({h: F.floor(F.col(f"p{a}") / (2 * fine)) for h, a in zip(home, "xyz")})
    crowd = posed.groupBy(*home).agg(F.ceil(F.count("*") / GROUP_CAMERAS).alias("crowd"))
    group = F.xxhash64(*home, F.pmod(F.xxhash64(id_col, "px", "py", "pz"), F.col("crowd")))
    posed = posed.join(crowd, home).select(group.alias(GROUP), id_col, *_POSE)
    spread, names = posed, [f"w{a}" for a in "xyz"]
    for a in "xyz":
        low, high = F.floor((F.col(f"p{a}") - reach - fine) / wide), F.floor((F.col(f"p{a}") + reach + fine) / wide)
        spread = spread.withColumn(f"w{a}", F.explode(F.sequence(low, high)))
    # The middle of a fine cell decides its coarse cell, so a coarse cell reaches a fine cell further than its side.
    spread = _touching(spread, names, wide, wide + fine, camera)
    own = [f"i{a}" for a in "xyz"]
    placed = points.select("point_id", "x", "y", "z", *(F.floor(F.col(a) / fine).alias(n) for a, n in zip("xyz", own)))
    full = placed.groupBy(*own).agg(F.count("*").alias("n"))
    full = full.withColumns({w: F.floor((F.col(n) + 0.5) * (fine / wide)) for w, n in zip(names, own)})
    views = _touching(full.join(spread, names), own, fine, fine, camera).select(GROUP, *own, "n").distinct()
    parts = F.ceil(F.col("n") / CELL_POINTS).cast("int")
    views = views.select(GROUP, *own, F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    divided = full.where(F.col("n") > CELL_POINTS).select(*own, parts.alias("parts"))
    dealt = placed.join(divided, own, "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("point_id", "x", "y", "z"), F.col("parts")), F.lit(0)).cast("int"))
    sent = dealt.drop("parts").join(views, [*own, "part"]).select(GROUP, "point_id", "x", "y", "z")
    # Cameras look small beside points; a broadcast of them would leave every image's rows scattered.
    met = sent.join(posed.hint("shuffle_hash"), GROUP)
    cx, cy, cz = into_camera(F.col("x"), F.col("y"), F.col("z"), camera)
    # By a generator, so that the formulas are worked out once and not repeated in every later condition.
    seen = met.select(GROUP, id_col, "point_id", F.inline(F.array(F.struct(cx.alias("cx"), cy.alias("cy"), cz.alias("cz")))))
    return seen.where(in_frustum(F.col("cx"), F.col("cy"), F.col("cz"), camera))


def _stretch(camera: Camera) -> tuple[float, float]:
    """How far from a pose its view can reach, and how much longer a distance can be in the camera's frame than in the world."""
    if camera.body_to_camera is None:
        return camera.reach, 1.0
    whole = np.array(camera.body_to_camera, float).reshape(4, 4)
    turned, shift = whole[:3, :3], whole[:3, 3]
    return float(np.linalg.norm(turned) * camera.reach + np.linalg.norm(shift)), float(np.linalg.norm(np.linalg.inv(whole)[:3, :3]))


def _touching(rows: DataFrame, cell: list[str], size: float, width: float, camera: Camera) -> DataFrame:
    """Rows whose cell, taken as ``width`` wide around its middle, the camera's view may touch.

    The middle must be no farther outside the view than half the diagonal.
    """
    half = width * math.sqrt(3) / 2 * _stretch(camera)[1]
    x, y, z = into_camera(*((F.col(c) + 0.5) * size for c in cell), camera)
    slack_x, slack_y = (half * math.sqrt(1 + t * t) for t in (camera.tan_x, camera.tan_y))
    return rows.where(
        z.between(camera.min_depth - half, camera.max_depth + half)
        & (F.abs(x) <= z * camera.tan_x + slack_x) & (F.abs(y) <= z * camera.tan_y + slack_y)
    )


def projected(seen: DataFrame, camera: Camera = Camera(), margin: float | None = None) -> DataFrame:
    """Adds u, v and the pixel iu, iv; keeps what falls inside the image less its margin."""
    u, v = project(F.col("cx"), F.col("cy"), F.col("cz"), camera)
    placed = seen.withColumns({"u": u, "v": v}).where(in_image(F.col("u"), F.col("v"), camera, margin))
    return placed.withColumns({"iu": pixel(F.col("u"), camera.width), "iv": pixel(F.col("v"), camera.height)})


def points_per_image(seen: DataFrame, cameras: DataFrame, id_col: str = "cam_id") -> DataFrame:
    """(cam_id, n_points) for every camera, also those that see nothing."""
    counts = seen.groupBy(id_col).agg(F.count("*").alias("n"))
    return cameras.select(id_col).join(counts, id_col, "left").select(id_col, F.coalesce("n", F.lit(0)).alias("n_points"))
