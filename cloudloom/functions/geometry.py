"""Row-wise geometry as column expressions; all of it stays inside generated code."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Camera:
    """A pinhole camera without distortion; one focal length, a depth range and a border margin.

    ``body_to_camera`` is a row-major 4 x 4 matrix for poses that are the
    body's; it may be any invertible matrix.
    """

    focal: float = 300.0
    width: int = 640
    height: int = 480
    center_x: float = 320.0
    center_y: float = 240.0
    min_depth: float = 1.0
    max_depth: float = 200.0
    margin: float = 0.01
    body_to_camera: tuple[float, ...] | None = field(default=None)

    def __post_init__(self) -> None:
        if self.body_to_camera is not None and len(self.body_to_camera) != 16:
            raise ValueError("body_to_camera must have 16 values")

    @property
    def tan_x(self) -> float:
        """Tangent of half the field of view."""
        return self.width / (2 * self.focal)

    @property
    def tan_y(self) -> float:
        return self.height / (2 * self.focal)

    @property
    def reach(self) -> float:
        """Distance from the camera to the farthest corner of what it sees."""
        return self.max_depth * math.sqrt(1 + self.tan_x**2 + self.tan_y**2)


def combine_timestamp(sec: Column, nanosec: Column) -> Column:
    """Seconds as a double."""
    return sec.cast("double") + nanosec.cast("double") * F.lit(1e-9)


def shift_time(t: Column, delay: float) -> Column:
    """``t`` plus a delay that is held in single precision."""
    return t + F.lit(float(np.float32(delay)))


def finite(*values: Column) -> Column:
    """All values are numbers other than NaN and infinity. Null is not finite."""
    out = F.lit(True)
    for v in values:
        out = out & v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return out


def rotation(x: Column, y: Column, z: Column, w: Column) -> dict[str, Column]:
    """Entries r00..r22 of the rotation of a unit quaternion."""
    two, one = F.lit(2.0), F.lit(1.0)
    return {
        "r00": one - two * (y * y + z * z), "r01": two * (x * y - z * w), "r02": two * (x * z + y * w),
        "r10": two * (x * y + z * w), "r11": one - two * (x * x + z * z), "r12": two * (y * z - x * w),
        "r20": two * (x * z - y * w), "r21": two * (y * z + x * w), "r22": one - two * (x * x + y * y),
    }


def into_camera(x: Column, y: Column, z: Column, camera: Camera) -> tuple[Column, Column, Column]:
    """World coordinates in the frame of a pose (columns px, py, pz, r00..r22), then of the camera on it."""
    dx, dy, dz = x - F.col("px"), y - F.col("py"), z - F.col("pz")
    out = tuple(F.col(f"r0{k}") * dx + F.col(f"r1{k}") * dy + F.col(f"r2{k}") * dz for k in range(3))
    if camera.body_to_camera is None:
        return out
    inverse = np.linalg.inv(np.array(camera.body_to_camera, float).reshape(4, 4))
    return tuple(sum((F.lit(float(inverse[r, c])) * out[c] for c in range(3)), F.lit(float(inverse[r, 3]))) for r in range(3))


def project(cx: Column, cy: Column, cz: Column, camera: Camera) -> tuple[Column, Column]:
    """Pixel coordinates (u, v)."""
    f = F.lit(camera.focal)
    return f * cx / cz + F.lit(camera.center_x), f * cy / cz + F.lit(camera.center_y)


def half_away(x: Column) -> Column:
    """Nearest integer, halves away from zero."""
    return F.when(x < 0, -F.floor(-x + 0.5)).otherwise(F.floor(x + 0.5))


def pixel(u: Column, size: int) -> Column:
    """Pixel index of a coordinate, held inside the image."""
    return F.greatest(F.least(half_away(u), F.lit(size - 1)), F.lit(0)).cast("int")


def in_depth(cz: Column, camera: Camera) -> Column:
    return cz.between(F.lit(camera.min_depth), F.lit(camera.max_depth))


def in_frustum(cx: Column, cy: Column, cz: Column, camera: Camera) -> Column:
    """Depth range inclusive, sides strict; symmetric around the optical axis."""
    return in_depth(cz, camera) & (F.abs(cx) < cz * F.lit(camera.tan_x)) & (F.abs(cy) < cz * F.lit(camera.tan_y))


def in_image(u: Column, v: Column, camera: Camera, margin: float | None = None) -> Column:
    """Half-open test against the image less a share of each side."""
    m = camera.margin if margin is None else margin
    mx, my = camera.width * m, camera.height * m
    return (u >= F.lit(mx)) & (u < F.lit(camera.width - mx)) & (v >= F.lit(my)) & (v < F.lit(camera.height - my))


def voxel_index(x: Column, size: float) -> Column:
    return F.floor(x * F.lit(1.0 / size)).cast("long")


def voxel_key(ix: Column, iy: Column, iz: Column) -> Column:
    """Three 21-bit fields in one long, x lowest; cells 2**21 apart share a key."""
    mask = F.lit((1 << 21) - 1)
    x, y, z = (i.bitwiseAND(mask) for i in (ix, iy, iz))
    return x.bitwiseOR(F.shiftleft(y, 21)).bitwiseOR(F.shiftleft(z, 42))


def spherical_flip(x: Column, y: Column, z: Column, radius: float) -> tuple[Column, Column, Column]:
    """Points mirrored on a sphere around the origin; points at the origin stay."""
    d = F.sqrt(x * x + y * y + z * z)
    scale = F.when(d < 1e-10, F.lit(0.0)).otherwise(F.lit(2.0) * (F.lit(radius) - d) / d)
    return x + scale * x, y + scale * y, z + scale * z


def slerp_weights(a: list[Column], b: list[Column], share: Column) -> tuple[Column, Column]:
    """Weights of two unit quaternions (x, y, z, w) on the shorter way; nearly equal ones are mixed linearly.

    The weighted sum still has to be normalised. Keep the weights in columns of
    their own, so that the trigonometry is evaluated once.
    """
    signed = sum((p * q for p, q in zip(a, b)), F.lit(0.0))
    sign = F.when(signed < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    dot = F.abs(signed)
    near = dot > 0.9995
    angle = F.acos(F.least(dot, F.lit(1.0)))
    first = F.when(near, F.lit(1.0) - share).otherwise(F.try_divide(F.sin((F.lit(1.0) - share) * angle), F.sin(angle)))
    second = F.when(near, share).otherwise(F.try_divide(F.sin(share * angle), F.sin(angle)))
    return first, sign * second


def rotation_to_quaternion(r: dict[str, Column]) -> list[Column]:
    """Quaternion (w, x, y, z) of a rotation, w >= 0; of the four closed forms the one with the largest divisor."""
    one = F.lit(1.0)
    squares = [
        one + r["r00"] + r["r11"] + r["r22"], one + r["r00"] - r["r11"] - r["r22"],
        one - r["r00"] + r["r11"] - r["r22"], one - r["r00"] - r["r11"] + r["r22"],
    ]
    top = F.greatest(*squares)
    s = F.sqrt(top) * 2.0
    a, b, c = r["r21"] - r["r12"], r["r02"] - r["r20"], r["r10"] - r["r01"]
    d, e, f = r["r01"] + r["r10"], r["r02"] + r["r20"], r["r12"] + r["r21"]
    forms = [(s / 4, a / s, b / s, c / s), (a / s, s / 4, d / s, e / s), (b / s, d / s, s / 4, f / s), (c / s, e / s, f / s, s / 4)]
    chosen = []
    for k in range(4):
        value = forms[3][k]
        for q in (2, 1, 0):
            value = F.when(squares[q] == top, forms[q][k]).otherwise(value)
        chosen.append(value)
    flip = F.when(chosen[0] < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    return [q * flip for q in chosen]


def frustum_corners(scale: float, aspect: float = 16 / 9) -> list[tuple[str, list[Column]]]:
    """Apex and far corners of a drawn camera, from columns px, py, pz and r00..r22.

    The first axis of the rotation looks ahead, the second to the left, the
    third up; the far plane is ``scale`` away and ``scale`` high.
    """
    half_w, half_h = scale * aspect * 0.5, scale * 0.5
    places = {
        "apex": (0.0, 0.0, 0.0), "top_left": (scale, half_w, half_h), "top_right": (scale, -half_w, half_h),
        "bottom_left": (scale, half_w, -half_h), "bottom_right": (scale, -half_w, -half_h),
    }
    out = []
    for name, (ahead, left, up) in places.items():
        xyz = [
            F.col(f"p{axis}") + F.lit(ahead) * F.col(f"r{row}0") + F.lit(left) * F.col(f"r{row}1") + F.lit(up) * F.col(f"r{row}2")
            for row, axis in enumerate("xyz")
        ]
        out.append((name, xyz))
    return out
