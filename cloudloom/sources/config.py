"""Settings of a reconstruction and of a capture, from YAML by the files' own keys."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, fields, replace

import yaml

from ..functions.geometry import Camera

#: Camera axes (x right, y down, z ahead) in body axes (x ahead, y left, z up): the matrix of a file that names none.
BODY_AXES = (0.0, 0.0, 1.0, 0.0, -1.0, 0.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)
IDENTITY = (1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0)


@dataclass(frozen=True)
class Config:
    """One field for each key of a settings file; the defaults are those of the colouring step."""

    focal_length: float = 1000.0
    image_width: int = 1920
    image_height: int = 1080
    principal_x: float = 960.0
    principal_y: float = 540.0
    time_delay: float = 0.0
    voxel_size: float = 0.03
    min_depth: float = 1.0
    max_depth: float = 400.0
    filter_outliers: bool = True
    sor_neighbors: int = 10
    sor_std_ratio: float = 2.0
    hpr_radius: float = 20_000.0
    preserve_edge_points: bool = True
    edge_canny_low: float = 50.0
    edge_canny_high: float = 150.0
    edge_dilation_px: int = 2
    edge_voxel_size: float = 0.01
    jbf_sigma_c: float = 15.0
    fill_background: bool = True
    sphere_radius: float = 200.0
    sphere_num_points: int = 50_000
    depth_render_hpr_radius: float = 40_000.0
    depth_sphere_num_points: int = 500_000
    poses_are_body_frame: bool = True
    trans_mat: tuple[float, ...] = BODY_AXES
    pcd_file: str = "pcd/input.pcd"
    downsampled_file: str = "pcd/downsampled.pcd"
    reconstructed_file: str = "pcd/reconstructed.pcd"
    poses_file: str = "poses.csv"
    registration_file: str = "color_registration.csv"
    pose_timestamps_file: str = "timestamps/odom.csv"
    image_timestamps_file: str = "timestamps/image.csv"
    images_dir: str = "images"
    depth_dir: str = "depth_renders"

    def __post_init__(self) -> None:
        if len(self.trans_mat) != 16:
            raise ValueError("trans_mat must have 16 values")
        if self.sor_neighbors < 1 or self.sphere_num_points < 0 or self.depth_sphere_num_points < 0:
            raise ValueError("counts must be positive")

    @property
    def camera(self) -> Camera:
        body = self.trans_mat if self.poses_are_body_frame else None
        return Camera(self.focal_length, self.image_width, self.image_height, self.principal_x, self.principal_y, self.min_depth, self.max_depth, body_to_camera=body)


#: Defaults of the steps that differ from those of the colouring step.
STEPS: dict[str, dict] = {
    "poses": {},
    "colors": {},
    "export": {"hpr_radius": 100_000.0},
    "depth": {"fill_background": False, "sphere_radius": 50.0, "images_dir": "distorted/images"},
}


@dataclass(frozen=True)
class CaptureConfig:
    """Settings of a capture. A file must name them all, as each program gets its part without a default."""

    output_dir: str
    image_save_interval: int
    image_prefix: str
    odom_save_interval: int
    leaf_size: float
    max_path_length: int
    accumulator_max_points: int
    accumulator_publish_interval: int
    global_downsample_interval: int
    global_max_points: int
    lidar_topic: str
    odom_topic: str
    image_topic: str
    frame_id: str
    bag_output_dir: str = ""


def _number(kind: type, value):
    """``value`` as a float or an int, also from text such as 1e3; an int must be whole."""
    if isinstance(value, bool):
        raise ValueError(value)
    number = float(value)
    if kind is int and number != int(number):
        raise ValueError(value)
    return kind(number)


def _as(kind: str, value):
    if kind == "float":
        return _number(float, value)
    if kind == "int":
        return _number(int, value)
    if kind == "bool":
        if isinstance(value, bool):
            return value
        raise ValueError(value)
    if isinstance(value, (list, dict, type(None))):
        raise ValueError(value)
    return str(value)


def _read(path: str) -> dict | None:
    """The map in a YAML file; None if it can't be read as one."""
    try:
        with open(path, encoding="utf-8") as file:
            found = yaml.safe_load(file)
    except (OSError, UnicodeDecodeError, yaml.YAMLError) as error:
        warnings.warn(f"{path}: {error}; all settings keep their defaults", stacklevel=3)
        return None
    if found is not None and not isinstance(found, dict):
        warnings.warn(f"{path}: no map of settings; all keep their defaults", stacklevel=3)
        return None
    return found or {}


def load_config(path: str, step: str = "colors") -> Config:
    """Settings of one step from a file.

    A missing key keeps its default, and so does a value of another kind. A
    matrix that has not 16 numbers counts as the identity. A file that is
    missing or no YAML map gives all defaults. Keys that no step knows, and
    values that are not taken, are reported as warnings.
    """
    default = replace(Config(), **STEPS[step])
    found = _read(path)
    if found is None:
        return default
    kinds = {f.name: f.type for f in fields(Config)}
    values = {}
    for key, value in found.items():
        if key not in kinds:
            warnings.warn(f"{path}: unknown setting {key}", stacklevel=2)
            continue
        try:
            if key == "trans_mat":
                numbers = tuple(_number(float, v) for v in value)
                values[key] = numbers if len(numbers) == 16 else IDENTITY
            else:
                values[key] = _as(kinds[key], value)
        except (TypeError, ValueError):
            warnings.warn(f"{path}: {key} = {value!r} is no {kinds[key]}; its default stays", stacklevel=2)
    return replace(default, **values)


def load_capture_config(path: str) -> CaptureConfig:
    """Settings of a capture; a missing file or key is an error."""
    with open(path, encoding="utf-8") as file:
        found = yaml.safe_load(file)
    kinds = {f.name: f.type for f in fields(CaptureConfig)}
    for key in found.keys() - kinds.keys():
        warnings.warn(f"{path}: unknown setting {key}", stacklevel=2)
    missing = kinds.keys() - found.keys() - {"bag_output_dir"}
    if missing:
        raise KeyError(f"{path}: no {', '.join(sorted(missing))}")
    return CaptureConfig(**{k: _as(kinds[k], v) for k, v in found.items() if k in kinds})
