"""Text tables of a recording, with fixed schemas, and their writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SEVEN = "px DOUBLE, py DOUBLE, pz DOUBLE, qx DOUBLE, qy DOUBLE, qz DOUBLE, qw DOUBLE"
ODOM = f"index INT, timestamp_sec LONG, timestamp_nanosec LONG, {_SEVEN}"
IMAGE_INDEX = "index INT, filename STRING, timestamp_sec LONG, timestamp_nanosec LONG"
POSES = f"index INT, filename STRING, timestamp DOUBLE, {_SEVEN}"
OBSERVATIONS = "point_id INT, r FLOAT, g FLOAT, b FLOAT"


def _read(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """A malformed number fails the read; blank lines are skipped."""
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)


def read_odom(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, ODOM)


def read_image_index(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, IMAGE_INDEX)


def read_poses(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, POSES)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, OBSERVATIONS, header=False)


def fixed(df: DataFrame, columns: list[str], digits: int) -> DataFrame:
    """Floating columns as text with a fixed number of decimals."""
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    return df.select(*(F.format_string(f"%.{digits}f", F.col(c).cast("double")).alias(c) if c in floats else F.col(c) for c in columns))


def _write(df: DataFrame, path: str, schema: str, digits: int, header: bool) -> None:
    columns = [c.split()[0] for c in schema.split(", ")]
    fixed(df, columns, digits).write.option("header", header).mode("overwrite").csv(path)


def write_poses(poses: DataFrame, path: str) -> None:
    _write(poses, path, POSES, 12, True)


def write_odom(odom: DataFrame, path: str) -> None:
    _write(odom, path, ODOM, 12, True)


def write_image_index(images: DataFrame, path: str) -> None:
    _write(images, path, IMAGE_INDEX, 12, True)


def write_observations(obs: DataFrame, path: str) -> None:
    """Text keeps eight decimals; hand typed values over as Parquet where that matters."""
    _write(obs, path, OBSERVATIONS, 8, False)
