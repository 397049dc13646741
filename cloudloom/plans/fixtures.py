"""Sensor data derived from the supplied tables, by SQL that both engines read alike.

Odometry, camera triggers, a point cloud, colour observations, camera poses and
procedural images. The scene is a strip along y that grows with the customers;
one camera for each supplier stands along it, so that a camera sees about as
much at every scale. FIXTURES.md describes the first, smaller form of the
views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import Camera

CAMERA = Camera(focal=150.0, width=160, height=120, center_x=80.0, center_y=60.0)
#: Side of the squares of pixels, of which the procedural images lack one in seven, as damaged frames do.
GAP = 20

_N = "(({k}%7-3)*({k}%7-3) + ({k}%5-2)*({k}%5-2) + ({k}%3-1)*({k}%3-1) + ({k}%11+1)*({k}%11+1))"
_EV = {"spark": "unix_micros(cast(ts as timestamp))", "duckdb": "epoch_us(ts)"}

#: SQL of each view over the base tables; {us} is the time in microseconds.
VIEWS = {
    "fx_odom": f"""
select id odom_id, us/1e6 t, px, py, pz,
       (id%7-3)/sqrt(n) qx, (id%5-2)/sqrt(n) qy, (id%3-1)/sqrt(n) qz, (id%11+1)/sqrt(n) qw
from (select event_id id, {{us}} us, value px, cast(user_id as double) py, (event_id%97)/1e1 pz,
             event_type, cast({_N.format(k="event_id")} as double) n from events) z
where event_type in ('view','click','signup')""",
    "fx_image": "select event_id image_id, {us}/1e6 t from events where event_type in ('purchase','error')",
    "fx_points": "select o_orderkey point_id, o_totalprice/1e4-25e0 x, o_custkey/2e1-25e0 y, (o_orderkey%400)/1e1-10e0 z from orders",
    "fx_obs": "select l_partkey point_id, l_orderkey img, l_discount*1e1 r, l_tax*125e-1 g, l_quantity/5e1 b from lineitem",
    "fx_camera": f"""
select id cam_id, (id%5)*2e0-4e0 px, id*75e-2-25e0 py, -3e1 pz,
       (id%7-3)/sqrt(n)/8 qx, (id%5-2)/sqrt(n)/8 qy, (id%3-1)/sqrt(n)/8 qz, (id%11+1)/sqrt(n) qw
from (select s_suppkey id, cast({_N.format(k="s_suppkey")} as double) n from supplier) z""",
    "fx_knn": "select vec_id point_id, cast(embedding[{first}] as double) x, cast(embedding[{second}] as double) y, cast(embedding[{third}] as double) z from embeddings",
}
_BASE = {"fx_odom": "events", "fx_image": "events", "fx_points": "orders", "fx_obs": "lineitem", "fx_camera": "supplier", "fx_knn": "embeddings"}


def _dialect(name: str, engine: str) -> str:
    start = 0 if engine == "spark" else 1
    return VIEWS[name].format(us=_EV[engine], first=start, second=start + 1, third=start + 2)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base = _BASE[name]
    return spark.sql(_dialect(name, "spark").replace(f"from {base}", f"from {{{base}}}"), **{base: spark.read.parquet(f"{sf_dir}/{base}.parquet")})


def duckdb_with(*names: str, **more: str) -> str:
    """A WITH clause of these views, then of further named queries."""
    parts = [f"{n} as ({_dialect(n, 'duckdb').strip()})" for n in names] + [f"{n} as ({q})" for n, q in more.items()]
    return "with " + ",\n".join(parts) + "\n"


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cam_id, iv, iu, grey): a procedural image of each camera, whole but for its gaps."""
    cameras = view(spark, sf_dir, "fx_camera").select("cam_id")
    pixels = cameras.select("cam_id", F.explode(F.sequence(F.lit(0), F.lit(CAMERA.height - 1))).alias("iv"))
    pixels = pixels.select("cam_id", "iv", F.explode(F.sequence(F.lit(0), F.lit(CAMERA.width - 1))).alias("iu"))
    there = F.expr(f"(iu div {GAP} + iv div {GAP} + cam_id) % 7 <> 0")
    return pixels.where(there).withColumn("grey", F.expr("(iu * 7 + iv * 13 + cam_id * 31) % 256"))
