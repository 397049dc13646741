"""Poses of camera triggers from odometry: as-of brackets and interpolation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import settled
from ..functions.geometry import rotation, shift_time, slerp_weights

_SAMPLE = ["odom_id", "t", "px", "py", "pz", "qx", "qy", "qz", "qw"]


def asof_bracket(
    images: DataFrame, odom: DataFrame, delay: float = 0.0, ranges: int | None = None, partition_by: list[str] | None = None
) -> DataFrame:
    """Each image with the odometry sample before and the first one at or after its shifted time.

    images: image_id, t. odom: odom_id, t, position and quaternion. Returns
    image_id, t (shifted), ``before`` and ``after`` structs; an image ahead of
    all samples has no ``before``, one behind all has no ``after``, one without
    a time has neither, none is dropped. Equal times are ordered by odom_id;
    samples without a time are left out. ``partition_by`` names columns (of a
    vehicle, say) that an image shares with its samples.

    Samples and images are cut into ``ranges`` (by default as many as the
    session has shuffle partitions) of their whole order, wherever in time
    they lie, so an hour of many vehicles is divided like any other rows. Only
    a table with one row for each range, and group in it, is scanned in order,
    to carry the last sample of earlier and the first of later ranges across.
    """
    by = list(partition_by or [])
    key = [*by, "__b"]
    sample = F.struct(*_SAMPLE)
    shifted = images.select(*by, "image_id", shift_time(F.col("t"), delay).alias("t"))
    tagged = odom.where("t is not null").select(*by, F.col("t"), F.lit(1).alias("kind"), F.col("odom_id").alias("id"), sample.alias("s")).unionByName(
        shifted.select(*by, "t", F.lit(0).alias("kind"), F.col("image_id").alias("id")), allowMissingColumns=True
    )
    # An image comes ahead of samples with its own time: those are at or after it.
    parts = ranges or int(images.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = settled(tagged.repartitionByRange(parts, *by, "t", "kind", "id").withColumn("__b", F.spark_partition_id()))
    edges = tagged.groupBy(*key).agg(
        F.max(F.when(F.col("kind") == 1, F.struct("t", "id", "s")))["s"].alias("__last"),
        F.min(F.when(F.col("kind") == 1, F.struct("t", "id", "s")))["s"].alias("__first"),
    )
    # What follows is read backwards: a frame up to the end would go through all the rest of a range for each row.
    whole = Window.partitionBy(*by) if by else Window
    passed = lambda value, order: F.last(value, True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    carried = edges.select(*key, passed("__last", whole.orderBy("__b")).alias("__in"), passed("__first", whole.orderBy(F.desc("__b"))).alias("__out"))
    inside, at = Window.partitionBy(*key), ("t", "kind", "id")
    seen = tagged.select(
        *key, *at, passed("s", inside.orderBy(*at)).alias("__prev"), passed("s", inside.orderBy(*map(F.desc, at))).alias("__next")
    ).where("kind = 0")
    names = [f"__k{k}" for k in range(len(key))]
    joined = seen.join(carried.toDF(*names, "__in", "__out"), [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(key, names)])
    timed = lambda inner, outer: F.when(F.col("t").isNotNull(), F.coalesce(inner, outer))
    return joined.select(
        *by, F.col("id").alias("image_id"), "t", timed("__prev", "__in").alias("before"), timed("__next", "__out").alias("after")
    )


def interpolated(brackets: DataFrame) -> DataFrame:
    """Poses at the images' times; outside the samples' range the nearest end is taken.

    ``matched`` tells interpolated from held poses; a hit on the very first
    sample counts as held.
    """
    a, b = F.col("before"), F.col("after")
    span = b["t"] - a["t"]
    axes, quaternion = ("px", "py", "pz"), ("qx", "qy", "qz", "qw")
    others = [c for c in brackets.columns if c not in ("before", "after")]
    rows = brackets.withColumn("__share", F.when(span > 0, (F.col("t") - a["t"]) / span).otherwise(F.lit(0.0)))
    first, second = slerp_weights([a[q] for q in quaternion], [b[q] for q in quaternion], F.col("__share"))
    rows = rows.withColumns({"__first": first, "__second": second, "matched": a.isNotNull() & b.isNotNull()})
    rows = rows.withColumns({f"__{q}": F.col("__first") * a[q] + F.col("__second") * b[q] for q in quaternion})
    rows = rows.withColumn("__norm", F.sqrt(sum((F.col(f"__{q}") * F.col(f"__{q}") for q in quaternion), F.lit(0.0))))
    values = {p: a[p] + F.col("__share") * (b[p] - a[p]) for p in axes} | {q: F.col(f"__{q}") / F.col("__norm") for q in quaternion}
    columns = [F.when(F.col("matched"), v).otherwise(F.coalesce(b, a)[name]).alias(name) for name, v in values.items()]
    return rows.select(*others, "matched", *columns)


def match_counts(brackets: DataFrame) -> DataFrame:
    """One row: interpolated and held images."""
    inside = F.col("before").isNotNull() & F.col("after").isNotNull()
    return brackets.agg(
        F.count("*").alias("n_images"), F.count(F.when(inside, 1)).alias("n_interpolated"), F.count(F.when(~inside, 1)).alias("n_clamped")
    )


def with_rotation(poses: DataFrame) -> DataFrame:
    """Adds r00..r22 of the pose's quaternion, which may have any length.

    Step by step, so that each part is computed once. The entries come as generated
    rows: not-null filters that Spark infers from them stop there, else each would
    repeat the whole arithmetic down to the scan.
    """
    axes = ("qx", "qy", "qz", "qw")
    length = F.sqrt(sum((F.col(q) * F.col(q) for q in axes[1:]), F.col("qx") * F.col("qx")))
    unit = poses.withColumn("__n", length).withColumns({f"__{q}": F.col(q) / F.col("__n") for q in axes})
    entries = [c.alias(n) for n, c in rotation(*(F.col(f"__{q}") for q in axes)).items()]
    return unit.select(*poses.columns, F.inline(F.array(F.struct(*entries))))
