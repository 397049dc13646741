"""Depth images and lookups in images, as sparse pixel rows (image, iv, iu, value)."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, DecimalType, DoubleType, LongType, NumericType, StringType, StructField, StructType

from ..checkpoints import settled
from ..functions.color import file_stem, inverse_depth, quantize, rainbow
from .camera import GROUP, image_keys


def zbuffer(projected: DataFrame, id_col: str = "cam_id") -> DataFrame:
    """(cam_id, iv, iu, depth): the nearest depth of each pixel, in single precision."""
    return projected.groupBy(*image_keys(projected, id_col), "iv", "iu").agg(F.min(F.col("cz").cast("float")).alias("depth"))


def encoded(depths: DataFrame) -> DataFrame:
    """Adds ``code``, the 16-bit inverse depth."""
    return depths.withColumn("code", inverse_depth(F.col("depth").cast("double")))


def depth_summary(depths: DataFrame, width: int, height: int, id_col: str = "cam_id") -> DataFrame:
    """(cam_id, n_valid, d_min, d_max, coverage): over valid pixels; coverage in percent of the image."""
    valid = F.when(F.col("depth") > 0, F.col("depth"))
    found = depths.groupBy(*image_keys(depths, id_col)).agg(F.count(valid).alias("n_valid"), F.min(valid).alias("d_min"), F.max(valid).alias("d_max"))
    return found.drop(GROUP).withColumn("coverage", F.col("n_valid") * 100.0 / (width * height))


def depth_params(images: DataFrame, summary: DataFrame, id_col: str = "cam_id", name_col: str = "filename") -> DataFrame:
    """(stem, scale, offset) of the images that hold any depth."""
    good = summary.where("n_valid > 0").select(id_col)
    return images.join(good, id_col, "left_semi").select(file_stem(F.col(name_col)).alias("stem"), F.lit(1.0).alias("scale"), F.lit(0.0).alias("offset"))


def depth_params_json(params: DataFrame) -> DataFrame:
    """One row: a JSON object from stem to scale and offset, in order of stems; its size is the number of images."""
    entry = F.struct("stem", F.struct("scale", "offset").alias("value"))
    rows = params.agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    return rows.select(F.to_json(F.map_from_entries("rows")).alias("json"))


def overlay_colors(projected: DataFrame, id_col: str = "cam_id") -> DataFrame:
    """(cam_id, iv, iu, r, g, b): each projected point's depth, scaled within its image, as a rainbow colour 0..255."""
    whole = Window.partitionBy(*image_keys(projected, id_col))
    ends = projected.withColumns({"lo": F.min("cz").over(whole), "hi": F.max("cz").over(whole)})
    share = F.when(F.col("hi") > F.col("lo"), (F.col("cz") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(F.lit(0.0))
    return ends.withColumn("share", share).select(id_col, "iv", "iu", *(quantize(c).alias(n) for c, n in zip(rainbow(F.col("share")), "rgb")))


def normalized(depths: DataFrame, id_col: str = "cam_id") -> DataFrame:
    """Adds ``level``: depth spread over 0..255 between each image's extremes (0 where they are equal)."""
    whole = Window.partitionBy(*image_keys(depths, id_col))
    joined = depths.where("depth > 0").withColumns({n: f("depth").over(whole).cast("double") for n, f in (("lo", F.min), ("hi", F.max))})
    level = F.when(F.col("hi") > F.col("lo"), (F.col("depth").cast("double") - F.col("lo")) * 255.0 / (F.col("hi") - F.col("lo"))).otherwise(F.lit(0.0))
    return joined.withColumn("level", level).drop("lo", "hi")


def edge_lookup(projected: DataFrame, mask: DataFrame, id_col: str = "cam_id") -> DataFrame:
    """Projected points whose pixel is set in ``mask`` (cam_id, iv, iu)."""
    # A mask can come from few rows that look small to the optimiser, so it must not be broadcast on an estimate.
    return projected.join(mask.select(id_col, "iv", "iu").hint("merge"), [id_col, "iv", "iu"], "left_semi")


#: Side of the tiles in which pixels meet what looks them up.
TILE = 256
#: Pixels (about) of a task that are packed by tiles together.
PACKED = 1 << 18
#: Most keys of tiles (about 64 bytes each) that are broadcast where a caller asks for it.
BROADCAST_TILES = 500_000
#: Window of the dilation that closes a guided completion (a fixed value).
CLOSING = 7
#: Side of the tiles that a window moves over in one task.
WINDOW_TILE = 256


def _asked(placed: DataFrame, id_col: str, broadcast_tiles: int) -> DataFrame | None:
    """(cam_id, tv, tu), broadcast: the tiles that rows fall into, or None where they are more than ``broadcast_tiles``."""
    found = settled(placed.select(id_col, "tv", "tu").distinct())
    return F.broadcast(found) if found.count() <= broadcast_tiles else None


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type of whole numbers that holds them; others stay as they are."""
    if values.dtype.kind in "iu" and len(values):
        low, high = int(values.min()), int(values.max())
        for kind in ("u1", "i2", "i4"):
            if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
                return values.astype(kind)
    return values


def _binary(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The bytes of each run of values, as a binary column."""
    offsets = (edges * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _packed(pixels: DataFrame, channels: list[str], rim: int, id_col: str) -> DataFrame:
    """Pixels (cam_id, tv, tu) by tiles, before anything is shuffled: one row for those of a tile that lie in one batch of rows.

    Their places in the tile with its rim are held as steps and the channels as
    arrays of the smallest type, a few bytes a pixel; columns that are not
    plain numbers, or have nulls, are held as Arrow has them.
    """
    names, width = ["__kinds", "__at", *(f"__{k}" for k in range(len(channels)))], TILE + rim
    shape = StructType([pixels.schema[id_col], *(StructField(n, LongType()) for n in ("tv", "tu")), StructField(names[0], StringType()), *(StructField(n, BinaryType()) for n in names[1:])])

    def pack(rows: pa.Table) -> pa.RecordBatch:
        code = rows[id_col].combine_chunks().dictionary_encode(null_encoding="encode")
        if isinstance(code, pa.ChunkedArray):
            code = code.combine_chunks()
        iv, iu = (rows[c].to_numpy().astype(np.int64) for c in ("iv", "iu"))
        parts = []
        for back_v in range(2 if rim else 1):
            for back_u in range(2 if rim else 1):
                tv, tu = iv // TILE - back_v, iu // TILE - back_u
                held = np.flatnonzero((iv >= 0) & (iu >= 0) & (tv >= 0) & (tu >= 0) & (iv - tv * TILE < width) & (iu - tu * TILE < width))
                parts.append((held, tv[held], tu[held]))
        row, tv, tu = (np.concatenate(p) for p in zip(*parts))
        image, at = code.indices.to_numpy()[row].astype(np.int64), (iv[row] - tv * TILE) * width + iu[row] - tu * TILE
        order = np.lexsort((at, tu, tv, image))
        row, tv, tu, image, at = row[order], tv[order], tu[order], image[order], at[order]
        starts = np.flatnonzero(np.concatenate(([True], (image[1:] != image[:-1]) | (tv[1:] != tv[:-1]) | (tu[1:] != tu[:-1])))) if len(row) else np.zeros(0, np.int64)
        edges = np.append(starts, len(row))
        steps = np.diff(at, prepend=0)
        steps[starts] = at[starts]
        columns, kinds = [], []
        for c in (None, *channels):
            values = pa.array(steps) if c is None else rows[c].take(pa.array(row)).combine_chunks()
            if isinstance(values, pa.ChunkedArray):
                values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], values.type)
            if values.null_count or not (pa.types.is_integer(values.type) or pa.types.is_floating(values.type)):
                kinds.append("A")
                cut = [pa.record_batch([values.slice(a, b - a)], ["v"]).serialize().to_pybytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                columns.append(pa.array(cut, pa.binary()))
            else:
                small = _narrow(values.to_numpy(zero_copy_only=False))
                kinds.append(small.dtype.char)
                columns.append(_binary(small, edges))
        ids = code.dictionary.take(pa.array(image[starts]))
        return pa.record_batch([ids, pa.array(tv[starts]), pa.array(tu[starts]), pa.array(["".join(kinds)] * len(starts), pa.string()), *columns], [id_col, "tv", "tu", *names])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= PACKED:
                yield pack(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield pack(pa.Table.from_batches(held))

    return pixels.select(id_col, "iv", "iu", *channels).where("iv is not null and iu is not null").mapInArrow(run, shape)


def _unpacked(part: pa.Table, channels: list[str], types: pa.Schema, rim: int) -> tuple[pa.Table, np.ndarray]:
    """The pixels' channels, and where in the tile each of them is."""
    place, chunks, begin = np.full((TILE + rim) ** 2, -1), [[] for _ in channels], 0
    for kinds, at, *blobs in zip(*(part[c].to_pylist() for c in ["__kinds", "__at", *(f"__{k}" for k in range(len(channels)))])):
        at = np.cumsum(np.frombuffer(at, kinds[0]), dtype=np.int64)
        place[at] = np.arange(begin, begin + len(at))
        begin += len(at)
        for c, kind, blob, out in zip(channels, kinds[1:], blobs, chunks):
            kept = types.field(c).type
            if kind == "A":
                out.append(pa.ipc.read_record_batch(pa.py_buffer(blob), pa.schema([("v", kept)])).column(0))
            else:
                out.append(pa.array(np.frombuffer(blob, kind)).cast(kept))
    return pa.table([pa.chunked_array(x, types.field(c).type) for c, x in zip(channels, chunks)], names=channels), place.reshape(TILE + rim, TILE + rim)


def _looked_up(placed: DataFrame, pixels: DataFrame, channels: list[str], rim: int, look: Callable, schema, id_col: str, broadcast_tiles: int) -> DataFrame:
    """``look`` on the rows of each tile (with tv, tu) and the tile's pixels, with ``rim`` more beyond its lower and right edge.

    Pixels are packed by tile where they are read; rows and packed pixels are
    shuffled once by tile and meet in a task as arrays. Neither side is
    broadcast: pixels come from few images, so the optimiser takes them for a
    small table. A caller who knows that rows fall into few tiles can let their
    keys be broadcast, to keep other pixels out of the shuffle.
    """
    sent, types = _packed(pixels, channels, rim, id_col), to_arrow_schema(pixels.select(*channels).schema)
    asked = _asked(placed, id_col, broadcast_tiles) if broadcast_tiles else None
    if asked is not None:
        sent = sent.join(asked, [id_col, "tv", "tu"], "left_semi")

    def meet(rows: pa.Table, part: pa.Table) -> pa.Table:
        if not rows.num_rows or not part.num_rows:
            return look(rows.slice(0, 0), types.empty_table(), np.full((1, 1), -1), 0, 0)
        return look(rows, *_unpacked(part, channels, types, rim), rows["tv"][0].as_py() * TILE, rows["tu"][0].as_py() * TILE)

    keys = [id_col, "tv", "tu"]
    return placed.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(meet, schema)


def _in_tiles(rows: DataFrame, row: Column, column: Column) -> DataFrame:
    return rows.withColumns({"tv": F.floor(row / TILE), "tu": F.floor(column / TILE)})


def gather(rows: DataFrame, pixels: DataFrame, channels: list[str], id_col: str = "cam_id", broadcast_tiles: int = 0) -> DataFrame:
    """``rows`` (with iv, iu) and the channels of their pixels; rows without one are dropped. Of a pixel that is there twice any one is taken."""
    shape = StructType([*rows.schema.fields, *(pixels.schema[c] for c in channels)])

    def look(part: pa.Table, held: pa.Table, place: np.ndarray, top: int, left: int) -> pa.Table:
        found = place[part["iv"].to_numpy() - top, part["iu"].to_numpy() - left]
        kept = found >= 0
        picked = part.select(rows_columns).filter(pa.array(kept))
        values = held.select(channels).take(pa.array(found[kept]))
        return pa.table([*picked.columns, *values.columns], names=[*rows_columns, *channels])

    rows_columns = rows.columns
    return _looked_up(_in_tiles(rows, F.col("iv"), F.col("iu")), pixels, channels, 0, look, shape, id_col, broadcast_tiles)


def bilinear(
    projected: DataFrame, pixels: DataFrame, width: int, height: int, channels: list[str], id_col: str = "cam_id", broadcast_tiles: int = 0
) -> DataFrame:
    """Each channel (0..1) at (u, v), blended from the four pixels around; points that lack one are dropped.

    Tiles of pixels have a rim so that all four are in the tile of the first.
    """
    plain = {c: isinstance(k := pixels.schema[c].dataType, NumericType) and not isinstance(k, DecimalType) for c in channels}
    points = projected.select(id_col, "point_id", F.col("u").cast("double").alias("u"), F.col("v").cast("double").alias("v")).where("u is not null and v is not null")
    shape = StructType([*points.schema.fields[:2], *(StructField(c, DoubleType()) for c in channels)])

    def look(part: pa.Table, held: pa.Table, place: np.ndarray, top: int, left: int) -> pa.Table:
        u, v = part["u"].to_numpy(), part["v"].to_numpy()
        x0, y0 = np.floor(u), np.floor(v)
        fx, fy = u - x0, v - y0
        x0, y0 = x0.astype(np.int64), y0.astype(np.int64)
        x1, y1 = np.minimum(x0 + 1, width - 1), np.minimum(y0 + 1, height - 1)
        corner = lambda y, x: np.where((y >= top) & (x >= left), place[np.maximum(y - top, 0), np.maximum(x - left, 0)], -1)
        taps = [corner(y, x) for y, x in ((y0, x0), (y0, x1), (y1, x0), (y1, x1))]
        kept = np.logical_and.reduce([t >= 0 for t in taps])
        fx, fy, taps = fx[kept], fy[kept], [t[kept] for t in taps]
        weights = ((1 - fx) * (1 - fy), fx * (1 - fy), (1 - fx) * fy, fx * fy)
        picked = part.select([id_col, "point_id"]).filter(pa.array(kept))
        values = []
        for c in channels:
            channel = held[c].to_numpy().astype(np.float64)
            values.append(pa.array(sum(channel[t] * w for t, w in zip(taps, weights)) / 255.0, pa.float64()))
        return pa.table([*picked.columns, *values], names=[id_col, "point_id", *channels])

    # Numbers become doubles where they are used, as most images are of bytes.
    typed = pixels.select(id_col, "iv", "iu", *(F.col(c) if plain[c] else F.col(c).cast("double").alias(c) for c in channels))
    return _looked_up(_in_tiles(points, F.floor("v"), F.floor("u")), typed, channels, 1, look, shape, id_col, broadcast_tiles)


def ellipse_spans(size: int) -> dict[int, int]:
    """Half width of each row of an elliptical structuring element of odd ``size``."""
    r = size // 2
    return {dy: round(r * math.sqrt((r * r - dy * dy) / (r * r))) if r else 0 for dy in range(-r, r + 1)}


def _windowed(rows: DataFrame, radius: int, work: Callable, schema: str, id_col: str, tile: int = WINDOW_TILE, homes: bool = False) -> DataFrame:
    """``work`` (image id, first row, first column, rows) on square tiles with the rows around them; it returns rows of the tile alone.

    A row goes to its own tile and to those that it is near; so a task holds a
    tile and its rim, not an image. With ``homes`` a row that lies before an
    image's first row or column goes to its own tile too.
    """
    near = lambda a: F.sequence(F.floor((F.col(a) - radius) / tile), F.floor((F.col(a) + radius) / tile))
    kept = "tv >= 0 and tu >= 0" + (f" or tv = floor(iv / {tile}) and tu = floor(iu / {tile})" if homes else "")
    sent = rows.withColumn("tv", F.explode(near("iv"))).withColumn("tu", F.explode(near("iu"))).where(kept)

    def run(key: tuple, part: pa.Table) -> pa.Table:
        image, tv, tu = (k.as_py() for k in key[-3:])
        return work(image, tv * tile, tu * tile, part)

    return sent.groupBy(*image_keys(rows, id_col), "tv", "tu").applyInArrow(run, schema)


def _crop(part: pa.Table, column: str, top: int, left: int, radius: int, tile: int, width: int, height: int) -> tuple[np.ndarray, int, int]:
    """A tile with its rim, cut where the image ends, so that a kernel meets the image's borders as in the whole image; missing pixels are 0.

    Returns the array and the place of the tile's first pixel in it.
    """
    begin_v, begin_u = max(0, top - radius), max(0, left - radius)
    out = np.zeros((min(height, top + tile + radius) - begin_v, min(width, left + tile + radius) - begin_u))
    out[part["iv"].to_numpy() - begin_v, part["iu"].to_numpy() - begin_u] = part[column].to_numpy()
    return out, top - begin_v, left - begin_u


def _box(iv: np.ndarray, iu: np.ndarray, values: np.ndarray, radius: int, fill: float) -> tuple[np.ndarray, int, int]:
    """The pixels as an array as large as they are, and ``radius`` more on each side; with the place of its first pixel."""
    begin_v, begin_u = int(iv.min()) - radius, int(iu.min()) - radius
    out = np.full((int(iv.max()) - begin_v + radius + 1, int(iu.max()) - begin_u + radius + 1), fill, values.dtype)
    out[iv - begin_v, iu - begin_u] = values
    return out, begin_v, begin_u


def _tile(box: np.ndarray, begin_v: int, begin_u: int, top: int, left: int, height: int, width: int) -> tuple[np.ndarray, int, int]:
    """The part of an array within a tile and the image; with the place of its first pixel."""
    v, u = max(top, begin_v), max(left, begin_u)
    return box[v - begin_v : max(0, min(top + WINDOW_TILE, height) - begin_v), u - begin_u : max(0, min(left + WINDOW_TILE, width) - begin_u)], v, u


def _table(id_col: str, image: int, top: int, left: int, found: np.ndarray, values: np.ndarray, value: str) -> pa.Table:
    iv, iu = np.nonzero(found)
    return pa.table({
        id_col: pa.array(np.full(len(iv), image, np.int64)), "iv": pa.array((iv + top).astype(np.int32)), "iu": pa.array((iu + left).astype(np.int32)),
        value: pa.array(values[iv, iu]),
    })


def dilate(pixels: DataFrame, size: int, width: int, height: int, value: str = "depth", id_col: str = "cam_id") -> DataFrame:
    """Largest value within an elliptical window of odd ``size`` around each pixel that has any; values are numbers, nulls are left out."""
    spans, radius = ellipse_spans(size), size // 2
    kind = pixels.schema[value].dataType.simpleString()

    def grown(image: int, top: int, left: int, part: pa.Table) -> pa.Table:
        values = part[value].to_numpy().astype(np.float32 if kind == "float" else np.float64)
        wide, v, u = _box(part["iv"].to_numpy(), part["iu"].to_numpy(), values, radius, -np.inf)
        best, v, u = _tile(_window(wide, spans, np.maximum, -np.inf), v, u, top, left, height, width)
        return _table(id_col, image, v, u, best > -np.inf, best, value)

    rows = pixels.where(F.col(value).isNotNull()).select(*_keys(pixels, id_col), F.col("iv").cast("int").alias("iv"), F.col("iu").cast("int").alias("iu"), value)
    shape = "float" if kind == "float" else "double"
    return _windowed(rows, radius, grown, f"{id_col} long, iv int, iu int, {value} {shape}", id_col)


def _along(depths: DataFrame, guide: DataFrame | None, id_col: str, how: str) -> DataFrame:
    """(cam_id, iv, iu, r, g, b, depth) as numbers of one kind each; pixels without a depth have 0."""
    kinds = {"iv": "int", "iu": "int", **dict.fromkeys("rgb", "double")}
    own = F.when(F.col("depth") > 0, F.col("depth").cast("double"))
    if guide is None:
        rows = depths.withColumn("depth", own)
    else:
        rows = guide.select(id_col, "iv", "iu", *"rgb").join(depths.where("depth > 0").select(id_col, "iv", "iu", own.alias("depth")), [id_col, "iv", "iu"], how)
    return rows.select(*_keys(rows, id_col), *(F.col(c).cast(k).alias(c) for c, k in kinds.items()), F.coalesce("depth", F.lit(0.0)).alias("depth"))


def _weighted(part: pa.Table, radius: int, sigma_s: float, sigma_c: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and weighted mean depth of the pixels that have colours and a depth near them.

    Pixels meet pair by pair, each pair once for both, so empty places cost nothing.
    """
    iv, iu, depth = (part[c].to_numpy() for c in ("iv", "iu", "depth"))
    colors = [part[c].to_numpy(zero_copy_only=False) for c in "rgb"]
    place, begin_v, begin_u = _box(iv, iu, np.arange(len(iv)), radius, -1)
    step, place = place.shape[1], place.ravel()
    at = (iv - begin_v) * step + iu - begin_u
    limit = int(9 * sigma_c * sigma_c) + 1
    share = np.where((depth > 0) & ~np.isnan(sum(colors)) & (place[at] == np.arange(len(iv))), 1.0, 0.0)
    valid, total = share.copy(), share * depth
    known = np.flatnonzero(~np.isnan(sum(colors)) & (place[at] == np.arange(len(iv))))
    for dy in range(radius + 1):
        for dx in range(-radius if dy else 1, radius + 1):
            other = place[at[known] + dy * step + dx]
            one, other = known[other >= 0], other[other >= 0]
            apart = sum((c[one] - c[other]) ** 2 for c in colors)
            near = apart < limit
            one, other, apart = one[near], other[near], apart[near]
            w = np.exp(-(dy * dy + dx * dx) / (2.0 * sigma_s**2)) * np.exp(-apart / (2.0 * sigma_c**2))
            # Within one step no pixel comes twice on a side.
            there, here = w * valid[other], w * valid[one]
            share[one] += there
            total[one] += there * depth[other]
            share[other] += here
            total[other] += here * depth[one]
    good = share > 1e-6
    return iv[good], iu[good], total[good] / share[good]


def weighted_depth(
    depths: DataFrame, guide: DataFrame | None = None, radius: int = 4, sigma_s: float = 3.0, sigma_c: float = 3.0, id_col: str = "cam_id"
) -> DataFrame:
    """(cam_id, iv, iu, depth): mean depth around each guide pixel, weighted by distance and colour likeness.

    guide: cam_id, iv, iu, r, g, b (0..255); without one ``depths`` has the
    colours itself, and nothing is joined. Only pixels near a valid depth get
    a value; the colour cut-off is nine times the variance.
    """

    def smoothed(image: int, top: int, left: int, part: pa.Table) -> pa.Table:
        iv, iu, mean = _weighted(part, radius, sigma_s, sigma_c)
        own = (iv // WINDOW_TILE * WINDOW_TILE == top) & (iu // WINDOW_TILE * WINDOW_TILE == left)
        return _rows(id_col, image, iv[own], iu[own], mean[own])

    return _windowed(_along(depths, guide, id_col, "left"), radius, smoothed, f"{id_col} long, iv int, iu int, depth double", id_col)


def _rows(id_col: str, image: int, iv: np.ndarray, iu: np.ndarray, depth: np.ndarray) -> pa.Table:
    return pa.table({id_col: pa.array(np.full(len(iv), image, np.int64)), "iv": pa.array(iv.astype(np.int32)), "iu": pa.array(iu.astype(np.int32)), "depth": pa.array(depth)})


def _restored(id_col: str, image: int, part: pa.Table, top: int, left: int, tile: int, filled: np.ndarray, begin_v: int, begin_u: int) -> pa.Table:
    """Filled pixels (not 0) of a tile, an array from this place on; measured pixels of ``part`` keep their own depth, wherever they lie."""
    iv, iu, depth = (part[c].to_numpy() for c in ("iv", "iu", "depth"))
    own = (depth > 0) & (iv // tile * tile == top) & (iu // tile * tile == left)
    iv, iu, depth = iv[own], iu[own], depth[own]
    inside = (iv >= begin_v) & (iu >= begin_u) & (iv < begin_v + filled.shape[0]) & (iu < begin_u + filled.shape[1])
    free = filled != 0
    free[iv[inside] - begin_v, iu[inside] - begin_u] = False
    fv, fu = np.nonzero(free)
    return _rows(id_col, image, np.concatenate([iv, fv + begin_v]), np.concatenate([iu, fu + begin_u]), np.concatenate([depth, filled[fv, fu]]))


def densify_guided(
    depths: DataFrame, guide: DataFrame | None, width: int, height: int, id_col: str = "cam_id", radius: int = 4, sigma_s: float = 3.0, sigma_c: float = 3.0
) -> DataFrame:
    """Depth completed along the colours of a guide image, then closed by a small dilation; measured pixels stay.

    A tile comes with a rim for both windows, so all three steps are one pass.
    """
    spans = ellipse_spans(CLOSING)

    def fill(image: int, top: int, left: int, part: pa.Table) -> pa.Table:
        iv, iu, mean = _weighted(part, radius, sigma_s, sigma_c)
        best, v, u = np.zeros((0, 0)), top, left
        if len(iv):
            wide, v, u = _box(iv, iu, mean, CLOSING // 2, -np.inf)
            best, v, u = _tile(_window(wide, spans, np.maximum, -np.inf), v, u, top, left, height, width)
        return _restored(id_col, image, part, top, left, WINDOW_TILE, np.where(best > -np.inf, best, 0.0), v, u)

    schema = f"{id_col} long, iv int, iu int, depth double"
    return _windowed(_along(depths, guide, id_col, "full"), radius + CLOSING // 2, fill, schema, id_col, homes=True)


def _window(image: np.ndarray, spans: dict[int, int], best, fill: float) -> np.ndarray:
    """Best value within rows of these half widths around each pixel: running bests of each row by doubling, then one look a row and side."""
    r = max(max(spans), max(spans.values()))
    wide = np.pad(image, r, constant_values=fill)
    out = np.full_like(image, fill)
    h, w = image.shape
    power = [wide]  # power[k][:, x] is the best of 2 ** k values from x on
    while 2 ** len(power) <= 2 * max(spans.values()) + 1:
        last, step = power[-1], 2 ** (len(power) - 1)
        power.append(best(last[:, :-step], last[:, step:]))
    for dy, half in spans.items():
        size = 2 * half + 1
        k = size.bit_length() - 1
        row = slice(r + dy, r + dy + h)
        first, second = r - half, r + half + 1 - 2**k
        out = best(out, best(power[k][row, first : first + w], power[k][row, second : second + w]))
    return out


def _blurred(image: np.ndarray, size: int, sigma: float) -> np.ndarray:
    r = size // 2
    kernel = np.exp(-((np.arange(size) - r) ** 2) / (2 * sigma * sigma))
    kernel /= kernel.sum()
    wide = np.pad(image, r, mode="reflect" if min(image.shape) > r else "edge")
    rows = sum(k * wide[i : i + image.shape[0]] for i, k in enumerate(kernel))
    return sum(k * rows[:, i : i + image.shape[1]] for i, k in enumerate(kernel))


#: Side of the tiles of kernels with wide rims.
WIDE_TILE = 256
#: Windows of the completion without a guide: two dilations, a closing, a blur and its deviation (fixed values).
GROWN, CLOSED, BLURRED, DEVIATION = (5, 15), 61, 9, 3.0


def completed(image: np.ndarray) -> np.ndarray:
    """Two dilations, a wide closing and a blur of an array of depths, 0 where there is none."""
    for size in GROWN:
        image = _window(image, ellipse_spans(size), np.maximum, 0.0)
    spans = ellipse_spans(CLOSED)
    closed = _window(_window(image, spans, np.maximum, 0.0), spans, np.minimum, np.inf)
    return _blurred(closed, BLURRED, DEVIATION)


def _keys(df: DataFrame, id_col: str) -> list[Column]:
    """The columns of :func:`image_keys`, by one kind."""
    return [F.col(c).cast("long").alias(c) for c in image_keys(df, id_col)]


def _positions(df: DataFrame, value: str, id_col: str) -> DataFrame:
    """Image, row, column and value of pixels, by one kind each."""
    kinds = {"iv": "int", "iu": "int", value: "double"}
    return df.select(*_keys(df, id_col), *(F.col(c).cast(k).alias(c) for c, k in kinds.items()))


def densify_morphological(depths: DataFrame, width: int, height: int, id_col: str = "cam_id", tile: int = WIDE_TILE) -> DataFrame:
    """Depth completed without a guide: two dilations, a wide closing, a blur; measured pixels stay.

    The rim of a tile is as wide as all these windows together, so an image of
    any size comes in tiles, and each is what the whole image would give.
    """
    radius = sum(size // 2 for size in GROWN) + 2 * (CLOSED // 2) + BLURRED // 2

    def fill(image: int, top: int, left: int, part: pa.Table) -> pa.Table:
        iv, iu = part["iv"].to_numpy(), part["iu"].to_numpy()
        inside = part.filter(pa.array((iv >= 0) & (iv < height) & (iu >= 0) & (iu < width)))
        if top < 0 or left < 0 or top >= height or left >= width or not inside.num_rows:
            return _restored(id_col, image, part, top, left, tile, np.zeros((0, 0)), 0, 0)
        whole, v, u = _crop(inside, "depth", top, left, radius, tile, width, height)
        return _restored(id_col, image, part, top, left, tile, completed(whole)[v : v + tile, u : u + tile], top, left)

    valid = _positions(depths.where("depth > 0"), "depth", id_col)
    return _windowed(valid, radius, fill, f"{id_col} long, iv int, iu int, depth double", id_col, tile, homes=True)


def thinned(grey: np.ndarray) -> np.ndarray:
    """Size of the gradient where it is a ridge across its own direction, else 0."""
    height, width = grey.shape
    wide = np.pad(grey, 1, mode="edge")
    left, mid, right = (wide[:, k : k + width] for k in range(3))
    down = left + 2 * mid + right
    gy = down[2:] - down[:-2]
    side = right - left
    gx = side[:-2] + 2 * side[1:-1] + side[2:]
    size = np.abs(gx) + np.abs(gy)
    around = np.pad(size, 1)
    sector = np.round(np.arctan2(gy, gx) / (np.pi / 4)).astype(int) % 4
    keep = np.zeros_like(size, bool)
    for k, (dy, dx) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1))):
        ahead = around[1 + dy : 1 + dy + height, 1 + dx : 1 + dx + width]
        behind = around[1 - dy : 1 - dy + height, 1 - dx : 1 - dx + width]
        keep |= (sector == k) & (size > behind) & (size >= ahead)
    return np.where(keep, size, 0.0)


def _blobs(mask: np.ndarray) -> np.ndarray:
    """For each set pixel the least flat place of those that it is connected with, also over corners."""
    place = np.arange(mask.size).reshape(mask.shape)
    label = np.arange(mask.size)
    pairs = []
    for dy, dx in ((0, 1), (1, 0), (1, 1), (1, -1)):
        a = (slice(0, mask.shape[0] - dy), slice(max(0, -dx), mask.shape[1] - max(0, dx)))
        b = (slice(dy, None), slice(max(0, dx), mask.shape[1] + min(0, dx)))
        both = mask[a] & mask[b]
        pairs.append(np.stack([place[a][both], place[b][both]]))
    one, other = np.concatenate(pairs, axis=1)
    while True:
        low = np.minimum(label[one], label[other])
        if (label[one] == low).all() and (label[other] == low).all():
            return label.reshape(mask.shape)
        np.minimum.at(label, label[one], low)
        np.minimum.at(label, label[other], low)
        for _ in range(2):
            label = label[label]


def _ridges(part: pa.Table, top: int, left: int, tile: int, width: int, height: int) -> np.ndarray:
    """Thinned gradient of a tile."""
    if top >= height or left >= width:
        return np.zeros((0, 0))
    whole, v, u = _crop(part, "grey", top, left, 2, tile, width, height)
    return thinned(whole)[v : v + tile, u : u + tile]


def _edges_in_one_tile(inside: DataFrame, width: int, height: int, low: float, high: float, id_col: str, tile: int) -> DataFrame:
    """Edges of images that are a single tile: hysteresis inside the task, nothing is linked over borders."""

    def find(image: int, top: int, left: int, part: pa.Table) -> pa.Table:
        sizes = _ridges(part, top, left, tile, width, height)
        blob = _blobs(sizes > low)
        strong = np.zeros(max(sizes.size, 1), bool)
        strong[blob[sizes > high]] = True
        iv, iu = np.nonzero((sizes > low) & strong[blob])
        return pa.table({id_col: pa.array(np.full(len(iv), image, np.int64)), "iv": pa.array((iv + top).astype(np.int32)), "iu": pa.array((iu + left).astype(np.int32))})

    return _windowed(inside, 2, find, f"{id_col} long, iv int, iu int", id_col, tile)


def edge_candidates(pixels: DataFrame, width: int, height: int, low: float, high: float, id_col: str = "cam_id", tile: int = WIDE_TILE) -> DataFrame:
    """(cam_id, iv, iu, strong, blob): ridges of the gradient of grey images (column ``grey``) above ``low``, and whether they are above ``high``.

    ``blob`` numbers what is connected inside a tile, by a pixel of the image.
    """

    def find(image: int, top: int, left: int, part: pa.Table) -> pa.Table:
        sizes = _ridges(part, top, left, tile, width, height)
        iv, iu = np.nonzero(sizes > low)
        blob = _blobs(sizes > low)[iv, iu] if len(iv) else np.zeros(0, int)
        columns = max(sizes.shape[1], 1)
        number = (blob // columns + top).astype(np.int64) * width + blob % columns + left
        return pa.table({
            id_col: pa.array(np.full(len(iv), image, np.int64)), "iv": pa.array((iv + top).astype(np.int32)), "iu": pa.array((iu + left).astype(np.int32)),
            "strong": pa.array(sizes[iv, iu] > high), "blob": pa.array(number),
        })

    inside = _positions(pixels, "grey", id_col).where((F.col("iv") < height) & (F.col("iu") < width))
    return _windowed(inside, 2, find, f"{id_col} long, iv int, iu int, strong boolean, blob long", id_col, tile)


def _joined_blobs(blobs: DataFrame, links: DataFrame, id_col: str) -> DataFrame:
    """(cam_id, blob, root): blobs that are linked over the borders of tiles share a root.

    Each round takes the least root among neighbours, then that root's own, so
    the rounds grow with the logarithm of a chain's length.
    """
    both = settled(links.union(links.select(id_col, F.col("other").alias("blob"), F.col("blob").alias("other"))).distinct())
    roots = blobs.select(id_col, "blob", F.col("blob").alias("root"))
    while True:
        of_other = roots.select(id_col, F.col("blob").alias("other"), F.col("root").alias("theirs"))
        least = both.join(of_other, [id_col, "other"]).groupBy(id_col, "blob").agg(F.min("theirs").alias("theirs"))
        lower = roots.join(least, [id_col, "blob"], "left").select(id_col, "blob", "root", F.least("root", "theirs").alias("now"))
        lower = settled(lower)
        beyond = lower.select(id_col, F.col("blob").alias("now"), F.col("now").alias("further"))
        after = settled(lower.join(beyond, [id_col, "now"]).select(id_col, "blob", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved")))
        if not after.where("moved").limit(1).count():
            return after.select(id_col, "blob", "root")
        roots = after.select(id_col, "blob", "root")


def canny_edges(pixels: DataFrame, width: int, height: int, low: float = 50.0, high: float = 150.0, id_col: str = "cam_id", tile: int = WIDE_TILE) -> DataFrame:
    """(cam_id, iv, iu) of edge pixels of grey images (column ``grey``): gradient, thinning, hysteresis.

    Images of any size come in tiles. Weak pixels are connected inside tiles
    first; pixels on the borders of tiles link their blobs, and a blob is an
    edge if one that it is linked with holds a strong pixel. Images no larger
    than a tile have no such borders and are done in one pass.
    """
    if width <= tile and height <= tile:
        inside = _positions(pixels, "grey", id_col).where((F.col("iv") < height) & (F.col("iu") < width))
        return _edges_in_one_tile(inside, width, height, low, high, id_col, tile)
    found = settled(edge_candidates(pixels, width, height, low, high, id_col, tile))
    blobs = found.groupBy(id_col, "blob").agg(F.max("strong").alias("strong"))
    at_border = " or ".join(f"{a} % {tile} in (0, {tile - 1})" for a in ("iv", "iu"))
    border = found.where(at_border).select(id_col, "iv", "iu", "blob")
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in ((0, 1), (1, 0), (1, 1), (1, -1))])
    ahead = border.withColumn("step", F.explode(steps)).select(id_col, (F.col("iv") + F.col("step.dy")).alias("iv"), (F.col("iu") + F.col("step.dx")).alias("iu"), F.col("blob").alias("other"))
    links = border.join(ahead, [id_col, "iv", "iu"]).where("blob <> other").select(id_col, "blob", "other")
    roots = _joined_blobs(blobs, links, id_col)
    whole = blobs.join(roots, [id_col, "blob"])
    strong = whole.groupBy(id_col, "root").agg(F.max("strong").alias("strong")).where("strong").select(id_col, "root")
    kept = roots.join(strong, [id_col, "root"], "left_semi").select(id_col, "blob")
    return found.join(kept, [id_col, "blob"], "left_semi").select(id_col, "iv", "iu")


def keep_edges(edge_points: DataFrame, points: DataFrame, size: float, id_col: str = "cam_id") -> DataFrame:
    """Points on an edge in any image, each once, the first of each voxel by image and id."""
    from .cloud import first_per_voxel

    once = edge_points.groupBy("point_id").agg(F.min(id_col).alias("first_image"))
    return first_per_voxel(points.join(once, "point_id"), size, ["first_image", "point_id"])
