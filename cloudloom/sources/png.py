"""PNG images of grey or colour, 8 or 16 bits, read and written without an image library."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.camera import image_keys

_MAGIC = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(image: np.ndarray, level: int = 6) -> bytes:
    """(h, w) or (h, w, 3); uint8 or uint16."""
    h, w = image.shape[:2]
    depth, color = (16 if image.dtype == np.uint16 else 8), 2 if image.ndim == 3 else 0
    rows = image.astype(">u2" if depth == 16 else np.uint8).reshape(h, -1)
    raw = b"".join(b"\0" + row.tobytes() for row in rows)
    return _MAGIC + _chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, color, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(raw, level)) + _chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray | None:
    """The pixels of a grey or RGB(A) image that is not interlaced; None if it cannot be read."""
    if not data.startswith(_MAGIC):
        return None
    at, body, head = 8, b"", None
    try:
        while at < len(data):
            (size,) = struct.unpack(">I", data[at : at + 4])
            kind, part = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
            head = struct.unpack(">IIBBBBB", part) if kind == b"IHDR" else head
            body += part if kind == b"IDAT" else b""
            at += 12 + size
        w, h, depth, color, _, _, interlace = head
        planes = {0: 1, 2: 3, 4: 2, 6: 4}[color]
        if interlace or depth not in (8, 16):
            return None
        step = planes * depth // 8
        flat = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * step)
    except (struct.error, zlib.error, KeyError, TypeError, ValueError):
        return None
    out = np.zeros((h, w * step), np.uint8)
    above = np.zeros(w * step, np.int64)
    for y in range(h):
        mode, row = flat[y, 0], flat[y, 1:].astype(np.int64)
        if mode == 1:
            row = np.cumsum(row.reshape(-1, step), axis=0).ravel()
        elif mode == 2:
            row = row + above
        elif mode in (3, 4):
            for x in range(len(row)):
                left = row[x - step] if x >= step else 0
                if mode == 3:
                    guess = (left + above[x]) // 2
                else:
                    corner = above[x - step] if x >= step else 0
                    p = left + above[x] - corner
                    pa, pb, pc = abs(p - left), abs(p - above[x]), abs(p - corner)
                    guess = left if pa <= pb and pa <= pc else above[x] if pb <= pc else corner
                row[x] = (row[x] + guess) & 255
        above = row & 255
        out[y] = above
    pixels = out.view(">u2").astype(np.uint16) if depth == 16 else out
    pixels = pixels.reshape(h, w, planes)
    return pixels[:, :, 0] if planes < 3 else pixels[:, :, :3]


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(filename, iv, iu, r, g, b, grey): pixels of all PNG files under ``path``; unreadable files give no rows."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def pixels(batches):
        for part in batches:
            for name, data in zip(part["path"], part["content"]):
                image = decode_png(bytes(data))
                if image is None:
                    continue
                image = image if image.ndim == 3 else np.repeat(image[:, :, None], 3, axis=2)
                iv, iu = np.indices(image.shape[:2])
                r, g, b = (image[:, :, k].ravel().astype(np.int32) for k in range(3))
                grey = np.floor(0.299 * r + 0.587 * g + 0.114 * b + 0.5).astype(np.int32)
                yield pd.DataFrame({"filename": name.rsplit("/", 1)[-1], "iv": iv.ravel().astype(np.int32), "iu": iu.ravel().astype(np.int32), "r": r, "g": g, "b": b, "grey": grey})

    return files.mapInPandas(pixels, "filename string, iv int, iu int, r int, g int, b int, grey int")


def depth_pngs(encoded: DataFrame, width: int, height: int, id_col: str = "cam_id") -> DataFrame:
    """(cam_id, png): a 16-bit image of each camera's codes (column ``code``); one image a group."""

    def draw(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        image = np.zeros((height, width), np.uint16)
        image[part["iv"].to_numpy(int), part["iu"].to_numpy(int)] = part["code"]
        return pd.DataFrame({id_col: [key[-1]], "png": [encode_png(image)]})

    keys = image_keys(encoded, id_col)
    return encoded.select(*keys, "iv", "iu", "code").groupBy(*keys).applyInPandas(draw, f"{id_col} long, png binary")


def write_files(blobs: DataFrame, folder: str, name_col: str, data_col: str) -> DataFrame:
    """Writes each row's bytes to ``folder/name`` on shared storage; returns (name, size) of what was written."""
    import os

    def put(batches):
        os.makedirs(folder, exist_ok=True)
        for part in batches:
            sizes = []
            for name, data in zip(part[name_col], part[data_col]):
                temporary = os.path.join(folder, f".{name}.{os.getpid()}")
                with open(temporary, "wb") as file:
                    file.write(bytes(data))
                os.replace(temporary, os.path.join(folder, name))  # a task that runs again leaves the same file
                sizes.append(len(data))
            yield pd.DataFrame({"name": part[name_col], "size": sizes})

    return blobs.select(F.col(name_col), F.col(data_col)).mapInPandas(put, "name string, size long")


def grey_pixels(images: DataFrame, id_col: str = "cam_id", value: str = "code") -> DataFrame:
    """(cam_id, iv, iu, code): pixels of one-channel images (column ``png``) that are not 0; unreadable images have none."""

    def read(batches):
        for part in batches:
            for key, data in zip(part[id_col], part["png"]):
                image = decode_png(bytes(data))
                if image is not None and image.ndim == 2:
                    iv, iu = np.nonzero(image)
                    yield pd.DataFrame({id_col: key, "iv": iv.astype(np.int32), "iu": iu.astype(np.int32), value: image[iv, iu].astype(np.int32)})

    return images.select(id_col, "png").mapInPandas(read, f"{id_col} long, iv int, iu int, {value} int")
