"""Rasters and named arrays from files: GeoTIFF bands block by block, ``.npz`` members, and the guard on conditioned surfaces.

A file reaches one task as one binary cell (2 GB at most) and leaves it a block of rows at a time.
"""

from __future__ import annotations

import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: TIFF tags that are read.
_TAGS = {
    256: "width", 257: "height", 258: "bits", 259: "compression", 273: "offsets", 277: "bands", 278: "rows", 279: "sizes",
    317: "predictor", 322: "tile_width", 323: "tile_height", 324: "offsets", 325: "sizes", 339: "kind", 33550: "scale", 33922: "tie", 42113: "nodata",
}
#: Sizes and codes of TIFF field types.
_FIELDS = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q")}
_CONDITIONED = re.compile(r"fill|breach|burn|condition|flood", re.IGNORECASE)


def _header(data: bytes) -> tuple[str, dict]:
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a classic TIFF")
    (at,) = struct.unpack_from(order + "I", data, 4)
    (n,) = struct.unpack_from(order + "H", data, at)
    tags: dict = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
        if tag not in _TAGS or kind not in _FIELDS:
            continue
        size, code = _FIELDS[kind]
        place = at + 2 + 12 * k + 8
        if size * count > 4:
            (place,) = struct.unpack_from(order + "I", data, place)
        tags[_TAGS[tag]] = data[place : place + count] if code == "s" else struct.unpack_from(f"{order}{count}{code}", data, place)
    return order, tags


def tiff_blocks(data: bytes) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(first row, first column, cells)`` of each strip or tile of a one-band raster."""
    order, t = _header(data)
    width, height = t["width"][0], t["height"][0]
    if t.get("bands", (1,))[0] != 1:
        raise ValueError("more than one band")
    code = {1: "u", 2: "i", 3: "f"}[t.get("kind", (1,))[0]]
    kind = np.dtype(f"{order}{code}{t['bits'][0] // 8}")
    tiled = "tile_width" in t
    wide, high = (t["tile_width"][0], t["tile_height"][0]) if tiled else (width, t.get("rows", (height,))[0])
    across = -(-width // wide)
    for k, (at, size) in enumerate(zip(t["offsets"], t["sizes"], strict=True)):
        raw = data[at : at + size]
        packing = t.get("compression", (1,))[0]
        if packing in (8, 32946):
            raw = zlib.decompress(raw)
        elif packing != 1:
            raise ValueError(f"TIFF compression {packing}")
        r, c = k // across * high, k % across * wide
        rows = high if tiled else min(high, height - r)
        cells = np.frombuffer(raw, kind, rows * wide).reshape(rows, wide)
        if t.get("predictor", (1,))[0] == 2:
            cells = np.cumsum(cells, axis=1, dtype=kind)
        elif t.get("predictor", (1,))[0] != 1:
            raise ValueError("floating-point predictor")
        yield r, c, cells[: height - r, : width - c]


def read_geotiff(spark: SparkSession, path: str, cell: float, left: float, top: float, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """``(r, c, z)`` of one-band GeoTIFFs on one common grid; ``window`` (first row, first column, last row, last column) keeps the blocks it meets.

    Cells without data are left out. Strips and tiles, plain or deflated, are read block by block.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in frames:
            for data in files["content"]:
                _, t = _header(data)
                tie, scale = t.get("tie", (0, 0, 0, left, top, 0)), t.get("scale", (cell, cell, 0))
                if abs(scale[0] - cell) > 1e-9 * cell:
                    raise ValueError(f"cells of {scale[0]}, not {cell}")
                r0, c0 = round((top - tie[4]) / cell), round((tie[3] - left) / cell)
                none = float(t["nodata"].rstrip(b"\0")) if "nodata" in t else None
                for r, c, cells in tiff_blocks(data):
                    r, c = r + r0, c + c0
                    if window and (r > window[2] or c > window[3] or r + cells.shape[0] <= window[0] or c + cells.shape[1] <= window[1]):
                        continue
                    z = cells.astype(np.float64)
                    i, j = np.nonzero(np.isfinite(z) & (z != none) if none is not None else np.isfinite(z))
                    out = pd.DataFrame({"r": i + r, "c": j + c, "z": z[i, j]})
                    if window:
                        out = out[out["r"].between(window[0], window[2]) & out["c"].between(window[1], window[3])]
                    yield out

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "r long, c long, z double")


def read_npz(spark: SparkSession, path: str, rows: int = 4_096) -> DataFrame:
    """``(name, r, c, value)`` of the named arrays of ``.npz`` files, one- or two-dimensional, a block of rows at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in frames:
            for data in files["content"]:
                with np.load(io.BytesIO(data), allow_pickle=False) as held:
                    for name in held.files:
                        a = held[name]
                        if a.ndim > 2:
                            raise ValueError(f"{name} has {a.ndim} dimensions")
                        a = a.reshape(len(a), -1) if a.ndim else a.reshape(1, 1)
                        for at in range(0, len(a), rows):
                            part = a[at : at + rows].astype(np.float64)
                            r, c = np.indices(part.shape)
                            yield pd.DataFrame({"name": name, "r": (r + at).ravel(), "c": c.ravel(), "value": part.ravel()})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "name string, r long, c long, value double")


def unconditioned(name: str) -> str:
    """``name`` of a surface that no step has filled, breached or burned; heights must not be read from any other."""
    if _CONDITIONED.search(name.rsplit("/", 1)[-1]):
        raise ValueError(f"{name} is a conditioned surface: its heights are made, not measured")
    return name
