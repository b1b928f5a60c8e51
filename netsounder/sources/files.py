"""Readers and writers of the exchange formats around the network.

Every reader takes a path that Spark opens, so local folders and remote
stores are alike; schemas are given, not inferred.
"""

from __future__ import annotations

import io
import json
import struct
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netsounder.operators.relational import first_by, refused, without_nan


def read_csv(spark: SparkSession, path: str, schema: str, required: tuple[str, ...] = (), comment: str = "#") -> DataFrame:
    """CSV with a header; blank and commented lines are skipped, and a row that lacks a required field is an error."""
    df = spark.read.csv(path, header=True, schema=schema, comment=comment, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    df = df.dropna(how="all")
    for field in required:
        df = refused(df, F.trim(F.coalesce(F.col(field).cast("string"), F.lit(""))) == "", f"a row has no {field}")
    return df


def read_utf16_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """UTF-16 CSV, unpacked or as members of ZIP files; a ZIP is one binary cell (2 GB at most), its members are read in parts."""
    if not path.endswith(".zip"):
        return spark.read.csv(path, header=True, schema=schema, encoding="UTF-16", multiLine=True)
    names = StructType.fromDDL(schema).names

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in frames:
            for content in files["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for member in z.namelist():
                        with z.open(member) as f:
                            for part in pd.read_csv(f, encoding="utf-16", dtype=str, chunksize=50_000):
                                yield part.reindex(columns=names).astype(object).where(lambda x: x.notna(), None)

    as_text = ", ".join(f"`{n}` string" for n in names)
    out = spark.read.format("binaryFile").load(path).select("content").mapInPandas(unpack, as_text)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in StructType.fromDDL(schema)])


def read_readings(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """JSON lines appended over time: the first reading of a key wins, by file and place in it."""
    rows = spark.read.json(path, schema=schema).withColumn("_file", F.input_file_name()).withColumn("_at", F.monotonically_increasing_id())
    return first_by(rows, [key], [F.asc("_file"), F.asc("_at")]).drop("_file", "_at")


def read_geojson_lines(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """LineString features with their vertices, and ``refused``: why a feature can't be used, else null."""
    schema = f"features array<struct<properties: struct<{properties}>, geometry: struct<type: string, coordinates: array<array<double>>>>>"
    doc = spark.read.json(path, schema=schema, multiLine=True)
    f = doc.select(F.explode("features").alias("f"))
    pts = F.transform("f.geometry.coordinates", lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    out = f.select("f.properties.*", F.col("f.geometry.type").alias("_type"), pts.alias("pts"))
    flat = F.array_max(F.transform("pts", lambda p: F.greatest(F.abs(p["x"]), F.abs(p["y"])))) <= 180
    still = F.size(F.array_distinct("pts")) < 2
    why = F.when(F.col("_type") != "LineString", "not a line").when(flat, "degrees, not metres").when(still, "no length")
    return out.withColumn("refused", why).drop("_type")


def read_boxed(df: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Rows whose box (columns xmin, ymin, xmax, ymax) meets a rectangle; the comparisons reach the Parquet scan."""
    return df.where((F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin))


def read_ascii_grids(spark: SparkSession, path: str, cell: float, left: float, top: float) -> DataFrame:
    """``(r, c, z)`` of ASCII grids, plain or in ZIPs, each placed on one common grid by its own corner."""

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in frames:
            for name, content in zip(files["path"], files["content"], strict=True):
                texts = [content]
                if name.endswith(".zip"):
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        texts = [z.read(m) for m in z.namelist() if m.lower().endswith(".asc")]
                for text in texts:
                    yield _grid(text.decode("ascii"), cell, left, top)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(decode, "r long, c long, z double")


def _grid(text: str, cell: float, left: float, top: float) -> pd.DataFrame:
    lines = text.split("\n")
    head: dict[str, float] = {}
    while lines and lines[0][:1].isalpha():
        k, v = lines.pop(0).split()
        head[k.lower()] = float(v)
    z = np.array(" ".join(lines).split(), np.float64).reshape(int(head["nrows"]), int(head["ncols"]))
    r0 = round((top - (head["yllcorner"] + head["nrows"] * head["cellsize"])) / cell)
    c0 = round((head["xllcorner"] - left) / cell)
    r, c = np.nonzero(z != head.get("nodata_value", -9999))
    return pd.DataFrame({"r": r + r0, "c": c + c0, "z": z[r, c]})


def wkb_point(x: float, y: float) -> bytes:
    return struct.pack("<BIdd", 1, 1, x, y)


def wkb_line(pts: list[tuple[float, float]]) -> bytes:
    return struct.pack("<BII", 1, 2, len(pts)) + b"".join(struct.pack("<dd", *p) for p in pts)


def points_of_wkb(data: bytes) -> list[tuple[float, float]]:
    """Vertices of a WKB point or line, either byte order."""
    order = "<" if data[0] == 1 else ">"
    (kind,) = struct.unpack_from(f"{order}I", data, 1)
    if kind % 1000 == 1:
        return [struct.unpack_from(f"{order}dd", data, 5)]
    if kind % 1000 != 2:
        raise ValueError(f"geometry kind {kind}")
    (n,) = struct.unpack_from(f"{order}I", data, 5)
    flat = struct.unpack_from(f"{order}{2 * n}d", data, 9)
    return list(zip(flat[::2], flat[1::2], strict=True))


def write_layers(layers: dict[str, DataFrame], path: str) -> None:
    """One Parquet folder per layer."""
    for name, df in layers.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; a measure that is not a number is an error."""
    without_nan(df).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def geojson(df: DataFrame, x: str, y: str, limit: int = 100_000) -> str:
    """A small result as a GeoJSON text of points; for reports, so a larger one is refused."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} features: write a layer instead")
    features = []
    for row in rows:
        p = row.asDict(recursive=True)
        features.append({"type": "Feature", "geometry": {"type": "Point", "coordinates": [round(p.pop(x), 6), round(p.pop(y), 6)]}, "properties": p})
    return json.dumps({"type": "FeatureCollection", "features": features}, allow_nan=False, default=str)


def markdown(df: DataFrame, title: str, limit: int = 1_000) -> str:
    """A small result as a Markdown table; a larger one is refused."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows: write a table instead")
    head = f"| {' | '.join(df.columns)} |\n|{'---|' * len(df.columns)}\n"
    return f"## {title}\n\n{head}" + "".join(f"| {' | '.join('' if v is None else str(v) for v in r)} |\n" for r in rows)
