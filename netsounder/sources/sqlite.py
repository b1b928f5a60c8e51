"""SQLite and GeoPackage layers as a Spark data source, read by ranges of row ids with filters pushed down."""

from __future__ import annotations

import os
import sqlite3
import struct
import tempfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

_KINDS = {"INTEGER": "long", "INT": "long", "MEDIUMINT": "long", "REAL": "double", "DOUBLE": "double", "FLOAT": "double", "BOOLEAN": "boolean"}
_GEOMETRY = {"GEOMETRY", "POINT", "LINESTRING", "POLYGON", "MULTILINESTRING", "MULTIPOLYGON", "BLOB"}
_SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class _Range(InputPartition):
    def __init__(self, low: int, high: int) -> None:
        self.low, self.high = low, high


class SqliteSource(DataSource):
    """``format("netsounder_sqlite")`` with options ``path``, ``table`` and ``partitions``."""

    @classmethod
    def name(cls) -> str:
        return "netsounder_sqlite"

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True)

    def schema(self) -> str:
        with self._open() as db:
            info = db.execute(f"PRAGMA table_info({_quoted(self.options['table'])})").fetchall()
        kind = lambda t: "binary" if t.upper() in _GEOMETRY else _KINDS.get(t.upper().split("(")[0], "string")
        return ", ".join(f"`{row[1]}` {kind(row[2])}" for row in info)

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, schema)


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema) -> None:
        self.path, self.table, self.schema = options["path"], options["table"], schema
        self.count = int(options.get("partitions", 4))
        self.where: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if type(f) in _SIGNS and len(f.attribute) == 1 and isinstance(f.value, (int, float, str)):
                self.where.append((f.attribute[0], _SIGNS[type(f)], f.value))
            else:
                yield f

    def _db(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self) -> list[InputPartition]:
        with self._db() as db:
            low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
        if low is None:
            return [_Range(0, 0)]
        step = max(1, -(-(high - low + 1) // self.count))
        return [_Range(at, min(at + step, high + 1)) for at in range(low, high + 1, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        cols = ", ".join(_quoted(f.name) for f in self.schema.fields)
        where = "".join(f" AND {_quoted(c)} {sign} ?" for c, sign, _ in self.where)
        booleans = [i for i, f in enumerate(self.schema.fields) if f.dataType.typeName() == "boolean"]
        with self._db() as db:
            for row in db.execute(
                f"SELECT {cols} FROM {_quoted(self.table)} WHERE rowid >= ? AND rowid < ?{where}",
                (partition.low, partition.high, *(v for *_, v in self.where)),
            ):
                out = list(row)
                for i in booleans:
                    out[i] = None if out[i] is None else bool(out[i])
                yield tuple(out)


def layer(spark, path: str, table: str, partitions: int = 4):
    """A layer of an SQLite or GeoPackage file that every executor finds at the same local path; see :func:`stored_layer` for others."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteSource)
    return spark.read.format("netsounder_sqlite").options(path=path, table=table, partitions=partitions).load()


def last_change(path: str) -> str | None:
    """The newest ``last_change`` of a GeoPackage's contents, to the day."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        (found,) = db.execute("SELECT max(last_change) FROM gpkg_contents").fetchone()
    return found and found[:10]


def stored_layer(spark: SparkSession, path: str, table: str, schema: str, rows: int = 20_000) -> DataFrame:
    """A layer of files in any store that Spark reads: a file is one binary cell (2 GB at most), its rows leave the task in parts."""
    from pyspark.sql.types import StructType

    names = StructType.fromDDL(schema).names

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in frames:
            for content in files["content"]:
                db = sqlite3.connect(":memory:")
                db.deserialize(bytes(content))
                found = db.execute(f"SELECT {', '.join(map(_quoted, names))} FROM {_quoted(table)} ORDER BY rowid")
                while part := found.fetchmany(rows):
                    yield pd.DataFrame(part, columns=names, dtype=object)
                db.close()

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


#: A GeoPackage's mark, version and the tables that it must have.
_MARK, _VERSION = 0x47504B47, 10300
_FRAME = """
CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME NOT NULL, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL, PRIMARY KEY (table_name, column_name));
"""
_SQL_TYPES = {"long": "INTEGER", "integer": "INTEGER", "double": "REAL", "boolean": "BOOLEAN", "binary": "BLOB"}


def write_geopackage(layers: dict[str, DataFrame], path: str, clock: str, geometry: str = "geom", srs: int = 27700) -> dict[str, int]:
    """One GeoPackage of several layers with their last change pinned to ``clock``; returns the layers' rows.

    A layer's ``geometry`` column, where it has one, holds WKB. Rows arrive at the driver one partition
    at a time and in the layer's own order, so the same rows make the same file. The file is put where Spark's
    file systems say ``path`` is.
    """
    spark = next(iter(layers.values())).sparkSession
    counts = {}
    with tempfile.TemporaryDirectory() as folder:
        local = os.path.join(folder, "out.gpkg")
        db = sqlite3.connect(local)
        db.execute(f"PRAGMA application_id = {_MARK}")
        db.execute(f"PRAGMA user_version = {_VERSION}")
        db.executescript(_FRAME)
        db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{srs}", srs, srs))
        for name, df in layers.items():
            kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
            columns = ", ".join(f"{_quoted(c)} {'GEOMETRY' if c == geometry else _SQL_TYPES.get(k, 'TEXT')}" for c, k in kinds.items())
            db.execute(f"CREATE TABLE {_quoted(name)} (fid INTEGER PRIMARY KEY AUTOINCREMENT NOT NULL, {columns})")
            db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, last_change, srs_id) VALUES (?, ?, ?, ?, ?)", (name, "features" if geometry in kinds else "attributes", name, clock, srs))
            if geometry in kinds:
                db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, ?, 'GEOMETRY', ?, 0, 0)", (name, geometry, srs))
            head = b"GP" + struct.pack("<BBi", 0, 1, srs)
            put = f"INSERT INTO {_quoted(name)} ({', '.join(map(_quoted, kinds))}) VALUES ({', '.join('?' * len(kinds))})"
            at = list(kinds).index(geometry) if geometry in kinds else -1
            counts[name] = 0
            for row in df.toLocalIterator():
                values = [v if v is None or isinstance(v, (int, float, str, bytes, bytearray)) else str(v) for v in row]
                if at >= 0 and values[at] is not None:
                    values[at] = head + bytes(values[at])
                db.execute(put, values)
                counts[name] += 1
        db.commit()
        db.close()
        files = spark._jvm.org.apache.hadoop.fs
        target = files.Path(path)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).copyFromLocalFile(False, True, files.Path("file://" + local), target)
    return counts
