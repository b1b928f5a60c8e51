"""Raster and array sources, packages and tars, rules, sources, checks and releases."""

import io
import sqlite3
import struct
import tarfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from netsounder.build.pipeline import BuildError, Params, Pipeline
from netsounder.build.release import Source, Sources, checked, release, table_digest
from netsounder.build.rules import Rules
from netsounder.operators.grids import plausible
from netsounder.sources import arrays, files, ledger, sqlite
from netsounder.streaming import events as E


def tiff(z, order="<", packed=False, tile=None, predictor=1, nodata=None, tie=(0.0, 0.0), cell=10.0):
    """A one-band TIFF of ``z`` in strips of two rows or in tiles."""
    z = np.asarray(z)
    high, wide = tile or (2, z.shape[1])
    blocks = []
    for r in range(0, z.shape[0], high):
        for c in range(0, z.shape[1], wide):
            part = z[r : r + high, c : c + wide]
            if tile:
                part = np.pad(part, ((0, high - part.shape[0]), (0, wide - part.shape[1])))
            if predictor == 2:
                part = np.diff(part, axis=1, prepend=0).astype(z.dtype)
            raw = part.astype(z.dtype.newbyteorder(order)).tobytes()
            blocks.append(zlib.compress(raw) if packed else raw)
    tags = [(256, 3, (z.shape[1],)), (257, 3, (z.shape[0],)), (258, 3, (z.dtype.itemsize * 8,)), (259, 3, (8 if packed else 1,)), (277, 3, (1,)), (317, 3, (predictor,)), (339, 3, ({"u": 1, "i": 2, "f": 3}[z.dtype.kind],))]
    at, places = 8, []
    for b in blocks:
        places.append(at)
        at += len(b)
    sizes = tuple(len(b) for b in blocks)
    tags += [(322, 3, (wide,)), (323, 3, (high,)), (324, 4, tuple(places)), (325, 4, sizes)] if tile else [(278, 3, (high,)), (273, 4, tuple(places)), (279, 4, sizes)]
    tags += [(33550, 12, (cell, cell, 0.0)), (33922, 12, (0.0, 0.0, 0.0, *tie, 0.0))]
    if nodata is not None:
        tags.append((42113, 2, nodata.encode() + b"\0"))
    code = {3: "H", 4: "I", 12: "d"}
    after = at + 2 + 12 * len(tags) + 4
    head, tail = b"", b""
    for tag, kind, value in sorted(tags, key=lambda x: x[0]):
        raw = value if kind == 2 else struct.pack(f"{order}{len(value)}{code[kind]}", *value)
        place = raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack(order + "I", after + len(tail))
        tail += b"" if len(raw) <= 4 else raw
        head += struct.pack(order + "HHI", tag, kind, len(value)) + place
    mark = b"II" if order == "<" else b"MM"
    return mark + struct.pack(order + "HI", 42, at) + b"".join(blocks) + struct.pack(order + "H", len(tags)) + head + b"\0" * 4 + tail


@pytest.mark.parametrize("kind", [{}, {"packed": True}, {"order": ">"}, {"tile": (4, 3), "packed": True}, {"predictor": 2}])
def test_geotiff_blocks(spark, tmp_path, kind):
    z = (np.arange(35).reshape(5, 7) * 3 % 11).astype(np.int16)
    z[2, 3] = -9
    (tmp_path / "a.tif").write_bytes(tiff(z, nodata="-9", tie=(20.0, 100.0), **kind))
    got = {(r.r, r.c): r.z for r in arrays.read_geotiff(spark, str(tmp_path), 10.0, 0.0, 120.0).collect()}
    assert got == {(i + 2, j + 2): float(v) for (i, j), v in np.ndenumerate(z) if v != -9}
    part = {(r.r, r.c) for r in arrays.read_geotiff(spark, str(tmp_path), 10.0, 0.0, 120.0, (3, 3, 4, 5)).collect()}
    assert part == {k for k in got if 3 <= k[0] <= 4 and 3 <= k[1] <= 5}


def test_geotiff_refusals(spark, tmp_path):
    f = np.array([[1.5, np.nan], [2.5, 3.0]], np.float32)
    (tmp_path / "f.tif").write_bytes(tiff(f))
    assert sorted(r.z for r in arrays.read_geotiff(spark, str(tmp_path), 10.0, 0.0, 0.0).collect()) == [1.5, 2.5, 3.0]
    with pytest.raises(ValueError, match="not a classic TIFF"):
        list(arrays.tiff_blocks(b"PNG....."))
    assert arrays.unconditioned("tiles/terrain50") == "tiles/terrain50"
    with pytest.raises(ValueError, match="conditioned surface"):
        arrays.unconditioned("tiles/terrain50_breached.tif")


def test_npz(spark, tmp_path):
    np.savez(tmp_path / "a.npz", one=np.arange(5), two=np.arange(6.0).reshape(2, 3), three=np.float64(7))
    got = {(r["name"], r.r, r.c): r.value for r in arrays.read_npz(spark, str(tmp_path), 2).collect()}
    assert got[("one", 4, 0)] == 4 and got[("two", 1, 2)] == 5 and got[("three", 0, 0)] == 7 and len(got) == 12


def test_geopackage_there_and_back(spark, tmp_path):
    line = spark.createDataFrame([(1, "a", files.wkb_line([(0, 0), (3, 4)]), True), (2, None, None, None)], "id long, name string, geom binary, open boolean")
    rows = spark.createDataFrame([("x", 1.5)], "k string, v double")
    path = str(tmp_path / "out.gpkg")
    assert sqlite.write_geopackage({"link": line, "note": rows}, path, "2024-05-06T00:00:00Z") == {"link": 2, "note": 1}
    first = open(path, "rb").read()
    sqlite.write_geopackage({"link": line, "note": rows}, path, "2024-05-06T00:00:00Z")
    assert open(path, "rb").read() == first and sqlite.last_change(path) == "2024-05-06"
    got = sqlite.stored_layer(spark, path, "link", "id long, name string, geom binary, open long").orderBy("id").collect()
    assert [(r.id, r.name, r.open) for r in got] == [(1, "a", 1), (2, None, None)]
    assert files.points_of_wkb(bytes(got[0].geom)[8:]) == [(0, 0), (3, 4)]
    with sqlite3.connect(path) as db:
        assert db.execute("SELECT count(*) FROM gpkg_geometry_columns").fetchone() == (1,)


def test_tar_from_manifest(spark):
    held = spark.createDataFrame([("b", bytearray(b"22")), ("a", bytearray(b"1")), ("c", bytearray(b"3"))], "name string, content binary")
    pinned = held.where("name <> 'c'").select("name", F.sha2("content", 256).alias("sha256"))
    out = io.BytesIO()
    assert ledger.packed(held, pinned, out) == 2
    with tarfile.open(fileobj=io.BytesIO(out.getvalue())) as tar:
        assert [(m.name, tar.extractfile(m).read(), m.mtime) for m in tar] == [("a", b"1", 0), ("b", b"22", 0)]
    with pytest.raises(ValueError, match="b is changed"):
        ledger.packed(held, pinned.withColumn("sha256", F.when(F.col("name") == "b", "0").otherwise(F.col("sha256"))), io.BytesIO())


def test_addresses(spark):
    declared = spark.createDataFrame([("a", "https://x.org/1"), ("b", ""), ("c", "ftp://x"), ("d", "http://y.org"), ("e", "http://z.org"), ("f", "http://w.org")], "source string, url string")
    answers = spark.createDataFrame([("https://x.org/1", 200), ("http://y.org", 404), ("http://w.org", 301)], "url string, status int")
    got = {r.source: r.verdict for r in ledger.resolution(declared, answers).collect()}
    assert got == {"a": "resolves", "b": "no address", "c": "not a web address", "d": "refused 404", "e": "not asked", "f": "moved"}


def test_plausible_labels(spark):
    groups = spark.createDataFrame([("lake", 5.0), ("sea", 50.0)], "label string, depth double")
    bounds = spark.createDataFrame([("lake", 10.0), ("sea", 60.0)], "label string, most double")
    assert plausible(groups, "label", "depth", bounds).count() == 2
    with pytest.raises(ValueError, match=r"sea 50 \(40 at most\)"):
        plausible(groups, "label", "depth", bounds.withColumn("most", F.least("most", F.lit(40.0))))
    with pytest.raises(ValueError, match=r"sea 50 \(no bound\)"):
        plausible(groups, "label", "depth", bounds.where("label = 'lake'"))


RULE = {"id": "R-01", "order": 1, "kind": "veto", "status": "implemented", "title": "t", "statement": "s", "implements": ["m"], "params": ["a.b"]}


def test_rules():
    ok = [RULE, {**RULE, "id": "R-02", "order": 2, "status": "proposed", "statement": "as R-01 says", "owner": "x"}]
    rules = Rules(ok, {"implemented", "proposed", "superseded"}, {"veto"}, Params({"a": {"b": 1}}))
    assert [r.id for r in rules.listed()] == ["R-01", "R-02"] and [r.id for r in rules.listed("proposed", "x")] == ["R-02"]
    for change, why in (({"order": 3}, "order is not"), ({"status": "done"}, "status done"), ({"kind": "k"}, "kind k"), ({"implements": []}, "by nothing"), ({"statement": "see R-09"}, "R-09"), ({"statement": "R-01"}, "itself"), ({"params": ["q"]}, "q is not set"), ({"title": ""}, "no title"), ({"status": "superseded"}, "no successor")):
        with pytest.raises(BuildError, match=why):
            Rules([{**RULE, **change}], {"implemented", "superseded"}, {"veto"}, Params({"a": {"b": 1}}))
    with pytest.raises(BuildError, match="twice"):
        Rules([RULE, {**RULE, "order": 2}], {"implemented"}, {"veto"})


def test_sources_and_release(spark):
    sources = Sources([Source("a", "https://a", "OGL", True, True), Source("b", "https://b", "closed", True, False)])
    assert sources.digest() == Sources(list(reversed(sources.by_name.values()))).digest()
    with pytest.raises(BuildError, match="not declared"):
        sources.get("c")
    layers = {"link": spark.range(5).toDF("id"), "node": spark.range(3).toDF("id")}
    used = spark.createDataFrame([("a",)], "source string")
    listed, text = release(layers, None, used, sources, "1.0")
    assert text == "Version 1.0. Contains a (OGL)." and listed.count() == 2
    assert release(layers, listed, used, sources, "1.0")[0].count() == 2
    with pytest.raises(BuildError, match="drift: node changed"):
        release({**layers, "node": spark.range(4).toDF("id")}, listed, used, sources, "1.1")
    with pytest.raises(BuildError, match="empty layers: node"):
        release({**layers, "node": spark.range(0).toDF("id")}, None, used, sources, "1.1")
    with pytest.raises(BuildError, match="b"):
        release(layers, None, spark.createDataFrame([("b",)], "source string"), sources, "1")
    two = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    assert table_digest(two).collect() == table_digest(two.orderBy(F.desc("a")).select("b", "a").select("b", "a")).collect()


def test_checks(spark):
    assert checked(spark, {"one": lambda: True, "two": lambda: None}).where("passed").count() == 2
    with pytest.raises(BuildError, match="checks failed: bad, worse"):
        checked(spark, {"good": lambda: True, "bad": lambda: False, "worse": lambda: 1 / 0})
    with pytest.raises(BuildError, match="no check passed"):
        checked(spark, {})


def test_undeclared_sources():
    p = Pipeline(sources=("link",))

    @p.stage(reads=("link",), writes=("edge",))
    def load(spark, tables, settings): ...

    assert p.plan() == ["load"]

    @p.stage(reads=("edge", "other"), writes=("more",))
    def more(spark, tables, settings): ...

    with pytest.raises(BuildError, match="other, which is no source"):
        p.plan()
    with pytest.raises(BuildError, match="link is a source"):

        @p.stage(writes=("link",))
        def again(spark, tables, settings): ...


def test_freshness_stream(spark, tmp_path):
    schema = "stage string, fingerprint string, ran_at string"
    for k, (stage, mark) in enumerate([("load", "a"), ("crawl", "b"), ("load", "c")]):
        spark.createDataFrame([(stage, mark, f"2024-01-0{k + 1}")], schema).write.mode("append").json(str(tmp_path / "ledger"))
    got = E.run_now(E.freshness(spark, str(tmp_path / "ledger"), schema), "fresh", "complete")
    assert {(r.stage, r.fingerprint) for r in got.collect()} == {("load", "c"), ("crawl", "b")}


def test_reports_are_whole_or_refused(spark):
    with pytest.raises(ValueError, match="more than 2 rows"):
        files.markdown(spark.range(3), "t", 2)
    assert files.markdown(spark.range(2), "t", 2).count("\n") == 6
