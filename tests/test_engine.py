"""Sources, streams, the build engine and the entry point."""

import json
import sqlite3
import subprocess
import sys
import zipfile

import pytest
from pyspark.sql import functions as F

from netsounder.build.audit import audit_pipeline
from netsounder.build.pipeline import Build, BuildError, Params, Pipeline, calibrated, licence_gate
from netsounder.plans.derived import frame
from netsounder.sources import files, sqlite
from netsounder.streaming import events as E


def test_csv_with_required_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text("node,reason\n# note\n\nn1,seen\nn2,\n")
    df = files.read_csv(spark, str(tmp_path / "a.csv"), "node string, reason string")
    assert df.count() == 2
    with pytest.raises(Exception, match="no reason"):
        files.read_csv(spark, str(tmp_path / "a.csv"), "node string, reason string", required=("reason",)).collect()


def test_utf16_in_zip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "t.zip", "w") as z:
        z.writestr("t.csv", "id,text\n1,Fähre\n2,\n".encode("utf-16"))
    assert [tuple(r) for r in files.read_utf16_csv(spark, str(tmp_path / "t.zip"), "id long, text string").collect()] == [(1, "Fähre"), (2, None)]


def test_first_reading_wins(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"node":"a","elev":1}\n{"node":"b","elev":2}\n{"node":"a","elev":3}\n')
    got = files.read_readings(spark, str(tmp_path / "r.jsonl"), "node string, elev double", "node").collect()
    assert sorted(map(tuple, got)) == [("a", 1.0), ("b", 2.0)]


def test_geojson(spark, tmp_path):
    line = lambda p, k="LineString": {"type": "Feature", "properties": {"name": "n"}, "geometry": {"type": k, "coordinates": p}}
    (tmp_path / "c.geojson").write_text(json.dumps({"features": [line([[400000, 1], [400001, 5]]), line([[1, 2], [3, 4]]), line([[500, 1], [500, 1]])]}))
    got = files.read_geojson_lines(spark, str(tmp_path / "c.geojson"), "name: string").collect()
    assert [r.refused for r in got] == [None, "degrees, not metres", "no length"] and got[0].pts[1].y == 5
    text = files.geojson(spark.createDataFrame([(1.0, 2.0, "a")], "x double, y double, id string"), "x", "y")
    assert json.loads(text)["features"][0]["geometry"]["coordinates"] == [1.0, 2.0]


def test_ascii_grids(spark, tmp_path):
    head = "ncols 2\nnrows 2\nxllcorner {}\nyllcorner 100\ncellsize 10\nnodata_value -9999\n"
    (tmp_path / "a.asc").write_text(head.format(0) + "1 2\n3 -9999\n")
    (tmp_path / "b.asc").write_text(head.format(20) + "5 6\n7 8\n")
    got = {(r.r, r.c): r.z for r in files.read_ascii_grids(spark, str(tmp_path), 10, 0, 120).collect()}
    assert got == {(0, 0): 1, (0, 1): 2, (1, 0): 3, (0, 2): 5, (0, 3): 6, (1, 2): 7, (1, 3): 8}


def test_wkb():
    assert files.points_of_wkb(files.wkb_point(1, 2)) == [(1, 2)] and files.points_of_wkb(files.wkb_line([(1, 2), (3, 4)])) == [(1, 2), (3, 4)]


def test_sqlite_layer(spark, tmp_path):
    with sqlite3.connect(tmp_path / "x.gpkg") as db:
        db.execute("CREATE TABLE link (id INTEGER PRIMARY KEY, form TEXT, length REAL, closed BOOLEAN, geom BLOB)")
        db.executemany("INSERT INTO link VALUES (?,?,?,?,?)", [(i, "canal" if i % 3 else "lake", i / 2, i % 2, b"g") for i in range(1, 50)])
        db.execute("CREATE TABLE gpkg_contents (last_change TEXT)")
        db.execute("INSERT INTO gpkg_contents VALUES ('2024-05-06T01:02:03Z')")
    df = sqlite.layer(spark, str(tmp_path / "x.gpkg"), "link", 3)
    assert df.count() == 49 and df.where("form = 'lake' and length > 10").count() == sum(i % 3 == 0 and i / 2 > 10 for i in range(1, 50))
    assert sqlite.last_change(str(tmp_path / "x.gpkg")) == "2024-05-06"


def test_streams_agree_with_batch(spark, sf, tmp_path):
    batch = spark.read.parquet(f"{sf}/events.parquet")
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = E.read_parquet_stream(spark, str(tmp_path / "in"), batch.schema)
    got = E.run_now(E.windowed(stream, "ts", ["event_type"], "1 day"), "win", "complete")
    want = batch.groupBy(F.window("ts", "1 day").start.alias("start"), "event_type").agg(F.count("*").alias("n"))
    assert {(r.start, r.event_type, r.n) for r in got.collect()} == {(r.start, r.event_type, r.n) for r in want.collect()}
    assert E.run_now(E.first_readings(stream, "event_id", "ts"), "first").count() == batch.select("event_id").distinct().count()
    edits = E.run_now(E.sessions(stream, "ts", "user_id", "10 minutes"), "edits", "complete")
    assert edits.agg(F.sum("n")).first()[0] == batch.count()
    for _ in range(2):
        E.merge_log(stream, str(tmp_path / "log"), str(tmp_path / "mark")).awaitTermination()
    again = E.merge_log(stream, str(tmp_path / "log"), str(tmp_path / "other"))
    again.awaitTermination()
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.select("event_id").distinct().count() == batch.select("event_id").distinct().count() == log.count()
    good, bad = E.routed(batch.select("event_id", F.when(F.col("event_id") % 5 > 0, F.col("value")).alias("value")), 0, 1e9)
    assert good.count() + bad.count() == batch.count() and bad.where("refused = 'no answer'").count() > 0
    assert E.folded(batch, "user_id", ["ts", "event_id"]).count() == batch.select("user_id").distinct().count()


def test_pipeline_rules():
    p = Pipeline()

    @p.stage(reads=("b",), writes=("a",))
    def one(spark, tables, settings): ...

    with pytest.raises(BuildError, match="written by one"):

        @p.stage(writes=("a",))
        def two(spark, tables, settings): ...

    @p.stage(reads=("a",), writes=("b",))
    def three(spark, tables, settings): ...

    with pytest.raises(BuildError, match="circle"):
        p.plan()
    with pytest.raises(BuildError, match="not set"):
        Params({"a": {}}).get("a.b")
    assert calibrated(102, 100) == pytest.approx(0.02)
    with pytest.raises(BuildError, match=r"\+5.0%"):
        calibrated(105, 100)


def test_audit_build(spark, sf, tmp_path):
    root = str(tmp_path / "build")
    frame(spark, sf, "trunk").write.parquet(f"{root}/link")
    frame(spark, sf, "nation").select(F.concat(F.lit("N:"), "n_nationkey").alias("node_id"), F.col("n_regionkey").alias("basin")).write.parquet(f"{root}/basin")
    build = Build(spark, root, audit_pipeline())
    assert set(build.status().values()) == {"never ran"}
    assert build.run() == ["load", "census", "crawl", "dead_ends", "basin_reach"] and build.run() == []
    dead = build.table("dead_end").collect()
    assert dead and all(r.stranded_m <= r.upstream_m for r in dead)
    changed = Build(spark, root, audit_pipeline({"audit": {"report_top_n": 3}, "seeds": {}}))
    assert {k for k, v in changed.status().items() if v != "fresh"} == {"dead_ends"} and changed.run() == ["dead_ends"]
    assert changed.table("dead_end").count() == 3


def test_fingerprints_follow_imports():
    from netsounder.build import audit, pipeline

    stage = audit_pipeline().stages["crawl"].run
    reached = pipeline.closure(audit.__name__)
    assert {"netsounder.operators.graph", "netsounder.operators.components", "netsounder.session", "netsounder"} <= set(reached)
    plain = pipeline._code(stage)

    def edited(name):
        found = pipeline._source(name)
        return (found[0] + "\nADDED = 1\n", found[1]) if name == "netsounder.operators.graph" else found

    def reformatted(name):
        found = pipeline._source(name)
        return (found[0].replace("\n\n\n", "\n\n\n# a note\n\n"), found[1]) if found else found

    assert pipeline._code(stage, edited) != plain
    assert pipeline._code(stage, reformatted) == plain


def test_licence_gate(spark):
    sources = spark.createDataFrame([("a", True, True), ("b", True, False)], "source string, open boolean, permitted boolean")
    licence_gate(spark.createDataFrame([("a",)], "source string"), sources)
    with pytest.raises(BuildError, match="b"):
        licence_gate(spark.createDataFrame([("a",), ("b",)], "source string"), sources)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_command_line():
    out = subprocess.run([sys.executable, "-m", "netsounder", "plan"], capture_output=True, text=True, check=True)
    assert out.stdout.split() == ["load", "census", "crawl", "dead_ends", "basin_reach"]
