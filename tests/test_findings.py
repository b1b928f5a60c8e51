"""Cases that a review of round 2 found: ids that meet, short last lines, far sights, and many pairs."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from netsounder.plans import registry
from netsounder.session import TABLES
from tests.test_oracles import plain

SOURCE = "/root/testdata/sf0.001"


@pytest.fixture
def same(spark, tmp_path):
    """Whether a query gives its SQL's rows over the smallest tables with some of them replaced."""

    def check(name: str, **tables) -> list:
        con, folder = duckdb.connect(), str(tmp_path)
        for t in TABLES:
            df = tables.get(t, None)
            at = f"{folder}/{t}.parquet"
            if df is None:
                os.symlink(f"{SOURCE}/{t}.parquet", at)
            else:
                df.coalesce(1).write.parquet(at)
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}{'' if df is None else '/*.parquet'}'")
        got = registry.queries()[name](spark, folder)
        cur = con.execute(registry.oracles()[name])
        columns = [c[0] for c in cur.description]
        want = sorted((tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in cur.fetchall()), key=str)
        have = sorted((tuple(plain(r[c]) for c in sorted(columns)) for r in got.collect()), key=str)
        assert have == want
        return have

    return check


def log(spark, pairs):
    """Events whose steps are ``pairs``: an error of each first user, then a signup of the second with a higher value."""
    rows = [(2 * i + k, user, kind, float(k)) for i, pair in enumerate(pairs) for k, (user, kind) in enumerate(zip(pair, ("error", "signup"), strict=True))]
    e = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double")
    return e.select(F.timestamp_seconds("event_id").alias("ts"), "event_id", "user_id", "event_type", "value", F.lit('{"k": 1}').alias("props"))


def test_chains_of_edges_that_share_an_id(same, spark):
    # 1 * 1000 + 1002 and 2 * 1000 + 2 are one id
    assert len(same("g23_chains", events=log(spark, [(1, 1002), (2, 2), (2, 7), (7, 9)]))) == 3


def test_spanning_forest_of_edges_that_share_an_id(same, spark):
    # the ids 1 * 1000 + 1002 and 2 * 1000 + 2 meet; those from 1000 on pass the weight of a lesser id; 11 apart, both weight and id are one
    rings = [(1, 1002), (2, 2000), (1002, 2000), (2000, 1), (3, 1400), (1400, 5), (5, 3), (12, 1), (1, 11001), (11001, 12), (11001, 1)]
    same("g16_spanning_forest", events=log(spark, rings))


def test_second_reading_of_edges_that_share_an_id(same, spark):
    same("q15_second_reading", events=log(spark, [(1, 1020), (2, 20), (3, 1), (4, 34), (20, 9)]))


def vectors(spark, n):
    """``n`` points of one to five a line, spread without a pattern."""
    at = lambda k: ((F.col("vec_id") * k) % 997 / 997).cast("float")
    return spark.range(n).select(F.col("id").alias("vec_id")).select("vec_id", F.array(at(619), at(389)).alias("embedding"), (F.col("vec_id") % 10).cast("int").alias("label"))


@pytest.mark.parametrize("n", [21, 22, 23, 24])
def test_last_line_of_fewer_points(same, spark, n):
    assert len(same("p7_simplified", embeddings=vectors(spark, n))) == 5


@pytest.mark.parametrize("n", [21, 22, 23, 24])
def test_area_of_a_last_line_that_is_not_closed(same, spark, n):
    assert len(same("p8_gridded_polygons", embeddings=vectors(spark, n))) == (4 if n == 21 else 5)


@pytest.mark.parametrize("n", [201, 203])
def test_a_last_line_of_fewer_points_lies_in_no_water(same, spark, n):
    assert same("q23_water_crossings", embeddings=vectors(spark, n)) is not None


def test_sights_of_any_reach(same, spark):
    # 1,600 cells: 100 rows, heights up to 44, reaches up to 8
    assert len(same("r14_visibility_bands", embeddings=vectors(spark, 1600))) == 1598


@pytest.mark.parametrize("name", ["j10_nearest_line_to_line", "j14_line_crossings", "j18_point_in_polygon", "q23_water_crossings"])
def test_blocks_of_a_crowded_cell(same, spark, name, monkeypatch):
    from netsounder.operators import blocks

    monkeypatch.setattr(blocks, "ROWS", 16)
    assert same(name, embeddings=vectors(spark, 404)) is not None


def test_pairs_of_segments_are_not_shuffled(spark):
    # pairs leave the kernel as results: no list of candidates is sorted out or counted up
    from netsounder.plans.spatial import QUERIES

    for name in ("j14_line_crossings", "j18_point_in_polygon"):
        plan = QUERIES[name](spark, SOURCE)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.startswith("MapInArrow")


def test_names_are_made_plain_once_a_row(spark):
    plan = registry.queries()["f17_name_compatibility"](spark, SOURCE)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join", 1)
    assert "lower(" not in above and "lower(" in below


def test_pairs_of_points_and_waters_are_not_shuffled(spark):
    # only lines that lie wholly in a water leave the kernel: what is joined or counted is not every point in every ring
    plan = registry.queries()["q23_water_crossings"](spark, SOURCE)._jdf.queryExecution().optimizedPlan().toString()
    above, _ = plan.split("MapInArrow", 1)
    assert "Aggregate" in above and "Join" not in above
