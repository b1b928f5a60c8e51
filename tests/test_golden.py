"""A hand-made network with every pathology, and rasters by hand."""

import heapq

import pytest
from pyspark.sql import functions as F

from netsounder.functions import ids, maths
from netsounder.operators import graph as G
from netsounder.operators import raster as R
from netsounder.operators import relational as X
from netsounder.operators import spatial as S

EDGES = [
    # chain to a sink, a diamond above it, and an edge navigable both ways from the sink
    ("e1", "a", "b", "forward", 1.0), ("e2", "b", "t1", "forward", 2.0), ("e3", "c", "d1", "forward", 3.0), ("e4", "c", "d2", "forward", 4.0),
    ("e5", "d1", "b", "forward", 5.0), ("e6", "d2", "b", "forward", 6.0), ("e7", "t1", "m", "both", 7.0), ("e8", "n", "m", "forward", 8.0),
    # two seeds meet in one wave
    ("f1", "x", "t1", "forward", 1.0), ("f2", "x", "t2", "forward", 1.0), ("f3", "y", "x", "forward", 1.0),
    # a dead end whose water also leaves elsewhere, and a true one
    ("g1", "p", "dead", "forward", 9.0), ("g2", "p", "t2", "forward", 1.0), ("h1", "q", "end", "forward", 2.5), ("h2", "q0", "q", "forward", 1.5),
    # a cycle with no exit, a braid with one, a self-loop
    ("k1", "u", "v", "forward", 1.0), ("k2", "v", "w", "forward", 1.0), ("k3", "w", "u", "forward", 1.0),
    ("l1", "r", "s", "forward", 1.0), ("l2", "s", "r", "forward", 1.0), ("l3", "s", "t2", "forward", 1.0), ("z1", "z", "z", "forward", 1.0),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "edge_id string, from_node string, to_node string, mode string, length_m double")


@pytest.fixture(scope="module")
def seeds(spark):
    return spark.createDataFrame([("t1",), ("t2",)], "node_id string")


def test_crawl(edges, seeds):
    got = {r.edge_id: (r.seed, r.hops) for r in G.crawl(edges, seeds).collect() if r.admitted}
    assert got == {
        "e2": ("t1", 1), "e7": ("t1", 1), "f1": ("t1", 1), "f2": ("t2", 1), "g2": ("t2", 1), "l3": ("t2", 1), "e1": ("t1", 2), "e5": ("t1", 2), "e6": ("t1", 2),
        "e8": ("t1", 2), "f3": ("t1", 2), "l1": ("t2", 2), "e3": ("t1", 3), "e4": ("t1", 3), "l2": ("t2", 3),
    }
    other = {r.edge_id: r.seed for r in G.crawl(edges, seeds, seed_tie="max").collect()}
    assert other["f3"] == "t2" and other["h1"] is None


def test_upstream_and_stranded(spark, edges, seeds):
    starts = spark.createDataFrame([("t1",), ("dead",), ("end",), ("nowhere",)], "node_id string")
    up = {r.node_id: r.upstream_m for r in G.upstream_length(edges, starts).collect()}
    assert up == {"t1": 23.0, "dead": 9.0, "end": 4.0, "nowhere": 0.0}
    reach = edges.join(G.crawl(edges, seeds).select("edge_id", "admitted"), "edge_id")
    dry = {r.node_id: r.upstream_m for r in G.upstream_length(reach.where("not admitted"), starts).collect()}
    assert dry == {"t1": 0.0, "dead": 9.0, "end": 4.0, "nowhere": 0.0}


def test_cycles_and_braids(edges):
    got = {(r.scc, r.n_nodes, r.kind) for r in G.cycles(edges).collect()}
    assert got == {("u", 3, "cycle"), ("r", 2, "cycle"), ("z", 1, "self-loop")}


def test_roles_and_shape(edges):
    roles = {r.node_id: r for r in G.roles(edges).collect()}
    assert [n for n in sorted(roles) if roles[n].sink] == ["dead", "end", "m", "t2"] and roles["p"].bifurcation and not roles["z"].sink
    one = G.shape(edges).first()
    assert one.edges == 22 and one.spare == one.edges - (one.nodes - one.components)


def test_forest_keeps_zero_weights(spark):
    rows = [(1, 1, 2, 0.0), (2, 2, 3, 0.0), (3, 1, 3, 0.0), (4, 3, 4, 2.0), (5, 1, 4, 2.0), (6, 8, 9, 1.0)]
    got = sorted(r.edge_id for r in G.spanning_forest(spark.createDataFrame(rows, "edge_id long, a long, b long, w double")).collect())
    assert got == [1, 2, 4, 6]


def test_shortest(spark, edges):
    got = {r.node_id: (r.dist, r.pred) for r in G.shortest(edges, spark.createDataFrame([("c",)], "node_id string"), 100.0).collect()}
    assert got["b"] == (8.0, "d1") and got["t1"] == (10.0, "b") and got["c"] == (0.0, None) and "a" not in got


def test_pairs_on_cell_borders(spark):
    rows = [(1, 0.0, 0.0), (2, 0.5, 0.0), (3, 1.5, 0.0), (4, -0.5, 0.0), (5, 100.0, 1.0), (6, 100.0, 2.01)]
    got = {(r.a, r.b): r.gap for r in S.near_pairs(spark.createDataFrame(rows, "id long, x double, y double"), 1.0).collect()}
    assert set(got) == {(1, 2), (2, 3), (1, 4), (2, 4)} and got[1, 2] == 0.5


def test_split_and_identifiers(spark):
    df = spark.sql("SELECT array(struct(0D AS x, 0D AS y), struct(3D AS x, 4D AS y), struct(3D AS x, 10D AS y)) AS pts")
    head, tail = S.split(F.col("pts"), F.lit(7.0))
    a, b = df.select(head, tail).first()
    assert [tuple(p) for p in a] == [(0, 0), (3, 4), (3, 6)] and [tuple(p) for p in b] == [(3, 6), (3, 10)]
    assert df.select(*S.split(F.col("pts"), F.lit(0.0))).first()[0] is None and df.select(*S.split(F.col("pts"), F.lit(11.0))).first()[1] is None
    one, two = df.select(ids.line(F.col("pts")), ids.line(F.reverse("pts"))).first()
    assert one == two and one.startswith("ns:link/") and len(one) == 20


def test_positions(spark):
    df = spark.createDataFrame([("50-12-36N",), ("3 30 0 W",), ("no",)], "t string")
    got = [r[0] for r in df.select(maths.degrees_of(F.col("t"))).collect()]
    assert got == [pytest.approx(50.21), pytest.approx(-3.5), None]


def test_guards(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "v double")
    with pytest.raises(Exception, match="not a number"):
        X.without_nan(df).collect()
    with pytest.raises(ValueError):
        X.unchanged_count(df, df.union(df))
    shown = spark.createDataFrame([(1.0,), (0.99999,), (0.5,)], "v double").select(X.floored_share(F.col("v"))).collect()
    assert [r[0] for r in shown] == ["100%", "99.9%", "50.0%"]


def cells(spark, grid):
    return spark.createDataFrame([(r, c, float(z)) for r, row in enumerate(grid) for c, z in enumerate(row)], "r long, c long, z double")


def test_filling_is_the_spill_level(spark):
    grid = [[9, 9, 9, 9, 9], [9, 2, 3, 9, 9], [9, 3, 1, 6, 4], [9, 9, 9, 9, 9], [9, 9, 9, 9, 9]]
    got = {(r.r, r.c): r.z for r in R.filled(cells(spark, grid)).collect()}
    level = {}
    heap = [(grid[r][c], r, c) for r in range(5) for c in range(5) if r in (0, 4) or c in (0, 4)]
    heapq.heapify(heap)
    while heap:
        z, r, c = heapq.heappop(heap)
        if (r, c) in level:
            continue
        level[r, c] = float(z)
        for a, b in R.EIGHT:
            if 0 <= r + a < 5 and 0 <= c + b < 5 and (r + a, c + b) not in level:
                heapq.heappush(heap, (max(z, grid[r + a][c + b]), r + a, c + b))
    assert got == level


def test_allocation_and_backlinks(spark):
    grid = [[1, 1, 1, 50], [50, 50, 1, 50], [1, 1, 1, 1]]
    costs = cells(spark, grid).withColumnRenamed("z", "cost")
    sources = spark.createDataFrame([(0, 0, 7), (2, 0, 8)], "r long, c long, id long")
    got = {(r.r, r.c): (r.dist, r.source) for r in R.allocated(costs, sources).collect()}
    assert got[0, 2] == (2.0, 7) and got[2, 2] == (2.0, 8) and got[0, 0] == (0.0, 7)
    assert [tuple(r) for r in R.crossings(R.allocated(costs, sources), costs).collect()] == [(7, 8, pytest.approx(2 + 2 * 2**0.5, abs=1e-6))]


def test_circle_not_square(spark):
    points = spark.createDataFrame([(1, 0, 0)], "id long, r long, c long")
    corner = spark.createDataFrame([(2, 2)], "r long, c long")
    assert R.snapped(points, corner, 2).first().d2 is None and R.snapped(points, corner, 3).first().d2 == 8


def test_transverse_mercator(spark):
    from netsounder.functions.crs import NATIONAL_GRID, UTM_30N

    # the worked example published with the national grid's formulas
    df = spark.sql("SELECT 52D + 39D / 60 + 27.2531D / 3600 AS lat, 1D + 43D / 60 + 4.5177D / 3600 AS lon")
    e, n = NATIONAL_GRID.forward(F.col("lat"), F.col("lon"))
    got = df.select(e.alias("e"), n.alias("n")).first()
    assert (round(got.e, 3), round(got.n, 3)) == (651409.903, 313177.270)
    back = spark.createDataFrame([(651409.903, 313177.270)], "e double, n double").select(*NATIONAL_GRID.backward(F.col("e"), F.col("n"))).first()
    assert back[0] == pytest.approx(52.65757031, abs=1e-8) and back[1] == pytest.approx(1.71792158, abs=1e-8)
    e, n = UTM_30N.forward(F.lit(54.0), F.lit(-3.0))
    assert spark.range(1).select(e).first()[0] == pytest.approx(500_000)


def test_simplified(spark):
    pts = [(0.0, 0.0), (1.0, 0.1), (2.0, -0.1), (3.0, 5.0), (4.0, 6.0), (5.0, 7.0)]
    df = spark.createDataFrame([(1, pts), (2, pts[:2])], "line_id long, pts array<struct<x: double, y: double>>")
    got = {r.line_id: [tuple(p) for p in r.pts] for r in S.simplified(df, 1.0).collect()}
    assert got == {1: [pts[0], pts[2], pts[3], pts[5]], 2: pts[:2]}


def test_window_paths(spark):
    from netsounder.operators.graph import window_paths

    grid = [[1, 9, 1], [1, 9, 1], [1, 1, 1]]
    rows = [(w, r, c, float(k), (r, c) == (0, 2)) for w in (1, 2) for r, row in enumerate(grid) for c, k in enumerate(row)]
    got = window_paths(spark.createDataFrame(rows, "window long, r long, c long, cost double, goal boolean"), spark.createDataFrame([(1, 0, 0), (2, 2, 2)], "window long, r long, c long")).collect()
    assert {r.window: (round(r.cost, 6), r.path[0], r.path[-1]) for r in got} == {1: (round(2 + 2 * 2**0.5, 6), "0,0", "0,2"), 2: (2.0, "2,2", "0,2")}


def test_touching_squares(spark):
    from netsounder.operators.grids import hex_centre, hex_of, touching

    rows = [(1, 0, 0, 4), (2, 0, 4, 2), (3, 2, 4, 2), (4, 4, 4, 4), (5, 0, 6, 2)]
    got = {tuple(r) for r in touching(spark.createDataFrame(rows, "id long, r int, c int, size int")).collect()}
    assert got == {(1, 2), (1, 3), (2, 3), (2, 5), (3, 4)}
    cells = spark.createDataFrame([(q, s) for q in range(-3, 4) for s in range(-3, 4)], "q long, s long")
    x, y = hex_centre(F.col("q"), F.col("s"), 7.0)
    assert cells.where(hex_of(x, y, 7.0)["q"] != F.col("q")).count() == 0
