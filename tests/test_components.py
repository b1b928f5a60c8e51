"""Components closed in one task and by rounds of stars agree with brute force."""

import random

import pytest

from netsounder.operators import graph as G
from netsounder.operators.components import SMALL, connected_components


def reach(edges, directed):
    nodes = {x for e in edges for x in e}
    out = {n: {n} for n in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            for x, y in ((a, b),) if directed else ((a, b), (b, a)):
                if not out[y] <= out[x]:
                    out[x] |= out[y]
                    moved = True
    return out


@pytest.mark.parametrize("kind", ["long", "string"])
@pytest.mark.parametrize("small", [0, SMALL])
def test_weak(spark, kind, small):
    r = random.Random(3)
    name = (lambda x: f"n{x}") if kind == "string" else (lambda x: x)
    edges = [(name(r.randrange(60)), name(r.randrange(60))) for _ in range(45)]
    df = spark.createDataFrame([*edges, (None, name(1)), (name(2), None)], f"a {kind}, b {kind}")
    got = {x.node: x.component for x in connected_components(df, "a", "b", small=small).collect()}
    want = {n: min(m) for n, m in reach([e for e in edges if e[0] != e[1]], False).items()}
    assert got == want
    assert connected_components(df.limit(0), "a", "b", small=small).count() == 0


@pytest.mark.parametrize("small", [-1, SMALL])
def test_strong(spark, small, monkeypatch):
    monkeypatch.setattr(G, "SMALL", small)
    r = random.Random(4)
    edges = [(r.randrange(25), r.randrange(25)) for _ in range(40)]
    df = spark.createDataFrame(edges, "from_node long, to_node long")
    to = reach(edges, True)
    want = {n: min(m for m in to[n] if n in to[m]) for n in to}
    assert {x.node_id: x.scc for x in G.strong_components(df).collect()} == want


def test_strong_components_of_a_long_ring(spark):
    n = 3_000
    df = spark.createDataFrame([(i, (i + 1) % n) for i in range(n)] + [(0, n), (n, n + 1)], "from_node long, to_node long")
    got = {x.node_id: x.scc for x in G.strong_components(df).collect()}
    assert got == {**{i: 0 for i in range(n)}, n: n, n + 1: n + 1}
