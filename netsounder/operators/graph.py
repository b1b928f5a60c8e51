"""Graph operators over ``edges(from_node, to_node, ...)``: degrees, reach, cycles, trees and paths.

Iterative operators keep their state as tables in the shared folder and move
one frontier a round; the driver only learns how many rows a frontier has.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsounder.operators.components import SMALL, connected_components, in_one_task
from netsounder.session import counted, discard, stored, together


def nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("from_node", "to_node")).alias("node_id")).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """``(node_id, n_in, n_out)`` of every node on an edge."""
    ends = edges.select(
        F.explode(F.array(F.struct(F.col("from_node").alias("node_id"), F.lit(1).alias("o")), F.struct(F.col("to_node").alias("node_id"), F.lit(0).alias("o")))).alias("e")
    ).select("e.*")
    return ends.groupBy("node_id").agg((F.count("*") - F.sum("o")).alias("n_in"), F.sum("o").alias("n_out"))


def roles(edges: DataFrame) -> DataFrame:
    """Degrees with ``sink``, ``headwater``, ``bifurcation`` and ``one_in_two_out``."""
    i, o = F.col("n_in"), F.col("n_out")
    return degrees(edges).withColumns(
        {"sink": (i > 0) & (o == 0), "headwater": (o > 0) & (i == 0), "bifurcation": o > 1, "one_in_two_out": (i == 1) & (o >= 2)}
    )


def weak_components(edges: DataFrame) -> DataFrame:
    """``(node_id, component)``; an isolated self-loop is its own component."""
    found = connected_components(edges, "from_node", "to_node", small=SMALL)
    return nodes_of(edges).join(found.withColumnRenamed("node", "node_id"), "node_id", "left").select("node_id", F.coalesce("component", "node_id").alias("component"))


#: Waves of a crawl that are kept apart before they become one table.
WAVES = 64


def crawl(edges: DataFrame, seeds: DataFrame, seed_tie: str = "min", max_rounds: int = 100_000, columns: tuple[str, ...] = ()) -> DataFrame:
    """``(edge_id, admitted, seed, hops)`` and ``columns``: which edges drain to a seed, wave by wave.

    An edge is admitted when its downstream node is in the network; an edge of mode
    ``both`` also when its upstream node is. ``hops`` is the wave, counted from 1. A node that
    two seeds reach in one wave takes the least seed (``seed_tie="max"``: the greatest).

    A wave labels nodes, and only those that something flows into; it is written once, and the next
    looks it up beside the waves before it. The edges read the labels at the end.
    """
    pick, least = (F.min, F.least) if seed_tie == "min" else (F.max, F.greatest)
    kept = edges if hasattr(edges, "_netsounder_path") else stored(edges.select(*dict.fromkeys(["edge_id", "from_node", "to_node", "mode", *columns])), "edges")
    all_ = kept.withColumn("both", F.coalesce(F.col("mode") == "both", F.lit(False)))
    ways = all_.select(F.col("to_node").alias("at"), F.col("from_node").alias("next"))
    ways = ways.unionByName(all_.where("both").select(F.col("from_node").alias("at"), F.col("to_node").alias("next")))
    entered = ways.select(F.col("at").alias("next")).distinct()
    moves = stored(ways.where("at <> next").join(entered, "next", "left_semi"), "moves")
    wave = seeds.select(F.col("node_id").alias("at"), F.col("node_id").alias("seed")).distinct()
    wave, n = counted(wave.withColumn("hops", F.lit(1)), "wave")
    waves = [wave]
    while n:
        if len(waves) > max_rounds:
            raise RuntimeError("the crawl did not end")
        met = wave.join(moves, "at").groupBy(F.col("next").alias("at")).agg(pick("seed").alias("seed"), (F.max("hops") + 1).alias("hops"))
        wave, n = counted(met.join(together(waves).select("at"), "at", "left_anti"), "wave")
        waves.append(wave)
        if len(waves) % WAVES == 0:
            folded = stored(together(waves), "waves")
            for w in waves[:-1]:
                discard(w)
            waves = [folded]
    discard(moves)
    labels = together(waves).select("at", "seed", "hops")
    below = labels.withColumnRenamed("at", "to_node")
    above = labels.toDF("from_node", "seed_", "hops_")
    plain = all_.where("not both").join(below, "to_node", "left").select("edge_id", "seed", "hops", *columns)
    seed = F.when(F.coalesce(F.col("hops") < F.col("hops_"), F.col("hops_").isNull()), F.col("seed"))
    seed = seed.when(F.coalesce(F.col("hops") > F.col("hops_"), F.col("hops").isNull()), F.col("seed_")).otherwise(least("seed", "seed_"))
    twice = all_.where("both").join(below, "to_node", "left").join(above, "from_node", "left")
    out = plain.unionByName(twice.select("edge_id", seed.alias("seed"), F.least("hops", "hops_").alias("hops"), *columns))
    return out.select("edge_id", F.col("hops").isNotNull().alias("admitted"), "seed", "hops", *columns)


def _drained(inner: DataFrame, own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(node, to)``: where the one way down from a node leads to, a start or a node with no or several ways; and the nodes that go round in a circle."""
    one = inner.groupBy(F.col("from_node").alias("node")).agg(F.count("*").alias("n"), F.min("to_node").alias("to")).where("n = 1")
    one = one.join(own.withColumnRenamed("start", "node"), "node", "left_anti")
    at, total = counted(one.select("node", "to", F.lit(True).alias("moved")), "doubling")
    for _ in range(total.bit_length() + 1):
        far = at.select(F.col("node").alias("to"), F.col("to").alias("next"))
        nxt = stored(at.join(far, "to", "left").select("node", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "doubling")
        discard(at)
        at = nxt
        if at.where("moved").isEmpty():
            break
    return at.where("not moved").select("node", "to"), at.where("moved").select("node")


def upstream_length(edges: DataFrame, starts: DataFrame, max_rounds: int = 100_000) -> DataFrame:
    """``(node_id, upstream_m, n_edges)``: length of the distinct edges above each start; edges of mode ``both`` are left out.

    Lengths are summed at the node they flow into, and move from there to the next start, bifurcation or
    end of the water, by pointer doubling over nodes with one way down; only these few nodes are then
    walked for each start. Edges from nodes that nothing flows into take part in the first sum alone.
    To measure stranded length, give only the edges that nothing reaches.
    """
    plain = edges.where("mode <> 'both'").select("from_node", "to_node", "length_m")
    own = stored(starts.select(F.col("node_id").alias("start")).distinct(), "starts")
    below = stored(plain.groupBy(F.col("to_node").alias("node")).agg(F.sum("length_m").alias("m"), F.count("*").alias("n")), "below")
    inner = stored(plain.select("from_node", "to_node").join(below.select(F.col("node").alias("from_node")), "from_node", "left_semi"), "inner")
    down, circling = _drained(inner, own)
    root = F.coalesce("to", "node").alias("root")
    held = below.join(circling, "node", "left_anti").join(down, "node", "left").groupBy(root).agg(F.sum("m").alias("m"), F.sum("n").alias("n"))
    held = stored(held, "held")
    fork = inner.join(held.select(F.col("root").alias("from_node")), "from_node", "left_semi").withColumnRenamed("to_node", "node")
    links = fork.join(circling, "node", "left_anti").join(down, "node", "left").select("from_node", root).where("from_node <> root")
    links = stored(links.distinct(), "links")
    front, n = counted(own.select("start", F.col("start").alias("root")), "front")
    seen = [front]
    while n:
        if len(seen) > max_rounds:
            raise RuntimeError("the walk did not end")
        nxt = front.join(links, "root").select("start", F.col("from_node").alias("root")).distinct()
        front, n = counted(nxt.join(together(seen), ["start", "root"], "left_anti"), "front")
        seen.append(front)
        if len(seen) % WAVES == 0:
            folded = stored(together(seen), "seen")
            for w in seen[:-1]:
                discard(w)
            seen = [folded]
    sums = together(seen).join(held, "root").groupBy("start").agg(F.sum("m").alias("m"), F.sum("n").alias("n"))
    total = own.join(sums, "start", "left")
    return total.select(F.col("start").alias("node_id"), F.coalesce("m", F.lit(0.0)).alias("upstream_m"), F.coalesce("n", F.lit(0)).alias("n_edges"))


def _spread(labels: DataFrame, edges: DataFrame, max_rounds: int = 100_000) -> DataFrame:
    """Least label reaching each node along edges ``(u, v)``; ``labels(node, label)``."""
    state = kept = stored(labels, "labels")
    changed = state
    for _ in range(max_rounds):
        sent = changed.join(edges, changed.node == edges.u).groupBy(F.col("v").alias("node")).agg(F.min("label").alias("got"))
        nxt = stored(
            state.join(sent, "node", "left").select("node", F.least("label", "got").alias("label"), F.coalesce(F.col("got") < F.col("label"), F.lit(False)).alias("moved")), "labels"
        )
        discard(kept)
        kept = nxt
        changed = nxt.where("moved").select("node", "label")
        state = nxt.select("node", "label")
        if changed.isEmpty():
            return state
    raise RuntimeError("labels did not settle")


def _strong_labels(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The least member of each node's strong component (Tarjan's walk, with its own stack)."""
    order = np.argsort(u, kind="stable")
    to, first = v[order].tolist(), np.searchsorted(u[order], np.arange(n + 1)).tolist()
    seen, low, held, label = [-1] * n, [0] * n, [False] * n, [0] * n
    path: list[int] = []
    clock = 0
    for root in range(n):
        if seen[root] >= 0:
            continue
        walk = [(root, first[root])]
        while walk:
            node, at = walk.pop()
            if at == first[node]:
                seen[node] = low[node] = clock
                clock += 1
                path.append(node)
                held[node] = True
            elif held[to[at - 1]]:
                low[node] = min(low[node], low[to[at - 1]])
            while at < first[node + 1] and seen[to[at]] >= 0:
                if held[to[at]]:
                    low[node] = min(low[node], seen[to[at]])
                at += 1
            if at < first[node + 1]:
                walk += [(node, at + 1), (to[at], first[to[at]])]
            elif low[node] == seen[node]:
                cut = len(path) - 1
                while path[cut] != node:
                    cut -= 1
                least = min(path[cut:])
                for x in path[cut:]:
                    held[x], label[x] = False, least
                del path[cut:]
    return np.array(label, np.int64)


def strong_components(edges: DataFrame, max_rounds: int = 1_000) -> DataFrame:
    """``(node_id, scc)``, named by the least member.

    Rounds of colouring: nodes without an edge in or out are alone and go; of the rest each takes the least
    node that reaches it, and those of a colour that also reach its namesake are one component. Up to ``SMALL``
    edges are closed in one task.
    """
    left, n = counted(edges.select(F.col("from_node").alias("u"), F.col("to_node").alias("v")).distinct().where("u <> v"), "left")
    if n <= SMALL:
        found = in_one_task(left, _strong_labels, ("node_id", "scc"))
        return nodes_of(edges).join(found, "node_id", "left").select("node_id", F.coalesce("scc", "node_id").alias("scc"))
    todo = stored(nodes_of(edges).withColumnRenamed("node_id", "node"), "todo")
    done = None
    for _ in range(max_rounds):
        live = left.select(F.col("u").alias("node")).intersect(left.select(F.col("v").alias("node")))
        alone = stored(todo.join(live, "node", "left_anti").select(F.col("node").alias("node_id"), F.col("node").alias("scc")), "alone")
        if alone.isEmpty():
            colour = _spread(todo.select("node", F.col("node").alias("label")), left)
            same = left.join(colour.select(F.col("node").alias("u"), F.col("label").alias("cu")), "u").join(colour.select(F.col("node").alias("v"), F.col("label").alias("cv")), "v")
            inner = stored(same.where("cu = cv").select(F.col("v").alias("u"), F.col("u").alias("v")), "inner")
            # a node that is not its colour's namesake starts above every label of that colour
            start = colour.select("node", F.when(F.col("node") == F.col("label"), F.lit(0)).otherwise(F.lit(1)).alias("label"))
            back = _spread(start, inner)
            alone = stored(back.where("label = 0").join(colour.select("node", F.col("label").alias("scc")), "node").select(F.col("node").alias("node_id"), "scc"), "alone")
        done = alone if done is None else done.unionByName(alone)
        todo = stored(todo.join(alone.select(F.col("node_id").alias("node")), "node", "left_anti"), "todo")
        if todo.isEmpty():
            return done
        gone = alone.select("node_id")
        left = stored(left.join(gone.withColumnRenamed("node_id", "u"), "u", "left_anti").join(gone.withColumnRenamed("node_id", "v"), "v", "left_anti").select("u", "v"), "left")
    raise RuntimeError("strong components did not settle")


def cycles(edges: DataFrame) -> DataFrame:
    """``(scc, n_nodes, kind)``: components of more than one node, and each self-loop by itself."""
    big = strong_components(edges).groupBy("scc").agg(F.count("*").alias("n_nodes")).where("n_nodes > 1").withColumn("kind", F.lit("cycle"))
    loops = edges.where("from_node = to_node").select(F.col("from_node").alias("scc")).distinct()
    return big.unionByName(loops.select("scc", F.lit(1).cast("long").alias("n_nodes"), F.lit("self-loop").alias("kind")))


def spanning_forest(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(edge_id, a, b, w)`` of the least spanning forest, weights tied by id; zero weights stay (Borůvka's rounds)."""
    all_ = stored(edges.select("edge_id", "a", "b", "w"), "edges")
    label = stored(all_.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("part")), "parts")
    kept = None
    for _ in range(max_rounds):
        la = label.select(F.col("node").alias("a"), F.col("part").alias("pa"))
        lb = label.select(F.col("node").alias("b"), F.col("part").alias("pb"))
        between = all_.join(la, "a").join(lb, "b").where("pa <> pb")
        sides = between.select(F.explode(F.array("pa", "pb")).alias("part"), F.struct("w", "edge_id").alias("k"), "a", "b", "pa", "pb")
        best = stored(sides.groupBy("part").agg(F.min_by(F.struct("k.edge_id", "a", "b", "k.w", "pa", "pb"), "k").alias("m")).select("m.*").distinct(), "best")
        if best.isEmpty():
            return kept if kept is not None else all_.limit(0)
        chosen = best.select("edge_id", "a", "b", "w")
        kept = chosen if kept is None else kept.unionByName(chosen)
        merged = connected_components(best, "pa", "pb", small=SMALL).withColumnRenamed("node", "part")
        moved = stored(label.join(merged, "part", "left").select("node", F.coalesce("component", "part").alias("part")), "parts")
        discard(label)
        label = moved
    raise RuntimeError("the forest did not settle")


def unbridged(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(edge_id, a, b, w)`` of the edges whose ends no path of lesser weights joins: every edge of every least spanning forest.

    Borůvka's rounds: until the parts at an edge's ends become one, the edge remembers the greatest weight that they
    merged by, which in the end is the greatest on the forest's path between them. Rows may share an id; loops are none of it.
    """
    left = stored(edges.where("a <> b").select("edge_id", "a", "b", "w", F.col("a").alias("pa"), F.col("b").alias("pb"), F.lit(None).cast(edges.schema["w"].dataType).alias("seen")), "edges")
    kept = left.select("edge_id", "a", "b", "w").limit(0)
    for _ in range(max_rounds):
        if left.isEmpty():
            return kept
        # equal weights fall to the lesser pair of parts, so that no circle of parts picks one another
        pair = F.struct("w", F.least("pa", "pb").alias("p"), F.greatest("pa", "pb").alias("q"))
        sides = left.select(F.explode(F.array("pa", "pb")).alias("part"), pair.alias("k"))
        best = stored(sides.groupBy("part").agg(F.min("k").alias("k")).select("part", "k.*"), "best")
        merged = connected_components(best, "p", "q", small=SMALL).withColumnRenamed("node", "part")
        moved = stored(best.join(merged, "part").select("part", F.col("w").alias("by"), F.col("component").alias("to")), "parts")
        at = lambda n: moved.select(F.col("part").alias(f"p{n}"), F.col("by").alias(f"by{n}"), F.col("to").alias(f"to{n}"))
        met = left.join(at("a"), "pa").join(at("b"), "pb").withColumn("seen", F.greatest("seen", "bya", "byb"))
        met = stored(met.select("edge_id", "a", "b", "w", F.col("toa").alias("pa"), F.col("tob").alias("pb"), "seen"), "edges")
        kept = kept.unionByName(met.where("pa = pb and w <= seen").select("edge_id", "a", "b", "w"))
        left = met.where("pa <> pb")
    raise RuntimeError("the forest did not settle")


def shortest(edges: DataFrame, sources: DataFrame, limit: float, max_rounds: int = 100_000) -> DataFrame:
    """``(node_id, dist, pred)``: least distance from any source along directed edges, up to ``limit``."""
    all_ = stored(edges.select("from_node", "to_node", "length_m"), "edges")
    best = stored(sources.select("node_id", F.lit(0.0).alias("dist"), F.lit(None).cast("string").alias("pred")).distinct(), "best")
    front = best
    for _ in range(max_rounds):
        cand = front.join(all_, F.col("node_id") == F.col("from_node")).select(
            F.col("to_node").alias("node_id"), (F.col("dist") + F.col("length_m")).alias("dist"), F.col("from_node").cast("string").alias("pred")
        )
        cand = cand.where(F.col("dist") <= limit).groupBy("node_id").agg(F.min(F.struct("dist", "pred")).alias("m")).select("node_id", "m.*")
        old = best.select("node_id", F.col("dist").alias("od"))
        front = stored(cand.join(old, "node_id", "left").where("od is null or dist < od").drop("od"), "front")
        if front.isEmpty():
            return best
        grown = stored(best.join(front.select("node_id"), "node_id", "left_anti").unionByName(front), "best")
        discard(best)
        best = grown
    raise RuntimeError("distances did not settle")


def shape(edges: DataFrame) -> DataFrame:
    """One row: edges, nodes, components, and ``spare`` = edges - (nodes - components), 0 for a forest."""
    comp = weak_components(edges).agg(F.count("*").alias("nodes"), F.countDistinct("component").alias("components"))
    return edges.agg(F.count("*").alias("edges")).join(F.broadcast(comp)).withColumn("spare", F.col("edges") - (F.col("nodes") - F.col("components")))


def clustered(points: DataFrame, radius: float) -> DataFrame:
    """``(id, cluster)``: single-linkage clusters of points within ``radius``, named by the least id."""
    from netsounder.operators.spatial import near_pairs

    found = connected_components(near_pairs(points, radius), "a", "b", small=SMALL)
    return points.select("id").join(found.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("cluster"))


def chains(edges: DataFrame) -> DataFrame:
    """``(edge_id, chain)``: undirected edges grouped between nodes that are not of degree two, named by the least edge.

    Edges that share an id are parts of one: it has one row.
    """
    e = stored(edges.select("edge_id", "from_node", "to_node"), "edges")
    ends = e.select("edge_id", F.explode(F.array("from_node", "to_node")).alias("node"))
    through = ends.groupBy("node").agg(F.count("*").alias("n"), F.min("edge_id").alias("a"), F.max("edge_id").alias("b")).where("n = 2 and a <> b")
    found = connected_components(through, "a", "b", small=SMALL).withColumnRenamed("node", "edge_id")
    return e.select("edge_id").distinct().join(found, "edge_id", "left").select("edge_id", F.coalesce("component", "edge_id").alias("chain"))


def routing_edges(links: DataFrame, repairs: DataFrame, retired: DataFrame, merged: DataFrame, reversed_: DataFrame, modes: DataFrame, excluded: DataFrame) -> DataFrame:
    """The one routing graph from survey links, repairs and judgements.

    Retired and excluded links go, merged nodes are replaced at both ends, links whose own or
    parent key is reversed swap ends, and modes given override the default.
    """
    cols = ["link_id", "parent_id", "from_node", "to_node", "length_m", "form", "origin"]
    every = links.select(*cols).unionByName(repairs.select(*cols))
    every = every.join(retired.select("link_id"), "link_id", "left_anti").join(excluded.select("link_id"), "link_id", "left_anti")
    for end in ("from_node", "to_node"):
        m = merged.select(F.col("node_id").alias(end), F.col("merged").alias("_m"))
        every = every.join(m, end, "left").withColumn(end, F.coalesce("_m", end)).drop("_m")
    flip = reversed_.select(F.col("link_id").alias("_key"), F.lit(True).alias("_flip")).distinct()
    every = every.withColumn("_key", F.coalesce("parent_id", "link_id")).join(flip, "_key", "left").drop("_key")
    every = every.join(modes.select("link_id", F.col("mode").alias("_mode")), "link_id", "left")
    swap = F.coalesce("_flip", F.lit(False))
    return every.select(
        F.concat(F.lit("e:"), F.col("link_id")).alias("edge_id"), "link_id",
        F.when(swap, F.col("to_node")).otherwise(F.col("from_node")).alias("from_node"),
        F.when(swap, F.col("from_node")).otherwise(F.col("to_node")).alias("to_node"),
        F.coalesce("_mode", F.lit("forward")).alias("mode"), "length_m", "form", "origin", swap.alias("reversed"),
    )


def sea_edges(routes: DataFrame, entries: DataFrame, most_coast: float = 100.0) -> DataFrame:
    """Edges of mode ``both`` between entries: the river's own mouth where it may stand for one, else a node at sea.

    ``routes(a, b, length_m)``; ``entries(entry, node_id, kind, coast_m)`` is folded to one row an entry first,
    so that several mouths of one entry make no further edges.
    """
    near = (F.col("kind") == "terminus") | (F.col("coast_m") <= most_coast)
    one = entries.groupBy("entry").agg(F.min(F.when(near, F.col("node_id"))).alias("mouth"))
    end = lambda c: F.coalesce(F.col(f"m{c}"), F.concat(F.lit("sea-node/"), F.col(c).cast("string")))
    out = routes
    for c in ("a", "b"):
        out = out.join(one.select(F.col("entry").alias(c), F.col("mouth").alias(f"m{c}")), c, "left")
    return out.select(F.concat_ws("-", F.lit("sea"), "a", "b").alias("edge_id"), end("a").alias("from_node"), end("b").alias("to_node"), F.lit("both").alias("mode"), "length_m", F.lit("sea").alias("form"))


def window_paths(cells: DataFrame, starts: DataFrame) -> DataFrame:
    """``(window, cost, path)``: the cheapest walk from each window's start to any of its goals.

    ``cells(window, r, c, cost, goal)`` and ``starts(window, r, c)``; a window is small by construction and one task
    walks it with a heap over 8 neighbours, a move costing the mean of its cells times its length.
    """
    import heapq

    import pandas as pd

    def walk(key: tuple, own: pd.DataFrame, at: pd.DataFrame) -> pd.DataFrame:
        if own.empty or at.empty:
            return pd.DataFrame([], columns=["window", "cost", "path"])
        cost = dict(zip(zip(own["r"], own["c"], strict=True), own["cost"], strict=True))
        goals = set(map(tuple, own.loc[own["goal"], ["r", "c"]].to_numpy().tolist()))
        heap = [(0.0, (int(r), int(c)), None) for r, c in zip(at["r"], at["c"], strict=True) if (r, c) in cost]
        came: dict = {}
        while heap:
            d, cell, before = heapq.heappop(heap)
            if cell in came:
                continue
            came[cell] = before
            if cell in goals:
                path = [cell]
                while came[path[-1]] is not None:
                    path.append(came[path[-1]])
                return pd.DataFrame([(key[0], round(d, 9), [f"{r},{c}" for r, c in reversed(path)])], columns=["window", "cost", "path"])
            for dr in (-1, 0, 1):
                for dc in (-1, 0, 1):
                    to = (cell[0] + dr, cell[1] + dc)
                    if to in cost and to not in came:
                        heapq.heappush(heap, (d + (cost[cell] + cost[to]) / 2 * (dr * dr + dc * dc) ** 0.5, to, cell))
        return pd.DataFrame([], columns=["window", "cost", "path"])

    found = cells.groupBy("window").cogroup(starts.groupBy("window")).applyInPandas(walk, "window long, cost double, path array<string>")
    return stored(found, "paths")
