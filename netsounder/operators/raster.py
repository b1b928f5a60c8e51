"""Rasters as tables of cells ``(r, c, value)``: sampling, labelling, cost, distance and drainage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsounder.operators.components import SMALL, connected_components
from netsounder.session import discard, stored

EIGHT = [(dr, dc) for dr in (-1, 0, 1) for dc in (-1, 0, 1) if (dr, dc) != (0, 0)]
FOUR = [(-1, 0), (0, -1), (0, 1), (1, 0)]


def reduced(cells: DataFrame, k: int, **aggs: Column) -> DataFrame:
    """Blocks of ``k`` by ``k`` cells folded into one by the given aggregates."""
    block = lambda c: F.floor(F.col(c) / k).alias(c)
    return cells.groupBy(block("r"), block("c")).agg(*[a.alias(n) for n, a in aggs.items()])


def sampled(points: DataFrame, cells: DataFrame, value: str, left: float, top: float, size: float) -> DataFrame:
    """``points(id, x, y)`` with the value of the cell they fall in, null off the grid."""
    at = points.withColumns({"r": F.floor((F.lit(top) - F.col("y")) / size), "c": F.floor((F.col("x") - left) / size)})
    return at.join(cells.select("r", "c", value), ["r", "c"], "left").drop("r", "c")


def shifted(cells: DataFrame, offsets: list[tuple[int, int]], **names: str) -> DataFrame:
    """Each cell sent to its neighbours: ``(r, c)`` of the receiver, ``(fr, fc)`` of the sender, renamed values."""
    steps = F.explode(F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in offsets])).alias("s")
    kept = [F.col(k).alias(v) for k, v in names.items()]
    sent = cells.select("r", "c", *kept, steps)
    return sent.select(
        (F.col("r") + F.col("s.dr")).alias("r"), (F.col("c") + F.col("s.dc")).alias("c"), F.col("r").alias("fr"), F.col("c").alias("fc"), *names.values(),
        F.when((F.col("s.dr") != 0) & (F.col("s.dc") != 0), F.sqrt(F.lit(2.0))).otherwise(1.0).alias("step"),
    )


def _key(r: str, c: str) -> Column:
    return F.shiftleft(F.col(r).cast("long"), 32) + F.col(c).cast("long")


def regions(cells: DataFrame, offsets: list[tuple[int, int]] = FOUR) -> DataFrame:
    """``(r, c, region)``: connected cells share the least key of a cell of theirs."""
    near = shifted(cells.select("r", "c"), offsets).join(cells.select("r", "c"), ["r", "c"])
    pairs = near.select(_key("r", "c").alias("a"), _key("fr", "fc").alias("b"))
    found = connected_components(pairs, "a", "b", small=SMALL)
    own = cells.select("r", "c", _key("r", "c").alias("node"))
    return own.join(found, "node", "left").select("r", "c", F.coalesce("component", "node").alias("region"))


def dilated(cells: DataFrame, radius: int) -> DataFrame:
    """Cells within ``radius`` rows and columns of a cell."""
    offsets = [(a, b) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1)]
    return shifted(cells.select("r", "c"), offsets).select("r", "c").distinct()


def snapped(points: DataFrame, cells: DataFrame, radius: int) -> DataFrame:
    """``(id, r, c, d2)``: the nearest cell within a circle, ties by row and column; null if none."""
    offsets = [(a, b) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1) if a * a + b * b <= radius * radius]
    want = shifted(points.select("id", "r", "c"), offsets, id="id").join(cells.select("r", "c"), ["r", "c"])
    d2 = (F.col("r") - F.col("fr")) ** 2 + (F.col("c") - F.col("fc")) ** 2
    best = want.groupBy("id").agg(F.min(F.struct(d2.cast("long").alias("d2"), "r", "c")).alias("m"))
    return points.select("id").join(best, "id", "left").select("id", "m.r", "m.c", "m.d2")


def sea_cost(depth: Column, clear: float = 2.0, deep: float = 50.0) -> Column:
    """Cost of a cell: 1 in deep water, rising as depth falls to the clearance."""
    ratio = F.lit(deep) / F.greatest(depth, F.lit(clear))
    return F.least(F.greatest(ratio, F.lit(1.0)), F.lit(deep / clear))


def distance_transform(cells: DataFrame, targets: DataFrame, bound: int) -> DataFrame:
    """``(r, c, d2)``: squared distance to the nearest target cell, exact up to ``bound`` cells, null beyond."""
    points = cells.select(_key("r", "c").alias("id"), "r", "c")
    near = snapped(points, targets, bound).select("id", "d2")
    return points.join(near, "id").select("r", "c", "d2")


def allocated(costs: DataFrame, sources: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """``(r, c, dist, source, br, bc)``: least accumulated cost from a source, that source, and the cell it came by.

    A move costs the mean of the two cells times its length, to 8 neighbours. Rounds relax
    the cells whose distance fell until none does; ties go to the least source, then cell.
    """
    best = stored(
        sources.join(costs, ["r", "c"]).select("r", "c", F.lit(0.0).alias("dist"), F.col("id").alias("source"), F.lit(None).cast("long").alias("br"), F.lit(None).cast("long").alias("bc")),
        "best",
    )
    front = best
    order = F.struct("dist", "source", "br", "bc")
    for _ in range(max_rounds):
        sent = shifted(front.join(costs, ["r", "c"]), EIGHT, dist="d0", source="source", cost="k0").join(costs, ["r", "c"])
        cand = sent.select(
            "r", "c", F.round(F.col("d0") + F.col("step") * (F.col("k0") + F.col("cost")) / 2, 9).alias("dist"), "source",
            F.col("fr").cast("long").alias("br"), F.col("fc").cast("long").alias("bc"),
        )
        cand = cand.groupBy("r", "c").agg(F.min(order).alias("m")).select("r", "c", "m.*")
        old = best.select("r", "c", F.col("dist").alias("od"), F.col("source").alias("os"))
        fell = stored(
            cand.join(old, ["r", "c"], "left").where("od is null or dist < od or (dist = od and source < os)").drop("od", "os"), "front"
        )
        if fell.isEmpty():
            return best
        grown = stored(best.join(fell.select("r", "c"), ["r", "c"], "left_anti").unionByName(fell), "best")
        discard(best)
        best, front = grown, fell
    raise RuntimeError("cost distance did not settle")


def crossings(allocation: DataFrame, costs: DataFrame) -> DataFrame:
    """``(a, b, cost)``: the cheapest crossing between territories that touch."""
    a = allocation.join(costs, ["r", "c"])
    half = [(0, 1), (1, -1), (1, 0), (1, 1)]
    met = shifted(a, half, dist="d0", source="s0", cost="k0").join(a, ["r", "c"]).where("s0 <> source")
    total = F.round(F.col("d0") + F.col("dist") + F.col("step") * (F.col("k0") + F.col("cost")) / 2, 9)
    return met.groupBy(F.least("s0", "source").alias("a"), F.greatest("s0", "source").alias("b")).agg(F.min(total).alias("cost"))


def filled(cells: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """``(r, c, z)`` with pits raised to their spill level; cells with fewer than 8 neighbours are outlets.

    Starts from the flood of everything and lowers each cell to the larger of its own height and its lowest
    neighbour until nothing falls.
    """
    base = stored(cells.select("r", "c", F.col("z").cast("double").alias("z")), "base")
    degree = shifted(base, EIGHT, z="w").join(base.select("r", "c"), ["r", "c"]).groupBy("r", "c").count()
    level = stored(
        base.join(degree, ["r", "c"], "left").select("r", "c", "z", F.when(F.coalesce("count", F.lit(0)) < 8, F.col("z")).otherwise(float("inf")).alias("w")),
        "level",
    )
    for _ in range(max_rounds):
        low = shifted(level.select("r", "c", "w"), EIGHT, w="n").groupBy("r", "c").agg(F.min("n").alias("n"))
        nxt = level.join(low, ["r", "c"], "left").select("r", "c", "z", F.least("w", F.greatest("z", F.coalesce("n", "w"))).alias("w"), (F.greatest("z", F.coalesce("n", "w")) < F.col("w")).alias("fell"))
        nxt = stored(nxt, "level")
        discard(level)
        level = nxt.drop("fell")
        level._netsounder_path = nxt._netsounder_path
        if nxt.where("fell").isEmpty():
            return level.select("r", "c", F.col("w").alias("z"))
    raise RuntimeError("filling did not settle")


def steepest(cells: DataFrame) -> DataFrame:
    """``(r, c, tr, tc, drop)``: the neighbour of steepest descent; null targets where no neighbour is lower."""
    n = shifted(cells, EIGHT, z="nz").join(cells, ["r", "c"])
    # here (r, c) receives the value of (fr, fc): the neighbour it may drain to
    drop = F.round((F.col("z") - F.col("nz")) / F.col("step"), 9)
    best = n.withColumn("drop", drop).where("drop > 0").groupBy("r", "c").agg(F.min(F.struct((-F.col("drop")).alias("d"), "fr", "fc")).alias("m"))
    return cells.select("r", "c").join(best, ["r", "c"], "left").select("r", "c", F.col("m.fr").alias("tr"), F.col("m.fc").alias("tc"), (-F.col("m.d")).alias("drop"))


def accumulated(pointers: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """``(r, c, cells)``: how many cells drain through each, itself included."""
    ptr = stored(pointers.select("r", "c", "tr", "tc"), "pointers")
    wave = stored(ptr.select("r", "c", F.lit(1).cast("long").alias("n")), "wave")
    total = wave
    for _ in range(max_rounds):
        moved = wave.join(ptr, ["r", "c"]).where("tr is not null").groupBy(F.col("tr").alias("r"), F.col("tc").alias("c")).agg(F.sum("n").alias("n"))
        wave = stored(moved, "wave")
        if wave.isEmpty():
            return total.groupBy("r", "c").agg(F.sum("n").alias("cells"))
        total = stored(total.unionByName(wave).groupBy("r", "c").agg(F.sum("n").alias("n")), "total")
    raise RuntimeError("the pointers have a loop")


def watersheds(pointers: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``(r, c, basin)``: the key of the cell that everything from here drains to, by pointer doubling."""
    at = stored(
        pointers.select(_key("r", "c").alias("node"), F.coalesce(_key("tr", "tc"), _key("r", "c")).alias("to")), "doubling"
    )
    for _ in range(max_rounds):
        far = at.select(F.col("node").alias("to"), F.col("to").alias("next"))
        nxt = stored(at.join(far, "to").select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")), "doubling")
        discard(at)
        at = nxt
        if at.where("moved").isEmpty():
            return at.select(F.shiftright("node", 32).alias("r"), (F.col("node") - F.shiftleft(F.shiftright("node", 32), 32)).alias("c"), F.col("to").alias("basin"))
    raise RuntimeError("the pointers have a loop")


def burned(cells: DataFrame, streams: DataFrame, depth: float) -> DataFrame:
    """The surface lowered by ``depth`` along ``streams(r, c)``."""
    mark = streams.select("r", "c").distinct().withColumn("_s", F.lit(depth))
    return cells.join(mark, ["r", "c"], "left").select("r", "c", (F.col("z") - F.coalesce("_s", F.lit(0.0))).alias("z"))


def no_flow(cells: DataFrame) -> DataFrame:
    """Cells with all eight neighbours of which none is lower: water stays there."""
    around = shifted(cells, EIGHT, z="n").groupBy("r", "c").agg(F.count("*").alias("k"), F.min("n").alias("low"))
    return cells.join(around, ["r", "c"]).where("k = 8 and low >= z").select("r", "c", "z")


def pour_points(points: DataFrame, accumulation: DataFrame, radius: int) -> DataFrame:
    """``(r, c, pr, pc, cells)``: each point moved to the cell within ``radius`` rows and columns that most drains through, ties by place."""
    offsets = [(a, b) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1)]
    near = shifted(points.select("r", "c"), offsets).join(accumulation, ["r", "c"])
    best = near.groupBy("fr", "fc").agg(F.min(F.struct((-F.col("cells")).alias("most"), "r", "c")).alias("m"))
    return best.select(F.col("fr").alias("r"), F.col("fc").alias("c"), F.col("m.r").alias("pr"), F.col("m.c").alias("pc"), (-F.col("m.most")).alias("cells"))


def grooves(cells: DataFrame, reach: int) -> DataFrame:
    """Cells that are the least of their row or column within ``reach`` and have a higher cell on both sides of it."""
    from pyspark.sql import Window

    out = None
    for along, across in (("r", "c"), ("c", "r")):
        w = Window.partitionBy(along).orderBy(across)
        behind, ahead = w.rowsBetween(-reach, -1), w.rowsBetween(1, reach)
        z = cells.select("r", "c", "z", F.max("z").over(behind).alias("b"), F.max("z").over(ahead).alias("a"), F.min("z").over(behind).alias("lb"), F.min("z").over(ahead).alias("la"))
        hit = z.where("b > z and a > z and lb > z and la > z").select("r", "c", F.lit(across).alias("axis"))
        out = hit if out is None else out.unionByName(hit)
    return out
