"""Cells of square and hexagonal grids: binning, neighbours, subdivision, visibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsounder.operators.raster import shifted
from netsounder.session import stored


def hex_of(x: Column, y: Column, size: float) -> Column:
    """Axial coordinates ``(q, s)`` of the pointy-topped hexagon of side ``size`` that holds a point."""
    q = (F.sqrt(F.lit(3.0)) / 3 * x - y / 3) / size
    r = (y * 2 / 3) / size
    t = -q - r
    rq, rr, rt = F.round(q), F.round(r), F.round(t)
    dq, dr, dt = F.abs(rq - q), F.abs(rr - r), F.abs(rt - t)
    fixed_q = F.when((dq > dr) & (dq > dt), -rr - rt).otherwise(rq)
    fixed_r = F.when((dq > dr) & (dq > dt), rr).when(dr > dt, -rq - rt).otherwise(rr)
    return F.struct(fixed_q.cast("long").alias("q"), fixed_r.cast("long").alias("s"))


def hex_centre(q: Column, s: Column, size: float) -> tuple[Column, Column]:
    return size * F.sqrt(F.lit(3.0)) * (q + s / 2), size * 1.5 * s


def hex_ring(cells: DataFrame, k: int) -> DataFrame:
    """``(q, s, nq, ns, ring)``: every cell within ``k`` steps of each."""
    steps = [(a, b, max(abs(a), abs(b), abs(a + b))) for a in range(-k, k + 1) for b in range(-k, k + 1) if max(abs(a), abs(b), abs(a + b)) <= k]
    at = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(n).alias("n")) for a, b, n in steps])).alias("t")
    return cells.select("q", "s", at).select("q", "s", (F.col("q") + F.col("t.a")).alias("nq"), (F.col("s") + F.col("t.b")).alias("ns"), F.col("t.n").alias("ring"))


def parent(r: Column, c: Column, levels: int = 1) -> tuple[Column, Column]:
    """The quad cell ``levels`` up."""
    return F.floor(r / (1 << levels)).cast("long"), F.floor(c / (1 << levels)).cast("long")


def guarded_sample(points: DataFrame, cells: DataFrame, half: int, least: int) -> DataFrame:
    """``(id, valid, low, verdict)``: the tenth percentile of the box of cells around a point, and whether it may be used."""
    offsets = [(a, b) for a in range(-half, half + 1) for b in range(-half, half + 1)]
    met = shifted(points, offsets, id="id").join(cells, ["r", "c"])
    verdict = F.when(F.count("*") < least, "too few cells").when(F.count_if(F.col("z") != 0) == 0, "all zero").otherwise("ok")
    return met.groupBy("id").agg(F.count("*").alias("valid"), F.round(F.percentile("z", F.lit(0.1)), 6).alias("low"), verdict.alias("verdict"))


def visible(cells: DataFrame, sights: DataFrame) -> DataFrame:
    """``(r, c, height)``: the greatest height among ``sights(r, c, height, reach)`` whose reach covers the cell, however far it is.

    In each column that it reaches, a sight covers a run of rows. A run is laid out in blocks of rows, two of each power of
    two at most; a cell then looks up the one block of each size that it lies in. Nothing is sent to every cell in reach.
    """
    bounds = cells.agg(*[f(c).alias(f"{n}{c}") for c in ("r", "c") for f, n in ((F.min, "_l"), (F.max, "_h"))])
    far = F.floor("reach").cast("long")
    seen = sights.where("reach >= 0").join(F.broadcast(bounds)).withColumns({"_l": F.greatest(F.col("c") - far, "_lc").cast("long"), "_h": F.least(F.col("c") + far, "_hc").cast("long")}).where("_l <= _h")
    seen = seen.withColumn("_c", F.explode(F.sequence("_l", "_h")))
    side, whole = (F.col("_c") - F.col("c")) ** 2, F.col("reach") ** 2
    half = F.floor(F.sqrt(F.greatest(whole - side, F.lit(0.0)))).cast("long")
    # the root can be rounded to either side of a row that lies on the rim
    half = F.when((half + 1) ** 2 + side <= whole, half + 1).when(half**2 + side > whole, half - 1).otherwise(half)
    runs = seen.withColumn("_n", half).where("_n >= 0").select(F.col("_c").alias("c"), F.greatest(F.col("r") - F.col("_n"), "_lr").cast("long").alias("_a"), (F.least(F.col("r") + F.col("_n"), "_hr") + 1).cast("long").alias("_b"), "height").where("_a < _b")
    runs = runs.groupBy("c", "_a", "_b").agg(F.max("height").alias("height"))
    sized = runs.withColumn("_k", F.explode(F.sequence(F.lit(0), F.floor(F.log2((F.col("_b") - F.col("_a")).cast("double")) + 1e-9).cast("int"))))
    sized = sized.selectExpr("c", "_k", "height", "-shiftright(-_a, _k) as _p", "shiftright(_b, _k) as _q").where("_p < _q")
    blocks = sized.withColumn("_at", F.explode(F.expr("filter(array(if(_p % 2 <> 0, _p, null), if(_q % 2 <> 0, _q - 1, null)), x -> x is not null)")))
    top = stored(blocks.groupBy("c", "_k", "_at").agg(F.max("height").alias("height")), "blocks")
    sizes = top.agg(F.coalesce(F.max("_k"), F.lit(0)).alias("_most"))
    looked = cells.select("r", "c").distinct().join(F.broadcast(sizes)).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_most")))).selectExpr("r", "c", "_k", "shiftright(r, _k) as _at")
    return looked.join(top, ["c", "_k", "_at"]).groupBy("r", "c").agg(F.max("height").alias("height"))


def ring_class(cells: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """``(r, c, ring)``: rings to the nearest target, null beyond ``most``."""
    offsets = [(a, b) for a in range(-most, most + 1) for b in range(-most, most + 1)]
    sent = shifted(targets, offsets)
    ring = F.greatest(F.abs(F.col("r") - F.col("fr")), F.abs(F.col("c") - F.col("fc")))
    near = sent.groupBy("r", "c").agg(F.min(ring).alias("ring"))
    return cells.join(near, ["r", "c"], "left").select("r", "c", "ring")


def subdivided(cells: DataFrame, size: int, least: int, relief: float) -> tuple[DataFrame, DataFrame]:
    """Squares split in four while their relief is above a bound: the kept squares, and a ledger by level."""
    top = lambda c: (F.floor(F.col(c) / size) * size).cast("int").alias(c)
    todo = cells.select(top("r"), top("c")).distinct()
    kept, ledger, level = None, None, 0
    while True:
        span = size >> level
        own = cells.select((F.floor(F.col("r") / span) * span).cast("int").alias("r"), (F.floor(F.col("c") / span) * span).cast("int").alias("c"), "z")
        stats = own.groupBy("r", "c").agg((F.max("z") - F.min("z")).alias("relief"))
        found = stored(todo.join(stats, ["r", "c"], "left").withColumn("split", F.coalesce(F.col("relief") > relief, F.lit(False)) & F.lit(span > least)), "squares")
        line = found.agg(F.lit(level).alias("level"), F.count("*").alias("tested"), F.count_if("split").alias("split"))
        ledger = line if ledger is None else ledger.unionByName(line)
        rest = found.where("not split").select(F.lit(level).alias("level"), "r", "c", F.lit(span).alias("size"))
        kept = rest if kept is None else kept.unionByName(rest)
        half = span // 2
        quarters = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, half) for b in (0, half)])).alias("q")
        todo = found.where("split").select("r", "c", quarters).select((F.col("r") + F.col("q.a")).alias("r"), (F.col("c") + F.col("q.b")).alias("c"))
        if todo.isEmpty():
            return kept, ledger
        level += 1


def implausible(groups: DataFrame, label: str, value: str, bounds: DataFrame) -> DataFrame:
    """Groups whose value is above what ``bounds(label, most)`` allows their label, or whose label has no bound."""
    met = groups.join(bounds.select(F.col("label").alias("_label"), "most"), F.col(label) == F.col("_label"), "left").drop("_label")
    return met.where(F.col("most").isNull() | (F.col(value) > F.col("most")))


def plausible(groups: DataFrame, label: str, value: str, bounds: DataFrame) -> DataFrame:
    """``groups`` as they are, or an error that names what is :func:`implausible`."""
    over = implausible(groups, label, value, bounds).orderBy(F.desc(value), label).limit(5).collect()
    if over:
        raise ValueError("not plausible: " + ", ".join(f"{r[label]} {r[value]:g} (" + ("no bound" if r["most"] is None else f"{r['most']:g} at most") + ")" for r in over))
    return groups


def conflicting(rows: DataFrame, stamp: str, digest: str) -> DataFrame:
    """Stamps that stand over more than one digest."""
    return rows.groupBy(stamp).agg(F.countDistinct(digest).alias("n")).where("n > 1").select(stamp)



def touching(squares: DataFrame) -> DataFrame:
    """``(a, b)``: squares ``(id, r, c, size)`` of any sizes that share a stretch of border, ``a < b``.

    Each square names the unit cells just outside its border; whoever owns one of them touches it.
    """
    side = F.explode(F.sequence(F.lit(0), F.col("size") - 1))
    s = squares.withColumn("k", side)
    cell = lambda r, c: F.struct(r.cast("long").alias("r"), c.cast("long").alias("c"))
    r, c, n, k = (F.col(x) for x in ("r", "c", "size", "k"))
    outer = F.array(cell(r - 1, c + k), cell(r + n, c + k), cell(r + k, c - 1), cell(r + k, c + n))
    inner = F.array(cell(r, c + k), cell(r + n - 1, c + k), cell(r + k, c), cell(r + k, c + n - 1))
    out = s.select(F.col("id").alias("a"), F.explode(outer).alias("u"))
    own = s.select(F.col("id").alias("b"), F.explode(inner).alias("u"))
    return out.join(own, "u").where("a < b").select("a", "b").distinct()


def spikes(cells: DataFrame, least: float) -> DataFrame:
    """Cells that stand more than ``least`` off the median of their neighbours."""
    from netsounder.operators.raster import EIGHT

    around = shifted(cells, EIGHT, z="n").groupBy("r", "c").agg(F.percentile("n", F.lit(0.5)).alias("median"))
    return cells.join(around, ["r", "c"]).where(F.abs(F.col("z") - F.col("median")) > least).select("r", "c", "z", "median")


def pruned(cells: DataFrame, rounds: int) -> DataFrame:
    """A skeleton of cells after cutting its loose ends (cells with one neighbour at most) so many times."""
    from netsounder.operators.raster import EIGHT

    left = cells.select("r", "c")
    for _ in range(rounds):
        degree = shifted(left, EIGHT).join(left, ["r", "c"]).groupBy("r", "c").agg(F.count("*").alias("n"))
        left = stored(left.join(degree.where("n > 1"), ["r", "c"], "left_semi"), "left")
    return left


def closed(cells: DataFrame, hop: int) -> DataFrame:
    """``(r, c, admitted)`` of ``cells(r, c, seen)``: seen cells, and blind ones with a seen cell within ``hop`` on both sides of them along a row or a column."""
    from pyspark.sql import Window

    seen = F.col("seen").cast("int")
    admitted = F.col("seen")
    for along, across in (("r", "c"), ("c", "r")):
        w = Window.partitionBy(along).orderBy(across)
        both = (F.max(seen).over(w.rangeBetween(-hop, -1)) == 1) & (F.max(seen).over(w.rangeBetween(1, hop)) == 1)
        admitted = admitted | F.coalesce(both, F.lit(False))
    return cells.select("r", "c", admitted.alias("admitted"))
