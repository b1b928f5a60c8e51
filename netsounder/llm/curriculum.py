"""A mix of sources to target weights, laid out on a time-varying curriculum.

Targets come from water filling: a share of all words goes to each source by
weight, none above twice its size. A source's documents follow each other in
a fixed shuffled order, again and again until its target is met; the running
demand of a document, divided by the target, is then inverted through the
integral of the source's weight schedule, giving the training position at
which it is due. The schedule is linear in training time, so the inverse is
closed. Running sums are range-partitioned: a hot source spans many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsounder.operators.ordering import running
from netsounder.session import stored

WEIGHTS = (5, 2, 1)
#: Relative weight of a source at the start and the end of training, for each of WEIGHTS.
RAMPS = ((2.0, 1.0), (1.0, 1.0), (1.0, 2.0))
SHARE = 1.5
MOST = 2


def due(u: Column, start: Column, end: Column) -> Column:
    """Training time in [0, 1] by which a share ``u`` of the integral of a linear schedule is spent."""
    slope = end - start
    root = (F.sqrt(start * start + slope * (start + end) * u) - start) / slope
    return F.when(slope == 0, u).otherwise(F.least(F.lit(1.0), F.abs(root)))


def _cycled(values: tuple, rank: Column) -> Column:
    chosen = F.lit(values[-1])
    for i, v in enumerate(values[:-1]):
        chosen = F.when(rank % len(values) == i, F.lit(v)).otherwise(chosen)
    return chosen


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sizes(source, source_size)`` with ``weight``, ``target``, ``rank`` and ``source_start``."""
    ranked, total = running(sizes, [F.col("source").asc_nulls_last()], "source_size")
    ranked = ranked.withColumnRenamed("before", "source_start")
    ranked, _ = running(ranked, [F.col("source").asc_nulls_last()])
    ranked = stored(
        ranked.withColumnRenamed("before", "rank")
        .withColumn("weight", _cycled(weights, F.col("rank")).cast("long"))
        .withColumn("cap", F.lit(most) * F.col("source_size"))
        .withColumn("level", F.col("cap") / F.col("weight")),
        "sources",
    )
    order = ["level", F.col("source").asc_nulls_last()]
    filled, _ = running(ranked, order, "cap")
    filled = filled.withColumnRenamed("before", "cap_before")
    filled, whole = running(filled, order, "weight")
    demand = share * total
    after = F.lit(whole) - F.col("before") - F.col("weight")
    filled = filled.withColumn("capped", F.col("cap_before") + F.col("cap") + F.col("level") * after <= F.lit(demand))
    filled = stored(filled, "filled")
    spent = filled.where("capped").agg(F.sum("cap"), F.sum("weight")).first()
    rest, open_weight = demand - (spent[0] or 0), whole - (spent[1] or 0)
    level = rest / open_weight if open_weight else 0.0
    return filled.select(
        "source", "source_size", "source_start", "rank", "weight",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.lit(float(level))).alias("target"),
    )


def _sized(docs: DataFrame) -> DataFrame:
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), words.cast("long").alias("size"))


def _laid(sizes: DataFrame, weights: tuple, ramps: tuple, share: float, most: int) -> DataFrame:
    """Each of ``sizes(doc_id, source, size)`` with its words taken, its words ahead in the source, and its source's target and ramp."""
    rows = stored(sizes, "sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aim = stored(targets(sums, weights, share, most), "targets")
    shuffled = rows.withColumn("_h", F.md5(F.col("doc_id").cast("string").cast("binary")))
    laid, _ = running(shuffled, [F.col("source").asc_nulls_last(), "_h", "doc_id", "size"], "size")
    aim = aim.withColumnRenamed("source", "_source")
    out = laid.join(aim, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "_h")
    goal = F.round(F.col("target")).cast("long")
    ahead = F.col("before") - F.col("source_start")
    passes = F.floor(goal / F.greatest(F.col("source_size"), F.lit(1)))
    rest = goal - passes * F.col("source_size")
    part = F.least(F.greatest(rest - ahead, F.lit(0)), F.col("size"))
    taken = (passes * F.col("size") + part).cast("long")
    begin, end = (_cycled(tuple(r[i] for r in ramps), F.col("rank")) for i in (0, 1))
    return out.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"),
        ahead.alias("ahead"), goal.alias("goal"), begin.alias("begin"), end.alias("end"),
    )


def _position(turn: Column) -> Column:
    share = (turn * F.col("source_size") + F.col("ahead")) / F.greatest(F.col("goal"), F.lit(1))
    return F.when(F.col("taken") > 0, due(F.least(share, F.lit(1.0)), F.col("begin"), F.col("end")))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, ramps: tuple = RAMPS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, position)`` of each document, in training order.

    ``taken`` counts a document's words over all passes; the pass that meets a
    source's target may end inside a document. ``position`` is when its first
    pass is due, null where nothing is taken; such rows come last. Null texts
    have size 0, the null source is a source of its own, repeated rows are
    mixed one by one; an empty table gives no row.
    """
    out = _laid(_sized(docs), weights, ramps, share, most).withColumn("position", _position(F.lit(0)))
    keep = ["doc_id", "source", "size", "source_size", "target", "taken", "position"]
    return out.select(*keep).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in training order, each as often as the mix takes it whole (half a pass counts as one).

    Only the document in which a source's target falls is rounded, so a source's words miss its target by
    half of one document at most. A document without words is in no demand and is left out. Rows that
    share an id are one document of their least source and come in each of its passes, rows without
    an id likewise; an empty table gives no row.
    """
    sizes = _sized(docs).groupBy("doc_id").agg(F.min("source").alias("source"), F.sum("size").alias("size"))
    plan = _laid(sizes, WEIGHTS, RAMPS, SHARE, MOST).where("taken > 0")
    turns = F.round(F.col("taken") / F.col("size")).cast("int")
    plan = plan.where(turns > 0).withColumn("_turn", F.explode(F.sequence(F.lit(0), turns - 1)))
    name, key = "_position", "_doc"
    while name in docs.columns:
        name += "_"
    while key in docs.columns:
        key += "_"
    plan = plan.select(F.col("doc_id").alias(key), _position(F.col("_turn")).alias(name))
    met = docs.join(plan.hint("shuffle_hash"), docs["doc_id"].cast("long").eqNullSafe(F.col(key)))
    return met.orderBy(name, key).select(docs.columns)
