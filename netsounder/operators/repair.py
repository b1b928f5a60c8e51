"""Curated judgements applied to a survey: reversals, modes, junctions, connectors and exclusions, in that order, into one routing graph.

A judgement that cannot be applied stays in the table with its reason; one that was applied must be
visible in the graph, and :func:`visible` says where that is not so.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsounder.operators import graph as G
from netsounder.operators import spatial as S
from netsounder.session import stored


@dataclass(frozen=True)
class Repaired:
    status: DataFrame
    edges: DataFrame
    retired: DataFrame
    merged: DataFrame


def _marked(df: DataFrame, reason) -> DataFrame:
    return df.withColumn("reason", reason).withColumn("applied", F.col("reason").isNull())


def _foot(px: str, py: str):
    """Share of a link at which a point's perpendicular meets it."""
    dx, dy = F.col("lx2") - F.col("lx1"), F.col("ly2") - F.col("ly1")
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col(px) - F.col("lx1")) * dx + (F.col(py) - F.col("ly1")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))))


def repaired(links: DataFrame, nodes: DataFrame, corrections: DataFrame, offset: float, snap: float, cut: float, max_rise: float) -> Repaired:
    """The routing graph of ``links(link_id, from_node, to_node, x1, y1, x2, y2, length_m, form)`` after ``corrections``.

    ``nodes(node_id, x, y)``; ``corrections(correction_id, kind, subject, target, x1, y1, x2, y2, rise, judged,
    structure)``, ids as longs. A junction merges its node with an end of the target within ``offset``, else cuts
    the target there. A connector that rises more than ``max_rise``, judged by rule alone and without a structure,
    is refused; its ends go to a node within ``snap``, else cut a link within ``cut``.
    """
    c = stored(corrections, "corrections")
    shape = stored(links.select("link_id", F.col("x1").alias("lx1"), F.col("y1").alias("ly1"), F.col("x2").alias("lx2"), F.col("y2").alias("ly2"), "from_node", "to_node", "length_m", "form"), "links")
    known = shape.select(F.col("link_id").alias("subject"), F.lit(True).alias("_known"))
    plain = c.where("kind in ('reversal', 'mode', 'exclusion')").join(known, "subject", "left")
    plain = _marked(plain, F.when(F.col("_known").isNull(), "identifier did not resolve"))

    place = nodes.select(F.col("node_id").alias("subject"), F.col("x").alias("px"), F.col("y").alias("py"))
    j = c.where("kind = 'junction'").join(place, "subject", "left").join(shape.withColumnRenamed("link_id", "target"), "target", "left")
    d1, d2 = S.distance(F.col("px"), F.col("py"), F.col("lx1"), F.col("ly1")), S.distance(F.col("px"), F.col("py"), F.col("lx2"), F.col("ly2"))
    j = j.withColumns({"t": _foot("px", "py"), "end": F.when(F.least(d1, d2) <= offset, F.when(d1 <= d2, F.col("from_node")).otherwise(F.col("to_node")))})
    j = stored(_marked(j, F.when(F.col("px").isNull(), "identifier did not resolve").when(F.col("lx1").isNull(), "target link is not in the network")), "junctions")
    merged = j.where("applied and end is not null and end <> subject").groupBy(F.col("subject").alias("node_id")).agg(F.min("end").alias("merged"))
    cuts = j.where("applied and end is null").select(F.col("target").alias("link_id"), "t", F.col("subject").cast("string").alias("at"), "correction_id")

    k = c.where("kind = 'connector'")
    climbs = (F.col("rise") > max_rise) & F.col("judged") & ~F.col("structure")
    legs = shape.select(F.col("link_id").alias("leg_id"), F.col("link_id").alias("line_id"), F.col("lx1").alias("x1"), F.col("ly1").alias("y1"), F.col("lx2").alias("x2"), F.col("ly2").alias("y2"))
    targets = nodes.select(F.col("node_id").alias("id"), "x", "y")
    for n in ("1", "2"):
        # ids of their own, so that no end is taken for the node of the same number
        ends = k.select((-F.xxhash64("correction_id").bitwiseAND(F.lit((1 << 62) - 1)) - 1).alias("id"), F.col(f"x{n}").alias("x"), F.col(f"y{n}").alias("y"), "correction_id")
        node = S.nearest_points(ends.select("id", "x", "y"), targets, snap).select("id", F.col("target").alias("_node"))
        line = S.nearest_line(ends.select("id", "x", "y"), legs, cut, 4 * cut).select("id", F.col("line_id").alias("_line"))
        found = ends.join(node, "id", "left").join(line, "id", "left").select("correction_id", F.col("_node").alias(f"node{n}"), F.when(F.col("_node").isNull(), F.col("_line")).alias(f"line{n}"))
        k = k.join(found, "correction_id", "left")
    unmet = F.coalesce("node1", "line1").isNull() | F.coalesce("node2", "line2").isNull()
    k = stored(_marked(k, F.when(climbs, "climbs more than the model can be trusted for").when(unmet, "an end finds no water")), "connectors")
    name = lambda n: F.coalesce(F.col(f"node{n}").cast("string"), F.concat(F.lit("cut:"), "correction_id", F.lit(f":{n}")))
    for n in ("1", "2"):
        own = k.where(f"applied and line{n} is not null").select(F.col(f"line{n}").alias("link_id"), F.col(f"x{n}").alias("px"), F.col(f"y{n}").alias("py"), name(n).alias("at"), "correction_id")
        cuts = cuts.unionByName(own.join(shape, "link_id").select("link_id", _foot("px", "py").alias("t"), "at", "correction_id"))
    cuts = stored(cuts, "cuts")

    text = lambda c: F.col(c).cast("string")
    ends = shape.join(cuts.select("link_id").distinct(), "link_id", "left_semi")
    stops = cuts.select("link_id", "t", "at").union(ends.select("link_id", F.lit(0.0), text("from_node"))).union(ends.select("link_id", F.lit(1.0), text("to_node")))
    # the link's own ends stay outermost where a cut falls on them
    order = Window.partitionBy("link_id").orderBy("t", F.when(F.col("_own"), F.when(F.col("t") == 0, 0).otherwise(2)).otherwise(1), "at")
    own_end = stops.join(ends.select("link_id", text("from_node").alias("_f"), text("to_node").alias("_t")), "link_id").withColumn("_own", ((F.col("t") == 0) & (F.col("at") == F.col("_f"))) | ((F.col("t") == 1) & (F.col("at") == F.col("_t"))))
    pieces = own_end.select("link_id", F.row_number().over(order).alias("n"), F.col("at").alias("from_node"), F.lead("at").over(order).alias("to_node"), (F.lead("t").over(order) - F.col("t")).alias("share"))
    pieces = pieces.where("to_node is not null").join(shape.select("link_id", "length_m", "form"), "link_id")
    children = pieces.select(
        F.concat_ws("/", "link_id", "n").alias("link_id"), text("link_id").alias("parent_id"), "from_node", "to_node", (F.col("share") * F.col("length_m")).alias("length_m"), "form", F.lit("repair").alias("origin")
    )
    new = k.where("applied").select(
        F.concat(F.lit("connector/"), "correction_id").alias("link_id"), F.lit(None).cast("string").alias("parent_id"), name("1").alias("from_node"), name("2").alias("to_node"),
        S.distance(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")).alias("length_m"), F.lit("connector").alias("form"), F.lit("repair").alias("origin"),
    )
    survey = shape.select(text("link_id").alias("link_id"), F.lit(None).cast("string").alias("parent_id"), text("from_node").alias("from_node"), text("to_node").alias("to_node"), "length_m", "form", F.lit("survey").alias("origin"))
    children = stored(children, "children")
    retired = cuts.groupBy(text("link_id").alias("link_id")).agg(F.min("correction_id").alias("correction_id"))

    def with_pieces(kind: str) -> DataFrame:
        given = plain.where(f"applied and kind = '{kind}'").select(text("subject").alias("link_id")).distinct()
        return given.union(children.join(given.withColumnRenamed("link_id", "parent_id"), "parent_id", "left_semi").select("link_id")).distinct()

    edges = G.routing_edges(
        survey, children.unionByName(new), retired.select("link_id"), merged.select(text("node_id").alias("node_id"), text("merged").alias("merged")),
        plain.where("applied and kind = 'reversal'").select(text("subject").alias("link_id")), with_pieces("mode").withColumn("mode", F.lit("both")), with_pieces("exclusion"),
    )
    keep = ["correction_id", "kind", "applied", "reason"]
    status = plain.select(*keep).unionByName(j.select(*keep)).unionByName(k.select(*keep))
    return Repaired(status, edges, retired, merged)


def visible(found: Repaired, corrections: DataFrame) -> DataFrame:
    """Applied corrections that the graph does not show: the release must have none."""
    e = found.edges.select("link_id", "mode", "reversed", F.element_at(F.split("link_id", "/"), 1).alias("key"))
    c = found.status.where("applied").select("correction_id", "kind").join(corrections.select("correction_id", F.col("subject").cast("string").alias("key"), F.col("target").cast("string").alias("target")), "correction_id")
    gone = corrections.where("kind = 'exclusion'").select(F.col("subject").cast("string").alias("key")).distinct()
    shown = {
        "reversal": e.where("reversed").select("key"), "mode": e.where("mode = 'both'").select("key"), "exclusion": None,
    }
    out = None
    for kind, there in shown.items():
        own = c.where(f"kind = '{kind}'")
        if kind == "exclusion":
            bad = own.join(e.select("key").distinct(), "key", "left_semi")
        else:
            # what is excluded as well has no edge left to show it
            bad = own.join(there.distinct(), "key", "left_anti").join(gone, "key", "left_anti")
        out = bad.select("correction_id", "kind") if out is None else out.unionByName(bad.select("correction_id", "kind"))
    new = found.edges.where("link_id like 'connector/%'").select(F.expr("substring(link_id, 11)").alias("correction_id"))
    bad = c.where("kind = 'connector'").join(new, "correction_id", "left_anti").select("correction_id", "kind")
    cut = c.where("kind = 'junction'").join(found.retired.select(F.col("link_id").alias("target")), "target", "left_anti")
    unmerged = cut.join(found.merged.select(F.col("node_id").cast("string").alias("key")), "key", "left_anti")
    own_end = found.edges.select(F.explode(F.array("from_node", "to_node")).alias("key")).distinct()
    return out.unionByName(bad).unionByName(unmerged.join(own_end, "key", "left_anti").select("correction_id", "kind"))
