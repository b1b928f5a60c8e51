"""The audit of a network as a build: load, census, crawl, dead ends, reach by basin, export."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsounder.build.pipeline import Params, Pipeline
from netsounder.operators import graph as G
from netsounder.operators import relational as R
from netsounder.plans.stages import seeds

DEFAULTS = {"audit": {"report_top_n": 50}, "seeds": {"tidal_form": "tidal"}}


def audit_pipeline(params: dict | None = None) -> Pipeline:
    """Stages over the source tables ``link(from_node, to_node, length_m, form, origin, mode)`` and ``basin(node_id, basin)``."""
    p = Pipeline(Params(params or DEFAULTS))

    @p.stage(reads=("link",), writes=("edge", "node"))
    def load(spark, tables, settings):
        edge = tables["link"].withColumn("edge_id", F.concat_ws(">", "from_node", "to_node"))
        edge = R.refused(edge, F.col("from_node").isNull() | F.col("to_node").isNull(), "a link has an open end")
        return {"edge": edge, "node": G.nodes_of(edge)}

    @p.stage(reads=("edge",), writes=("census",))
    def census(spark, tables, settings):
        edge = tables["edge"]
        parts = G.weak_components(edge)
        roles = G.roles(edge).select("node_id", "sink", "bifurcation")
        return {"census": parts.join(roles, "node_id").groupBy("component").agg(F.count("*").alias("nodes"), F.count_if("sink").alias("sinks"), F.count_if("bifurcation").alias("bifurcations"))}

    @p.stage(reads=("edge",), writes=("link_reach",))
    def crawl(spark, tables, settings):
        return {"link_reach": G.crawl(tables["edge"], seeds(tables["edge"]))}

    @p.stage(reads=("edge", "link_reach"), writes=("dead_end",), params=("audit.report_top_n",))
    def dead_ends(spark, tables, settings):
        edge = tables["edge"].join(tables["link_reach"].select("edge_id", "admitted"), "edge_id")
        sinks = G.roles(edge).where("sink").select("node_id")
        up = G.upstream_length(edge, sinks).select("node_id", "upstream_m")
        dry = G.upstream_length(edge.where("not admitted"), sinks).select("node_id", F.col("upstream_m").alias("stranded_m"))
        out = up.join(dry, "node_id").orderBy(F.desc("stranded_m"), F.desc("upstream_m"), "node_id")
        return {"dead_end": out.limit(settings["audit.report_top_n"])}

    @p.stage(reads=("edge", "link_reach", "basin"), writes=("basin_reach",))
    def basin_reach(spark, tables, settings):
        edge = tables["edge"].join(tables["link_reach"].select("edge_id", "admitted"), "edge_id")
        at = edge.join(tables["basin"].withColumnRenamed("node_id", "to_node"), "to_node")
        part = F.sum(F.when(F.col("admitted"), F.col("length_m")).otherwise(0.0))
        return {"basin_reach": at.groupBy("basin").agg(F.count("*").alias("links"), F.sum("length_m").alias("km"), R.share(part, F.sum("length_m")).alias("share"))}

    return p
