"""All named queries of the engine and their oracles."""

from __future__ import annotations

from netsounder.plans import audit, composite, graph, raster, relational, routing, spatial, stages

MODULES = (relational, spatial, graph, raster, stages, composite, routing, audit)


def flagship(spark, sf_dir: str):
    return stages.QUERIES["q13_crawl_share_by_form"](spark, sf_dir)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracles() -> dict:
    return {k: v for m in MODULES for k, v in m.ORACLES.items()}
