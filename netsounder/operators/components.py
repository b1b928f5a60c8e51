"""Weakly connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (combined map-side, so a node with very many
edges costs its partition one row per task) and an equi-join back with the
stored minima, which the adaptive planner can split when one node is hot. State between rounds lives in
the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from netsounder.session import counted, discard, stored

#: Edges, told by a count, up to which one task may close a graph in its memory.
SMALL = 1 << 20


def _least(edges: DataFrame) -> DataFrame:
    """The least smaller neighbour of each node that has one, stored: a join with it can then be split where a node is hot."""
    return stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")


def in_one_task(edges: DataFrame, close: Callable[[np.ndarray, np.ndarray, int], np.ndarray], names: tuple[str, str]) -> DataFrame:
    """``close(u, v, n)`` of the edges' ends as ranks of their values: each node's value and that of the rank it returns."""
    kind = edges.schema[0].dataType
    out = StructType([StructField(names[0], kind), StructField(names[1], kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        read = pa.Table.from_batches(held)
        ends = pa.chunked_array([*read.column(0).chunks, *read.column(1).chunks]).combine_chunks().dictionary_encode()
        order = pc.sort_indices(ends.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        code = rank[ends.indices.to_numpy()]
        label = close(code[: read.num_rows], code[read.num_rows :], len(order))
        values = ends.dictionary.take(pa.array(order))
        yield pa.RecordBatch.from_arrays([values, values.take(pa.array(label))], list(names))

    return edges.repartition(1).mapInArrow(run, out)


def _least_labels(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The least node of each one's component: labels fall along the edges, then jump to their label's label."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, before[u], low)
        np.minimum.at(label, before[v], low)
        label = label[label]
        if (label == before).all():
            return label


def connected_components(edges: DataFrame, src: str, dst: str, max_rounds: int = 60, small: int = 0) -> DataFrame:
    """``(node, component)`` for every node on an edge; component is the least node reachable.

    Null ends and self-loops join nothing and are left out. An empty edge
    table gives an empty result. Up to ``small`` edges are closed in one task.
    """
    state, n = counted(
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col("u") != F.col("v")))
        .distinct(),
        "edges",
    )
    if n <= small:
        return in_one_task(state, _least_labels, ("node", "component"))
    seen = None
    for _ in range(max_rounds):
        # large star: the larger end moves on to the least neighbour of the smaller end
        least = _least(state)
        large = stored(
            state.join(least.select(F.col("u").alias("v"), "m"), "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct(), "edges"
        )
        # small star: a node's smaller neighbours, and the node, hang on the least of them
        low = _least(large)
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        grown = stored(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(least)
        discard(large)
        discard(low)
        mark = grown.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(state)
        state = grown
        if seen == mark:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
