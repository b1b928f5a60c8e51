"""Joins of many with many by blocks of rows: a cell's rows meet as arrays, and what does not match is never a row.

Rows of a cell are dealt to blocks of a bounded size, every block of one side meets every block of the other, and a
kernel over arrays gives the matches. A cell with very many rows becomes many pairs of blocks, which tasks share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netsounder.session import stored

#: Rows in a block, as a mean of the hash draw.
ROWS = 512
#: Parts of a cell that tasks can share.
SHARES = 8

Side = dict[str, pa.Array]
Kernel = Callable[[Side, Side, dict], list[pa.Array] | None]


def in_blocks(df: DataFrame, cell: list[str], key: str) -> DataFrame:
    """``cell``, ``_block`` and ``_rows``, an array of the other columns; rows of one ``key`` share a block."""
    kept = stored(df, "dealt")
    sizes = kept.groupBy(*cell).agg(F.ceil(F.count("*") / ROWS).alias("_of"))
    dealt = kept.join(sizes, cell).withColumn("_block", F.pmod(F.xxhash64(key), "_of"))
    return dealt.groupBy(*cell, "_block").agg(F.collect_list(F.struct(*[c for c in df.columns if c not in cell])).alias("_rows"))


def _side(column: pa.ListArray, at: int) -> Side:
    low, high = column.offsets[at].as_py(), column.offsets[at + 1].as_py()
    rows = column.values.slice(low, high - low)
    return {f.name: c for f, c in zip(rows.type, rows.flatten(), strict=True)}


def met(left: DataFrame, right: DataFrame | None, cell: list[str], schema: StructType, kernel: Kernel, fold: Kernel | None = None) -> DataFrame:
    """What ``kernel(left rows, right rows, cell)`` gives for each pair of blocks of a cell, as rows of ``schema``.

    Without ``right``, blocks of ``left`` (from :func:`in_blocks`) meet one another, each pair once; ``cell`` tells the kernel
    by ``_same`` where a block meets itself. ``fold`` is given all that a task has so far and says what of it is still wanted.
    """
    spark = left.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    keys = [*cell, "_share"]
    a = left.select(*cell, F.col("_block").alias("_a"), F.col("_rows").alias("_l"), F.pmod("_block", F.lit(SHARES)).alias("_share"))
    b = (left if right is None else right).select(*cell, F.col("_block").alias("_b"), F.col("_rows").alias("_r"), F.explode(F.expr(f"sequence(0L, {SHARES - 1}L)")).alias("_share"))
    pairs = a.repartition(n, *keys).join(b.repartition(n, *keys), keys)
    pairs = pairs.where("_a <= _b") if right is None else pairs
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            cells = {c: batch.column(c) for c in (*cell, "_a", "_b")}
            lists = batch.column("_l"), batch.column("_r")
            for at in range(batch.num_rows):
                here = {c: v[at].as_py() for c, v in cells.items()}
                here["_same"] = right_is_left and here["_a"] == here["_b"]
                out = kernel(_side(lists[0], at), _side(lists[1], at), here)
                if out is None or not len(out[0]):
                    continue
                held.append(pa.RecordBatch.from_arrays(out, names))
                rows += len(out[0])
                if rows >= 200_000:
                    all_ = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    if fold is None:
                        yield all_
                        held, rows = [], 0
                    else:
                        held = [pa.RecordBatch.from_arrays(fold(dict(zip(names, all_.columns, strict=True))), names)]
                        rows = held[0].num_rows if held[0].num_rows < 100_000 else 0
        if held:
            all_ = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield all_ if fold is None else pa.RecordBatch.from_arrays(fold(dict(zip(names, all_.columns, strict=True))), names)

    right_is_left = right is None
    return pairs.select(*cell, "_a", "_b", "_l", "_r").mapInArrow(run, schema)


def numbers(side: Side, *names: str) -> list[np.ndarray]:
    return [side[n].to_numpy(zero_copy_only=False) for n in names]
