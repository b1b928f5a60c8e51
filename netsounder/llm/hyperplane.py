"""Near-duplicate vectors by random-hyperplane signs, checked by exact cosine.

``tables`` independent hash tables each give a vector the signs of its
projections on ``bits`` random directions; vectors of one label that share a
table's signs are candidates. Their cosine is then computed in double
precision, so no link is below the threshold; ``bits`` grows with the
logarithm of the rows and ``tables`` follows from the chance of a miss at the
threshold. Exact copies are one class throughout. A bucket too large for one
task is cut into chunks and every pair of chunks becomes a task of its own:
nothing in it is dropped, and only counts and spanning links leave a task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsounder.llm.forest import Forest
from netsounder.operators.components import connected_components
from netsounder.session import stored

#: Rows of a bucket that one task compares with as many others.
CHUNK_ROWS = 384
SEED = 20_011
#: Chance that a pair exactly at the threshold shares no bucket.
MISS = 1e-3


def shape(rows: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """``(bits, tables)`` for so many vectors: about a row a bucket, misses at the threshold under ``miss``."""
    bits = min(30, max(4, math.ceil(math.log2(max(2, rows))) - 2))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-same)))


def _vector(values: list | None, label: object) -> np.ndarray | None:
    if label is None or not values or None in values:
        return None
    v = np.asarray(values, np.float64)
    if not np.isfinite(v).all() or not v.any():
        return None
    return v / np.abs(v).max() + 0.0


def _prepared(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, digest, vec)``; digest and vec are null where a vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, label, vec = batch.columns
            out = [_vector(v, k) for v, k in zip(vec.to_pylist(), label.to_pylist(), strict=True)]
            raw = [None if v is None else v.tobytes() for v in out]
            digest = [
                None if r is None else hashlib.blake2b(r + b"|" + str(k).encode(), digest_size=16).digest()
                for r, k in zip(raw, label.to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [ids, label, pa.array(digest, pa.binary()), pa.array(raw, pa.binary())], ["vec_id", "label", "digest", "vec"]
            )

    cols = [F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>")]
    return vectors.select(*cols).mapInArrow(run, "vec_id long, label string, digest binary, vec binary")


def _coded(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            raw = batch.column(batch.schema.get_field_index("vec")).to_pylist()
            codes = []
            for r in raw:
                v = np.frombuffer(r)
                if len(v) not in planes:
                    planes[len(v)] = np.random.default_rng([SEED, len(v)]).standard_normal((tables * bits, len(v)))
                codes.append(((planes[len(v)] @ v > 0).reshape(tables, bits) @ powers).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary())], [*batch.schema.names, "codes"])

    return classes.mapInArrow(run, "rep long, label string, weight long, digest binary, vec binary, codes binary")


def compare(vec: np.ndarray, codes: np.ndarray, weight: np.ndarray, side: np.ndarray, table: int, threshold: float) -> tuple[np.ndarray, Forest]:
    """Links' weight of each row and their forest, leaving pairs that an earlier table brought together.

    ``side`` 2 marks rows of one chunk met with itself; 0 and 1 two chunks met with each other.
    """
    n, whole = len(vec), side[0] == 2
    left, right = (np.arange(n), np.arange(n)) if whole else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    found, forest = np.zeros(n, np.int64), Forest(n)
    if not len(left) or not len(right):
        return found, forest
    norm = np.sqrt(np.einsum("ij,ij->i", vec, vec))
    near = vec[left] @ vec[right].T / (norm[left][:, None] * norm[right][None, :]) >= threshold
    if whole:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    i, j = left[i], right[j]
    first = ~(codes[i, :table] == codes[j, :table]).any(axis=1)
    i, j = i[first], j[first]
    np.add.at(found, i, weight[j])
    np.add.at(found, j, weight[i])
    forest.add(i, j)
    return found, forest


def _verified(work: DataFrame, threshold: float, tables: int) -> DataFrame:
    """Links of each row and a forest of them, item by item; rows come in order of item, so one item is held at a time."""

    def close(rows: list, out: tuple[list, list, list]) -> None:
        table, side, weight, rep, raw, codes = rows
        if len(rep) < 2:
            return
        vec = np.array([np.frombuffer(x) for x in raw])
        code = np.array([np.frombuffer(x, np.int64) for x in codes])
        links, forest = compare(vec, code, weight, side, int(table[0]), threshold)
        some = np.flatnonzero(links)
        out[0].append(rep[some])
        out[1].append(links[some])
        out[2].append(rep[forest.roots()[some]])

    def told(out: tuple[list, list, list]) -> Iterator[pa.RecordBatch]:
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["src", "links", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None
        now = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            item, out = batch.column(0), ([], [], [])
            columns = [*(batch.column(c).to_numpy() for c in ("t", "side", "weight", "rep")), *(batch.column(c).to_pylist() for c in ("vec", "codes"))]
            cuts = [0, *(np.flatnonzero(pc.not_equal(item.slice(1), item.slice(0, n - 1)).to_numpy(zero_copy_only=False)) + 1).tolist(), n]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                part = [c[lo:hi] for c in columns]
                if held is not None and lo == 0 and item[0].as_py() == now:
                    held = [np.concatenate([x, y]) if k < 4 else x + y for k, (x, y) in enumerate(zip(held, part, strict=True))]
                    continue
                if held is not None:
                    close(held, out)
                held = part
            now = item[n - 1].as_py()
            yield from told(out)
        if held is not None:
            out = ([], [], [])
            close(held, out)
            yield from told(out)

    return work.mapInArrow(run, "src long, links long, dst long")


def linked_vectors(vectors: DataFrame, threshold: float = 0.98, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of each row of ``vectors(vec_id, embedding, label)``.

    Rows link when labels are equal and not null and the cosine is at least
    ``threshold``. Null, empty and all-zero vectors, and those with null or
    non-finite parts, link with nothing; so do vectors of different lengths.
    Repeated rows count as vectors of their own; different vectors under one id share their links.
    An empty table gives no row.
    """
    rows = stored(_prepared(vectors), "vectors")
    grouped = stored(
        rows.where("digest is not null").groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")),
        "classes",
    )
    bits, tables = shape(grouped.count(), threshold)
    firsts = rows.select("vec_id", "label", F.col("digest").alias("d"), "vec").dropDuplicates(["vec_id", "d"])
    classes = grouped.join(firsts, (F.col("rep") == F.col("vec_id")) & (F.col("digest") == F.col("d")))
    coded = stored(_coded(classes.select("rep", "label", "weight", "digest", "vec"), bits, tables), "coded")
    # buckets are found and cut by ids and codes alone; vectors meet only those of more than one
    at = F.sequence(F.lit(0), F.lit(tables - 1))
    code = F.hex(F.expr("substring(codes, 1 + 8 * t, 8)"))
    keyed = coded.select("rep", "digest", "label", "codes", F.length("vec").alias("size"), F.explode(at).alias("t"))
    keyed = keyed.select("rep", "digest", "t", F.concat_ws("|", "t", code, "size", "label").alias("item"))
    sizes = keyed.groupBy("item").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / F.lit(chunk_rows)).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    work = (
        keyed.join(sizes, "item")
        .withColumn("chunks", chunks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
        .select(
            F.concat_ws("/", "item", F.least("own", "other"), F.greatest("own", "other")).alias("item"),
            "t", F.expr("case when own = other then 2 when own < other then 0 else 1 end").alias("side"), "digest",
        )
    )
    work = work.join(coded.select("digest", "rep", "weight", "vec", "codes"), "digest").select("item", "t", "side", "weight", "rep", "vec", "codes")
    found = stored(_verified(work.repartition("item").sortWithinPartitions("item"), threshold, tables), "links")
    links = found.groupBy("src").agg(F.sum("links").alias("links"))
    parts = connected_components(found, "src", "dst")
    named = (
        grouped.join(links, F.col("rep") == F.col("src"), "left")
        .join(parts, F.col("rep") == F.col("node"), "left")
        .select(
            "digest",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    out = rows.select("vec_id", "digest").join(named, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
