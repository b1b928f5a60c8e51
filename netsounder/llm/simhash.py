"""SimHash fingerprints linked by a binary-trie self-join.

Fingerprints of 64 bits are deduplicated first. A pair at distance ``k`` or
less agrees on at least one of ``k + 1`` bands, so each fingerprint enters
``k + 1`` tries, each rotated to put one band on top: node pairs above that
band are only the equal ones, and below it pairs of nodes are traversed together,
their differing bits added up and the pair left as soon as the budget is spent.
A node holding too many fingerprints for one task is opened by eight further
bits in the plan itself, before any task gets it; that may repeat to the last
bit, so no bucket is capped. Each task returns a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsounder.llm.forest import Forest
from netsounder.operators.components import connected_components
from netsounder.session import stored

BITS = 64
#: Fingerprints that one trie node may hold before the plan opens it.
NODE_ROWS = 512
#: Trie levels opened at a time.
STEP = 8
_LEAF_PAIRS = 16
_CHUNK = 1 << 19


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits of XXH64 over word shingles, ASCII letters lowered; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = [digest(join(x), seed) for x in zip(*(words[i:] for i in range(shingle)), strict=False)]
    counts = np.zeros(BITS, np.int64)
    every = np.array(hashes, np.uint64)
    for at in range(0, len(every), 1 << 16):
        part = every[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(every), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` is the fingerprint as a signed long. Null text: 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            prints = np.fromiter((fingerprint(x.as_py(), shingle, seed) for x in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def _rotated(fp, left: int):
    return fp if left == 0 else F.shiftleft(fp, left).bitwiseOR(F.shiftrightunsigned(fp, BITS - left))


def _work(prints: DataFrame, distance: int) -> DataFrame:
    """Rows ``(item, depth, budget, same, side, val, rep)``: node pairs and the fingerprints below them."""
    bands = distance + 1
    cuts = [BITS * i // bands for i in range(bands + 1)]
    tops = [
        F.struct(
            F.lit(i).alias("band"),
            _rotated(F.col("fp"), cuts[i]).alias("val"),
            F.lit(cuts[i + 1] - cuts[i]).alias("depth"),
        )
        for i in range(bands)
    ]
    rows = prints.select("rep", F.explode(F.array(*tops)).alias("t")).select(
        F.concat_ws(
            ".", F.col("t.band"), F.expr("hex(shiftrightunsigned(t.val, 64 - t.depth))")
        ).alias("item"),
        F.col("t.depth").alias("depth"), F.lit(distance).alias("budget"), F.lit(True).alias("same"),
        F.lit(0).alias("side"), F.col("t.val").alias("val"), "rep",
    )
    done = None
    rows = stored(rows, "work")
    while True:
        heavy = stored(
            rows.where(F.col("depth") < BITS).groupBy("item").count().where(F.col("count") > NODE_ROWS), "heavy"
        )
        light = rows.join(heavy, "item", "left_anti")
        done = light if done is None else done.unionByName(light)
        if heavy.isEmpty():
            return done
        opened = rows.join(heavy.select("item"), "item")
        step = F.least(F.lit(STEP), F.lit(BITS) - F.col("depth"))
        masks = F.array(*[F.lit(m) for m in range(1 << STEP) if m.bit_count() <= distance])
        opened = (
            opened.withColumn("step", step)
            .withColumn("x", F.expr("shiftrightunsigned(shiftleft(val, depth), 64 - step)"))
            .withColumn("mask", F.explode(masks))
            .where(F.expr("mask < shiftleft(1, step) and bit_count(mask) <= budget"))
            .withColumn("y", F.col("x").bitwiseXOR(F.col("mask").cast("long")))
        )
        first = F.when(F.col("same"), F.least("x", "y")).otherwise(F.when(F.col("side") == 0, F.col("x")).otherwise(F.col("y")))
        second = F.when(F.col("same"), F.greatest("x", "y")).otherwise(F.when(F.col("side") == 0, F.col("y")).otherwise(F.col("x")))
        rows = stored(
            opened.select(
                F.concat_ws(".", "item", F.hex(first), F.hex(second)).alias("item"),
                (F.col("depth") + F.col("step")).alias("depth"),
                (F.col("budget") - F.expr("bit_count(mask)")).alias("budget"),
                (F.col("same") & (F.col("mask") == 0)).alias("same"),
                F.when(F.col("same"), (F.col("x") > F.col("y")).cast("int")).otherwise(F.col("side")).alias("side"),
                "val", "rep",
            ),
            "work",
        )


def trie_links(val: np.ndarray, starts: np.ndarray, ends: np.ndarray, others: np.ndarray, other_ends: np.ndarray, depth: np.ndarray, budget: np.ndarray) -> Forest:
    """Walk pairs of trie nodes, given as ranges of ``val`` sorted within each node.

    A node meets itself where ``starts == others``. Returns the forest of all
    pairs of rows that differ in at most the node pair's budget of bits.
    """
    forest, ones = Forest(len(val)), {}

    def split(lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
        if level not in ones:
            bit = ((val >> np.uint64(BITS - 1 - level)) & np.uint64(1)).astype(np.int32)
            ones[level] = np.concatenate([[0], np.cumsum(bit)])
        return hi - (ones[level][hi] - ones[level][lo])

    stack = []
    for d in np.unique(depth):
        k = depth == d
        stack.append((int(d), starts[k], ends[k], others[k], other_ends[k], budget[k]))
    while stack:
        level, a, b, c, d, left = stack.pop()
        if len(a) > _CHUNK:
            half = len(a) // 2
            stack += [(level, *(x[:half] for x in (a, b, c, d, left))), (level, *(x[half:] for x in (a, b, c, d, left)))]
            continue
        size = (b - a) * (d - c)
        keep = (size > 0) & ~((a == c) & (b - a == 1))
        leaf = keep & ((size <= _LEAF_PAIRS) | (level >= BITS))
        if leaf.any():
            n, width = size[leaf], (d - c)[leaf]
            which = np.repeat(np.arange(len(n)), n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            i, j = a[leaf][which] + k // width[which], c[leaf][which] + k % width[which]
            below = np.uint64((1 << (BITS - level)) - 1)
            near = np.bitwise_count((val[i] ^ val[j]) & below) <= left[leaf][which]
            forest.add(i[near], j[near])
        inner = keep & ~leaf
        if not inner.any():
            continue
        a, b, c, d, left = (x[inner] for x in (a, b, c, d, left))
        m, n = split(a, b, level), split(c, d, level)
        self_ = (a == c) & (b == d)
        spent = left > 0
        cross = spent & ~self_
        parts = [
            (a, m, c, n, left),
            (m, b, n, d, left),
            (a[spent], m[spent], n[spent], d[spent], left[spent] - 1),
            (m[cross], b[cross], c[cross], n[cross], left[cross] - 1),
        ]
        stack.append((level + 1, *(np.concatenate(x) for x in zip(*parts, strict=True))))
    return forest


def _join_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read = list(batches)
    if not read or not sum(b.num_rows for b in read):
        return
    t = pa.Table.from_batches(read)
    item = t.column("item").combine_chunks().dictionary_encode()
    code = (item.combine_chunks() if isinstance(item, pa.ChunkedArray) else item).indices.to_numpy(zero_copy_only=False)
    num = {c: t.column(c).to_numpy() for c in ("depth", "budget", "side", "val", "rep")}
    same = t.column("same").to_numpy(zero_copy_only=False)
    val = num["val"].view(np.uint64)
    order = np.lexsort((val, num["side"], code))
    code, val, side, rep = code[order], val[order], num["side"][order], num["rep"][order]
    depth, budget, same = num["depth"][order], num["budget"][order], same[order]
    group = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    end = np.concatenate([group[1:], [len(code)]])
    middle = end - np.add.reduceat(side, group)
    same = same[group]
    forest = trie_links(
        val, group, np.where(same, end, middle), np.where(same, group, middle), end, depth[group], budget[group]
    )
    root = forest.roots()
    linked = root != np.arange(len(root))
    yield pa.RecordBatch.from_arrays([pa.array(rep[linked]), pa.array(rep[root[linked]])], ["src", "dst"])


def linked_components(prints: DataFrame, distance: int = 2) -> DataFrame:
    """``(doc_id, fp, component_id)``: documents linked through fingerprints at most ``distance`` bits apart.

    ``prints`` has ``(doc_id, fp)``; equal fingerprints link. ``component_id``
    is the least document id reachable.
    """
    prints = stored(prints, "prints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    work = _work(distinct.where("rep is not null"), distance).repartition("item")
    edges = work.mapInArrow(_join_part, "src long, dst long")
    found = connected_components(edges, "src", "dst")
    named = distinct.join(found, distinct.rep == found.node, "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, distance: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """Fingerprint and component of each document; see :func:`linked_components`.

    Null and empty texts have fingerprint zero and link like any other; repeated
    ``doc_id`` rows each come back; a row without an id links nothing; further columns
    are not read. An empty table gives none.
    """
    return linked_components(fingerprints(docs, shingle, seed), distance)


def keep_one(docs: DataFrame, distance: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is the least of its component, with all their columns.

    Only ids decide, and the texts meet them once, unsorted. Rows without an id cannot be named as a
    group's one and are left out; rows that share an id are one document and stay or go together; null
    and empty texts are copies of each other; an empty table gives no row.
    """
    kept = near_duplicates(docs, distance, shingle, seed).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept.hint("shuffle_hash"), "doc_id", "left_semi").select(docs.columns)
