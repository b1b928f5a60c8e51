"""Shards cut from a Hilbert curve through the documents' metadata.

Each dimension (language, source, size in bytes) is quantised by the share of
rows ahead of its value, so hot values get wide cells; the cells' curve index
orders the table, and runs of it become shards whose minima and maxima prune
in every dimension at once. Ties in a cell are broken by text checksum and
id, so equal texts of one cell lie side by side. Everything runs on DataFrame
functions; the order is one range partitioning of rows without their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsounder.operators.ordering import running
from netsounder.session import stored

BITS = 4
DIMENSIONS = ("lang", "source", "size")


def curve_index(point: tuple[int, ...], bits: int) -> int:
    """Index along the Hilbert curve of a cell, any number of dimensions (Skilling's transposition)."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    return sum(((v >> b) & 1) << (b * n + n - 1 - i) for i, v in enumerate(x) for b in range(bits))


def _cells(spark, bits: int) -> DataFrame:
    side = range(1 << bits)
    rows = [(a, b, c, curve_index((a, b, c), bits)) for a in side for b in side for c in side]
    return spark.createDataFrame(rows, "lang_q int, source_q int, size_q int, curve int")


def _quantised(rows: DataFrame, dim: str, bits: int) -> DataFrame:
    counts = rows.groupBy(dim).agg(F.count("*").alias("n"))
    order = [F.col(dim).asc_nulls_first()]
    placed, total = running(counts, order, "n")
    cell = F.floor((F.col("before") + F.col("n") / 2) * (1 << bits) / F.lit(max(total, 1)))
    return placed.select(F.col(dim).alias("_v"), F.least(cell, F.lit((1 << bits) - 1)).cast("int").alias(f"{dim}_q"))


def curve_order(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``(doc_id, lang, source, size, text_crc32, curve)`` of each document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"),
        (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows, _ = running(rows, ["size", "text_crc32", "doc_id"])
    rows = rows.drop("before")
    for dim in DIMENSIONS:
        found = _quantised(rows, dim, bits)
        rows = rows.join(found, F.col(dim).eqNullSafe(F.col("_v"))).drop("_v")
    return rows.join(_cells(docs.sparkSession, bits), [f"{d}_q" for d in DIMENSIONS])


def shards(docs: DataFrame, count: int = 24, bits: int = BITS) -> DataFrame:
    """Shard and slot of each document under the law ``rows``: shard sizes are at most one row apart.

    Null texts count as empty; null languages and sources sort first; repeated
    rows are placed one by one; other columns are not read. An empty table gives no row.
    """
    placed, total = running(curve_order(docs, bits), ["curve", "text_crc32", "size", "doc_id"])
    small, extra = divmod(total, count)
    wide = (small + 1) * extra
    at = F.col("before")
    late = F.lit(extra) + F.floor((at - wide) / F.lit(max(small, 1)))
    shard = F.when(at < wide, F.floor(at / F.lit(small + 1))).otherwise(late).cast("int")
    start = F.col("shard") * small + F.least(F.col("shard"), F.lit(extra))
    return placed.withColumn("shard", shard).withColumn("slot", (at - start).cast("long"))


def write_shards(docs: DataFrame, path: str, count: int = 24, bits: int = BITS) -> DataFrame:
    """Write whole documents as one folder per shard, in curve order; returns each shard's pruning ranges.

    Columns named shard or slot are replaced. Rows that share id and text take one of their places together.
    """
    plan = stored(shards(docs, count, bits), "plan")
    keys = plan.select(F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_crc"), "shard", "slot").dropDuplicates(["_id", "_crc"])
    own = docs.drop("shard", "slot")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    placed = own.join(keys, F.col("doc_id").eqNullSafe(F.col("_id")) & crc.eqNullSafe(F.col("_crc"))).drop("_id", "_crc")
    placed.repartitionByRange(count, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    ranges = [f(c).alias(f"{f.__name__}_{c}") for c in DIMENSIONS for f in (F.min, F.max)]
    return plan.groupBy("shard").agg(F.count("*").alias("rows"), *ranges)
