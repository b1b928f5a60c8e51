"""Digests of what was read: manifests, verification against a ledger, drift between two states."""

from __future__ import annotations

import io
import tarfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest(files: DataFrame) -> DataFrame:
    """One row: SHA-256 over the sorted ``name:sha256`` lines of ``files(name, sha256)``."""
    lines = F.array_sort(F.collect_list(F.concat_ws(":", "name", "sha256")))
    return files.agg(F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("manifest"))


def verification(declared: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """``verified``, ``MISMATCH`` or ``unverified`` for each declared source."""
    found = seen.select(key, F.col("digest").alias("_seen"))
    status = F.when(F.col("_seen").isNull(), "unverified").when(F.col("_seen") == F.col("digest"), "verified").otherwise("MISMATCH")
    return declared.join(found, key, "left").select(key, status.alias("status"))


def drift(published: DataFrame, now: DataFrame, key: str, digest: str) -> DataFrame:
    """Rows that are missing, extra or changed against what was published."""
    a = published.select(key, F.col(digest).alias("_a"), F.lit(True).alias("_in_a"))
    b = now.select(key, F.col(digest).alias("_b"), F.lit(True).alias("_in_b"))
    kind = F.when(F.col("_in_b").isNull(), "missing").when(F.col("_in_a").isNull(), "extra").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return a.join(b, key, "full").select(key, kind.alias("drift")).where("drift is not null")


def resolution(declared: DataFrame, answers: DataFrame) -> DataFrame:
    """``(source, url, verdict)`` of ``declared(source, url)`` against ``answers(url, status)`` that a fetcher brought.

    A source without an address, an address that is no web address, and one nobody asked are told apart
    from refusals, so that silence is never read as success.
    """
    met = declared.join(answers.groupBy("url").agg(F.max("status").alias("status")), "url", "left")
    code = F.col("status")
    verdict = (
        F.when(F.trim(F.coalesce("url", F.lit(""))) == "", "no address").when(~F.col("url").rlike("(?i)^https?://[^/]+"), "not a web address")
        .when(code.isNull(), "not asked").when(code.between(200, 299), "resolves").when(code.between(300, 399), "moved").otherwise(F.concat(F.lit("refused "), code.cast("string")))
    )
    return met.select("source", "url", verdict.alias("verdict"))


def packed(files: DataFrame, pinned: DataFrame, out: io.BufferedIOBase) -> int:
    """A tar of ``files(name, content)`` by ``pinned(name, sha256)`` in order of name, each with the same clock; returns their number.

    A file that is missing or whose digest drifted is refused before anything is written. Files stream through
    the driver one partition at a time.
    """
    seen = files.select("name", F.sha2("content", 256).alias("sha256"))
    off = [r for r in drift(pinned, seen, "name", "sha256").where("drift <> 'extra'").limit(5).collect()]
    if off:
        raise ValueError("not as pinned: " + ", ".join(f"{r['name']} is {r['drift']}" for r in off))
    n = 0
    with tarfile.open(fileobj=out, mode="w|", format=tarfile.PAX_FORMAT) as tar:
        for row in files.join(pinned.select("name"), "name", "left_semi").orderBy("name").toLocalIterator():
            info = tarfile.TarInfo(row["name"])
            info.size = len(row["content"])
            tar.addfile(info, io.BytesIO(row["content"]))
            n += 1
    return n
