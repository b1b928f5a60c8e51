"""What stands between a build and its publication: sources, checks, drift against what was pinned, and the citation."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsounder.build.pipeline import BuildError, licence_gate
from netsounder.sources.ledger import drift


@dataclass(frozen=True)
class Source:
    name: str
    url: str
    licence: str
    open: bool
    permitted: bool
    digest: str = ""


class Sources:
    """Declared sources by name; asking for another is an error."""

    def __init__(self, declared: list[Source]) -> None:
        self.by_name = {s.name: s for s in declared}
        if len(self.by_name) < len(declared):
            raise BuildError("a source is declared twice")

    def get(self, name: str) -> Source:
        if name not in self.by_name:
            raise BuildError(f"source {name} is not declared")
        return self.by_name[name]

    def digest(self) -> str:
        """One digest of all that is declared, whatever its order."""
        return hashlib.sha256(json.dumps({k: asdict(v) for k, v in self.by_name.items()}, sort_keys=True).encode()).hexdigest()

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(s.name, s.url, s.licence, s.open, s.permitted, s.digest) for s in self.by_name.values()]
        return spark.createDataFrame(rows, "source string, url string, licence string, open boolean, permitted boolean, digest string")


def checked(spark: SparkSession, checks: dict[str, Callable[[], bool | None]]) -> DataFrame:
    """``(check, passed, why)`` of every check, each a call that returns false or raises where it fails.

    All are run before any failure is raised; a list in which nothing passed is a failure too.
    """
    rows = []
    for name, check in checks.items():
        try:
            rows.append((name, check() is not False, ""))
        except Exception as e:  # noqa: BLE001 -- a check may fail in any way, and the report names it
            rows.append((name, False, f"{type(e).__name__}: {e}"[:500]))
    failed = [r[0] for r in rows if not r[1]]
    if failed or not rows:
        raise BuildError(f"checks failed: {', '.join(failed)}" if failed else "no check passed")
    return spark.createDataFrame(rows, "check string, passed boolean, why string")


def table_digest(df: DataFrame) -> DataFrame:
    """One row ``(rows, digest)`` that no order of rows or columns changes: the sum of the rows' hashes."""
    row = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in sorted(df.columns)])
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest"))


def assets(layers: dict[str, DataFrame]) -> DataFrame:
    """``(name, rows, digest)`` of the layers of a release."""
    out = None
    for name, df in sorted(layers.items()):
        one = table_digest(df).select(F.lit(name).alias("name"), "rows", "digest")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise BuildError("a release without layers")
    return out


def release(layers: dict[str, DataFrame], pinned: DataFrame | None, used: DataFrame, sources: Sources, version: str) -> tuple[DataFrame, str]:
    """The asset list and the citation of a release, or why there is none: a licence, an empty layer, or drift from ``pinned(name, digest)``."""
    spark = used.sparkSession
    licence_gate(used, sources.table(spark))
    listed = spark.createDataFrame(assets(layers).collect(), "name string, rows long, digest string")
    empty = [r["name"] for r in listed.where("rows = 0").collect()]
    if empty:
        raise BuildError(f"empty layers: {', '.join(empty)}")
    if pinned is not None:
        off = drift(pinned, listed, "name", "digest").orderBy("name").collect()
        if off:
            raise BuildError("drift: " + ", ".join(f"{r['name']} {r['drift']}" for r in off))
    named = sorted(r[0] for r in used.select("source").distinct().collect())
    credit = "; ".join(f"{n} ({sources.get(n).licence})" for n in named)
    return listed, f"Version {version}. Contains {credit}."
