"""Distributed running sums over a total order: no task sees more than its range."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsounder.session import stored

_ROW_BITS = 33


def running(df: DataFrame, order: list, weight: str | None = None, kind: str = "long") -> tuple[DataFrame, int | float]:
    """``df`` with ``before``, the sum of ``weight`` (or count of rows) ahead of each row, and the grand total.

    ``order`` must end in columns that break ties, or equal rows take any order.
    Rows are range-partitioned once and kept in the shared folder; what reaches
    the driver is one number per range. ``kind`` is the type of the sums.
    """
    spark = df.sparkSession
    placed = stored(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()),
        "ordered",
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS).cast("int"))
    amount = F.lit(1) if weight is None else F.col(weight)
    parts = sorted(placed.groupBy("_part").agg(F.sum(amount).cast(kind)).collect())
    starts, total = [], 0 if kind == "long" else 0.0
    for part, n in parts:
        starts.append((part, total))
        total += n or 0
    base = spark.createDataFrame(starts, f"_part int, _base {kind}")
    if weight is None:
        ahead = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    else:
        inside = Window.partitionBy("_part").orderBy("_at")
        ahead = F.sum(weight).over(inside) - F.col(weight)
    placed = placed.join(base, "_part").withColumn("before", (F.col("_base") + ahead).cast(kind))
    return placed.drop("_at", "_part", "_base"), total
