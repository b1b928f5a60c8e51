"""Relational operators that the network stages share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsounder.operators.ordering import running


def oriented(links: DataFrame, direction: str, start: str, end: str, against: Iterable[str], along: Iterable[str]) -> DataFrame:
    """``from_node``/``to_node`` by a direction word; ``direction_known`` is false for words of neither kind."""
    word = F.lower(F.trim(F.coalesce(F.col(direction), F.lit(""))))
    back = word.isin(list(against))
    return links.withColumns(
        {
            "from_node": F.when(back, F.col(end)).otherwise(F.col(start)),
            "to_node": F.when(back, F.col(start)).otherwise(F.col(end)),
            "direction_known": back | word.isin(list(along)),
        }
    )


def banded(value: Column, weak: float, clear: float) -> Column:
    """Five bands of a fall around two thresholds, and one for no reading."""
    return (
        F.when(value.isNull(), "no reading")
        .when(value > clear, "clear rise")
        .when(value > weak, "weak rise")
        .when(value >= -weak, "flat")
        .when(value >= -clear, "weak fall")
        .otherwise("clear fall")
    )


def histogram(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """One row: counts in ``<= e0``, ``(e0, e1]``, ..., and beyond or null."""
    aggs, low = [], None
    for i, e in enumerate(edges):
        inside = F.col(value) <= e if low is None else (F.col(value) > low) & (F.col(value) <= e)
        aggs.append(F.count_if(inside).alias(f"band_{i}"))
        low = e
    aggs.append(F.count_if((F.col(value) > low) | F.col(value).isNull()).alias("beyond"))
    return df.agg(*aggs)


def first_by(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def most_common(df: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """The modal value of each key; ties go to the least value."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).count()
    return first_by(counts, keys, [F.desc("count"), F.asc(value)]).select(*keys, F.col(value).alias(alias))


def unchanged_count(before: DataFrame, after: DataFrame) -> DataFrame:
    """``after``, or an error where a chain of left joins changed the number of rows."""
    n, m = before.count(), after.count()
    if n != m:
        raise ValueError(f"a left join made {m} rows of {n}")
    return after


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with rows of the same key replaced by those of ``new``."""
    return old.join(new, keys, "left_anti").unionByName(new)


def refused(df: DataFrame, bad: Column, message: str) -> DataFrame:
    """``df`` whose evaluation fails on the first row for which ``bad`` holds."""
    return df.where(F.when(bad, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True)))


def share(part: Column, whole: Column) -> Column:
    """A ratio, null where the whole is zero."""
    return part / F.nullif(whole, F.lit(0.0))


def floored_share(value: Column) -> Column:
    """A share as text, floored to a tenth of a percent: 100 % only when it is all."""
    return F.when(value >= 1, F.lit("100%")).otherwise(F.format_string("%.1f%%", F.floor(value * 1000) / 10))


def running_share(df: DataFrame, value: str, order: list[Column]) -> DataFrame:
    """``cum_share``: the part of the total that a row and those ahead of it hold; ``order`` must break all ties."""
    placed, total = running(df, order, value, "double")
    return placed.withColumn("cum_share", (F.col("before") + F.col(value)) / F.lit(total or None)).drop("before")


def plain_name(name: str) -> Column:
    """A name without case and outer blanks, null where nothing is left: what :func:`same_name` compares, made once a row."""
    return F.nullif(F.lower(F.trim(F.col(name))), F.lit(""))


def same_name(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Whether any plain name of one pair equals any of another."""
    out = F.lit(False)
    for x in a:
        for y in b:
            out = out | F.coalesce(F.col(x) == F.col(y), F.lit(False))
    return out


def conflicting_name(a: str, b: str) -> Column:
    """Both plain names given, and not the same."""
    return F.coalesce(F.col(a) != F.col(b), F.lit(False))


def padded_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def without_nan(df: DataFrame) -> DataFrame:
    """``df``, failing on evaluation where a double is NaN or infinite: JSON has no word for it."""
    doubles = [c for c, t in df.dtypes if t in ("double", "float")]
    bad = F.lit(False)
    for c in doubles:
        bad = bad | F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
    return refused(df, F.coalesce(bad, F.lit(False)), "a measure is not a number") if doubles else df
