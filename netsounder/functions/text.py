"""Text classes and tokens as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_word(text: Column) -> Column:
    """The last run of letters a to z, lowered; null or empty where there is none."""
    return F.regexp_extract(F.lower(text), "([a-z]+)[^a-z]*$", 1)


def classes(text: Column, patterns: dict[str, str]) -> Column:
    """A struct of booleans: which named patterns the text has."""
    return F.struct(*[F.coalesce(text.rlike(p), F.lit(False)).alias(k) for k, p in patterns.items()])
