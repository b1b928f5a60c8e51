"""Identifiers that are pure functions of what they name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX = "ns"


def coordinate(x: Column) -> Column:
    """Three decimals as text."""
    return F.format_string("%.3f", x)


def digest(kind: str, payload: Column, digits: int = 12) -> Column:
    """``ns:kind/`` and the head of SHA-256 over kind and payload."""
    whole = F.sha2(F.concat(F.lit(f"{kind}|"), payload).cast("binary"), 256)
    return F.concat(F.lit(f"{PREFIX}:{kind}/"), F.substring(whole, 1, digits))


def publisher(kind: str, key: Column) -> Column:
    return F.concat(F.lit(f"src:{kind}/"), key.cast("string"))


def publisher_key(identifier: Column) -> Column:
    """The publisher's own key, null for identifiers made here."""
    return F.when(identifier.startswith("src:"), F.substring_index(identifier, "/", -1))


def point(x: Column, y: Column, kind: str = "node") -> Column:
    return digest(kind, F.concat_ws(",", coordinate(x), coordinate(y)))


def line(pts: Column, kind: str = "link") -> Column:
    """The same for a line and its reverse: ``pts`` is an array of structs (x, y)."""
    as_text = F.transform(pts, lambda p: F.concat_ws(",", coordinate(p["x"]), coordinate(p["y"])))
    forward, backward = F.array_join(as_text, ";"), F.array_join(F.reverse(as_text), ";")
    return digest(kind, F.least(forward, backward))


def derived(parent: Column, ordinal: Column, kind: str = "link") -> Column:
    """A child's identifier from its parent's and its place."""
    return digest(kind, F.concat_ws("#", parent, ordinal.cast("string")))


def correction(payload: Column) -> Column:
    return digest("correction", payload, 10)
