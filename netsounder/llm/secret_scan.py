"""Secrets in texts: assignment, access-key and hex patterns, and the token-efficiency test.

A vocabulary learned from prose packs several characters of a word into one
token but needs one for about every two characters of a random string. Runs of
key characters, or parts of them between ``/``, ``=``, ``_``, ``+`` and ``-``, that fall to
``MOST_CHARS`` characters a token or fewer are spans of kind ``random``, unless they
are known digests (hex of a digest's length) or identifiers (UUIDs, plain
numbers). Words in capitals are packed badly, so a run's lower-cased form must
fail too. Below ``LONG_RUN`` characters a ratio says little: such runs count down to
``LEAST_RUN`` where they mix cases or digits and fall to ``MOST_SHORT``.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
MOST_CHARS = 2.0
LONG_RUN = 16
MOST_SHORT = 1.5
LEAST_RUN = 12

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_RUN)
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_PART = re.compile(r"[A-Za-z0-9]{%d,}" % LEAST_RUN)
#: Lengths in hex digits of common digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
_DIGESTS = frozenset((32, 40, 56, 64, 96, 128))


@cache
def encoding(path: str):
    """The tiktoken encoding of a rank file of the public tokenizers."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _known(run: str) -> bool:
    """Digests, UUIDs and numbers."""
    bare = run.strip("=-_+/")
    if _UUID.fullmatch(bare) or not re.search("[A-Za-z]", bare):
        return True
    return len(bare) in _DIGESTS and re.fullmatch(r"[0-9a-fA-F]+", bare) is not None


def _random(run: str, ranks: str) -> bool:
    """Whether the vocabulary packs few characters of ``run`` into a token, as written and in small letters."""
    if len(run) < LONG_RUN:
        kinds = any(c.islower() for c in run) + any(c.isupper() for c in run) + any(c.isdigit() for c in run)
        if kinds < 2:
            return False
    most = MOST_CHARS if len(run) >= LONG_RUN else MOST_SHORT
    encode = encoding(ranks).encode_ordinary
    return len(run) <= most * len(encode(run)) and (run.islower() or len(run) <= MOST_CHARS * len(encode(run.lower())))


def random_runs(text: str, ranks: str) -> Iterator[tuple[int, int]]:
    """Places of the runs, else of their parts, that fail the token-efficiency test; a run that holds a known part is not tested whole."""
    for m in _RUN.finditer(text):
        run, at = m[0], m.start()
        if _known(run):
            continue
        parts = [x.span() for x in _PART.finditer(run)]
        known = [x.span() for x in _UUID.finditer(run)] + [(s, e) for s, e in parts if _known(run[s:e])]
        if not known and _random(run, ranks):
            yield m.span()
            continue
        for s, e in parts:
            if e - s < len(run) and not any(a < e and s < b for a, b in known) and _random(run[s:e], ranks):
                yield at + s, at + e


def spans(text: str, ranks: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by start, then kind as listed; code points, end exclusive."""
    found = []
    for m in _ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 6:
            found.append((0, *m.span()))
    if "AKIA" in text:
        found += [(1, *m.span()) for m in _ACCESS.finditer(text)]
    found += [(2, *m.span()) for m in _HEX.finditer(text)]
    base = list(found)
    found += [(3, *x) for x in random_runs(text, ranks) if not any(s <= x[0] and x[1] <= e for _, s, e in base)]
    return [(KINDS[k], s, e) for s, k, e in sorted((s, k, e) for k, s, e in found)]


def _joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def scan(docs: DataFrame, ranks: str) -> DataFrame:
    """Counts, digest and spans of each row of ``docs``.

    Null texts count as empty and have no span; repeated rows each come back;
    other columns are not read. Works row by row on whole texts.
    """
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names[1:]]
            for text in batch.column(1):
                found = spans(text.as_py() or "", ranks)
                base = [x for x in found if x[0] != "random"]
                counts = [sum(x[0] == k for x in found) for k in KINDS]
                row = (*counts[:3], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found), counts[3])
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            cols = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    )
