"""Benchmark decontamination by an FM-index over each shard of training text.

A shard is a run of documents of one task, read as words. Words that no test
phrase has can be in no occurrence, so they become separators; each maximal
run of the others is indexed, whatever its length down to that of the
shortest phrase. The index is the Burrows-Wheeler transform of the runs in a
wavelet matrix, from a suffix array by prefix doubling. All phrases are
searched backwards together through the matrix's ranks, their rows walked to
sampled suffix positions, and the spans found merged by document.

The benchmark reaches the tasks in blocks of bounded size, each of which meets
all documents; documents never move.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words in a test phrase; shorter items are one phrase.
WINDOW = 10
#: Words indexed at a time; a run of half as many is cut into pieces that overlap by a phrase.
SHARD_WORDS = 1 << 20
#: Bytes of a text that are read into words at a time.
SLICE_BYTES = 1 << 22
#: Every so many positions of a run one suffix position is kept.
SAMPLE = 16
#: Characters of benchmark text that tasks receive at a time.
BLOCK_CHARS = 16_000_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    """ASCII letters, digits and all non-ASCII characters make words; A-Z are lowered."""
    return _WORD.findall((text or b"").lower())


_GAP = re.compile(rb"[^0-9a-zA-Z\x80-\xff]")


def symbols_of(text: bytes | None, symbol: dict[bytes, int]) -> np.ndarray:
    """The words of a text as symbols, 0 where ``symbol`` has none; long texts are read slice by slice."""
    raw, at, parts = text or b"", 0, []
    while at < len(raw):
        gap = _GAP.search(raw, at + SLICE_BYTES)
        to = gap.start() if gap else len(raw)
        found = words(raw[at:to])
        parts.append(np.fromiter((symbol.get(w, 0) for w in found), np.int32, len(found)))
        at = to
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Rows in suffix order. Zeros are separators, each less than any word and than later separators."""
    n = len(symbols)
    if n > 1 << 21:
        raise ValueError("three ranks of more than 2**21 symbols do not fit one key")
    zero = symbols == 0
    rank = np.where(zero, np.cumsum(zero) - 1, symbols.astype(np.int64) + zero.sum())
    _, rank = np.unique(rank, return_inverse=True)
    wide = np.concatenate([rank, np.zeros(2, np.int64)])
    key = wide[:n] << 42 | wide[1 : n + 1] << 21 | wide[2:]
    rows = np.argsort(key, kind="stable")
    key = key[rows]
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[rows] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    tied = np.flatnonzero(~(fresh & np.concatenate([fresh[1:], [True]])))
    step = 3
    while len(tied):
        own = rows[tied]
        key = rank[own] << 32 | (rank[np.minimum(own + step, n)] + 1)
        order = np.argsort(key, kind="stable")
        own, key = own[order], key[order]
        rows[tied] = own
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        rank[own] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(own)), 0))]
        tied = tied[~(fresh & np.concatenate([fresh[1:], [True]]))]
        step *= 2
    return rows


class FMIndex:
    """Counts and positions of phrases in symbols whose zeros separate runs."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE) -> None:
        """``symbols`` must end in a zero."""
        n = self.n = len(symbols)
        rows = suffix_array(symbols)
        before = symbols[rows - 1]
        before[rows == 0] = 0
        self.top = int(symbols.max(initial=0))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=self.top + 1))])
        kept = (before == 0) | (rows % sample == 0)
        self.kept, self.position = kept, rows[kept]
        self.kept_rank = np.cumsum(kept) - kept
        self.levels: list[tuple[int, np.ndarray, int]] = []
        current = before
        for bit in range(max(1, self.top.bit_length()) - 1, -1, -1):
            one = (current >> bit & 1).astype(bool)
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            self.levels.append((bit, ones, n - int(ones[-1])))
            current = np.concatenate([current[~one], current[one]])
        every = np.arange(self.top + 1)
        self.begin = self._descend(every, np.zeros(len(every), np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, ones, zeros in self.levels:
            up = ones[at]
            at = np.where(symbol >> bit & 1, zeros + up, at - up)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols of the transform are ``symbol``."""
        return self._descend(symbol, at) - self.begin[symbol]

    def search(self, phrases: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases, given aligned to the right of ``phrases``; empty where absent."""
        last = phrases[:, -1].astype(np.int64)
        known = (last > 0) & (last <= self.top)
        safe = np.where(known, last, 0)
        low = np.where(known, self.first[safe], 0)
        high = np.where(known, self.first[safe + 1], 0)
        for back in range(2, phrases.shape[1] + 1):
            k = np.flatnonzero((size >= back) & (low < high))
            if not len(k):
                break
            symbol = phrases[k, -back].astype(np.int64)
            fits = symbol <= self.top
            symbol = np.where(fits, symbol, 0)
            base = self.first[symbol]
            low[k], high[k] = (
                np.where(fits, base + self.rank(symbol, low[k]), 0),
                np.where(fits, base + self.rank(symbol, high[k]), 0),
            )
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes, each walked back to a sampled one."""
        out = np.zeros(len(rows), np.int64)
        open_, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(open_):
            hit = self.kept[at]
            out[open_[hit]] = self.position[self.kept_rank[at[hit]]] + steps
            open_, at = open_[~hit], at[~hit]
            symbol, down = np.zeros(len(at), np.int64), at
            for bit, ones, zeros in self.levels:
                up = ones[down]
                one = ones[down + 1] > up
                symbol |= one.astype(np.int64) << bit
                down = np.where(one, zeros + up, down - up)
            at = self.first[symbol] + down - self.begin[symbol]
            steps += 1
        return out


class Phrases:
    """Test phrases of a block of items, as symbols of their own vocabulary."""

    def __init__(self, items: list[tuple[int | None, bytes]], window: int = WINDOW) -> None:
        found: dict[tuple, set] = {}
        for item, text in items:
            w = words(text)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                found.setdefault(tuple(w[i : i + window]), set()).add(item)
        self.symbol = {w: i + 1 for i, w in enumerate(sorted({w for p in found for w in p}))}
        self.size = np.array([len(p) for p in found], np.int64)
        self.phrases = np.zeros((len(found), window), np.int64)
        for k, p in enumerate(found):
            self.phrases[k, window - len(p) :] = [self.symbol[w] for w in p]
        self.items = [sorted(x for x in named if x is not None) for named in found.values()]
        self.shortest = int(self.size.min(initial=window))


def _runs(ids: np.ndarray, shortest: int, window: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all runs without zeros of at least ``shortest``; longer ones than ``most`` in overlapping pieces."""
    turn = np.diff(np.concatenate([[0], ids != 0, [0]]).astype(np.int8))
    begin, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    long = end - begin >= shortest
    begin, end = begin[long], end[long]
    step = most - window + 1
    pieces = np.maximum(1, -(-(end - begin - window + 1) // step))
    if len(pieces) and pieces.max() > 1:
        which = np.repeat(np.arange(len(begin)), pieces)
        k = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, end = begin[which] + k * step, end[which]
        end = np.minimum(end, begin + most)
    return begin, end


def occurrences(texts: list[np.ndarray], phrases: Phrases, shard_words: int = SHARD_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, first word, phrase)`` of every occurrence in texts given as symbols."""
    none = (np.zeros(0, np.int64),) * 3
    if not len(phrases.size) or not texts:
        return none
    gap = np.zeros(1, np.int32)
    ids = np.concatenate([x for t in texts for x in (t, gap)])
    starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    window = phrases.phrases.shape[1]
    begin, end = _runs(ids, phrases.shortest, window, max(2 * window, shard_words // 2))
    if not len(begin):
        return none
    found = []
    size = end - begin + 1
    group = np.cumsum(size) // shard_words
    edges = np.flatnonzero(np.diff(group, prepend=-1))
    for lo, hi in zip(edges, [*edges[1:], len(begin)], strict=True):
        n = size[lo:hi]
        source = np.repeat(begin[lo:hi] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        symbols = ids[source].astype(np.int64)
        symbols[np.cumsum(n) - 1] = 0
        index = FMIndex(symbols)
        low, high = index.search(phrases.phrases, phrases.size)
        times = high - low
        k = np.flatnonzero(times > 0)
        times = times[k]
        rows = np.repeat(low[k] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        if len(rows):
            found.append(np.stack([source[index.locate(rows)], np.repeat(k, times)]))
    if not found:
        return none
    # a phrase inside an overlap is found in both pieces
    position, phrase = np.unique(np.concatenate(found, axis=1), axis=1)
    doc = np.searchsorted(starts, position, side="right") - 1
    return doc, position - starts[doc], phrase


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that overlap or touch, made one."""
    order = np.lexsort((end, start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    far = int(end.max()) + 2
    reach = np.maximum.accumulate(doc * far + end)
    fresh = np.concatenate([[True], doc[1:] * far + start[1:] > reach[:-1]])
    at = np.flatnonzero(fresh)
    return doc[at], start[at], reach[np.concatenate([at[1:], [len(doc)]]) - 1] - doc[at] * far


_SCHEMA = "row long, doc_id long, n_words long, starts array<long>, ends array<long>, items array<long>"


def _scan(docs: DataFrame, phrases: Phrases) -> DataFrame:
    def search(held: list[tuple]) -> pa.RecordBatch:
        texts = [w for _, _, w in held]
        doc, first, phrase = occurrences(texts, phrases)
        named = [set() for _ in held]
        for d, p in np.unique(np.stack([doc, phrase]), axis=1).T.tolist():
            named[d].update(phrases.items[p])
        d, s, e = merged(doc, first, first + phrases.size[phrase])
        edge = np.searchsorted(d, np.arange(len(held) + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(edge, pa.array(x)) for x in (s, e)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in held], pa.int64()), pa.array([x[1] for x in held], pa.int64()),
                pa.array([len(w) for w in texts], pa.int64()), *lists,
                pa.array([sorted(x) for x in named], pa.list_(pa.int64())),
            ],
            ["row", "doc_id", "n_words", "starts", "ends", "items"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for row, doc, text in zip(*(batch.column(k) for k in range(3)), strict=True):
                w = symbols_of(text.as_py(), phrases.symbol)
                held.append((row.as_py(), doc.as_py(), w))
                n += len(w)
                if n >= SHARD_WORDS:
                    yield search(held)
                    held, n = [], 0
        if held:
            yield search(held)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, _SCHEMA)


def _united(found: DataFrame) -> DataFrame:
    """Spans and items of each document over several blocks of the benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(6)]
            starts, ends = [], []
            for s, e in zip(cols[3], cols[4], strict=True):
                s, e = np.array(s, np.int64), np.array(e, np.int64)
                _, s, e = merged(np.zeros(len(s), np.int64), s, e)
                starts.append(s.tolist())
                ends.append(e.tolist())
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 3
            cols = [*cols[:3], starts, ends, [sorted(set(x)) for x in cols[5]]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], batch.schema.names)

    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")]
    grouped = found.groupBy("row", "doc_id", "n_words").agg(*lists)
    return grouped.mapInArrow(run, _SCHEMA)


def _blocks(benchmark: DataFrame, window: int, block_chars: int) -> Iterator[Phrases]:
    """The benchmark's phrases, one block of bounded size after the other."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // block_chars) or 1
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield Phrases([(i, t.encode()) for i, t in part.collect()], window)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(doc_id, n_words, starts, ends, items)`` of each row of ``docs``.

    ``starts`` and ``ends`` are the merged spans, in words, of all occurrences of
    the benchmark's phrases; ``items`` the ids of items with an occurring phrase.
    Null and empty texts have no words and no phrases; items without an id mark
    words but are not named; repeated rows each come back. With an empty
    benchmark every document is clean.
    """
    found, blocks = None, 0
    for own in _blocks(benchmark, window, block_chars):
        scan = _scan(docs, own)
        found, blocks = scan if found is None else found.unionByName(scan), blocks + 1
    if blocks > 1:
        found = _united(found)
    return found.drop("row")


def digests(found: DataFrame) -> DataFrame:
    """Counts and the item digest of each document of :func:`contamination`."""
    n_hit = F.expr("aggregate(zip_with(starts, ends, (s, e) -> e - s), 0L, (a, x) -> a + x)")
    names = F.expr("array_sort(transform(items, i -> cast(i as string)))")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names).cast("binary"), 256).alias("items_sha256"), (F.size("starts") > 0).alias("contaminated"),
    )


def _without(docs: DataFrame, phrases: Phrases) -> DataFrame:
    at = docs.columns.index("text")

    def search(held: list[tuple[pa.RecordBatch, list[np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        keep = np.ones(sum(len(w) for _, w in held), bool)
        keep[occurrences([x for _, w in held for x in w], phrases)[0]] = False
        done = 0
        for batch, w in held:
            yield batch.filter(pa.array(keep[done : done + len(w)]))
            done += len(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            begun = 0
            w: list[np.ndarray] = []
            for k, text in enumerate(texts):
                w.append(symbols_of(text.as_py(), phrases.symbol))
                n += len(w[-1])
                if n >= SHARD_WORDS or k + 1 == batch.num_rows:
                    held.append((batch.slice(begun, k + 1 - begun), w))
                    begun, w = k + 1, []
                if n >= SHARD_WORDS:
                    yield from search(held)
                    held, n = [], 0
        if held:
            yield from search(held)

    return docs.mapInArrow(run, docs.schema)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows of ``docs`` that hold no phrase of the benchmark, with all their columns.

    Each row is judged by its own text in the pass that reads it, so rows without an id and rows that
    share one are decided one by one. Null and empty texts hold nothing and stay; with an empty
    benchmark all rows stay; an empty table gives no row.
    """
    for own in _blocks(benchmark, window, block_chars):
        docs = _without(docs, own)
    return docs


def removed(text: bytes | None, starts: list[int], ends: list[int]) -> bytes:
    """``text`` without the characters from the first to the last word of each span."""
    at = [m.span() for m in _WORD.finditer((text or b"").lower())]
    out, done = [], 0
    for s, e in zip(starts, ends, strict=True):
        out.append((text or b"")[done : at[s][0]])
        done = at[e - 1][1]
    return b"".join([*out, (text or b"")[done:]])
