"""Token ids in a static range-ANS file format, written and read in parallel.

A segment is the unit of the format: some million ids of whole documents in
document order, one frequency table shared by all of its blocks, and blocks of
whole documents that decode independently. In a block, ``LANES`` coders take
turns over the ids and share one word stream; every ``CHECKPOINT`` turns the
lanes' states and the stream position are noted, so that each stretch between
two notes decodes on its own too. Blocks and ids carry CRC-32 sums. Segments
are rows of an uncompressed Parquet table, written through Spark's commit
protocol to any store; a lost executor repeats its own segments only.

Segment layout, little-endian: magic ``NSRA``, then sections, each a 64-bit
length and its bytes: header (6 uint64: version, scale bits, lanes, checkpoint
turns, documents, ids), symbols and frequencies (uint32, zlib), document ids
(int64, zlib), document lengths (uint32, zlib), block table (6 uint64 each:
first document, first id, ids, first word, words, CRC-32 of words and ids
packed), checkpoint positions (uint32), checkpoint states (uint64), words.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAGIC = b"NSRA"
VERSION = 1
LANES = 64
CHECKPOINT = 512
BLOCK_IDS = 1 << 16
SEGMENT_IDS = 1 << 21
#: Distinct chunks of text whose ids a Python worker remembers.
MEMO = 1_000_000
#: Bytes of text tokenised at a time.
SLICE = 1 << 23
_LOW = 1 << 31
_NO_ID = -(1 << 63)
_MARKS = ".,;:!?"
_LATIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
_CORE = "^[^.,;:!?]+"


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols, their frequencies scaled to a power of two (each at least 1), and its exponent."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    bits = min(24, max(12, int(np.ceil(np.log2(max(1, len(symbols))))) + 3))
    whole = 1 << bits
    scaled = np.maximum(1, counts * whole // max(1, counts.sum())).astype(np.int64)
    order = np.argsort(-scaled, kind="stable")
    rest = whole - int(scaled.sum())
    if rest > 0 and len(order):
        scaled[order[0]] += rest
    for k in order:
        if rest >= 0:
            break
        cut = min(-rest, int(scaled[k]) - 1)
        scaled[k] -= cut
        rest += cut
    return symbols.astype(np.uint32), scaled.astype(np.uint32), bits


def _blocks(lengths: np.ndarray) -> np.ndarray:
    """First document of each block."""
    ends = np.cumsum(lengths)
    starts, at = [0], 0
    while True:
        nxt = int(np.searchsorted(ends, at + BLOCK_IDS)) + 1
        if nxt >= len(lengths):
            return np.array(starts, np.int64)
        starts.append(nxt)
        at = int(ends[nxt - 1])


def encode_segment(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    symbols, freq, bits = frequencies(ids)
    place = np.zeros(int(symbols.max(initial=0)) + 1, np.uint32)
    place[symbols] = np.arange(len(symbols))
    code = place[ids]
    cum = np.concatenate([[0], np.cumsum(freq[:-1], dtype=np.uint64)]).astype(np.uint64) if len(freq) else np.zeros(0, np.uint64)
    wide = freq.astype(np.uint64)
    edge = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    first_doc = _blocks(lengths) if len(lengths) else np.zeros(0, np.int64)
    start = edge[first_doc]
    size = np.diff(np.concatenate([start, [len(ids)]]))
    turns = -(-size // LANES)
    order = np.argsort(-turns, kind="stable")
    s_start, s_size, s_turns = start[order], size[order], turns[order]
    state = np.full((len(order), LANES), _LOW, np.uint64)
    lane = np.arange(LANES)
    marks = np.concatenate([[0], np.cumsum(-(-s_turns // CHECKPOINT))]).astype(np.int64)
    mark_state = np.zeros((marks[-1], LANES), np.uint64)
    said: list[np.ndarray] = []
    by_turn = np.zeros((int(turns.max(initial=0)), len(order)), np.int64)
    b_bits, limit = np.uint64(bits), np.uint64(63 - bits)
    for turn in range(len(by_turn) - 1, -1, -1):
        n = int(np.searchsorted(-s_turns, -turn, side="left"))
        at = turn * LANES + lane
        live = at[None, :] < s_size[:n, None]
        c = code[np.where(live, s_start[:n, None] + at, 0)]
        f, x = wide[c], state[:n]
        full = live & (x >= (f << limit))
        said.append((x[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        by_turn[turn, :n] = full.sum(1)
        x = np.where(full, x >> np.uint64(32), x)
        q, r = np.divmod(x, f)
        state[:n] = np.where(live, (q << b_bits) + r + cum[c], x)
        if turn % CHECKPOINT == 0:
            mark_state[marks[:n] + turn // CHECKPOINT] = state[:n]
    words = np.concatenate(said[::-1]) if said else np.zeros(0, np.uint32)
    owner = np.repeat(np.tile(np.arange(len(order)), len(by_turn)), by_turn.ravel())
    words = words[np.argsort(owner.astype(np.uint32), kind="stable")]
    per = by_turn.sum(0)
    w_start = np.concatenate([[0], np.cumsum(per)]).astype(np.int64)
    before = np.cumsum(by_turn, axis=0) - by_turn
    mark_at = np.concatenate([before[::CHECKPOINT][: -(-t // CHECKPOINT), b] for b, t in enumerate(s_turns)] or [np.zeros(0)])
    table = np.zeros((len(order), 6), np.uint64)
    for b in range(len(order)):
        own = words[w_start[b] : w_start[b + 1]]
        part = ids[s_start[b] : s_start[b] + s_size[b]]
        sums = zlib.crc32(own.tobytes()) << 32 | zlib.crc32(np.ascontiguousarray(part, "<u4").tobytes())
        table[b] = (first_doc[order[b]], s_start[b], s_size[b], w_start[b], per[b], sums)
    head = struct.pack("<6Q", VERSION, bits, LANES, CHECKPOINT, len(doc_ids), len(ids))
    sections = [
        head,
        zlib.compress(np.concatenate([np.diff(symbols, prepend=np.uint32(0)), freq]).astype("<u4").tobytes(), 6),
        zlib.compress(doc_ids.astype("<i8").tobytes(), 1),
        zlib.compress(lengths.astype("<u4").tobytes(), 1),
        table.astype("<u8").tobytes(),
        mark_at.astype("<u4").tobytes(),
        mark_state.astype("<u8").tobytes(),
        words.astype("<u4").tobytes(),
    ]
    return MAGIC + b"".join(struct.pack("<Q", len(s)) + s for s in sections)


def decode_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(doc_ids, lengths, ids)`` of a segment; raises ValueError where a checksum fails."""
    if data[:4] != MAGIC:
        raise ValueError("not a segment")
    sections, at = [], 4
    while at < len(data):
        (n,) = struct.unpack_from("<Q", data, at)
        sections.append(data[at + 8 : at + 8 + n])
        at += 8 + n
    head, model, docs, lens, table, mark_at, mark_state, words = sections
    version, bits, lanes, stretch, n_docs, n_ids = struct.unpack("<6Q", head)
    if version != VERSION:
        raise ValueError(f"segment version {version}")
    model = np.frombuffer(zlib.decompress(model), "<u4")
    symbols, freq = np.cumsum(model[: len(model) // 2], dtype=np.uint32), model[len(model) // 2 :].astype(np.uint64)
    cum = np.concatenate([[0], np.cumsum(freq)]).astype(np.uint64)[:-1]
    doc_ids, lengths = np.frombuffer(zlib.decompress(docs), "<i8"), np.frombuffer(zlib.decompress(lens), "<u4")
    table = np.frombuffer(table, "<u8").reshape(-1, 6)
    words = np.frombuffer(words, "<u4")
    ids = np.zeros(n_ids, np.uint32)
    if n_ids:
        slot_code = np.repeat(np.arange(len(symbols), dtype=np.uint32), freq.astype(np.int64))
        start, size, w_start = (table[:, k].astype(np.int64) for k in (1, 2, 3))
        turns = -(-size // lanes)
        marks = -(-turns // stretch)
        block = np.repeat(np.arange(len(table)), marks)
        step = np.arange(len(block)) - np.repeat(np.cumsum(marks) - marks, marks)
        mine = np.minimum(stretch, turns[block] - step * stretch)
        base = start[block] + step * stretch * lanes
        end = (start + size)[block]
        ptr = w_start[block] + np.frombuffer(mark_at, "<u4").astype(np.int64)
        state = np.frombuffer(mark_state, "<u8").reshape(-1, lanes).astype(np.uint64)
        order = np.argsort(-mine, kind="stable")
        mine, base, end, ptr, state = mine[order], base[order], end[order], ptr[order], state[order].copy()
        lane = np.arange(lanes)
        mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
        padded = np.append(words, np.uint32(0))
        for turn in range(int(mine[0])):
            n = int(np.searchsorted(-mine, -turn, side="left"))
            x = state[:n]
            at = base[:n, None] + turn * lanes + lane
            live = at < end[:n, None]
            slot = x & mask
            c = slot_code[slot]
            nxt = freq[c] * (x >> shift) + slot - cum[c]
            empty = live & (nxt < _LOW)
            took = np.cumsum(empty, axis=1)
            word = padded[np.where(empty, ptr[:n, None] + took - 1, len(words))]
            nxt = np.where(empty, nxt << np.uint64(32) | word, nxt)
            state[:n] = np.where(live, nxt, x)
            ptr[:n] += took[:, -1]
            ids[at[live]] = symbols[c[live]]
    for first, at, n, w, m, sums in table.tolist():
        found = zlib.crc32(words[w : w + m].tobytes()) << 32 | zlib.crc32(ids[at : at + n].astype("<u4").tobytes())
        if found != sums:
            raise ValueError(f"checksum of the block at document {first} fails")
    return doc_ids, lengths, ids


class _Ids:
    """Ids of texts, remembered by chunk between blanks: no piece of the tokenizer spans a blank."""

    def __init__(self, path: str, end: int) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; idle threads would spin
        self.tokenizer, self.end = Tokenizer.from_file(path), end
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, k in vocabulary.items():
            self.closes[k] = piece.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        """Forget all but the end of a document, whose place a blank holds."""
        self.known, self.tails = pa.array([" "]), {}
        self.flat, self.size = np.array([self.end], np.uint32), np.ones(1, np.int32)
        self.start = np.zeros(1, np.int32)

    def _add(self, words: pa.Array, ids: list[np.ndarray], size: list[np.ndarray]) -> None:
        self.known = pa.concat_arrays([self.known, words])
        self.flat, self.size = np.concatenate([self.flat, *ids]), np.concatenate([self.size, *size])
        self.start = np.cumsum(self.size, dtype=np.int32) - self.size

    def _gather(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of remembered chunks in a row, and each one's number of them."""
        size = self.size[k]
        through = np.cumsum(size, dtype=np.int32)
        take = np.repeat(self.start[k] - (through - size), size)
        take += np.arange(len(take), dtype=np.int32)
        return self.flat[take], size

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _each(self, words: pa.Array) -> None:
        """Remember chunks of any kind, encoded one by one."""
        for at in range(0, len(words), 1 << 12):
            part = words.slice(at, 1 << 12)
            got = self._encoded(part.to_pylist())
            self._add(part, got, [np.array([len(x) for x in got], np.int32)])

    def _joined(self, words: pa.Array) -> None:
        """Remember chunks of one piece, whose last id alone closes a word: many go in one text."""
        flat, size = [], []
        for at in range(0, len(words), 1 << 14):
            part = words.slice(at, 1 << 14).to_pylist()
            ids = np.concatenate(self._encoded([" ".join(part[i : i + 512]) for i in range(0, len(part), 512)]))
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(part):
                each = self._encoded(part)
                ids, ends = np.concatenate(each), np.cumsum([len(x) for x in each])
            flat.append(ids)
            size.append(np.diff(ends, prepend=0).astype(np.int32))
        self._add(words, flat, size)

    def _learn(self, fresh: pa.Array, core: pa.Array, core_at: np.ndarray) -> np.ndarray:
        """Places of chunks that are new, given without the marks behind them too, and the places of those, -1 if new.

        Latin letters are one piece and marks behind them one more, so such a chunk is put together from the two.
        """
        base = len(self.known)
        latin = pc.match_substring_regex(core, _LATIN).to_numpy(zero_copy_only=False)
        marked = latin & (pc.binary_length(core).to_numpy() < pc.binary_length(fresh).to_numpy())
        self._joined(pc.unique(core.filter(pa.array(latin & (core_at < 0)))))
        self._each(fresh.filter(pa.array(~latin)))
        at = np.flatnonzero(marked)
        if len(at):
            tail = pc.replace_substring_regex(fresh.take(pa.array(at)), _CORE, "").dictionary_encode()
            for t in tail.dictionary.to_pylist():
                if t not in self.tails:
                    self.tails[t] = len(self.known)
                    self._each(pa.array([t]))
            tail_at = np.array([self.tails[t] for t in tail.dictionary.to_pylist()], np.int32)[tail.indices.to_numpy()]
            new = pc.index_in(core.take(pa.array(at)), value_set=self.known.slice(base)).fill_null(-1).to_numpy()
            own = np.where(core_at[at] >= 0, core_at[at], new + base)
            ids, size = self._gather(np.stack([own, tail_at], 1).ravel())
            self._add(fresh.take(pa.array(at)), [ids], [size.reshape(-1, 2).sum(1, dtype=np.int32)])
        return pc.index_in(fresh, value_set=self.known.slice(base)).to_numpy() + base

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of the texts, each closed by the end id."""
        for blank in "\n\t\r":
            texts = pc.replace_substring(texts, blank, " ")
        parts = pc.split_pattern(texts, " ")
        edge = np.cumsum(pc.list_value_length(parts).to_numpy())
        coded = pc.list_flatten(parts).dictionary_encode()
        seen = coded.dictionary
        core = pc.utf8_rtrim(seen, characters=_MARKS)
        places = pc.index_in(pa.concat_arrays([seen, core]), value_set=self.known).fill_null(-1).to_numpy()
        place, core_at = places[: len(seen)].copy(), places[len(seen) :].copy()
        new = np.flatnonzero(place < 0)
        if len(new):
            if len(self.known) + len(new) > MEMO:
                old = np.flatnonzero(place >= 0)
                ids, size = self._gather(place[old])
                self.clear()
                self._add(seen.take(pa.array(old)), [ids], [size])
                place[old] = np.arange(1, len(old) + 1)
                core_at[:] = -1
            take = pa.array(new)
            place[new] = self._learn(seen.take(take), core.take(take), core_at[new])
        k = np.insert(place[coded.indices.to_numpy()], edge, 0)
        ids, size = self._gather(k)
        lengths = np.add.reduceat(size, np.concatenate([[0], edge[:-1] + np.arange(1, len(edge))])).astype(np.int64)
        return lengths, ids


_coders: dict[tuple[str, int], _Ids] = {}


def _coder(path: str, end: int) -> _Ids:
    """One per Python worker, so that tasks that follow each other in it share what it remembers."""
    if (path, end) not in _coders:
        _coders[path, end] = _Ids(path, end)
    return _coders[path, end]


def write(docs: DataFrame, path: str, tokenizer: str, end: int = 1) -> None:
    """Write the ids of ``docs(doc_id, text)`` in ascending ``doc_id`` order.

    Null texts are empty: the end id alone. A null id is kept as the least 64-bit number, which reads back as null. Repeated ids keep a fixed order by
    text hash. Other columns are not read; an empty table writes no segment.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, segment = _coder(tokenizer, end), TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            doc, lens, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            data = encode_segment(doc, lens, ids)
            cols = [[part], [segment], [len(doc)], [len(ids)], [data]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], _NAMES)

        for batch in batches:
            bytes_ = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64)
            at = 0
            while at < batch.num_rows:
                done = bytes_[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(bytes_, done + SLICE, side="right")))
                lens, ids = coder.encode(batch.column(1).slice(at, to - at))
                held.append((batch.column(0).slice(at, to - at).to_numpy(), lens, ids))
                at = to
                if sum(len(x[2]) for x in held) >= SEGMENT_IDS:
                    yield close()
                    held, segment = [], segment + 1
        if held:
            yield close()

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("_h", F.xxhash64("text")).repartitionByRange("doc_id", "_h")
    rows = rows.sortWithinPartitions("doc_id", "_h").select("doc_id", "text")
    out = rows.mapInArrow(run, "part int, segment int, n_docs long, n_ids long, data binary")
    out.write.option("compression", "none").parquet(path)


_NAMES = ["part", "segment", "n_docs", "n_ids", "data"]


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document, decoded from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, segment, data in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                doc, lens, ids = decode_segment(data)
                ends = np.cumsum(lens, dtype=np.int64)
                raw = memoryview(ids.astype("<u4")).cast("B")
                crc = np.fromiter(
                    (zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lens.tolist(), strict=True)), np.int64, len(doc)
                )
                n = len(doc)
                cols = [np.full(n, part, np.int32), np.full(n, segment, np.int32), doc, ends - lens, lens.astype(np.int64), crc]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["part", "segment", "doc_id", "inside", "n_tokens", "ids_crc32"])

    stored = spark.read.parquet(path)
    sizes = stored.select("part", "segment", "n_ids")
    per_part = sorted(sizes.groupBy("part").agg(F.sum("n_ids")).collect())
    starts, total = [], 0
    for part, n in per_part:
        starts.append((part, total))
        total += n
    base = spark.createDataFrame(starts, "part int, base long")
    inside = Window.partitionBy("part").orderBy("segment")
    offsets = sizes.join(base, "part").select("part", "segment", (F.col("base") + F.sum("n_ids").over(inside) - F.col("n_ids")).alias("offset"))
    docs = stored.select("part", "segment", "data").mapInArrow(
        run, "part int, segment int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )
    return docs.join(offsets, ["part", "segment"]).select(
        F.nullif("doc_id", F.lit(_NO_ID)).alias("doc_id"), (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
