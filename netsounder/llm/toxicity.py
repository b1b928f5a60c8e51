"""Toxicity of texts after noisy-channel deobfuscation.

Three passes. Character 4-grams are counted over every document into a
language model of fixed size. A stretch written in leetspeak, spaced out or
with letters repeated becomes a lattice of the characters it may stand for,
and Viterbi decoding under the model restores it; all other text has a lattice
of one path and stays as it is. A logistic model over words and word stems of
the restored text, learned from labelled rows, scores the whole of each text.

What is learned: feature counts by label over a bounded, hash-chosen sample of
labelled rows (``FIT_ROWS``), of which the most telling ``FEATURES`` enter the
regression. The language model covers all rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsounder.session import stored

#: Labelled rows of each label that the classifier is fitted on, at most.
FIT_ROWS = 6_000
#: Features in the classifier, at most.
FEATURES = 1_000
#: Decoded stretches and words that a task remembers.
MEMO = 200_000
#: Longest decoded stretch that is remembered.
LONGEST = 104

_SIDE = 32
_OTHER, _DIGIT, _MARK = 27, 28, 29
_GRAMS = _SIDE**4
#: What a disguised character may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
_SEPARATORS = frozenset(".-_*~' ")
#: Log costs: writing a character plainly where it could stand for another, dropping a separator, a repeated letter kept twice, or as often as it stands.
_PLAIN, _DROP, _DOUBLE, _WHOLE = -6.0, -0.1, -1.0, -0.5

_L = r"[^\W\d_]"
_LEETS = r"[0-9@$!|+(€£]"
_SUSPECT = re.compile(
    r"(?<![^\s])(?:[^\s] ){2,}[^\s](?![^\s.,;:!?])"  # s p a c e d
    rf"|(?<![^\s])[^\s]*?(?:{_L}{_LEETS}+(?:{_L}|{_LEETS}+{_L})|{_L}(?:[.\-_*~]{_L}){{2,}}|({_L})\1\1)[^\s]*"
    rf"|(?<![^\s]){_LEETS}+{_L}[^\s]*"
    rf"|(?<![^\s])[^\s]*?{_L}{_LEETS}*[0-9@$|+€£](?=[^\w\s@$|+€£]*(?:\s|\Z))"  # only at the end, before closing marks
)
_SIGN = re.compile(r"[0-9@$!|+(€£]|[.\-_*~]\w[.\-_*~]|(\w)\1\1|^\S ")
#: Digests and UUIDs are no disguise.
_DIGEST = re.compile(r"\W*(?:[0-9a-f]{16,}|[0-9A-F]{16,}|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})\W*")
_WORD = re.compile(rf"{_L}+")


def _table() -> np.ndarray:
    code = np.full(256, _MARK, np.int64)
    code[[9, 10, 11, 12, 13, 32]] = 0
    for k in range(26):
        code[65 + k] = code[97 + k] = 1 + k
    code[48:58] = _DIGIT
    code[0x80:0xC0] = -1
    code[0xC0:] = _OTHER
    return code


_CODE = _table()


def _codes(text: bytes) -> np.ndarray:
    code = _CODE[np.frombuffer(text, np.uint8)]
    return code[code >= 0]


def gram_counts(docs: DataFrame) -> DataFrame:
    """``(gram, n)``: occurrences of each character 4-gram in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_GRAMS, np.int64)
        for batch in batches:
            texts = batch.column(0).drop_null()
            for at in range(0, len(texts), 256):
                c = _codes(b" ".join([b"", *texts.slice(at, 256).to_pylist(), b" "]))
                for lo in range(0, len(c), 1 << 22):
                    p = c[lo : lo + (1 << 22) + 3]
                    if len(p) > 3:
                        counts += np.bincount(((p[:-3] * 32 + p[1:-2]) * 32 + p[2:-1]) * 32 + p[3:], minlength=_GRAMS)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], ["gram", "n"])

    found = docs.select(F.col("text").cast("string").cast("binary")).mapInArrow(run, "gram int, n long")
    return found.groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(grams: DataFrame) -> np.ndarray:
    """Log-probability of each character after three others; at most 32**4 counts come to the driver."""
    counts = np.zeros(_GRAMS)
    got = grams.toPandas()
    counts[got["gram"].to_numpy()] = got["n"].to_numpy()
    n4 = counts.reshape((_SIDE,) * 4)
    n1 = n4.sum((0, 1, 2)) + 1.0
    p = n1 / n1.sum()
    for lower in (n4.sum((0, 1)), n4.sum(0), n4):
        p = (lower + 4.0 * p) / (lower.sum(-1, keepdims=True) + 4.0)
    return np.log(p).ravel().astype(np.float32)


def _options(stretch: str) -> list[list[tuple[str, float]]]:
    """The lattice: for each position the characters it may stand for, with their channel costs."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(stretch):
        c, j = stretch[i], i + 1
        while j < len(stretch) and stretch[j] == c:
            j += 1
        if c in LEET:
            end = i + 1 if j - i < 3 else j
            edge = i == 0 or j == len(stretch)
            if edge and j - i >= 3 and not c.isdigit():
                # a row of marks beside a word
                out.append([(c * (j - i), 0.0)])
                i = j
                continue
            out.append([(x, 0.0) for x in LEET[c]] + [(c, _PLAIN)] + ([("", _DROP - 2.0)] if not c.isdigit() or edge else []))
            i = end
        elif c in _SEPARATORS:
            out.append([("", _DROP), (" ", _PLAIN)])
            i = j
        elif c.isalpha() and j - i >= 3:
            out.append([(c, 0.0), (c + c, _DOUBLE), (c * (j - i), _WHOLE)])
            i = j
        else:
            out.append([(c, 0.0)])
            i += 1
    return out


def decode(stretch: str, model: np.ndarray) -> str:
    """The likeliest reading of a disguised stretch (Viterbi; the state is the last three characters)."""
    # each state's score and, back to front, what it read; equal tails are shared, so long stretches cost no copies
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for options in [*_options(stretch.lower()), [(" ", 0.0)]]:
        options = [(text, cost, _codes(text.encode()).tolist()) for text, cost in options]
        nxt: dict[int, tuple[float, tuple | None]] = {}
        for state, (score, out) in states.items():
            for text, cost, codes in options:
                total, at = score + cost, state
                for code in codes:
                    gram = at * _SIDE + code
                    total += float(model[gram])
                    at = gram % (_SIDE**3)
                if at not in nxt or total > nxt[at][0]:
                    nxt[at] = (total, (out, text) if text else out)
        states = nxt
    best = max(score for score, _ in states.values())
    found = max(_read(out) for score, out in states.values() if score == best).strip()
    return stretch if found == stretch.lower() else found


def _read(out: tuple | None) -> str:
    found = []
    while out is not None:
        out, text = out
        found.append(text)
    return "".join(reversed(found))


def _kinds() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[[ord(c) for c in "0123456789@$!|+("] + [0xE2, 0xC2]] = 1  # € and £ begin with the last two
    kind[[ord(c) for c in ".-_*~"]] = 2
    kind[[9, 10, 11, 12, 13, 32]] = 3
    return kind


_KIND = _kinds()


def _signs(raw: bytes) -> np.ndarray:
    """Places that may belong to a disguised stretch: leet characters, a letter three times, separators or blanks about single letters."""
    b = np.frombuffer(b" \n" + raw + b"\n     ", np.uint8)
    k = _KIND[b]
    two = (b[:-6] == b[1:-5]) & (b[1:-5] == b[2:-4]) & (k[:-6] == 0)
    wide = (b[:-6] == b[2:-4]) & (b[2:-4] == b[4:-2]) & (b[:-6] >= 0x80)
    parted = (k[:-6] == 2) & ((k[2:-4] == 2) | (k[3:-3] == 2))
    blank = k == 3
    step = np.where(blank[2:-4], 2, np.where((b[1:-5] >= 0xC2) & blank[3:-3], 3, 0))
    at = np.arange(len(step))
    ahead = np.minimum(at + step, len(step) - 1)
    spaced = blank[:-6] & (step > 0) & (step[ahead] > 0) & (b[ahead] == 32)
    found = np.flatnonzero((k[:-6] == 1) | two | wide | parted | spaced)
    return np.clip(found - 2 + spaced[found], 0, max(0, len(raw) - 1))


class Restorer:
    """Restores texts, remembering what it decoded."""

    def __init__(self, model: np.ndarray) -> None:
        self.model, self.memo = model, {}

    def _one(self, m: re.Match) -> str:
        stretch = m[0]
        if not _SIGN.search(stretch) or _DIGEST.fullmatch(stretch):
            return stretch
        if len(stretch) > LONGEST:
            return decode(stretch, self.model)
        if stretch not in self.memo:
            if len(self.memo) > MEMO:
                self.memo.clear()
            self.memo[stretch] = decode(stretch, self.model)
        return self.memo[stretch]

    def __call__(self, text: str) -> str:
        """``text`` with its disguised stretches restored; they never span lines, so lines without a sign of one are left alone."""
        raw = text.encode()
        at = _signs(raw)
        if not len(at):
            return text
        breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
        edge = np.concatenate([[0], breaks + 1, [len(raw) + 1]])
        out, done = [], 0
        for k in np.unique(np.searchsorted(breaks, at)).tolist():
            lo, hi = int(edge[k]), int(edge[k + 1]) - 1
            out += [raw[done:lo].decode(), _SUSPECT.sub(self._one, raw[lo:hi].decode())]
            done = hi
        return "".join([*out, raw[done:].decode()])


def _key(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode()) >> 3


def _keys(word: str) -> list[int]:
    """A word's features: itself and its stems of four to seven letters."""
    return [_key("=" + word), *(_key(word[:k]) for k in range(4, min(8, len(word) + 1)))]


def _levels(text: str) -> Counter:
    """Occurrences of each feature in a restored text, up to three."""
    found: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for key in _keys(word):
            found[key] += n
    return found


_SPLIT = "pmod(crc32(cast(cast(doc_id as string) as binary)), 5)"


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> tuple[DataFrame, dict[int, float]]:
    """Training rows ``(doc_id, text, toxic)`` and each label's rows for one of the sample."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("doc_id is not null and toxic in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(f"{_SPLIT} <> 0")
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    picked = None
    for k in (0, 1):
        share = min(1.0, rows / max(1, sizes.get(k, 0)))
        part = known.where((F.col("toxic") == k) & (F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_003)) < share * 1_000_003))
        picked = part if picked is None else picked.unionByName(part)
    picked = stored(picked, "picked")
    got = {r[0]: r[1] for r in picked.groupBy("toxic").count().collect()}
    weight = {k: sizes[k] / n for k, n in got.items()}
    text = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return text.join(picked, "doc_id").select("doc_id", "text", "toxic"), weight


def _fit_weights(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Weighted ridge logistic regression by Newton's method; the last weight is the intercept."""
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-3
    beta = np.zeros(x.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (y - p)) - keep * beta
        hess = (x.T * (w * p * (1 - p)).astype(np.float32)) @ x
        step = np.linalg.solve(hess.astype(np.float64) + np.diag(keep), grad)
        beta += step
        if np.abs(step).max() < 1e-5:
            break
    return beta


class Classifier:
    """``score`` of a restored text: logistic over (feature, level) pairs."""

    def __init__(self, pairs: list[tuple[int, int]], beta: np.ndarray) -> None:
        self.bias = float(beta[-1])
        self.weights: dict[int, list[tuple[int, float]]] = {}
        for (key, level), b in zip(pairs, beta[:-1].tolist(), strict=True):
            self.weights.setdefault(key, []).append((level, b))
        self.memo: dict[str, tuple[int, ...]] = {}

    def score(self, text: str) -> float:
        found: dict[int, int] = {}
        words, memo = _WORD.findall(text.lower()), self.memo
        fresh = set(words).difference(memo)
        if len(memo) + len(fresh) > MEMO:
            memo.clear()
            fresh = set(words)
        for word in fresh:
            memo[word] = tuple(k for k in _keys(word) if k in self.weights)
        for keys in filter(None, map(memo.get, words)):
            for k in keys:
                found[k] = found.get(k, 0) + 1
        z = self.bias + sum(b for k, n in found.items() for level, b in self.weights[k] if n >= level)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray, rows: int = FIT_ROWS) -> Classifier:
    """Learn from labelled rows outside the held-out fifth."""
    sample, weight = _sample(docs, labels, rows)

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model)
        for batch in batches:
            texts = [restore(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), batch.column(2)], ["doc_id", "text", "toxic"])

    kept = stored(sample.mapInArrow(restored, "doc_id long, text string, toxic int"), "restored")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = counts[toxic]
                for key, n in _levels(text).items():
                    for level in range(1, min(n, 3) + 1):
                        own[key << 2 & (1 << 63) - 1 | level] += 1
        for toxic in (0, 1):
            keys = np.fromiter(counts[toxic].keys(), np.int64, len(counts[toxic]))
            n = np.fromiter(counts[toxic].values(), np.int64, len(counts[toxic]))
            zero = np.zeros(len(n), np.int64)
            for at in range(0, len(n), 100_000):
                part = slice(at, at + 100_000)
                cols = (keys[part], (n if toxic else zero)[part], (zero if toxic else n)[part])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["key", "n1", "n0"])

    sizes = {r[0]: r[1] for r in kept.groupBy("toxic").count().collect()}
    ratio = F.lit(sizes.get(1, 0) / max(1, sizes.get(0, 0)))
    expected = F.col("n0") * ratio
    telling = (
        kept.mapInArrow(counted, "key long, n1 long, n0 long")
        .groupBy("key")
        .agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
        .where("n1 >= 4")
        .withColumn("z", (F.col("n1") - expected) / F.sqrt(expected + 1))
        .where("z >= 3.5")
        .orderBy(F.desc("z"), "key")
        .limit(FEATURES)
    )
    chosen = sorted(r[0] for r in telling.select("key").collect())
    slot = {k: i for i, k in enumerate(chosen)}
    mask = (1 << 63) - 1

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                own = ((key << 2 & mask | level) for key, n in _levels(text).items() for level in range(1, min(n, 3) + 1))
                out.append(sorted(slot[k] for k in own if k in slot))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "toxic", "on"])

    got = kept.mapInArrow(featured, "doc_id long, toxic int, on array<int>").toPandas().sort_values("doc_id")
    y = got["toxic"].to_numpy(np.float64)
    x = np.zeros((len(got), len(chosen)), np.float32)
    for i, on in enumerate(got["on"]):
        x[i, np.asarray(on, int)] = 1
    w = np.array([weight[int(k)] for k in y]) if len(y) else np.zeros(0)
    beta = _fit_weights(x, y, w) if len(y) else np.array([-3.0])
    pairs = [(k >> 2, k & 3) for k in chosen]
    return Classifier(pairs, beta)


def trained(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Classifier]:
    model = language_model(gram_counts(docs))
    return model, fit(docs, labels, model)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of each row of ``docs``.

    Null texts count as empty and get the score of no evidence. Labels that are
    null or other than 0 and 1 teach nothing; a document labelled twice is toxic
    if any label says so; without labelled rows every score is low. Repeated rows
    each come back; other columns are not read.
    """
    model, classifier = trained(docs.sparkSession, docs, labels)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model)
        for batch in batches:
            score = [classifier.score(restore(x.as_py() or "")) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    out = named.mapInArrow(run, "doc_id long, score double")
    held = F.coalesce(F.expr(f"{_SPLIT} = 0"), F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def harmless(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` not predicted toxic, with all their columns.

    Each row is judged by its own text in the pass that reads it, so rows without an id and rows that
    share one are decided one by one. Null and empty texts are harmless unless the corpus says
    otherwise; an empty table gives no row.
    """
    model, classifier = trained(docs.sparkSession, docs, labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model)
        for batch in batches:
            texts = batch.column(at).cast(pa.string())
            yield batch.filter(pa.array([classifier.score(restore(x.as_py() or "")) < 0.5 for x in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
