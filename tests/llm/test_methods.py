"""What each method itself contributes: the answer changes, or is lost, without it."""

import itertools
import random
import re
import string

import numpy as np
import pytest

from netsounder.llm import fm_index, html_extract, secret_scan, toxicity
from netsounder.llm.queries import RANKS
from netsounder.session import table

# 1


def unlabelled(r, k):
    """A page without article, navigation or class names, and its article."""
    words = lambda n: " ".join(r.choice("river mouth tide basin weir lock canal stream ford".split()) for _ in range(n))
    body = [words(r.randrange(60, 120)) for _ in range(r.randrange(1, 3))]
    parts = "".join(f"<p>{x}</p>" for x in body)
    links = "".join(f"<li><a href=/{i}>{words(1)}</a></li>" for i in range(8))
    page = f"<body><div><ul>{links}</ul></div><div>{words(5)}</div><div><h1>Title {k}</h1>{parts}</div><div>{words(6)}</div><div><ul>{links}</ul></div></body>"
    return page, " ".join([f"Title {k}", *body])


def test_clusters_choose_the_region(monkeypatch):
    r = random.Random(1)
    pages = [unlabelled(r, k) for k in range(60)]
    assert all(html_extract.main_text(p) == t for p, t in pages)
    flat = "<body><p><a href=1>home</a></p><p><a href=2>news</a></p><p><a href=3>about</a></p><h1>Head</h1>" + "<p>" + "long text here " * 30 + "</p><p>" + "more of it " * 30 + "</p></body>"
    assert html_extract.main_text(flat) == "Head " + ("long text here " * 30 + "more of it " * 30).strip()
    monkeypatch.setattr(html_extract, "content_lines", lambda ratio: np.array([r.random() < 0.5 for _ in ratio], bool))
    assert sum(html_extract.main_text(p) == t for p, t in pages) < 45


def test_several_articles_and_none():
    text = "a sentence of the main piece. " * 40
    cards = "".join(f"<article><h2>Card {k}</h2><p>teaser words here</p></article>" for k in range(3))
    assert html_extract.main_text(f"<body><article><h1>H</h1><p>{text}</p></article><div>{cards}</div></body>") == "H " + text.strip()
    assert html_extract.main_text("<body><nav>only a menu</nav></body>") == ""
    assert html_extract.main_text("<p>" + "x " * 400_000) == ("x " * 400_000).strip()


# 5

ALPHABETS = {
    "lower": string.ascii_lowercase, "upper": string.ascii_uppercase, "letters": string.ascii_letters,
    "lower digits": string.ascii_lowercase + string.digits, "upper digits": string.ascii_uppercase + string.digits,
    "all": string.ascii_letters + string.digits, "base64": string.ascii_letters + string.digits + "+/",
}


@pytest.mark.parametrize("size", [16, 20, 32, 40])
@pytest.mark.parametrize("name", sorted(ALPHABETS))
def test_random_strings_are_found(name, size):
    r = random.Random(size)
    found = sum(any(k in ("random", "hex", "access") for k, *_ in secret_scan.spans("key " + "".join(r.choice(ALPHABETS[name]) for _ in range(size)) + " end", RANKS)) for _ in range(150))
    assert found >= 0.9 * 150
    if name != "base64":  # whose strings may hold separators themselves
        path = "home/projects/configuration/"
        assert sum(bool(secret_scan.spans(path + "".join(r.choice(ALPHABETS[name]) for _ in range(size)), RANKS)) for _ in range(150)) >= 0.9 * 150


def test_digests_and_identifiers_are_not():
    r = random.Random(2)
    names = ["internationalization", "CONFIGURATION_DIRECTORY", "getAbsoluteFilePathName", "characteristically-named", "https://example.com/some/ordinary/path/index", "MAX_BUFFER_SIZE_LIMIT"]
    digests = ["".join(r.choice("0123456789ABCDEF") for _ in range(n)) for n in (32, 40, 56, 64, 96, 128)]
    numbers = ["20240102030405060708", "2024-01-02/03-04-05-06", "550e8400-e29b-41d4-a716-446655440000", "runs/550e8400-e29b-41d4-a716-446655440000/log"]
    for text in names + digests + numbers:
        assert secret_scan.spans(text, RANKS) == [], text


def test_base_spans_by_the_patterns():
    r = random.Random(4)
    letters = "pasword secrtkniyAPI_=:\"'  abc123+/.-"
    for _ in range(400):
        t = "".join(r.choice(["password", "TOKEN", "api_key", "apikey", "secret", *letters]) for _ in range(60))
        whole = re.compile("(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
        want = [m.span() for m in whole.finditer(t) if len(m[2]) >= 6]
        assert [(s, e) for k, s, e in secret_scan.spans(t, RANKS) if k == "assign"] == want


# 6


def readings(stretch):
    """Every path of the lattice: its text, its channel cost and the codes it writes."""
    for path in itertools.product(*toxicity._options(stretch.lower())):
        text = "".join(t for t, _ in path)
        yield text, sum(c for _, c in path), [c for t, _ in path for c in toxicity._codes(t.encode()).tolist()]


def test_decoding_is_the_best_of_all_paths():
    r = np.random.default_rng(3)
    model = np.log(r.dirichlet(np.ones(32), 32**3)).ravel().astype(np.float32)
    draw = random.Random(3)
    for _ in range(60):
        stretch = "".join(draw.choice("ab1!$@.-e3ooo") * draw.choice([1, 1, 1, 3]) for _ in range(7))
        best, texts = -np.inf, set()
        for text, cost, codes in readings(stretch):
            state, total = 0, cost
            for code in [*codes, 0]:
                gram = state * 32 + code
                total += float(model[gram])
                state = gram % 32**3
            if total > best + 1e-9:
                best, texts = total, {text.strip()}
            elif total > best - 1e-9:
                texts.add(text.strip())
        assert toxicity.decode(stretch, model) in texts, stretch


def disguised(word, r):
    """A word in leetspeak, spaced out, dotted or with a letter drawn out."""
    leet = {"o": "0", "i": "1", "e": "3", "a": "@", "s": "$", "t": "+"}
    kind = r.randrange(4)
    if kind == 0 and set(word) & set(leet):
        return "".join(leet.get(c, c) for c in word)
    if kind == 1:
        return " ".join(word)
    if kind == 2:
        return "-".join(word)
    at = r.randrange(1, len(word) - 1)
    return word[:at] + word[at] * 4 + word[at + 1 :]


def test_restoring_finds_disguised_toxicity(spark):
    """Held-out documents of the given tables whose telling words are disguised: caught with the channel, missed without."""
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model, classifier = toxicity.trained(spark, docs, labels)
    restore, r = toxicity.Restorer(model), random.Random(5)
    score = lambda t: classifier.score(t) >= 0.5
    toxic = {x.doc_id for x in labels.where("toxic = 1").collect()}
    rows = [x.text for x in docs.collect() if x.doc_id in toxic and x.text and score(restore(x.text))]
    telling = lambda w: any(classifier.weights.get(k) for k in toxicity._keys(w.lower()))
    hidden = [re.sub(r"[^\W\d_]{4,}", lambda m: disguised(m[0].lower(), r) if telling(m[0]) else m[0], t) for t in rows]
    caught, missed = sum(score(restore(t)) for t in hidden), sum(not score(t) for t in hidden)
    assert len(rows) >= 15 and caught >= 0.85 * len(rows) and missed >= 0.6 * len(rows)


def test_digests_and_ordinary_marks_are_left():
    model = np.zeros(32**4, np.float32)
    restore = toxicity.Restorer(model)
    for text in ("59b79a44c83160ff605db5295c3f1b8f59a30bf7", '"DA39A3EE5E6B4B0D3255BFEF95601890AFD80709",', "550e8400-e29b-41d4-a716-446655440000", "Words$$$ and*** more!!!"):
        assert restore(text) == text


# 8


def test_long_runs_are_cut_without_loss():
    r = np.random.default_rng(1)
    vocabulary = [b"w%d" % k for k in range(12)]
    drawn = r.integers(0, 12, 6_000)
    items = [(k, b" ".join(np.array(vocabulary)[drawn[a : a + 14]].tolist())) for k, a in enumerate(r.integers(0, 5_900, 40))] + [(99, b"w1 w2 w3"), (100, b"w5")]
    phrases = fm_index.Phrases(items)
    texts = [b" ".join(np.array(vocabulary)[part].tolist()) for part in np.split(drawn, [4_000, 4_000, 4_001])]
    ids = [fm_index.symbols_of(t, phrases.symbol) for t in texts]
    want = set()
    for d, own in enumerate(ids):
        for k, (row, n) in enumerate(zip(phrases.phrases, phrases.size, strict=True)):
            p = row[len(row) - n :]
            want |= {(d, i, k) for i in range(len(own) - n + 1) if (own[i : i + n] == p).all()}
    for shard in (1 << 20, 300, 40):
        got = list(zip(*(x.tolist() for x in fm_index.occurrences(ids, phrases, shard)), strict=True))
        assert len(got) == len(set(got)) and set(got) == want, shard


def test_slices_of_a_text_are_its_words(monkeypatch):
    monkeypatch.setattr(fm_index, "SLICE_BYTES", 7)
    r = random.Random(6)
    symbol = {b"ab": 1, "é".encode(): 2, b"a1b": 3}
    for _ in range(200):
        text = "".join(r.choice(["ab", "é", "A1B", " ", "-", "x"]) for _ in range(40)).encode()
        assert fm_index.symbols_of(text, symbol).tolist() == [symbol.get(w, 0) for w in fm_index.words(text)]


def test_a_text_of_seven_million_words():
    r = np.random.default_rng(0)
    vocabulary = np.array([b"w%d" % k for k in range(300)])
    drawn = r.integers(0, 300, 7_000_000)
    text = b" ".join(vocabulary[drawn].tolist())
    items = [(0, b" ".join(vocabulary[drawn[6_999_980:6_999_990]].tolist())), (1, b" ".join(vocabulary[drawn[3_500_000:3_500_010]].tolist())), (2, b"w1 w2 w3"), (3, b" ".join(vocabulary.tolist()))]
    phrases = fm_index.Phrases(items)
    ids = fm_index.symbols_of(text, phrases.symbol)
    doc, first, phrase = fm_index.occurrences([ids], phrases)
    own = np.array([phrases.symbol[w] for w in vocabulary.tolist()])[drawn]
    assert (ids == own).all() and not doc.any()
    for k in (0, 10, 11, 12) if len(phrases.size) > 12 else range(len(phrases.size)):
        p = phrases.phrases[k][len(phrases.phrases[k]) - phrases.size[k] :]
        at = np.flatnonzero(own[: len(own) - len(p) + 1] == p[0])
        at = at[[(own[i : i + len(p)] == p).all() for i in at]] if len(at) else at
        assert first[phrase == k].tolist() == at.tolist()
