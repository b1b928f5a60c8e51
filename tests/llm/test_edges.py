"""Pipeline stages and pair operators on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import random

import numpy as np
import pytest

import corpus_pipeline
from netsounder.llm import compact_windows, curriculum, hyperplane
from tests.llm.test_llm import pairs_closed, prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, item string, _doc long, _position int, hub long, signs string, before int, root int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder of documents, labels and benchmark with every awkward row, and the rows."""
    r = random.Random(11)
    bad = ["idiot", "moron", "clown"]
    rows, labels = [], []
    for i in range(240):
        words, toxic = prose(r, r.randrange(20, 60)).split(), i % 6 == 0
        if toxic:
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words), r.choice(["en", None]), r.choice(["a", "a", "b", None])))
        labels.append((i, 1, int(toxic)))
    phrase = " ".join(f"exam{k}" for k in range(14))
    rows += [(300, None, None, None), (301, "", "en", "a"), (302, " \n ", "en", "a"), (303, "x", "en", "b"), (304, prose(r, 20_000), "en", "b"), (305, f"before {phrase} after", "en", "a")]
    rows += [(306, rows[1][1], "en", "a"), (307, rows[1][1], "en", "b"), rows[2], rows[2], (None, prose(r, 30), "en", "a"), (None, f"null {phrase}", "en", "a"), (None, "idiot moron clown idiot moron clown", "en", None)]
    full = [(*x, len(x[1] or ""), 0.5, "i", 7, 8, 9, "s", 1, 2) for x in rows]
    path = str(tmp_path_factory.mktemp("edges"))
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([*labels, (None, 1, 1), (0, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, phrase), (2, None), (None, "exam3 exam4"), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, full


def test_filtering_stages(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), path).count() == 0
        kept.append(out.collect())
    toxic, near, clean = kept
    texts = lambda found: [x.text for x in found if x.doc_id is None]
    # toxicity and decontamination judge rows by their text, whether or not they have an id
    assert not any(t.startswith("idiot") for t in texts(toxic)) and len(texts(toxic)) == 2
    assert sum(x.doc_id is not None and x.doc_id < 240 for x in toxic) == 202  # five in six, and a row repeated twice
    assert {x.doc_id for x in rows_named(rows)} - {x.doc_id for x in clean} == {305} and len(texts(clean)) == 2
    # one of each group of copies stays, empty texts are one group, rows without an id can't be its one
    ids = {x.doc_id for x in near}
    assert 1 in ids and not {306, 307} & ids and 300 in ids and not {301, 302} & ids and None not in ids
    assert sum(x.doc_id == 2 for x in near) == 3


def rows_named(rows):
    class Row:
        def __init__(self, r):
            self.doc_id = r[0]

    return [Row(r) for r in rows if r[0] is not None]


def test_mixing_stage(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    mix = corpus_pipeline.STAGES[3][1]
    got = mix(spark, docs, path)
    assert got.columns == docs.columns and mix(spark, docs.limit(0), path).count() == 0
    times, size, source = {}, {}, {}
    for x in got.collect():
        times[x.doc_id] = times.get(x.doc_id, 0) + 1
    for x in rows:
        size[x[0]] = size.get(x[0], 0) + len((x[1] or "").split())
        source[x[0]] = min((s for s in (source.get(x[0]), x[3]) if s is not None), default=None)
    repeats = {i: sum(x[0] == i for x in rows) for i in size}
    assert not {300, 301, 302} & set(times)
    # rows of an id come in each of its passes; a source misses its target by half of one document at most
    passes = {i: n / repeats[i] for i, n in times.items()}
    assert all(p in (1, 2) for p in passes.values())
    target = {x.source: x.target for x in curriculum.targets(spark.createDataFrame([(s, sum(n for i, n in size.items() if source[i] == s)) for s in set(source.values())], "source string, source_size long")).collect()}
    for s, want in target.items():
        own = [i for i in size if source[i] == s]
        assert abs(sum(passes.get(i, 0) * size[i] for i in own) - want) <= max(size[i] for i in own) / 2 + 1


def test_whole_pipeline(spark, folder):
    path, _ = folder
    got = corpus_pipeline.run(spark, path)
    assert got.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(got.collect(), key=lambda x: x.start)
    assert rows[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:], strict=False))
    assert not {305, 306, 307} & {x.doc_id for x in rows}


def test_passages_beside_other_columns_and_in_long_texts(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    got = {x.doc_id: x for x in compact_windows.repeats(docs).collect()}
    assert len(got) == docs.select("doc_id").distinct().count()
    assert got[None].n_links == 0 and got[None].spans == "" and got[300].component_id == 300
    r = random.Random(2)
    words = [f"w{k}" for k in range(9_000)]
    text = lambda n: [r.choice(words) for _ in range(n)]
    passage = text(70)
    long = text(150_000) + passage + text(150_000)
    two = spark.createDataFrame([(1, " ".join(long), "x"), (2, " ".join(text(20) + passage), "y"), (3, "q" * 3_000_000, "z")], "doc_id long, text string, hub string")
    got = {x.doc_id: x for x in compact_windows.repeats(two).collect()}
    assert got[1].spans == "150000:150070" and got[2].component_id == 1 and got[3].n_links == 0


def test_every_document_with_a_passage_is_found(spark):
    """Some thousand documents with exact and edited passages of 60 to 120 words among clean texts: links, classes and clean documents."""
    r = random.Random(8)
    words = [f"w{k}" for k in range(3_000)]
    text = lambda n: [r.choice(words) for _ in range(n)]
    passages = [text(r.randrange(60, 120)) for _ in range(150)]
    texts, held = [], {}
    for k in range(2_500):
        t = text(r.randrange(60, 200))
        if k % 3 == 0:
            which = r.randrange(150)
            p = list(passages[which])
            if k % 2:
                p[r.randrange(len(p))] = "other"
            at = r.randrange(len(t))
            t[at:at] = p
            held.setdefault(which, []).append((k, bool(k % 2)))
        texts.append(t)
    # of two edited passages some stretch of 50 words may not be alike enough, of an exact and an edited one it is
    links = {(a, b) for own in held.values() for a, x in own for b, y in own if a < b and not (x and y)}
    part = pairs_closed(range(len(texts)), links)
    got = {x.doc_id: x for x in compact_windows.repeats(spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string").repartition(5)).collect()}
    linked = {d for pair in links for d in pair}
    assert len(linked) > 700 and sum(got[d].n_links > 0 for d in linked) >= 0.995 * len(linked)
    assert sum(got[a].component_id == got[b].component_id for a, b in links) >= 0.99 * len(links)
    assert all(part[got[d].component_id] == part[d] for d in linked if part[d] in linked and got[d].component_id in linked)
    clean = [d for d in range(len(texts)) if d % 3]
    assert all(got[d].n_links == 0 for d in clean)


def test_dense_parts():
    r = np.random.default_rng(5)
    for _ in range(300):
        hit = r.random(90) < r.choice([0.7, 0.9, 0.97])
        got = compact_windows._dense(hit, 20)
        for a, b in got:
            assert b - a >= 20 and hit[a:b].mean() >= 8 / 9
        best = max((b - a for a in range(91) for b in range(a + 20, 91) if hit[a:b].mean() >= 8 / 9 - 1e-12), default=0)
        assert max((b - a for a, b in got), default=0) == best


def test_vectors_beside_other_columns_and_wide(spark):
    r = np.random.default_rng(4)
    base = r.standard_normal((6, 2_000))
    rows = [(i, [float(x) for x in base[i % 6] * (i + 1)], 1, "c", i) for i in range(18)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code string, bucket long")
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in hyperplane.linked_vectors(table).collect()}
    assert got == {i: (2, i % 6, i < 6) for i in range(18)}


def test_all_links_of_near_copies_are_counted(spark):
    """The least document verifies all others; these are linked with each other too, copies of a text with all that it is linked with."""
    r = random.Random(12)
    words = [f"w{k}" for k in range(3_000)]
    text = lambda n: [r.choice(words) for _ in range(n)]
    base, shared, passage = text(110), text(70), text(60)
    near = [base[:k] + ["other"] + base[k + 1 :] for k in (4, 20, 40, 55, 70, 90, 100)]
    # 10 holds the passage only, 11 and 12 what follows it too
    parts = [text(30) + passage, passage + shared + text(20), text(25) + passage + shared]
    texts = [base, *near, base, near[2], *parts, text(200)]
    got = {x.doc_id: x for x in compact_windows.repeats(spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string").repartition(3)).collect()}

    def alike(x, y):
        a, b = ({tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in (x, y))
        return len(a & b) >= 0.8 * len(a | b) or any(tuple(x[k : k + 50]) in {tuple(y[m : m + 50]) for m in range(len(y) - 49)} for k in range(len(x) - 49))

    want = {a: sum(alike(x, y) for b, y in enumerate(texts) if a != b) for a, x in enumerate(texts)}
    assert want[0] == want[8] == 9 and want[11] == 2
    assert {d: x.n_links for d, x in got.items()} == want
    assert got[11].spans == "0:130" and got[12].spans == "25:155" and got[10].spans == "30:90"


def test_members_meet_one_by_one_or_sifted():
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 32, 120, np.uint32)
    signs = []
    for k in range(90):
        x = np.concatenate([r.integers(0, 1 << 32, k % 30, np.uint32), base])
        for at in r.integers(0, 115, k % 4):
            x[at : at + 5] = r.integers(0, 1 << 32, 5, np.uint32)
        signs.append(x)
    members = [(k, None, np.array([0]), np.array([len(x) - 1]), x) for k, x in enumerate(signs)]
    link, spans = compact_windows.linked(members, 46)
    for a, b in ((a, b) for a in range(90) for b in range(a)):
        assert link[a, b] == link[b, a] == compact_windows.linked([members[a], members[b]], 46)[0][0, 1]
    crossed = compact_windows.linked([(k, k % 2, *m[2:]) for k, m in enumerate(members)], 46)[0]
    assert (crossed == (link & ((np.arange(90)[:, None] - np.arange(90)) % 2 == 1))).all()
    # what a smaller group has is left to it
    assert not compact_windows.linked([(k, None, np.array([3, 7]), *m[3:]) for k, m in enumerate(members)], 46, 7)[0].any()


def test_stretches_that_could_be_alike():
    r = np.random.default_rng(9)
    for _ in range(200):
        texts = [r.random(r.integers(6, 40)) < r.choice([0.2, 0.7, 0.9]) for _ in range(r.integers(1, 9))]
        miss = int(r.choice([4, 8]))
        want = [any((x[a:b] * (miss + 1) - miss).sum() >= 0 for a in range(len(x)) for b in range(a + 6, len(x) + 1)) for x in texts]
        assert compact_windows._could(np.concatenate(texts), np.array([len(x) for x in texts]), 6, miss).tolist() == want


def test_repeated_lines_are_sifted_on_both_sides(monkeypatch):
    """A line said over and over in one place and here and there in other texts: no passage, and no pair that is looked at one by one."""
    r = np.random.default_rng(6)
    fill = lambda n: r.integers(0, 1 << 32, n, np.uint32)
    line, base = fill(10), fill(60)
    apart = [np.concatenate([x for _ in range(6) for x in (fill(15), line)]) for _ in range(20)]
    close = [np.concatenate([fill(k + 1), *[line] * 6, fill(30)]) for k in range(20)]
    # the line within a passage, cut so that no run of 46 is left: these have to be found
    edited = [np.concatenate([line, fill(20), line, base[:30], fill(3), base[30 + k % 4 :], fill(9)]) for k in range(12)]
    signs = [*apart, *close, *edited]
    members = [(k, None, np.array([0]), np.array([len(x) - 1]), x) for k, x in enumerate(signs)]
    pairs = [(a, b) for a in range(len(signs)) for b in range(a)]
    want = {(a, b): bool(compact_windows.linked([members[b], members[a]], 46)[0][0, 1]) for a, b in pairs}
    asked = []
    plain = compact_windows.in_common
    monkeypatch.setattr(compact_windows, "in_common", lambda *a: asked.append(len(a[0])) or plain(*a))
    link, spans = compact_windows.linked(members, 46)
    assert {(a, b): bool(link[a, b]) for a, b in pairs} == want and (link == link.T).all()
    assert not link[:20].any() and link[20:40, 20:40].sum() == 380 and link[40:, 40:].sum() == 132
    assert len(asked) <= 12 * 11 / 2 and all(spans[20:])


def test_members_of_a_large_group_are_sent_a_few_times(spark):
    """Every two blocks of a group meet in one place, and a member goes to a place for each share of its group, not for each block."""
    placed = spark.range(600).selectExpr("id AS class", "id % 3 AS group", "CASE WHEN id % 3 = 0 THEN 50L WHEN id % 3 = 1 THEN 3L ELSE 1L END AS blocks")
    rows = compact_windows.dealt(placed).collect()
    sent = {c: [x for x in rows if x["class"] == c] for c in range(600)}
    assert max(map(len, sent.values())) <= compact_windows.SHARES
    assert all(len(sent[c]) == (3 if c % 3 == 1 else 1) for c in range(600) if c % 3)
    places = {c: {(x.lo, x.hi): x.share for x in own} for c, own in sent.items()}
    for g in range(3):
        for a in range(g, 600, 3):
            for b in range(a + 3, 600, 3):
                met = [p for p in places[a].keys() & places[b].keys() if p[0] == p[1] or places[a][p] != places[b][p]]
                assert len(met) == 1


def test_links_of_groups_of_many_blocks(spark, monkeypatch):
    """Blocks of two members in shares of several blocks count each link once, copies included."""
    monkeypatch.setattr(compact_windows, "BLOCK", 2)
    monkeypatch.setattr(compact_windows, "HELD", 3)
    r = random.Random(21)
    words = [f"w{k}" for k in range(3_000)]
    text = lambda n: [r.choice(words) for _ in range(n)]
    passage = text(70)
    texts = [[*text(20), *passage, *text(15)] for _ in range(40)]
    texts += [texts[4], text(90)]
    got = {x.doc_id: x for x in compact_windows.repeats(spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string").repartition(3)).collect()}
    assert all(got[d].n_links == 40 and got[d].component_id == 0 for d in range(41))
    assert got[5].spans == "20:90" and got[41].n_links == 0 and got[41].component_id == 41
