"""The pipeline against its stages by hand, and the registered queries over whole tables."""

import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from netsounder.llm import queries, toxicity
from netsounder.session import table
from tests.llm.test_llm import contamination_by_hand, pairs_closed


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "mixing", "tokens"]


def test_pipeline_by_hand(spark, sf):
    from tokenizers import Tokenizer

    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = {r.doc_id: r for r in docs.collect()}
    bad = {r.doc_id for r in toxicity.scores(docs, labels).collect() if r.predicted}
    left = {k: r for k, r in rows.items() if k not in bad}
    one = corpus_pipeline.STAGES[0][1](spark, docs, sf)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == set(left)

    from netsounder.llm.simhash import fingerprint

    prints = {k: fingerprint((r.text or "").encode()) for k, r in left.items()}
    part = pairs_closed(left, [(a, b) for a in left for b in left if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    left = {k: r for k, r in left.items() if part[k] == k}
    bench = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    hit = {x[0] for x in contamination_by_hand([(k, r.text) for k, r in left.items()], bench) if x[5]}
    left = {k: r for k, r in left.items() if k not in hit}
    assert hit and len(left) > 50

    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for k, r in left.items()}
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    got = sorted(corpus_pipeline.run(spark, sf).collect(), key=lambda r: r.start)
    at, seen = 0, {}
    for r in got:
        ids = np.array([*tokenizer.encode(left[r.doc_id].text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got) and max(seen.values()) <= 2
    took = sum(size[k] * n for k, n in seen.items())
    assert abs(took / sum(size.values()) - 1.5) < 0.1


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_returns_every_row(name, spark, sf):
    source = {"op1": "pages", "op10": "embeddings"}.get(name.split("_")[0], "documents")
    assert queries.QUERIES[name](spark, sf).count() == table(spark, sf, source).count()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(name, spark, sf):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in cur.description]
    want = sorted(cur.fetchall())
    assert sorted(tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, sf).collect()) == want
