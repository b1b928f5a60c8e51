"""The thin ``opN_`` queries over whole tables, and their oracles where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsounder.llm import compact_windows, curriculum, fm_index, hilbert, html_extract, hyperplane, secret_scan, simhash, token_store, toxicity
from netsounder.session import new_path, table

#: Tokenizer of op2 and of the pipeline's last stage.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: Vocabulary of op5's token-efficiency test.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_store.write(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return token_store.read(spark, path)


def op3_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.repeats(table(spark, sf_dir, "documents"))


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = hilbert.shards(table(spark, sf_dir, "documents"), 24)
    return plan.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def op5_token_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"), RANKS)


def op6_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = curriculum.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


def op8_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return fm_index.digests(found)


def op9_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_hyperplane(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperplane.linked_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_html_regions": op1_html_regions,
    "op2_rans_tokens": op2_rans_tokens,
    "op3_compact_windows": op3_compact_windows,
    "op4_hilbert_shards": op4_hilbert_shards,
    "op5_token_efficiency": op5_token_efficiency,
    "op6_noisy_channel": op6_noisy_channel,
    "op7_curriculum_mix": op7_curriculum_mix,
    "op8_fm_index": op8_fm_index,
    "op9_simhash_trie": op9_simhash_trie,
    "op10_hyperplane": op10_hyperplane,
}

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_WORDS = "regexp_extract_all(translate(coalesce(text, ''), '" + _LETTERS.upper() + "', '" + _LETTERS + r"'), '[0-9a-z\x{80}-\x{10FFFF}]+')"

ORACLES: dict[str, str] = {
    "op8_fm_index": f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, s WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (win, n)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS sha
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(sha, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
""",
    "op7_curriculum_mix": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source),
w AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM s),
l AS (SELECT *, cap / weight AS level FROM w),
f AS (
  SELECT *, sum(cap) OVER o AS cap_through, sum(weight) OVER () - sum(weight) OVER o AS after,
    1.5::DOUBLE * sum(source_size) OVER () AS demand, sum(weight) OVER () AS whole
  FROM l WINDOW o AS (ORDER BY level, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, cap_through + level * after <= demand AS capped FROM f),
g AS (
  SELECT (max(demand) - coalesce(sum(cap) FILTER (WHERE capped), 0)::DOUBLE)
    / nullif(max(whole)::DOUBLE - coalesce(sum(weight) FILTER (WHERE capped), 0)::DOUBLE, 0) AS level FROM c),
t AS (
  SELECT source, source_size, rank,
    CASE WHEN capped THEN cap::DOUBLE ELSE weight * coalesce(g.level, 0) END AS target FROM c, g),
o AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.rank, round(t.target)::BIGINT AS goal,
    (sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(d.doc_id::VARCHAR), d.doc_id, d.size
      ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS ahead
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, (goal // greatest(source_size, 1) * size
    + least(greatest(goal - goal // greatest(source_size, 1) * source_size - ahead, 0), size))::BIGINT AS taken,
    least(ahead::DOUBLE / greatest(goal, 1), 1) AS u FROM o)
SELECT doc_id, size, source_size, target, taken,
  round(CASE WHEN taken > 0 THEN CASE rank % 3
    WHEN 0 THEN least(1.0::DOUBLE, abs((sqrt(4.0::DOUBLE - 3.0::DOUBLE * u) - 2.0::DOUBLE) / -1.0::DOUBLE))
    WHEN 1 THEN u
    ELSE least(1.0::DOUBLE, abs(sqrt(1.0::DOUBLE + 3.0::DOUBLE * u) - 1.0::DOUBLE)) END END, 9) AS position
FROM p
""",
    "op10_hyperplane": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (
  SELECT vec_id, label, e FROM v
  WHERE label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
part AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, p.component_id, v.vec_id = p.component_id AS kept
FROM v JOIN part p ON p.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
""",
}
