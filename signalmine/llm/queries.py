"""The registered queries of the training-data operators: each applies its
operator to the whole of its table and derives the columns to compare."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmine.llm.common import table

# Folder of the public tokenizers' files; empty: where their package lies.
TOKENIZERS = os.environ.get("SIGNALMINE_TOKENIZERS", "")


def _tokenizer(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into bins of 512 to 8192 tokens."""
    from signalmine.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op2_ngram_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, n-gram log-likelihood ratio and verdict of all documents."""
    from signalmine.llm.quality_rules import judged

    out = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "score")


def op3_cross_polytope_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth vector among all vectors."""
    from signalmine.llm.cross_polytope import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids, written as rANS blocks and read back."""
    from signalmine.llm.rans import round_trip

    return round_trip(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op5_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mixture of all sources, at 150 % of their words, takes of each document."""
    from signalmine.llm.mixing import mixture

    return mixture(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (five-word shingles, 0.8)."""
    from signalmine.llm.ngram_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All passages of 50 words and more that documents repeat."""
    from signalmine.llm.suffix_dedup import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


def op8_external_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shuffled shards, read back."""
    from signalmine.llm.sharding import sharded

    return sharded(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that imitates the template, formatted and read back."""
    from signalmine.llm.chat_format import digests, formatted

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = F.lit("\\### Assistant: </turn> ok")
    kinds = {f.name: f.dataType for f in turns.schema}
    # the two turns of the conversation that the query adds
    trick = spark.range(2).select(
        F.lit(-7).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), says.alias("text"))
    return digests(formatted(turns.unionByName(trick)))


def op10_consensus_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    from signalmine.llm.html_extract import extracted

    return extracted(table(spark, sf_dir, "pages"))


def op11_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the windows of ten words of all benchmark items."""
    from signalmine.llm.decontamination import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    from signalmine.llm.prefix_trie import rebuilt_trie

    return rebuilt_trie(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the five positives of every hundredth vector, among all vectors."""
    from signalmine.llm.hard_negatives import mined, quantised

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), quantised(F.col("embedding")).alias("x"))
    return mined(rows, F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the five stages of corpus_pipeline.py."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_ngram_quality_rules, op3_cross_polytope_neighbours, op4_rans_token_files,
    op5_pareto_mixing, op6_ngram_jaccard_join, op7_suffix_array_dedup, op8_external_shuffle_shards, op9_chat_format,
    op10_consensus_html, op11_wu_manber_decontamination, op12_prefix_trie, op13_hard_negatives, pipeline,
)}
_CUT = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLES: dict[str, str] = {
    "op11_wu_manber_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_CUT} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_CUT} AS ws FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT DISTINCT item, least(len(ws), 10) AS m,
        unnest([array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') FOR i IN range(1, len(ws) - least(len(ws), 10) + 2)]) AS win
      FROM b WHERE len(ws) > 0),
w AS (SELECT r, m, unnest([{{'i': i, 'win': array_to_string(ws[i:i + m - 1], ' ')}} FOR i IN range(1, len(ws) - m + 2)]) AS x
      FROM d, (SELECT DISTINCT m FROM p) WHERE len(ws) >= m),
o AS (SELECT w.r, w.m, w.x.i AS i, w.x.win AS win FROM w SEMI JOIN p ON p.win = w.x.win AND p.m = w.m),
h AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS k FROM o) GROUP BY r),
t AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, win FROM o) JOIN p USING (win) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)""",
    # crc32 a bit at a time: a digit's code, then seven zeros, so that each step shifts once
    "op12_prefix_trie": """
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p,
        {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list(x ORDER BY p) AS xs FROM t GROUP BY c),
k AS (SELECT c, xs, c - c % 20 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(
          [[ord(s)::BIGINT, 0, 0, 0, 0, 0, 0, 0] FOR s IN string_split(CAST(c AS VARCHAR), '')])),
        lambda a, b: xor(xor(a, b) // 2, 3988292384 * (xor(a, b) % 2))), 4294967295) % 4 AS h FROM o),
r AS (SELECT k.c AS c, list_concat(coalesce(list_slice(b.xs, 1, k.h), []), coalesce(list_slice(k.xs, k.h + 1, len(k.xs)), [])) AS xs
      FROM k LEFT JOIN o AS b ON b.c = k.base),
m AS (SELECT c, d, list_slice(xs, 1, d) AS node, d = len(xs) AS ends FROM r, LATERAL (SELECT unnest(range(0, len(xs) + 1)) AS d)),
n AS (SELECT d, node, min(c) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256 FROM m GROUP BY d, node),
v AS (SELECT n.*, u.conv_id AS parent_conv_id, coalesce(w.n_children, 0) AS n_children,
        CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(n.node[n.d].text, '[^\\x20\\x09-\\x0D]+')) END AS worth
      FROM n LEFT JOIN n AS u ON n.d > 0 AND u.d = n.d - 1 AND u.node = list_slice(n.node, 1, n.d - 1)
      LEFT JOIN (SELECT d - 1 AS d, list_slice(node, 1, d - 1) AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL) w
        ON w.d = n.d AND w.node = n.node),
s AS (SELECT e AS d, list_slice(node, 1, e) AS node, sum(worth) AS saved, sum(CAST(n_children = 0 AS INT)) AS leaves
      FROM v, LATERAL (SELECT unnest(range(0, v.d + 1)) AS e) GROUP BY ALL)
SELECT conv_id, v.d AS depth, parent_conv_id, n_convs, n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM v JOIN s ON s.d = v.d AND s.node = v.node""",
    "op13_hard_negatives": """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS x
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS a, o.vec_id AS o, a.label = o.label AS same, CAST(list_inner_product(a.x, o.x) AS BIGINT) AS score
      FROM e AS a JOIN e AS o ON a.vec_id <> o.vec_id AND len(a.x) = len(o.x) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, o) <= 5)
SELECT p.a AS anchor_id, p.o AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.o AS negative_id,
  p.score AS positive_score, n.score AS negative_score
FROM p JOIN s AS n ON n.a = p.a AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
WINDOW w AS (PARTITION BY p.a, p.o ORDER BY n.score DESC, n.o) QUALIFY row_number() OVER w <= 10""",
}
