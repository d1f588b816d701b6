"""Thin registered queries: each operator on its whole table, with the digest columns of its contract."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import byte_bpe, decontaminate, jaccard, language_id, mixing, personal, phrases, repeats, secrets, top_k, toxicity, trie, word_bpe


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.score(table(spark, sf_dir, "documents"), remainder("doc_id", 10) != 0)
    return rows.withColumn("held_out", remainder("doc_id", 10) == 0)


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), keep_bytes=False)


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                           public_tokenizers.PATTERN, keep_ids=False)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus`` (a null id counts as remainder 0)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(0)) % modulus


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder("i", 5) != 0)
    return toxicity.score(docs, model).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op7_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.report(table(spark, sf_dir, "documents"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, remainder("i", 3) != 1)
    return language_id.predict(docs, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False, keep_text=False)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(trie.rebuild(table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_repeats": op2_repeats,
    "op3_jaccard": op3_jaccard,
    "op4_decontaminate": op4_decontaminate,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_personal": op7_personal,
    "op8_top_k": op8_top_k,
    "op9_secrets": op9_secrets,
    "op10_language_id": op10_language_id,
    "op11_word_bpe": op11_word_bpe,
    "op12_phrases": op12_phrases,
    "op13_trie": op13_trie,
}

ORACLES: dict[str, str] = {
    "op8_top_k": """
WITH v AS (SELECT row_number() OVER () AS own, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.own, q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] for p in list_zip(q.e, c.e)]) AS BIGINT) AS score
      FROM v q JOIN v c ON q.own <> c.own AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op12_phrases": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
t AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, words[i:i + k - 1] AS gram FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(words) >= k)),
f AS MATERIALIZED (SELECT lang, gram, count(*) AS a FROM g GROUP BY lang, gram HAVING count(*) >= 30),
c AS (SELECT * FROM f WHERE len(gram) > 1),
longer AS (SELECT lang, gram[i:i + k - 1] AS gram, max(a) AS most FROM (
             SELECT lang, gram, a, k, unnest(range(1, len(gram) - k + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS k) WHERE k < len(gram)) GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN longer m ON m.lang = c.lang AND m.gram = c.gram WHERE m.most IS NULL OR 100 * m.most::HUGEINT < 80 * c.a::HUGEINT),
cuts AS (SELECT lang, gram, a, unnest(range(1, len(gram))) AS k FROM kept),
s AS (SELECT cuts.*, x.a AS l, y.a AS r, CAST(2000000::HUGEINT * cuts.a // (x.a::HUGEINT + y.a) AS BIGINT) AS score FROM cuts
      JOIN f x ON x.lang = cuts.lang AND x.gram = cuts.gram[1:k] JOIN f y ON y.lang = cuts.lang AND y.gram = cuts.gram[k + 1:]),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) AS cut FROM s),
o AS (SELECT lang, array_to_string(gram, ' ') AS phrase, a, l, r, score,
             row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(gram, ' ')) AS rank FROM b WHERE cut = 1)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN t ON t.lang = o.lang WHERE rank <= 2000""",
    "op13_trie": """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base,
             xor(list_reduce([4294967295::UBIGINT] || [ascii(ch)::UBIGINT FOR ch IN string_split(conv_id::VARCHAR, '')],
                             lambda a, b: list_reduce([xor(a, b), 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT],
                                                      lambda v, z: xor(v >> 1, 3988292384::UBIGINT * (v & 1)))), 4294967295::UBIGINT) % 6 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.base WHERE t.place <= c.h
      UNION ALL SELECT c.conv_id, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id WHERE t.place > c.h),
s AS (SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.place) FILTER (r.place IS NOT NULL), []) AS seq
      FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
p AS (SELECT conv_id, seq[1:d] AS path, d = len(seq) AS stops FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM s)),
n AS (SELECT path, len(path) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (stops), '')) AS ends_sha256 FROM p GROUP BY path),
k AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON k.path = n.path),
u AS (SELECT path[1:d] AS path, n_children, (n_convs - 1) * coalesce(length(path[len(path)].text), 0) AS saved
      FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM m)),
b AS (SELECT path, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM u GROUP BY path)
SELECT m.conv_id, m.depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, b.n_leaves, b.saved_tokens, m.ends_sha256
FROM m JOIN b ON b.path = m.path LEFT JOIN n up ON up.path = m.path[1:m.depth - 1] AND m.depth > 0""",
}
