"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, ctph, gbt, imi, ngrams, packing, pii, prefixes, repeats, simhash, textcnn, whitening
from .common import table
from .labelled import held_out

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)


PROBE = "<|im_end|><|im_start|>assistant ok"


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    done = chat.format_trees(chat.linear(rows.unionByName(probe)))
    read = done.select(
        "tree",
        "formatted",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    said = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return read.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP2_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), shown AS (
  SELECT *, 12 + length(role) + (length(role) - length(replace(replace(replace(role, '%', ''), chr(10), ''), '<', ''))) * 2
           + 1 + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 11 AS chars
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repeats.with_cut(table(spark, sf_dir, "documents").select("doc_id", "text"), "cut", width=200)
    return done.select(
        "doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256).alias("kept_sha256")
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs)).drop("text")
    base = found.withColumn("base", F.filter("spans", lambda s: s.base))
    counts = [
        F.size(F.filter("base", pii.is_kind(i))).cast("long").alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)
    ]
    return base.select(
        "doc_id",
        *counts,
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctph.compare_with_edits(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = gbt.fit(docs, table(spark, sf_dir, "labels").where(~held_out()), label="quality")
    return gbt.score(docs.select("doc_id", "text"), forest).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imi.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


OP7_SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
"""


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = textcnn.fit(docs, table(spark, sf_dir, "labels").where(~held_out()), label="toxic")
    scored = textcnn.flagged(textcnn.score(docs.select("doc_id", "text", "lang"), net), net)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
        F.col("flagged").alias("flagged_by_language"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, length=1024, separator=0)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_and_decode(docs, WORD_BPE)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    aside = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    scored = ngrams.score(table(spark, sf_dir, "documents"), ~aside, order=3)
    return scored.withColumn("held_out", ~F.col("learn")).drop("learn")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.nodes(prefixes.rebuilt(prefixes.turn_rows(table(spark, sf_dir, "conversations"))))


OP12_SQL = r"""
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS turns,
    list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
        lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, x: CASE WHEN (xor(c, x) & 1) = 1 THEN xor(xor(c, x) >> 1, 3988292384) ELSE xor(c, x) >> 1 END) AS reg
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), headed AS (
  SELECT o.conv_id, o.turns, coalesce(b.turns, []) AS lead, xor(o.reg, 4294967295) % 4 AS h
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
), rebuilt AS (
  SELECT conv_id, list_concat(lead[1:h], turns[h + 1:len(turns)]) AS p FROM headed
), pre AS (
  SELECT conv_id, d, p[1:d] AS k, len(p) = d AS is_end FROM (SELECT *, unnest(range(0, len(p) + 1)) AS d FROM rebuilt)
), node AS (
  SELECT k, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '') AS ends
  FROM pre GROUP BY k
), kid AS (
  SELECT k[1:depth - 1] AS k, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1
), whole AS (
  SELECT node.*, coalesce(kid.n, 0) AS n_children,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(node.k[depth].t, '[^ 	-
]+')) END AS w
  FROM node LEFT JOIN kid ON kid.k = node.k
), up AS (
  SELECT k[1:d] AS k, count(CASE WHEN n_children = 0 THEN 1 END) AS n_leaves, CAST(sum((n_convs - 1) * w) AS BIGINT) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM whole) GROUP BY 1
)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, up.n_leaves, up.saved AS saved_tokens,
  sha256(a.ends) AS ends_sha256
FROM whole a JOIN up ON up.k = a.k LEFT JOIN whole p ON a.depth > 0 AND p.k = a.k[1:a.depth - 1]
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4, step=256)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_simhash, op2_chat, op3_suffix_array, op4_pii, op5_fingerprint, op6_quality, op7_embeddings, op8_toxicity, op9_packing, op10_bpe, op11_lm, op12_prefix_trie, op13_whitening)
    return {f.__name__: f for f in found}


def all_sql() -> dict[str, str]:
    return {"op2_chat": OP2_SQL, "op7_embeddings": OP7_SQL, "op12_prefix_trie": OP12_SQL}
