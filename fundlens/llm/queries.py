"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.llm import conversations, decontaminate, difference_cover, hard_negatives, langid, licenses, line_dedup, lsh_forest, maxscore, packing, quality, suffix_dedup, toxicity
from fundlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_maxscore_topk(spark: SparkSession, sf: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf, "embeddings"))


ORACLE["op1_maxscore_topk"] = """
WITH x AS (
  SELECT vec_id, min(list_transform(embedding, lambda c: floor(64 * c::DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.x, v.x) AS BIGINT) AS score
  FROM x q JOIN x v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id AND len(q.x) = len(v.x)),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@register
def op8_pack_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register
def op10_lsh_forest(spark: SparkSession, sf: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf, "documents"), size=2)


@register
def op9_difference_cover(spark: SparkSession, sf: str) -> DataFrame:
    return difference_cover.remove_repeats(table(spark, sf, "documents"))


@register
def op2_line_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf, "documents"))


ORACLE["op2_line_chunks"] = line_dedup.SQL


@register
def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register
def op6_compression_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register
def op7_kneser_ney_langid(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(table(spark, sf, "documents"))


@register
def op4_template_windows(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register
def op3_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"))


@register
def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    noise = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf, "embeddings"), noise=noise)


ORACLE["op11_hard_negatives"] = """
WITH r AS (
  SELECT vec_id, min({'label': CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END,
                      'x': list_transform(embedding, lambda c: floor(256 * c::DOUBLE))}) AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
  GROUP BY vec_id),
x AS (SELECT vec_id, r.label AS label, r.x AS x FROM r),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_inner_product(a.x, v.x) AS BIGINT) AS score
  FROM x a JOIN x v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id AND len(a.x) = len(v.x)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@register
def op13_hirschberg_repair(spark: SparkSession, sf: str) -> DataFrame:
    return conversations.repair(table(spark, sf, "conversations"))


@register
def op12_prefix_doubling(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf, "documents"))
