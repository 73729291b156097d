"""Corpus pipeline: the cleaning and packing stages applied in order to documents.

Every stage but the last returns the columns of ``documents``.  Rows with a null id pass
the stages that judge by id; null and empty texts are kept as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.llm import decontaminate, line_dedup, lsh_forest, packing, toxicity
from fundlens.llm.common import materialise, table

TOXIC_FROM = 0.5


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go."""
    scored = toxicity.score_rows(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col(toxicity.SCORE) < TOXIC_FROM).select(docs.columns)


def lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line chunks that stand elsewhere before are cut out of the texts; every row stays."""
    gone = line_dedup.repeated_chunks(docs.select("doc_id", "text")).withColumnRenamed("gone", "_gone")
    cut = F.array_join(line_dedup.kept_lines(F.col("text"), F.col("_gone")), "\n")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(cut)
    out = docs.join(gone, "doc_id", "left").withColumn("text", text)
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(n_chars))
    return out.select(docs.columns)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each near-duplicate class stays (five words, 0.8)."""
    copies = lsh_forest.near_duplicates(docs, size=5).where("NOT kept").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def contaminated_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.where("contaminated").select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens; one row per piece."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxic_out), ("line dedup", lines_out), ("near duplicates", near_copies_out),
          ("decontamination", contaminated_out), ("packing", packed)]
#: Several stages are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
