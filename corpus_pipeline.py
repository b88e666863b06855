"""The corpus pipeline: language ID, near-duplicate removal, decontamination, secret redaction, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; run() writes each result to the
shared folder and reads it back. Stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import materialize, table
from strandline.llm.decontam import contamination_by_text
from strandline.llm.jaccard import jaccard_components
from strandline.llm.language import keep_identified
from strandline.llm.secrets import redact_secrets
from strandline.llm.tokens import pack_documents, vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear, with that language as lang."""
    return keep_identified(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links join (four fifths or more of their five-word shingles shared), the one with
    the smallest doc_id; of rows with one doc_id and one text one, the first by its other columns; rows without doc_id all
    stay. Different texts of one doc_id are one document with the links of all of them: they stay or go together."""
    kept = jaccard_components(docs, n=5, percent=80).where("doc_id = component_id").select("doc_id").distinct()
    rest = F.min(F.struct("lang", "source", "n_chars")).alias("rest")
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").groupBy("doc_id", "text").agg(rest)
    return named.select("doc_id", "text", "rest.*").unionByName(docs.where("doc_id is null").select(*COLUMNS)).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window; of rows with one doc_id, or without any, only those whose own text holds one go."""
    bad = contamination_by_text(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("id"), F.col("digest").alias("d")).distinct()
    same = docs["doc_id"].eqNullSafe(bad["id"]) & (F.xxhash64(docs["text"]) == bad["d"])
    return docs.join(bad, same, "left_anti").select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return redact_secrets(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their windows."""
    return pack_documents(docs, 2, vocabulary())


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("secrets", secrets), ("pack", pack)]

#: SQL has no tokenizer, no trained language model and no automaton: tests hold near-duplicates and rejections against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
