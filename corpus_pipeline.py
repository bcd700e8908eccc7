"""Documents to packed batches: quality rules, language ID, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs.
All but the last return the columns of their input, whatever their names, in the same order. No stage looks at the order of rows,
so ties between rows don't arise except in near-dedup, which names its own; every stage reads whole texts of any
length, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import language_id, length_packing, near_dedup, quality_rules
from cadenza.llm._shared import Scratch

#: A document whose language is less sure than this goes: 0 is a text that no learned language explains, 1 a typical one of its language.
LEAST_LANGUAGE = 0.2


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that pass every rule of policy v1, by their ledger: rules are evaluated once, for whole texts.

    The ledger (each document with its measurements and failure bits) is a table in the shared folder; policies and
    ablations read it again. Null texts and texts without words go; rows that repeat are judged alike, each for itself.
    """
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"))
    ledger = Scratch(spark, "ledger").keep(quality_rules.ledger(whole, "document", field="text"), "ledger")
    return ledger.where(quality_rules.passes("v1")).select("document.*")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learned language; texts without letters, or that no learned language explains, go.

    Languages are learned from the labelled documents; without any, nothing can be told apart and nothing goes, and
    with one language only texts without letters go. Rows that repeat are judged alike, each for itself.
    """
    model = language_id.learn(docs)
    if model is None:
        return docs
    judged = language_id.predict(docs, model, lang_out="__lang", score_out="__score", decision_out="__decision")
    return judged.where((F.col("__lang") != "und") & (F.col("__decision") >= LEAST_LANGUAGE)).select(*(F.col(f"`{c}`") for c in docs.columns))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the smallest id, of each group linked by a similarity of 0.8 over five-word shingles.

    Rows that repeat (id and text) are copies of which one stays; null texts, texts without words and null ids stay.
    """
    return near_dedup.drop_near_duplicates(docs, size=5, percent=80)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the place of each document: bucket, padded, batch, slot. Rows that repeat get a place each; null texts have an end only."""
    return length_packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [("quality_rules", quality_stage), ("language_id", language_stage), ("near_dedup", dedup_stage), ("packing", packing_stage)]

#: Language ID and packing are not SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written to the shared folder before the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
