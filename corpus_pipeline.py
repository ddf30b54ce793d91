"""A cleaned, deduplicated, decontaminated, redacted and packed corpus out of ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents; a changed text has its n_chars counted anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import decontam, langid, minhash, packing, pii
from tradeloom.llm.queries import held_out
from tradeloom.llm.runtime import stored, table


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language can be told: ``keep_identified`` rejects those without a text or a letter, and those in
    letters that no learned language has.

    Null ids and repeated rows are judged row by row. Without a labelled text there is nothing to parse by, and every text
    with a letter stays.
    """
    languages = langid.learn(docs.where(~held_out()).select("text", "lang"))
    if not languages.references:
        return langid.keep_identified(docs, langid.Languages({"any": " a "}), unknown=float("inf"))
    return langid.keep_identified(docs, languages)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one with the smallest id. Null ids are kept, and so are texts
    without words. Of rows that share a kept id one stays, as ``keep_one`` says; an empty table gives none.
    """
    return minhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the benchmark's passages out of the texts. All rows stay; null and empty texts, and those without a passage, are unchanged."""
    return _recounted(decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Hide personal data and secrets. All rows stay; null and empty texts, and those without a span, are unchanged."""
    return _recounted(pii.redact(docs, pii.learn(docs)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut into pieces of at most 1024 tokens and pack these into sequences. A null text is empty: one piece of the end token.
    Each of repeated rows is a document; an empty table has no pieces; other columns are not carried on.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("best_fit_packing", packing_stage),
]
#: Not expressible in SQL: learned models, tokenizer and packing. Tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that its predecessor kept, stored between stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
