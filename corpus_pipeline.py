"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All stages but the last return the columns of ``documents``.

Null or empty texts are rejected by the first stage (no language). Columns beyond those of
``documents`` are carried through unchanged, also if named like a column that a stage makes.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.llm import contamination, langid, neardup, packing, pii
from tickvault.llm.common import stage, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; rejected ones go."""
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    rows = docs.select(F.struct("*").alias("row"))            # whole rows, so that no column of theirs is replaced
    return langid.predict(rows, model, text="row.text").filter("NOT rejected").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return contamination.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with token ids, sequence and offset."""
    return packing.packed_pieces(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Trained and iterative stages have no SQL; the tests compare run() with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
