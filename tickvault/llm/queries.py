"""One registered query per operator, over its whole table and with production parameters."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.llm import oracles
from tickvault.llm.common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 tokens."""
    from tickvault.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language, learnt from the documents that are not held out."""
    from tickvault.llm.langid import languages
    return languages(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict. A page is labelled bad or good by the ``quality`` of the document its
    URL names (the last number of the path is that document's id)."""
    from tickvault.llm.urls import judge, url_path
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(url_path(F.col("url")), r"([0-9]{1,18})[^0-9]*$", 1)
    of = pages.select("url", F.when(number != "", number).cast("long").alias("doc_id"))
    marks = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("bad"))
    judged = judge(pages, of.join(marks, "doc_id").select("url", "bad"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "bad_rate")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base counts and verdict, cutoffs certified per language."""
    from tickvault.llm.quality import judge_quality
    marks = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("good"))
    judged = judge_quality(table(spark, sf_dir, "documents"), marks)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", F.concat_ws(",", "failed_rules").alias("failed_rules"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    from tickvault.llm.html_text import extract
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data spans."""
    from tickvault.llm.pii import pii_digest
    return pii_digest(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document into which a benchmark item leaks, with the item and the evidence."""
    from tickvault.llm.contamination import leaked_documents
    return leaked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies."""
    from tickvault.llm.neardup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot; equal texts are drawn together."""
    from tickvault.llm.sharding import shard_documents
    return shard_documents(table(spark, sf_dir, "documents"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message in reply order, without the passages it quotes."""
    from tickvault.llm.chat import reply_ordered
    return reply_ordered(table(spark, sf_dir, "conversations"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by the contract's rule and repaired at least cost."""
    from tickvault.llm.repair import repair_digest
    return repair_digest(table(spark, sf_dir, "conversations"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors, by inner product, for every vector whose id is divisible by 50."""
    from tickvault.llm.topk import search_digest
    return search_digest(table(spark, sf_dir, "embeddings"))


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs of words, and its text without their repetitions."""
    from tickvault.llm.periods import run_digest
    return run_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_language": op2_language,
    "op3_url_filter": op3_url_filter,
    "op4_quality_rules": op4_quality_rules,
    "op5_html_text": op5_html_text,
    "op6_pii": op6_pii,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_sharding": op8_sharding,
    "op9_decontamination": op9_decontamination,
    "op10_chat": op10_chat,
    "op11_repair": op11_repair,
    "op12_topk": op12_topk,
    "op13_periods": op13_periods,
}

#: DuckDB SQL of the queries that SQL can express. The others train, iterate or choose by statistics over
#: regular expressions that SQL engines lack; tests/llm compares them with brute-force versions.
ORACLES: dict[str, str] = {
    "op10_chat": oracles.CHAT,
}
