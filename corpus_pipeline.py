"""Corpus pipeline: five stages over ``documents``, each written as Parquet and reread as the next one's input.

Every stage takes all its predecessor kept and returns the columns of ``documents``; the last one adds the token ids.
Texts that a stage shortens get their ``n_chars`` anew. Rows without a doc_id cannot be named by a verdict, so they
pass the filtering stages; a doc_id that repeats goes when none of its rows is to be kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import decontaminate, jaccard, linededup, pieces, quality
from webloom.llm.queries import tokenizer_path
from webloom.llm.tables import documents, free_name, quoted, shared_path


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is not among ``ids``; one plan at every size."""
    gone = free_name(docs, "_gone_id")
    return docs.join(ids.select(F.col("doc_id").alias(gone)).hint("merge"), quoted("doc_id") == F.col(gone), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are depleted go, the others lose the boilerplate lines of their host."""
    cut = quality.clean_texts(docs, shared_path(spark, "verdicts"))
    return cut.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else cut


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them."""
    cut = linededup.drop_lines(docs, counts=False)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else cut


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    groups = jaccard.jaccard_components(docs)
    return _without(docs, groups.where("doc_id != component_id"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontaminate.find_leaks(docs, benchmark).select("doc_id").distinct())


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and the text decoded from them."""
    done = pieces.encode(docs, pieces.model_bytes(tokenizer_path()))
    return done.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: The last stage returns tokenizer ids, which SQL cannot express; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path, compression="zstd")
        docs = spark.read.parquet(path)
    return docs
