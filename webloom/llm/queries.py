"""Registered queries of this subpackage: thin reports over its operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import (
    decontaminate, hardnegatives, jaccard, licenses, linededup, pieces, quality, spelling, substring, suffixdedup, toxicity,
    vectordedup, warc)
from webloom.llm.tables import documents


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixdedup.remove_repeats(documents(spark, sf_dir))
    return done.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("span_starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring.remove_repeats(documents(spark, sf_dir))
    removed = F.aggregate(F.zip_with("span_ends", "span_starts", lambda a, b: (a - b).cast("long")),
                          F.lit(0).cast("long"), lambda x, y: x + y)
    return done.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir))


def tokenizer_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    done = pieces.encode(docs, pieces.model_bytes(tokenizer_path())).drop("text")
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(documents(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir))


def op11_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectordedup.link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select("vec_id", "n_links", "component_id", "kept")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.where(F.col("label").isNotNull() & hardnegatives.usable("embedding"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    return hardnegatives.mine(rows.select("vec_id", label.alias("label"), whole.alias("vector")), F.col("id") % 100 == 0)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(documents(spark, sf_dir), plant_every=199))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_line_dedup": op2_line_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_warc": op5_warc,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_toxicity": op8_toxicity,
    "op9_licenses": op9_licenses,
    "op10_quality_rules": op10_quality_rules,
    "op11_vector_dedup": op11_vector_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling_variants": op13_spelling_variants,
}
