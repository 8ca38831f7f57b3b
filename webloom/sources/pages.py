"""Page sources: parquet tables, raw HTML files, seen-URL logs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# markup test used when no content type is known
HTML_MARKUP = r"(?i)<(?:!doctype\s+html|html|head|body)[\s>]"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_source(sf_dir: str, name: str) -> str:
    """Path of a table for a file stream, be it one file or a folder of files: only with a pattern takes a stream both."""
    return f"{sf_dir.rstrip('/')}/{{{name}.parquet}}"


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page ``(page_id, url, html)``."""
    return read_table(spark, sf_dir, "pages")


def read_html_files(spark: SparkSession, path: str) -> DataFrame:
    """S1 for raw files: one row per file, url = file path, html = whole text."""
    df = spark.read.option("wholetext", True).text(path)
    return df.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html")).withColumn(
        "page_id", F.xxhash64("url"))


def html_only(pages: DataFrame, content_type_col: str | None = None) -> DataFrame:
    """drop rows without url/html; keep HTML responses only.

    With a content-type column the test is ``text/html...``; without, a markup test.
    """
    df = pages.dropna(subset=["url", "html"])
    if content_type_col:
        return df.filter(F.lower(F.col(content_type_col)).startswith("text/html"))
    return df.filter(F.col("html").rlike(HTML_MARKUP))


def read_seen_log(spark: SparkSession, path: str) -> DataFrame:
    """Seen-URL log, one URL per line, right-trimmed."""
    return spark.read.text(path).select(F.rtrim(F.col("value")).alias("url")).filter(F.col("url") != "")


def append_seen_log(urls: DataFrame, path: str) -> None:
    """Append the URLs the log does not hold yet, each once (one per line). A missing log is empty."""
    new = urls.select("url").where("url != ''").distinct()
    try:
        new = new.join(read_seen_log(urls.sparkSession, path), "url", "left_anti")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    new.write.mode("append").text(path)
