"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base rules look at one document: too few words, or more than half of its words inside word triples that come
up again. The second rule looks across documents: a line is hashed in normalised form (trimmed, A-Z
lower-cased), the distinct documents of one host that hold it are counted, and a line in more than ``max_docs`` of
them is boilerplate of that host. Boilerplate lines are removed, except in the smallest doc_id of the host holding
them, so one copy of every text stays. A document that loses so much that less than ``min_share`` of its words remain
is rejected as depleted. ``quality_rules`` gives the verdicts, ``clean_texts`` the kept documents without those lines.

Hot lines and hosts: (host, line, document) triples are made distinct by partial aggregation, counted per
(host, line) by partial aggregation, and only lines above the limit come back, to be joined to the narrow triples
(no text in any shuffle), where adaptive skew handling splits a hot line.

Defined cases: null or empty text has 0 words, fails the base rules and is not kept. A null host is a host
of its own. Rows without doc_id get their base columns, are no holder of a line and are never depleted. Rows
that repeat a doc_id count as one document in line counts; each gets its own base columns, and the removed words
of all of them together decide depletion. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.tables import ascii_lower, free_name, lines_of, quoted, trimmed, words_of

MIN_WORDS = 50
MAX_LINE_DOCS = 100
MIN_SHARE_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"


def base_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.select(
        F.col(id_col).alias("doc_id"),
        words_of(F.col(text_col)).alias("w"),
        F.filter(lines_of(F.col(text_col)), lambda x: trimmed(x) != "").alias("worded"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    step = step.select(
        "doc_id", "n_symbols", "w",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
    )
    # a triple's whole hash beside its start: one sort brings equal triples together, in a text of any length
    step = step.withColumn("triples", F.sort_array(F.coalesce(F.transform(
        F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), F.size("w") - 3)),
        lambda i: F.struct(F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("at")),
    ), F.array().cast("array<struct<h:bigint,at:int>>"))))
    step = step.drop("w")
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    step = step.withColumn("again", F.transform(
        F.filter("triples", lambda x, i: same(x, F.get("triples", i - 1)) | same(x, F.get("triples", i + 1))),
        lambda x: x["at"]))
    covered = F.array_distinct(F.concat("again", F.transform("again", lambda x: x + 1), F.transform("again", lambda x: x + 2)))
    return step.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.size("again") > 0, F.size(covered)).otherwise(0).cast("long").alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Narrow rows (host, key, doc_id, n_words): one per distinct worded line of a document."""
    lines = docs.where(F.col(id_col).isNotNull()).select(
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        F.col(id_col).alias("doc_id"),
        F.explode(lines_of(F.col(text_col))).alias("line"))
    lines = lines.select("host", "doc_id", trimmed(F.col("line")).alias("line")).where("line != ''")
    lines = lines.select(
        "host", "doc_id",
        F.xxhash64(ascii_lower(F.col("line"))).alias("key"),
        F.size(F.split("line", r"[\x20\x09-\x0D]+", -1)).cast("long").alias("n"))
    return lines.groupBy("host", "key", "doc_id").agg(F.sum("n").alias("n"))


def line_losses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                max_docs: int = MAX_LINE_DOCS) -> DataFrame:
    """(doc_id, n_all, n_cut, gone) of the documents that lose lines: words in all and lost, the lost (host, key)."""
    rows = line_rows(docs, id_col, text_col, host_col)
    hot = (rows.groupBy("host", "key").agg(F.count("*").alias("docs"), F.min("doc_id").alias("holder"))
           .where(F.col("docs") > max_docs).select("host", "key", "holder"))
    flagged = rows.join(hot, ["host", "key"], "left")
    lost = F.col("doc_id") != F.col("holder")
    per_doc = flagged.groupBy("doc_id").agg(
        F.sum("n").alias("n_all"), F.sum(F.when(lost, F.col("n")).otherwise(0)).alias("n_cut"),
        F.collect_list(F.when(lost, F.struct("host", "key"))).alias("gone"))
    return per_doc.where("n_cut > 0")


def depleted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
             max_docs: int = MAX_LINE_DOCS, min_share: int = MIN_SHARE_PERCENT) -> DataFrame:
    """(doc_id, n_cut): documents left with less than ``min_share`` percent of their words, and the words they lost."""
    per_doc = line_losses(docs, id_col, text_col, host_col, max_docs)
    return per_doc.where(100 * (F.col("n_all") - F.col("n_cut")) < min_share * F.col("n_all")).select("doc_id", "n_cut")


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
             max_docs: int = MAX_LINE_DOCS, min_share: int = MIN_SHARE_PERCENT) -> DataFrame:
    """Base columns of every row, ``kept`` and ``gone``, the (host, key) of the lines its document loses (or null)."""
    base = base_columns(docs, id_col, text_col)
    out = base.join(line_losses(docs, id_col, text_col, host_col, max_docs), "doc_id", "left")
    short = F.coalesce(100 * (F.col("n_all") - F.col("n_cut")) < min_share * F.col("n_all"), F.lit(False))
    return out.select(*base.columns, (~F.col("base_failed") & ~short).alias("kept"), "gone")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_docs: int = MAX_LINE_DOCS, min_share: int = MIN_SHARE_PERCENT) -> DataFrame:
    """Base columns of every row and ``kept``: base rules passed and not depleted by cross-document line removal."""
    return verdicts(docs, id_col, text_col, host_col, max_docs, min_share).drop("gone")


def cut_lines(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              host_col: str = "source") -> DataFrame:
    """``docs`` without the lines of ``gone`` (doc_id, gone); texts that lose no line are unchanged."""
    host = F.coalesce(quoted(host_col).cast("string"), F.lit(""))
    of, at, left = (free_name(docs, x) for x in ("_gone_of", "_gone", "_keys"))
    keys = F.transform(F.filter(at, lambda g: g["host"] == host), lambda g: g["key"])
    # a blank line has no key in line_rows and stays
    stays = lambda x: (trimmed(x) == "") | ~F.array_contains(left, F.xxhash64(ascii_lower(trimmed(x))))
    cut = docs.join(gone.select(F.col("doc_id").alias(of), F.col("gone").alias(at)).hint("merge"), quoted(id_col) == F.col(of), "left")
    cut = cut.withColumn(left, keys)
    text = F.when(F.size(left) > 0, F.array_join(F.filter(lines_of(quoted(text_col)), stays), "\n")).otherwise(quoted(text_col))
    return cut.select(*[text.alias(c) if c == text_col else quoted(c) for c in docs.columns])


def clean_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                max_docs: int = MAX_LINE_DOCS, min_share: int = MIN_SHARE_PERCENT) -> DataFrame:
    """The kept documents without their boilerplate lines. The verdicts are written to ``path`` and read from there.

    Rows without doc_id pass as they are; a doc_id that repeats goes when none of its rows is to be kept.
    """
    found = verdicts(docs, id_col, text_col, host_col, max_docs, min_share).where("doc_id is not null")
    found.select("doc_id", "kept", "gone").write.parquet(path)
    per_id = docs.sparkSession.read.parquet(path).groupBy("doc_id").agg(
        F.max("kept").alias("kept"), F.first("gone", ignorenulls=True).alias("gone"))
    of = free_name(docs, "_rejected")
    rejected = per_id.where(~F.col("kept")).select(F.col("doc_id").alias(of))
    left = docs.join(rejected.hint("merge"), quoted(id_col) == F.col(of), "left_anti")
    return cut_lines(left, per_id.where("gone is not null"), id_col, text_col, host_col)
