"""Small table helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.session import checkpoint_dir

WHITESPACE = " \t\n\x0b\x0c\r"
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(table: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as the table has such a column (in any case)."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def one_row_per_id(table: DataFrame, id_col: str, value_col: str) -> DataFrame:
    """``(id, value)`` with every non-null id once.

    Rows without an id cannot be named in a per-document result and are left out. Of rows that repeat an id
    the one with the largest value stays (null below all), so the choice does not depend on row order. The ids
    alone are counted first: a table whose ids are unique, the usual case, is passed on without a shuffle.
    """
    rows = table.select(F.col(id_col), F.col(value_col)).where(F.col(id_col).isNotNull())
    repeated = rows.groupBy(id_col).count().where("count > 1").limit(1).count() > 0
    if not repeated:
        return rows
    return rows.groupBy(id_col).agg(F.max(value_col).alias(value_col))


def lines_of(text: Column) -> Column:
    """The text split at newlines; null and empty text are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than space, tab, newline, vertical tab, form feed and return."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITESPACE))
    return F.array_remove(F.split(trimmed, WORD_SPLIT, -1), "")


_NON_ASCII_CASED = r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(value: Column) -> Column:
    """A-Z lower-cased, everything else unchanged.

    ``lower`` does the same, and faster, wherever no other cased letter occurs; only the rest is translated
    character by character.
    """
    return F.when(value.rlike(_NON_ASCII_CASED), F.translate(value, _UPPER, _LOWER)).otherwise(F.lower(value))


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITESPACE))
