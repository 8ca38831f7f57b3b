"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Words are the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of all texts, A-Z lower-cased, with at least ``MIN_LENGTH`` code
points and ``MIN_COUNT`` occurrences. Two words are near when exactly one inserted, deleted or replaced code point
tells them apart. Every frequent word that is near a far more frequent one points to it (its form), and the forms lead
to a root.

1. Tiles. Of two near words let m be the shorter length. The edit lies behind the first m // 2 code points or before
   the last m - m // 2, so the words share that prefix or that suffix. Words are dealt by (m, side, shared half), each
   under its own length and the one below. A group that holds more than ``BLOCK`` words is cut into blocks by hash, and every
   pair of its blocks is a tile: a frequent prefix becomes many tasks, and no task holds more than two blocks.
2. Comparison. The words of a tile are matrices of code points, one for each of the lengths m and m + 1. The common
   prefix and suffix lengths of all pairs are counted column by column; words are near when the two together reach the
   longer length minus one. A pair that shares both halves counts in the tile of the prefix only.
3. A tile returns one row per word: how many near words it has there, and the most frequent of them. Pairs are never
   listed. The rows of a word are added up over its tiles.
4. Roots. A form is at least ``FACTOR`` times as frequent as its word, so a chain of forms has at most 63 / log2(FACTOR)
   steps; doubling the pointers that many times' logarithm ends every chain, in a fixed number of joins on the word.

Defined cases: null and empty texts have no words; a null doc_id writes nothing before the colon of the planted
deletion's key; documents that repeat count as often as they stand there; an empty table gives an empty result; other
columns are ignored. Ties between forms go to the smallest word in code-point order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.tables import shared_path

RUN = "[A-Za-z\\u00C0-\\u00FF]"
MIN_LENGTH, MIN_COUNT, FACTOR = 6, 5, 5
BLOCK = 512
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TILE_ROWS = "word string, n_near long, near_n long, near string"


def planted(doc_id: Column, word: Column, every: int) -> Column:
    """``word`` without one code point when ``every`` divides the crc32 of ``doc_id:word``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word))
    at = (h % F.length(word)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
                  ).otherwise(word)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant_every: int | None = None,
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the frequent words. ``plant_every`` deletes a code point from runs by ``planted`` first."""
    # a greedy match from the first letter on is a maximal run; shorter runs cannot become words
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))
    # explode_outer: the filter that explode implies would be pushed below and match every text twice
    words = docs.select(F.col(id_col).alias("id"), F.explode_outer(runs).alias("word"))
    words = words.select("id", F.translate("word", _UPPER, _LOWER).alias("word"))
    if plant_every:
        words = words.select(planted(F.col("id"), F.col("word"), plant_every).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    return counts.where((F.col("n") >= min_count) & (F.length("word") >= min_length))


def _codes(words: np.ndarray, length: int) -> np.ndarray:
    """Code points of words of one length, one row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), length)


def _common(a: np.ndarray, b: np.ndarray, columns: list[tuple[int, int]]) -> np.ndarray:
    """For all pairs of rows: how many of the column pairs agree before the first that does not."""
    alive = np.ones((len(a), len(b)), dtype=bool)
    found = np.zeros(alive.shape, dtype=np.int32)
    for i, j in columns:
        alive &= a[:, i, None] == b[None, :, j]
        if not alive.any():
            break
        found += alive
    return found


def near_pairs(left: np.ndarray, right: np.ndarray, m: int, prefix_side: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of near words: ``left`` all of length m, ``right`` all of length m or all of m + 1."""
    long = len(right[0])
    a, b = _codes(left, m), _codes(right, long)
    prefix = _common(a, b, [(k, k) for k in range(m)])
    suffix = _common(a, b, [(m - 1 - k, long - 1 - k) for k in range(m)])
    near = (prefix + suffix >= long - 1) & ((long > m) | (prefix < m))
    if not prefix_side:
        near &= prefix < m // 2
    return np.nonzero(near)


def _tile(m: int, prefix_side: bool, words: np.ndarray, counts: np.ndarray, first: np.ndarray, second: np.ndarray):
    """(position, near position) both ways, of the near words of one tile: those of block one with those of block two."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    same = first is second
    out = []
    for la, lb in ((m, m), (m, m + 1), (m + 1, m)):
        if same and la > lb:
            continue  # in one block (m, m + 1) meets all
        a, b = first[size[first] == la], second[size[second] == lb]
        if len(a) and len(b):
            swap = la > lb
            i, j = near_pairs(words[b if swap else a], words[a if swap else b], m, prefix_side)
            x, y = (b[i], a[j]) if swap else (a[i], b[j])
            out.append((x, y))
            if not (same and la == lb):  # within one block equal lengths meet both ways by themselves
                out.append((y, x))
    return out


def _compare(tiles: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tiles (m, prefix_side, i, j, rows) to their words' near counts and most frequent near words."""
    for frame in tiles:
        parts = []
        for m, side, i, j, rows in zip(frame["m"], frame["prefix_side"], frame["i"], frame["j"], frame["rows"]):
            words = np.array([r["word"] for r in rows], dtype=object)
            counts = np.array([r["n"] for r in rows], dtype=np.int64)
            block = np.array([r["block"] for r in rows])
            first = np.nonzero(block == i)[0]
            found = _tile(m, side, words, counts, first, first if i == j else np.nonzero(block == j)[0])
            if sum(len(x) for x, _ in found):
                x, y = (np.concatenate(z) for z in zip(*found))
                parts.append(pd.DataFrame({"word": words[x], "near": words[y], "near_n": counts[y]}))
        if parts:
            pairs = pd.concat(parts, ignore_index=True)
            n_near = pairs.groupby("word", sort=False).size()
            pairs = pairs.sort_values(["word", "near_n", "near"], ascending=[True, False, True]).drop_duplicates("word")
            pairs["n_near"] = pairs["word"].map(n_near)
            yield pairs[["word", "n_near", "near_n", "near"]]


def tiles_of(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(m, prefix_side, i, j, rows): the block pairs of every group of words that share a half."""
    def keys(m: Column) -> list[Column]:
        half = (m / 2).cast("int")
        return [F.struct(m.alias("m"), F.lit(True).alias("prefix_side"), F.substring(F.col("word"), F.lit(1), half).alias("half")),
                F.struct(m.alias("m"), F.lit(False).alias("prefix_side"),
                         F.substring(F.col("word"), F.length("word") - (m - half) + 1, m - half).alias("half"))]

    size = F.length("word")
    dealt = words.select("word", "n", F.explode(F.array(*keys(size), *keys(size - 1))).alias("k"))
    key = ["m", "prefix_side", "half"]
    dealt = dealt.select("word", "n", "k.*").where("m > 0")
    sizes = dealt.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.count("*").alias("size"))
    sizes = sizes.where("size > 1").drop("size")
    rows = dealt.join(sizes.hint("merge"), key)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("word"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.select("*", other.alias("o"))
    rows = rows.withColumns({"i": F.least("block", "o"), "j": F.greatest("block", "o")})
    return rows.groupBy(*key, "i", "j").agg(F.collect_list(F.struct("block", "word", "n")).alias("rows")).where(F.size("rows") > 1)


def variants(words: DataFrame, factor: int = FACTOR, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n); words must be distinct."""
    spark = words.sparkSession
    path = shared_path(spark, "spelling")
    words.select("word", "n").write.parquet(f"{path}/words")  # read several times, a sliver of the corpus
    words = spark.read.parquet(f"{path}/words")
    parts = tiles_of(words, block).drop("half").mapInPandas(_compare, _TILE_ROWS)
    # the largest count first, then the smallest word: min of (-n, word)
    near = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"))
    near = near.select("word", "n_near", (-F.col("best.col1")).alias("near_n"), F.col("best.near").alias("near"))
    rows = words.join(near.hint("merge"), "word", "left")
    is_form = F.col("near_n") >= factor * F.col("n")
    rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                       F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"))
    rows.write.parquet(f"{path}/forms")
    rows = spark.read.parquet(f"{path}/forms")
    return rows.join(roots(rows.where("form is not null").select("word", "form"), factor, path).hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(forms: DataFrame, factor: int, path: str) -> DataFrame:
    """(word, root) of every word that has a form: the pointers are doubled until the longest possible chain has ended."""
    spark = forms.sparkSession
    steps = math.ceil(math.log2(63 / math.log2(factor)))
    hops = forms.select("word", F.col("form").alias("root"))
    for k in range(steps):
        further = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        hops = hops.join(further.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        hops.write.parquet(f"{path}/hops-{k}")
        hops = spark.read.parquet(f"{path}/hops-{k}")
    return hops
