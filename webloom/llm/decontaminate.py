"""Benchmark decontamination with SimHash over item-sized windows, in DataFrame functions only.

A document is contaminated by a benchmark item when a window of as many words as the item has a weighted shingle
similarity of ``MIN_SIMILARITY`` or more with it: shingles are five words, a shingle weighs as much as it has
code points, and the similarity is the sum of the smaller weights over the sum of the larger ones (as multisets).

1. Windows. Fingerprinting every window of every item's size is out of reach and not needed: a window that shares
   no shingle with an item has similarity 0. So shingles meet the benchmark's shingles first, and every shared one
   proposes the window that lines it up with the item. Items whose shared shingles in the document weigh less
   than ``MIN_SIMILARITY`` of the item's weight cannot reach the threshold and propose nothing.
2. Fingerprints: 64-bit SimHash of each proposed window and of each item.
3. Candidates: fingerprints are cut into 8 blocks of 8 bits. Two within ``RADIUS`` = 23 bits differ by at most
   two bits in some block (8 blocks times 3 bits would be 24), so the item side lists every block with its 36
   neighbours of one or two bits, the window side its 8 blocks, and an equality join on (window size, block number,
   value) finds every pair within the radius; the exact bit count removes the rest. A pair of similarity 0.8 or
   more can still be further apart, see the README for how often.
4. The exact similarity decides.

Only the benchmark is broadcast, after a count of its shingles; a larger one is joined by shuffle. The groups are
(document, item) pairs and windows, bounded by one document. Texts move once, to meet their windows on doc_id.

Words are maximal runs of letters and digits, lower-cased, so case and punctuation do not hide a passage.

Defined cases: null and empty texts match nothing; items of fewer than five words are no evidence and are not
searched. Rows without an id are left out; of rows that repeat an id the one with the largest text counts. Equal items
are reported each; of a document's windows on an item the most similar is reported, the first one on ties. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.tables import one_row_per_id, shared_path
from webloom.operators.common import maybe_broadcast

SHINGLE = 5
MIN_SIMILARITY = 0.8
BLOCKS, BLOCK_BITS = 8, 8
RADIUS = 23
MAX_BROADCAST_ROWS = 500_000


def plain_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1), "")


def shingles(words: str) -> Column:
    """(h, wt) of the five-word shingles of an array column, in order."""
    part = [lambda i, k=k: F.get(words, i + k) for k in range(SHINGLE)]
    return F.transform(F.when(F.size(words) >= SHINGLE, F.sequence(F.lit(0), F.size(words) - SHINGLE)), lambda i: F.struct(
        F.xxhash64(*[p(i) for p in part]).alias("h"),
        sum((F.char_length(p(i)) for p in part[1:]), F.char_length(part[0](i))).alias("wt")))


def hashes(words: str) -> Column:
    return F.transform(F.when(F.size(words) >= SHINGLE, F.sequence(F.lit(0), F.size(words) - SHINGLE)),
                       lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))


def simhash(features: str) -> Column:
    """64-bit SimHash of an array of (h, wt): a bit is set where the weights of the hashes that have it prevail."""
    def bit(b: Column) -> Column:
        total = F.aggregate(features, F.lit(0).cast("long"), lambda acc, x: acc + F.when(
            F.call_function("shiftright", x["h"], b).bitwiseAND(F.lit(1)) == 1, x["wt"]).otherwise(-x["wt"]))
        return F.when(total > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(63)), bit), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def blocks(print_col: str, neighbours: bool) -> Column:
    """Array of (block, value): the fingerprint's blocks, with their neighbours of one or two bits on demand."""
    # a bit twice is no flip, once is one bit; the masks are one literal array, not a struct each
    flips = sorted({(1 << a) ^ (1 << b) for a in range(BLOCK_BITS) for b in range(BLOCK_BITS)}
                   | {1 << b for b in range(BLOCK_BITS)}) if neighbours else [0]
    masks = F.expr(f"array({', '.join(map(str, flips))})")

    def block(k: Column) -> Column:
        value = F.call_function("shiftrightunsigned", F.col(print_col), k * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
        return F.transform(masks, lambda f: F.struct(k.alias("block"), value.cast("int").bitwiseXOR(f).alias("value")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), block))


def items_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, size, features, weight) of the items with at least one shingle."""
    rows = one_row_per_id(benchmark, id_col, text_col).toDF("item_id", "text")
    rows = rows.select("item_id", plain_words(F.col("text")).alias("w"))
    rows = rows.select("item_id", F.size("w").alias("size"), shingles("w").alias("features"))
    rows = rows.withColumn("weight", F.aggregate("features", F.lit(0).cast("long"), lambda a, x: a + x["wt"]))
    return rows.where("size >= 5")


def proposed(rows: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, windows): arrays of distinct (size, start) proposed by shared shingles in (doc_id, text)."""
    grams = items.select("item_id", "size", "weight", F.posexplode("features").alias("ipos", "f"))
    grams = grams.select("item_id", "size", "weight", "ipos", F.col("f.h").alias("h"), F.col("f.wt").alias("wt"))
    words = rows.select("doc_id", plain_words(F.col("text")).alias("w"))
    places = words.select("doc_id", F.size("w").alias("n"), hashes("w").alias("hs"))
    # explode_outer: the filters that explode implies would be pushed below the words and split each text per shingle
    places = places.select("doc_id", "n", F.posexplode_outer("hs").alias("pos", "h"))
    hits = places.join(maybe_broadcast(grams, MAX_BROADCAST_ROWS), "h")
    start = F.greatest(F.least(F.col("pos") - F.col("ipos"), F.col("n") - F.col("size")), F.lit(0))
    pairs = hits.groupBy("doc_id", "item_id", "size", "weight").agg(
        F.collect_set(F.struct("ipos", "wt")).alias("shared"), F.collect_set(start).alias("starts"))
    met = F.aggregate("shared", F.lit(0).cast("long"), lambda a, x: a + x["wt"])
    pairs = pairs.where(met >= MIN_SIMILARITY * F.col("weight"))
    per_doc = pairs.select("doc_id", "size", F.explode("starts").alias("start")).groupBy("doc_id")
    return per_doc.agg(F.collect_set(F.struct("size", "start")).alias("windows"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity): contaminated documents, one row per document and item."""
    rows = one_row_per_id(docs, id_col, text_col).toDF("doc_id", "text")
    spark = docs.sparkSession
    path = shared_path(spark, "leaks")
    # items and windows are a sliver of the corpus and read several times: written once, read from there
    items_of(benchmark).write.parquet(f"{path}/items")
    items = spark.read.parquet(f"{path}/items")
    spans = proposed(rows, items)
    cut = rows.join(spans.hint("shuffle_hash"), "doc_id").select("doc_id", "windows", plain_words(F.col("text")).alias("w"))
    windows = cut.select("doc_id", F.explode_outer(F.transform("windows", lambda x: F.struct(
        x["size"].alias("size"), x["start"].alias("start"),
        F.slice("w", x["start"] + 1, x["size"]).alias("w")))).alias("x"))
    windows = windows.select("doc_id", "x.size", "x.start", F.col("x.w").alias("w"))
    windows = windows.select("doc_id", "size", "start", F.size("w").alias("n"), shingles("w").alias("features"))
    windows.select("*", simhash("features").alias("print")).write.parquet(f"{path}/windows")
    windows = spark.read.parquet(f"{path}/windows")
    index = items.select("item_id", "size", simhash("features").alias("item_print"))
    index = index.select("item_id", "size", "item_print", F.explode(blocks("item_print", True)).alias("b"))
    index.select("item_id", "size", "item_print", "b.block", "b.value").write.parquet(f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    probes = windows.select("doc_id", "size", "start", "print", F.explode(blocks("print", False)).alias("b"))
    probes = probes.select("doc_id", "size", "start", "print", "b.block", "b.value")
    # the candidates are few: merge joins spare the driver a relation of each side
    near = probes.join(index.hint("merge"), ["size", "block", "value"])
    near = near.where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    near = near.select("doc_id", "size", "start", "item_id").distinct()
    parts = windows.select("doc_id", "size", "start", "n", F.explode_outer("features").alias("f"))
    parts = parts.groupBy("doc_id", "size", "start", "n", F.col("f.h").alias("h"), F.col("f.wt").alias("wt")).agg(
        F.count("*").alias("times"))
    whole = parts.groupBy("doc_id", "size", "start").agg(F.sum(F.col("wt") * F.col("times")).alias("all"))
    item_parts = items.select("item_id", "weight", F.explode("features").alias("f"))
    item_parts = item_parts.groupBy("item_id", "weight", F.col("f.h").alias("h")).agg(F.count("*").alias("item_times"))
    key = ["doc_id", "size", "start"]
    both = parts.join(near.hint("merge"), key).join(item_parts.hint("merge"), ["item_id", "h"])
    both = both.groupBy(*key, "n", "item_id", "weight").agg(
        F.sum(F.col("wt") * F.least("times", "item_times")).alias("common"))
    both = both.join(whole.hint("merge"), key)
    both = both.withColumn("similarity", F.col("common").cast("double") / (F.col("all") + F.col("weight") - F.col("common")))
    best = both.where(F.col("similarity") >= MIN_SIMILARITY).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("similarity", -F.col("start"), "n")).alias("best"))
    return best.select(
        "doc_id", "item_id", (-F.col("best.col2")).cast("long").alias("start_word"),
        F.col("best.n").cast("long").alias("n_words"), F.col("best.similarity").alias("similarity"))
