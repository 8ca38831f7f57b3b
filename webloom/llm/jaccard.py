"""Set similarity join on word n-grams with vertical partitioning, and the components of its links.

Documents are sets of distinct three-word shingles (64-bit hashes). Two documents are linked when
100 * intersection >= 90 * union. Equal sets are one class, represented by its smallest doc_id.

The global n-gram order is by approximate document frequency, then hash. Frequencies come from one fixed-size array of
counts over all documents; the order only has to be the same everywhere, the result does not depend on it.

1. Prefixes. Linked sets share one of their ``n - ceil(0.9 n) + 1`` first n-grams in the global order. Of two sets,
   take the one whose prefix ends first: what they have in common is in both prefixes, or behind that end and so in
   that set's suffix. The overlap is at most the fewer prefix n-grams that other prefixes hold, and the longer suffix.
2. Stars. In each bucket of a shared prefix n-gram all members meet the one with the largest reach, and the
   pairs that pass the size and reach bounds are verified. A group of near copies becomes one component this way,
   with as many pairs as members.
3. Rest. Pairs of a bucket whose members are in different components after step 2 are verified too, so no link
   between components is lost; pairs inside one component need no test, as they change nothing. Each set carries 128
   cells, one byte of its n-grams' hashes each: every cell in which two sets differ holds an n-gram that only one of
   them has, and a pair with more such cells than linked sets of these sizes can have is no candidate.
4. Sketches. Before their n-grams move, the sets of a candidate pair are compared by sketches: cells like those of step
   3, but as many as a quarter of the set's size, so that long sets are told apart too. A linked pair always passes.
5. Verification. The global order is cut into fragments. For each candidate pair the partial overlap is counted in
   every fragment separately, and the counts are summed per pair.

Hot n-grams: buckets are aggregated by partial aggregation and joined on the n-gram, which AQE can split. Texts never
move: the documents of the candidate pairs are found again in a scan by a bitmap of fixed size.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing; with one or
two words the whole sequence is the one shingle. Rows without doc_id are left out; of rows that repeat a doc_id the
one with the largest text counts. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm import textarrays as ta
from webloom.llm.components import components
from webloom.llm.tables import one_row_per_id, shared_path

N = 3
PERCENT = 90
COUNTERS = 1 << 18
FRAGMENTS = 8
SLOTS = 1 << 24
WORDS = 16
#: Bytes of text that are hashed and ordered at once; a Python worker takes about 60 times that beside its batch.
SLICE_BYTES = 1 << 19


def shingle_sets(column: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash): the distinct shingles of each text, sorted by row and hash."""
    data, offsets = ta.text_bytes(column)
    starts, ends, first = ta.word_spans(data, offsets)
    words = ta.word_hashes(data, starts, ends, lower=True)
    sizes = np.diff(first)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(words))
    left = first[1:][row] - at
    begins = (left >= n) | ((sizes[row] < n) & (at == first[:-1][row]))
    at, row = at[begins], row[begins]
    hashes = ta.RangeHash(words)(at, np.minimum(at + n, first[1:][row]))
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    return row[new], hashes[new]


def order_keys(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Place of each n-gram in the global order: frequency in the upper bits, hash below (ties share a place)."""
    frequency = np.minimum(counts[hashes & np.uint64(COUNTERS - 1)], (1 << 24) - 1).astype(np.uint64)
    return (frequency << np.uint64(40)) | (hashes >> np.uint64(24))


def pivots(counts: np.ndarray, fragments: int = FRAGMENTS) -> np.ndarray:
    """Places that cut the global order into fragments of about as many occurrences each."""
    frequency = np.sort(np.minimum(counts, (1 << 24) - 1))
    weight = np.cumsum(frequency)
    if not len(weight) or not weight[-1]:
        return np.zeros(0, np.uint64)
    out = []
    for j in range(1, fragments):
        goal = weight[-1] * j / fragments
        f = frequency[np.searchsorted(weight, goal)]
        before = weight[np.searchsorted(frequency, f) - 1] if f > frequency[0] else 0
        share = (goal - before) / (weight[np.searchsorted(frequency, f, side="right") - 1] - before)
        out.append((int(f) << 40) | int(min(max(share, 0.0), 1.0) * ((1 << 40) - 1)))
    return np.array(out, np.uint64)


def profile(docs: DataFrame, n: int = N) -> DataFrame:
    """Written once: (doc_id, n, s1, s2) for each document, (bucket, times) of the n-gram counts of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for first, last in ta.slices(batch.column("text"), SLICE_BYTES):
                row, hashes = shingle_sets(batch.column("text")[first:last], n)
                counts += np.bincount((hashes & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
                at = np.searchsorted(row, np.arange(last - first + 1))
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(ta.mix(hashes ^ np.uint64(salt)))])
                        for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                s1, s2 = ((x[at[1:]] - x[at[:-1]]).view(np.int64) for x in sums)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[first:last].cast(pa.int64()), pa.array(np.diff(at).astype(np.int32)),
                     pa.array(s1), pa.array(s2), pa.nulls(last - first, pa.int32()), pa.nulls(last - first, pa.int64())],
                    names=["doc_id", "n", "s1", "s2", "bucket", "times"])
        at = np.flatnonzero(counts)
        gap = [pa.nulls(len(at), t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())]
        yield pa.RecordBatch.from_arrays([*gap, pa.array(at.astype(np.int32)), pa.array(counts[at])],
                                         names=["doc_id", "n", "s1", "s2", "bucket", "times"])

    return docs.mapInArrow(run, "doc_id bigint, n int, s1 bigint, s2 bigint, bucket int, times bigint")


def prefixes(docs: DataFrame, shared, n: int = N, percent: int = PERCENT) -> DataFrame:
    """(doc, n, prefix): the first n-grams of each document in the global order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in ta.slices(batch.column("text"), SLICE_BYTES):
                row, hashes = shingle_sets(batch.column("text")[first:last], n)
                order = np.lexsort((hashes, order_keys(hashes, shared.value), row))
                hashes = hashes[order]  # row keeps its order: it is the last key
                at = np.searchsorted(row, np.arange(last - first + 1))
                size = np.diff(at)
                length = np.where(size > 0, size + (-size * percent // 100) + 1, 0)  # n - ceil(n * percent / 100) + 1
                index = np.arange(len(row)) - at[row] < length[row]
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                cell = cells(row, hashes, last - first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[first:last].cast(pa.int64()), pa.array(size.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[index].view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, cell.size + 1, WORDS, dtype=np.int32)), pa.array(cell.ravel())),
                     sketches(row, hashes, size)],
                    names=["doc", "n", "prefix", "cells", "sketch"])

    return docs.mapInArrow(run, "doc bigint, n int, prefix array<bigint>, cells array<bigint>, sketch binary")


def cells(row: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """For each set, one byte for each of 8 * WORDS cells of the n-grams: the sum of their hashes' bytes."""
    place = row * (8 * WORDS) + (hashes & np.uint64(8 * WORDS - 1)).astype(np.int64)
    sums = np.bincount(place, ((hashes >> np.uint64(7)) & np.uint64(255)).astype(np.float64), n * 8 * WORDS)
    return np.fmod(sums, 256).astype(np.uint8).reshape(n, 8 * WORDS).view(np.int64)


def sketches(row: np.ndarray, hashes: np.ndarray, size: np.ndarray) -> pa.Array:
    """For each set, one byte for each of a power of two of cells, at least a quarter of the set's size."""
    width = 8 * WORDS << np.ceil(np.log2(np.maximum(size / (32 * WORDS), 1))).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(width)])
    place = ends[row] + (hashes & (width[row] - 1).astype(np.uint64)).astype(np.int64)
    sums = np.bincount(place, ((hashes >> np.uint64(40)) & np.uint64(255)).astype(np.float64), ends[-1])
    data = pa.py_buffer(np.fmod(sums, 256).astype(np.uint8))
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends.astype(np.int64)), data]).cast(pa.binary())


def unequal(a: bytes, b: bytes) -> int:
    """How many cells of two sketches differ, after the wider one is folded to the width of the other."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    width = min(len(x), len(y))
    x, y = (z.reshape(-1, width).sum(axis=0, dtype=np.uint8) for z in (x, y))
    return int(np.count_nonzero(x != y))


def sketched(pairs: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, n_a, b, n_b) whose sketches allow a link; ``sketch`` holds (doc, sketch).

    Every cell in which two sets differ holds an n-gram that only one of them has. The sketches grow with the sets, so
    that this sorts out long sets as well; a pair moves a few bytes for every eight n-grams instead of the n-grams.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("sketch_a"), batch.column("sketch_b"), batch.column("slack").to_pylist())
            keep = [unequal(a.as_buffer(), b.as_buffer()) <= slack for a, b, slack in both]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "n_a", "b", "n_b"])

    slack = (F.col("n_a") + F.col("n_b") - 2 * _needed("n_a", "n_b", percent)).cast("long")
    met = pairs.join(sketch.select(F.col("doc").alias("a"), F.col("sketch").alias("sketch_a")).hint("merge"), "a")
    met = met.join(sketch.select(F.col("doc").alias("b"), F.col("sketch").alias("sketch_b")).hint("merge"), "b")
    return met.withColumn("slack", slack).mapInArrow(run, "a bigint, n_a int, b bigint, n_b int")


def _unequal_cells(a: str, b: str) -> Column:
    """How many cells of two sets differ: a lower bound of the n-grams that only one of them has."""
    total = F.lit(0)
    for k in range(WORDS):
        x = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        for shift in (4, 2, 1):  # the lowest bit of each byte becomes the OR of its bits
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        total = total + F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    return total


def slot(doc: str) -> Column:
    return F.pmod(F.xxhash64(doc), F.lit(SLOTS))


def wanted(ids: DataFrame) -> np.ndarray:
    """A bitmap of a fixed number of slots over the documents ``doc``, whatever their number."""
    words = ids.select(slot("doc").alias("s")).groupBy(F.shiftright("s", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(SLOTS // 64, np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def fragments(docs: DataFrame, shared, picked, n: int = N) -> DataFrame:
    """(doc, fragment, grams): the sets of the documents whose slot is picked, cut at the pivots of the global order.

    Some documents share a slot with a candidate; the joins drop them. The bitmap spares a shuffle of all texts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = pivots(shared.value)
        for batch in batches:
            place = batch.column("slot").to_numpy(zero_copy_only=False)
            use = (picked.value[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)
            batch = batch.filter(pa.array(use.astype(bool)))
            ids = batch.column("doc_id").cast(pa.int64()).to_numpy(zero_copy_only=False)
            for first, last in ta.slices(batch.column("text"), SLICE_BYTES):
                row, hashes = shingle_sets(batch.column("text")[first:last], n)
                part = np.searchsorted(cuts, order_keys(hashes, shared.value), side="right")
                order = np.lexsort((hashes, part, row))
                row, part, hashes = row[order], part[order], hashes[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
                head = np.flatnonzero(new)
                ends = np.append(head, len(row)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first:last][row[head]]), pa.array(part[head].astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))],
                    names=["doc", "fragment", "grams"])

    return docs.withColumn("slot", slot("doc_id")).mapInArrow(run, "doc bigint, fragment int, grams array<bigint>")


def _needed(a: str, b: str, percent: int) -> Column:
    """Smallest overlap of a linked pair of sets of these sizes: ceil(percent * (a + b) / (100 + percent))."""
    return F.ceil(F.lit(percent) * (F.col(a) + F.col(b)) / F.lit(100 + percent) - F.lit(1e-9))


def _suffix(n: str, percent: int) -> Column:
    """n-grams behind the prefix of a set of n: ceil(percent * n / 100) - 1."""
    return F.ceil(F.lit(percent) * F.col(n) / F.lit(100) - F.lit(1e-9)) - 1


def _bound(percent: int) -> Column:
    """Whether sets of these sizes and reaches (suffix and shared prefix n-grams) can be linked.

    A prefix n-gram of one set may stand in the suffix of the other, so neither reach alone bounds the overlap.
    """
    a, b = _suffix("n_a", percent), _suffix("n_b", percent)
    most = F.least(F.col("reach_a") - a, F.col("reach_b") - b) + F.greatest(a, b)
    return F.least(most, F.col("n_a"), F.col("n_b")) >= _needed("n_a", "n_b", percent)


def _bounded(pairs: DataFrame, percent: int) -> DataFrame:
    return pairs.where(_bound(percent))


def verified(pairs: DataFrame, texts: DataFrame, shared, path: str, n: int, percent: int) -> DataFrame:
    """(u, v) of the pairs (a, n_a, b, n_b) that are linked: partial overlaps by fragment, summed per pair."""
    spark = texts.sparkSession
    pairs.write.parquet(f"{path}-pairs", compression="zstd")
    pairs = spark.read.parquet(f"{path}-pairs")
    both = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc")))
    picked = spark.sparkContext.broadcast(wanted(both))
    fragments(texts, shared, picked, n).write.parquet(f"{path}-fragments", compression="zstd")
    picked.destroy()
    parts = spark.read.parquet(f"{path}-fragments")
    right = parts.select(F.col("doc").alias("b"), "fragment", F.col("grams").alias("grams_b"))
    left = parts.select(F.col("doc").alias("a"), "fragment", F.col("grams").alias("grams_a"))
    met = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), ["a", "fragment"])
    overlap = met.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).alias("common"))
    overlap = overlap.groupBy("a", "b", "n_a", "n_b").agg(F.sum("common").alias("common"))
    linked = overlap.where(100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common")))
    linked.select(F.col("a").alias("u"), F.col("b").alias("v")).write.parquet(f"{path}-links")
    return spark.read.parquet(f"{path}-links")


def jaccard_components(docs: DataFrame, n: int = N, percent: int = PERCENT, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document."""
    spark = docs.sparkSession
    path = shared_path(spark, "jaccard")
    texts = one_row_per_id(docs, id_col, text_col).toDF("doc_id", "text")
    profile(texts, n).write.parquet(f"{path}/profile", compression="zstd")
    seen = spark.read.parquet(f"{path}/profile")
    sums = seen.where("bucket is not null").groupBy("bucket").agg(F.sum("times").alias("times")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)  # a fixed number of counters, whatever the corpus
    counts[sums["bucket"].to_numpy()] = sums["times"].to_numpy()
    shared = spark.sparkContext.broadcast(counts)

    sets = seen.where("doc_id is not null").select("doc_id", "n", "s1", "s2")
    classes = sets.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"))
    reps = classes.select(F.col("rep").alias("doc")).hint("shuffle_hash")
    short = prefixes(texts, shared, n, percent).where("n > 0").join(reps, "doc", "left_semi")
    short.write.parquet(f"{path}/prefixes", compression="zstd")
    short = spark.read.parquet(f"{path}/prefixes")

    every = short.select("doc", "n", F.size("prefix").alias("p"), F.explode("prefix").alias("gram"))
    common = every.groupBy("gram").agg(F.count("*").alias("docs")).where("docs > 1").select("gram")
    mine = every.join(common.hint("merge"), "gram").groupBy("doc", "n", "p").agg(F.collect_list("gram").alias("grams"))
    mine = mine.select("doc", "n", (F.col("n") - F.col("p") + F.size("grams")).alias("reach"), "grams")
    mine.write.parquet(f"{path}/members", compression="zstd")
    members = spark.read.parquet(f"{path}/members")
    buckets = members.select("doc", "n", "reach", F.explode("grams").alias("gram"))
    lead = buckets.groupBy("gram").agg(F.max(F.struct("reach", -F.col("doc"), "n")).alias("l"))
    lead = lead.select("gram", (-F.col("l.col2")).alias("a"), F.col("l.n").alias("n_a"), F.col("l.reach").alias("reach_a"))
    row = buckets.select("gram", F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("reach").alias("reach_b"))
    stars = _bounded(row.join(lead.hint("merge"), "gram").where("a != b"), percent).select("a", "n_a", "b", "n_b").distinct()
    sketch = short.select("doc", "sketch")
    after = components(verified(sketched(stars, sketch, percent), texts, shared, f"{path}/stars", n, percent))

    # members with their component; in a bucket, those outside the leader's component meet all the others
    placed = members.join(after.select(F.col("u").alias("doc"), F.col("v").alias("comp")), "doc", "left")
    placed = placed.withColumn("comp", F.coalesce("comp", "doc"))
    placed = placed.join(short.select("doc", "cells").hint("merge"), "doc")
    spread = placed.select("doc", "n", "reach", "comp", "cells", F.explode("grams").alias("gram"))
    top = spread.groupBy("gram").agg(
        F.max(F.struct("reach", -F.col("doc"), "comp")).alias("l"), F.min("comp").alias("least"), F.max("comp").alias("most"))
    top = top.where("least != most").select("gram", (-F.col("l.col2")).alias("leader"), F.col("l.comp").alias("main"))
    spread = spread.join(top.hint("merge"), "gram").where("doc != leader")
    left = spread.where("comp != main").select(
        "gram", F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("reach").alias("reach_a"), F.col("comp").alias("comp_a"),
        F.col("cells").alias("cells_a"))
    right = spread.select("gram", F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("reach").alias("reach_b"),
                          F.col("comp").alias("comp_b"), "main", F.col("cells").alias("cells_b"))
    met = left.join(right.hint("merge"), (left["gram"] == right["gram"]) & (F.col("comp_a") != F.col("comp_b"))
                    & ((F.col("comp_b") == F.col("main")) | (F.col("a") < F.col("b")))
                    & _bound(percent)
                    & (_unequal_cells("cells_a", "cells_b") <= F.col("n_a") + F.col("n_b") - 2 * _needed("n_a", "n_b", percent)))
    met = met.select("a", "n_a", "b", "n_b").distinct()
    rest = verified(sketched(met, sketch, percent), texts, shared, f"{path}/rest", n, percent)
    shared.destroy()  # every table that needed the counters is written
    final = components(after.unionByName(rest))

    found = classes.join(final.select(F.col("u").alias("rep"), F.col("v").alias("comp")), "rep", "left")
    found = found.select("n", "s1", "s2", F.coalesce("comp", "rep").alias("component_id"))
    out = sets.join(found.hint("merge"), ["n", "s1", "s2"], "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                      F.coalesce("component_id", "doc_id").alias("component_id"))
