"""Repeated fixed-length windows of a corpus, found from sampled positions.

A document is a sequence of codes (bytes or word hashes). Every window of ``length`` codes contains
``length - k + 1`` k-grams; the one with the smallest hash (leftmost on ties) is the window's anchor. The choice
depends on the window's content alone, so equal windows have equal anchors at equal offsets. Consecutive windows with
one anchor form a block, which is the text they cover together; a corpus has about 2 / (length - k + 2) blocks a code.

Blocks are the sampled suffixes that stand for all others:

* windows of a block whose whole content occurred before (in order of document, position) occurred before;
* a block that is the only content around its anchor's k-gram shares no window with any other block;
* only the windows of the remaining blocks, the *open* ones, at the edges of repeats, have to be compared one by one.

Rows travel as (kind, g, b, doc, lo, hi): the k-gram's and the content's hash and the block's window starts lo..hi.
Each task reduces its blocks first: a content met before in the task is *known* to be repeated, and of a k-gram with
many contents in one task two are sent under its key and the others, open in any case, under a key of their own.
So the rows that meet in one place under a frequent k-gram or a group of copies are a few per task, however many
documents hold it. Contents are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm import textarrays as ta

ASK, KNOWN, OPEN = 0, 1, 2
FLUSH_ROWS = 1 << 19
PIECE = 1 << 22
CROWD = 8
_POS = np.uint64((1 << 24) - 1)
#: (codes, offsets, places): the sequence of all documents of a slice and where each starts
Codes = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def byte_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ta.BYTE_CODES[data], offsets


def word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = ta.word_spans(data, offsets)
    return ta.word_hashes(data, starts, ends), first


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:len(values)] = values
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def blocks(codes: np.ndarray, offsets: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """(g, b, doc, lo, hi) of a slice; doc is a row number, lo and hi are positions in the document."""
    parts = []
    for at in range(0, max(len(codes) - length + 1, 0), PIECE):
        parts.append(_piece(codes[at:at + PIECE + length - 1], np.clip(offsets - at, 0, None), at, offsets, length, k))
    if not parts:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _piece(codes, offsets, at, whole, length, k):
    n = len(codes)
    hashes = ta.RangeHash(codes)
    here = np.arange(n - k + 1)
    grams = hashes(here, here + k)
    low = sliding_min((grams & ~_POS) | here.astype(np.uint64), length - k + 1)
    ends = np.minimum(offsets[1:], n)
    first = np.minimum(offsets[:-1], n)
    doc = np.repeat(np.arange(len(first)), ends - first)
    fits = np.arange(n - length + 1) + length <= ends[doc[:n - length + 1]]
    starts = np.flatnonzero(fits)
    if not len(starts):
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    anchor = (low[starts] & _POS).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    head = np.flatnonzero(new)
    lo = starts[head]
    hi = starts[np.concatenate([head[1:], [len(starts)]]) - 1]
    owner = doc[lo]
    b = hashes(lo, hi + length)
    base = whole[owner] - at
    return grams[anchor[head]], b, owner, lo - base, hi - base


def reduce_blocks(g, b, doc, lo, hi, other_docs: bool) -> tuple[np.ndarray, ...]:
    """(kind, crowd, g, b, doc, lo, hi) of a task's blocks after what the task can tell by itself."""
    order = np.lexsort((lo, doc, b))
    g, b, doc, lo, hi = g[order], b[order], doc[order], lo[order], hi[order]
    fresh = np.ones(len(b), bool)
    fresh[1:] = b[1:] != b[:-1]
    lead = np.maximum.accumulate(np.where(fresh, np.arange(len(b)), 0))
    after = doc > doc[lead] if other_docs else (doc > doc[lead]) | (lo > lo[lead])
    kind = np.where(after, KNOWN, ASK)
    # contents of one k-gram in this task, in order of their hash
    by_gram = np.flatnonzero(fresh)[np.argsort(g[fresh], kind="stable")]
    start = np.ones(len(by_gram), bool)
    start[1:] = g[by_gram[1:]] != g[by_gram[:-1]]
    rank = np.arange(len(by_gram)) - np.maximum.accumulate(np.where(start, np.arange(len(by_gram)), 0))
    sizes = np.diff(np.append(np.flatnonzero(start), len(by_gram)))
    crowded = np.zeros(len(b), bool)
    crowded[by_gram] = np.repeat(sizes, sizes) > CROWD
    late = np.zeros(len(b), bool)
    late[by_gram] = rank >= 2
    crowded, late = crowded[lead], late[lead]
    kind[(kind == ASK) & crowded & late] = OPEN
    own = kind != ASK
    g = np.where(own, ta.mix(doc.astype(np.uint64) * np.uint64(31) + lo.astype(np.uint64)), g)
    # runs of known blocks that follow each other are one row
    order = np.lexsort((lo, doc, kind))
    kind, crowded, g, b, doc, lo, hi = (x[order] for x in (kind, crowded, g, b, doc, lo, hi))
    joined = np.zeros(len(b), bool)
    joined[1:] = (kind[1:] == KNOWN) & (kind[:-1] == KNOWN) & (doc[1:] == doc[:-1]) & (lo[1:] <= hi[:-1] + 1)
    head = np.flatnonzero(~joined)
    tail = np.append(head[1:], len(b)) - 1 if len(head) else head
    return kind[head], crowded[head], g[head], b[head], doc[head], lo[head], hi[tail]


def block_rows(docs: DataFrame, codes: Codes, length: int, k: int, other_docs: bool) -> DataFrame:
    """Reduced block rows of (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for first, last in ta.slices(batch.column("text")):
                g, b, doc, lo, hi = blocks(*codes(*ta.text_bytes(batch.column("text")[first:last])), length, k)
                held.append((g, b, ids[first:last][doc], lo, hi))
                count += len(g)
                if count >= FLUSH_ROWS:
                    yield flush(held)
                    held, count = [], 0
        if count:
            yield flush(held)

    def flush(held):
        kind, crowd, g, b, doc, lo, hi = reduce_blocks(*(np.concatenate(x) for x in zip(*held)), other_docs)
        return pa.RecordBatch.from_arrays(
            [pa.array((kind + 4 * crowd).astype(np.int8)), pa.array(g.view(np.int64)), pa.array(b.view(np.int64)),
             pa.array(doc), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
            names=["kind", "g", "b", "doc", "lo", "hi"])

    return docs.mapInArrow(run, "kind tinyint, g bigint, b bigint, doc bigint, lo int, hi int")


def judged_blocks(rows: DataFrame, other_docs: bool) -> DataFrame:
    """(kind, g, doc, lo, hi, size, crowd): KNOWN and OPEN blocks; size and crowd tell how many contents share g."""
    content = Window.partitionBy("g", "b").orderBy("doc", "lo")
    gram = Window.partitionBy("g")
    rows = rows.select(
        (F.col("kind") % 4).alias("kind"), (F.col("kind") >= 4).alias("crowd"), "g", "b", "doc", "lo", "hi")
    rows = rows.withColumn("first_doc", F.first("doc").over(content)).withColumn("first_lo", F.first("lo").over(content))
    rows = rows.withColumn("least", F.min("b").over(gram)).withColumn("most", F.max("b").over(gram))
    rows = rows.withColumn("size", F.count("*").over(gram)).withColumn("crowd", F.max("crowd").over(gram))
    kind = (F.when(F.col("kind") != ASK, F.col("kind"))
            .when(later("doc", "lo", "first_doc", "first_lo", other_docs), KNOWN)
            .when(F.col("least") != F.col("most"), OPEN))
    return rows.withColumn("kind", kind.cast("tinyint")).where("kind is not null").select(
        "kind", "g", "doc", "lo", "hi", "size", "crowd")


def later(doc: str, lo: str, first_doc: str, first_lo: str, other_docs: bool) -> Column:
    after = F.col(doc) > F.col(first_doc)
    return after if other_docs else after | (F.col(lo) > F.col(first_lo))


def spans_of(batch_column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, lo, hi) of a column of lists of (lo, hi)."""
    sizes = np.asarray(batch_column.value_lengths().fill_null(0))
    flat = batch_column.flatten()
    return np.repeat(np.arange(len(sizes)), sizes), np.asarray(flat.field("lo")), np.asarray(flat.field("hi"))


def gather(lists: DataFrame) -> DataFrame:
    """(doc_id, spans) from (doc, lo, hi); a document's spans are bounded by its length."""
    return (lists.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
            .withColumnRenamed("doc", "doc_id").hint("shuffle_hash"))


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, value) of all integers of the closed ranges lo..hi."""
    sizes = hi - lo + 1
    index = np.repeat(np.arange(len(lo)), sizes)
    return index, np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[index]


def window_rows(open_docs: DataFrame, codes: Codes, length: int, other_docs: bool) -> DataFrame:
    """(kind, h, doc, at) of every window of the open blocks of (doc_id, text, spans)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for first, last in ta.slices(batch.column("text")):
                sequence, offsets = codes(*ta.text_bytes(batch.column("text")[first:last]))
                hashes = ta.RangeHash(sequence)
                row, lo, hi = spans_of(batch.column("spans")[first:last])
                index, at = ranges(lo.astype(np.int64), hi.astype(np.int64))
                place = offsets[row[index]] + at
                held.append((hashes(place, place + length), ids[first:last][row[index]], at))
                count += len(at)
                if count >= FLUSH_ROWS:
                    yield flush(held)
                    held, count = [], 0
        if count:
            yield flush(held)

    def flush(held):
        h, doc, at = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((at, doc, h))
        h, doc, at = h[order], doc[order], at[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = h[1:] != h[:-1]
        lead = np.maximum.accumulate(np.where(fresh, np.arange(len(h)), 0))
        known = doc > doc[lead] if other_docs else ~fresh & ((doc > doc[lead]) | (at > at[lead]))
        h = np.where(known, ta.mix(doc.astype(np.uint64) * np.uint64(31) + at.astype(np.uint64)), h)
        return pa.RecordBatch.from_arrays(
            [pa.array(known.astype(np.int8)), pa.array(h.view(np.int64)), pa.array(doc), pa.array(at.astype(np.int32))],
            names=["kind", "h", "doc", "at"])

    return open_docs.mapInArrow(run, "kind tinyint, h bigint, doc bigint, at int")


def judged_windows(rows: DataFrame, other_docs: bool) -> DataFrame:
    """(doc, lo, hi) of the windows that occurred before."""
    same = Window.partitionBy("h").orderBy("doc", "at")
    rows = rows.withColumn("first_doc", F.first("doc").over(same)).withColumn("first_at", F.first("at").over(same))
    known = (F.col("kind") == KNOWN) | later("doc", "at", "first_doc", "first_at", other_docs)
    return rows.where(known).select("doc", F.col("at").alias("lo"), F.col("at").alias("hi"))


def cover(sizes_at: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int) -> np.ndarray:
    """Which codes of a slice the windows lo..hi (per row, at offsets ``sizes_at``) cover."""
    marks = np.zeros(int(sizes_at[-1]) + 1, np.int64)
    # rows that repeat an id with a shorter text: spans end where the text ends
    begin = np.minimum(sizes_at[row] + lo, sizes_at[row + 1])
    end = np.minimum(sizes_at[row] + hi + length, sizes_at[row + 1])
    np.add.at(marks, begin, 1)
    np.add.at(marks, end, -1)
    return np.cumsum(marks[:-1]) > 0


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the maximal runs of a mask inside the rows, positions in the row."""
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = mask[heads]
    start = np.flatnonzero(begins)
    ends = mask.copy()
    if len(mask):
        ends[:-1] &= ~mask[1:] | begins[1:]
    end = np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return row, start - offsets[row], end - offsets[row]


def lists(row: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
    ends = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))
