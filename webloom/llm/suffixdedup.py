"""Removal of bytes covered by long strings that occurred before, by external induced sorting.

Every string of ``length`` bytes that also starts earlier (smaller doc_id, or earlier in the document) marks its
bytes. The suffixes that matter are sorted outside memory, by Spark's spilling sorts over the cluster, and
the sorted few induce the rest (``anchors``):

1. sampled suffixes: content-chosen anchors, one tuple (k-gram, content, document, place) for about 35 bytes. The
   tuples are sorted by k-gram, content and place, so equal contents become neighbours; the first of them is the
   earliest and the others are repeats as a whole. A sampled tuple stands for all suffixes from lo to hi, whose
   common prefix with an equal neighbour is at least ``length``;
2. induced suffixes: only where the sorted order leaves open how far the common prefix reaches, at the edges of
   repeats, the suffixes between samples are named by their first ``length`` bytes and sorted in a second pass.

The queues of the method are the shuffles' sorted, disk-backed runs, not a structure inside one task: a
task holds one sort buffer, however large the corpus is. Texts move once, on doc_id, and that exchange serves both
the second pass and the result.

Defined cases: null and empty text have no bytes. Rows without doc_id cannot be placed in the order and are left out;
of rows that repeat a doc_id the one with the largest text counts. Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm import anchors
from webloom.llm import textarrays as ta
from webloom.llm.tables import one_row_per_id, shared_path

LENGTH = 100
K = 32


def repeated_spans(texts: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """(doc, lo, hi): windows lo..hi of (doc_id, text) that also start earlier."""
    spark = texts.sparkSession
    path = shared_path(spark, "suffix-blocks")
    rows = anchors.block_rows(texts, anchors.byte_codes, length, k, other_docs=False)
    anchors.judged_blocks(rows, other_docs=False).write.parquet(path, compression="zstd")
    judged = spark.read.parquet(path)
    known = judged.where(F.col("kind") == anchors.KNOWN).select("doc", "lo", "hi")
    edges = anchors.gather(judged.where(F.col("kind") == anchors.OPEN).select("doc", "lo", "hi"))
    windows = anchors.window_rows(texts.join(edges, "doc_id"), anchors.byte_codes, length, other_docs=False)
    return known.unionByName(anchors.judged_windows(windows, other_docs=False))


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = K, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, kept, span_starts, span_ends): remaining bytes and the removed runs of each document."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = one_row_per_id(docs, id_col, text_col).toDF("doc_id", "text").repartition(parts, "doc_id")
    marked = texts.join(anchors.gather(repeated_spans(texts, length, k)), "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in ta.slices(batch.column("text")):
                data, offsets = ta.text_bytes(batch.column("text")[first:last])
                row, lo, hi = anchors.spans_of(batch.column("spans")[first:last])
                gone = anchors.cover(offsets, row, lo, hi, length)
                kept_at = np.concatenate([[0], np.cumsum(~gone)])[offsets]
                kept = pa.Array.from_buffers(pa.large_binary(), last - first, [
                    None, pa.py_buffer(kept_at.astype(np.int64)), pa.py_buffer(data[~gone])])
                at, start, end = anchors.runs(gone, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[first:last], pa.array(np.diff(offsets)), kept.cast(pa.binary()),
                     anchors.lists(at, start, last - first), anchors.lists(at, end, last - first)],
                    names=["doc_id", "n_bytes", "kept", "span_starts", "span_ends"])

    kind = marked.schema["doc_id"].dataType.simpleString()
    return marked.select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, kept binary, span_starts array<int>, span_ends array<int>")
