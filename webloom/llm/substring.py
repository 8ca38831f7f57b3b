"""Removal of long word passages that occur in an earlier document, by suffix automata of reference shards.

A suffix automaton of a set of word sequences gives, word by word, the length of the longest run that ends there and
occurs in the set (matching statistics); a run of ``min_words`` or more marks its words. Documents are taken in
ascending doc_id order: a document is streamed through the automaton of what came before, then added to it.

One automaton of all documents would not fit a task, and broadcasting shards of it to every document would cost
the square of the corpus. So reference and documents are cut to what can match and meet by shards:

* content-chosen anchors (``anchors``) split every document into blocks of windows; a block whose content occurred
  in an earlier document is marked as a whole, and one that shares its anchor with no other content is done;
* the open blocks with one anchor are a shard: equal windows have equal anchors, so a shard's documents need
  no other shard. A shard's blocks are sorted by document and streamed through its automaton;
* a shard of more than ``max_shard`` blocks (a phrase of thousands of documents) is not given to one task: its windows
  are compared by hash, spread over all tasks. Both ways give the same result.

``remove_reference`` is the operator's other form, for a reference table small enough to broadcast: its size is checked
against ``max_words`` and a larger one is refused.

Defined cases: null and empty text have no words. Rows without doc_id cannot be placed in the order and are left out;
of rows that repeat a doc_id the one with the largest text counts. Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm import anchors
from webloom.llm import textarrays as ta
from webloom.llm.tables import one_row_per_id, shared_path

MIN_WORDS = 50
K = 8
MAX_SHARD = 400
MAX_REFERENCE_WORDS = 2_000_000


class SuffixAutomaton:
    """Suffix automaton of several sequences; no run crosses from one sequence into the next."""

    def __init__(self):
        self.link, self.length, self.step = [-1], [0], [{}]

    def _state(self, length: int, step: dict, link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, code: int, target: int) -> int:
        """A copy of ``target`` that ends runs of length[state] + 1, put in its place for shorter runs."""
        copy = self._state(self.length[state] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.step[state].get(code) == target:
            self.step[state][code] = copy
            state = self.link[state]
        return copy

    def add(self, codes: Iterable[int]) -> None:
        last, link, length, step = 0, self.link, self.length, self.step
        for code in codes:
            target = step[last].get(code)
            if target is not None:  # the run is there already, from an earlier sequence
                last = target if length[target] == length[last] + 1 else self._split(last, code, target)
                continue
            new, state = self._state(length[last] + 1, {}, 0), last
            while state >= 0 and code not in step[state]:
                step[state][code] = new
                state = link[state]
            if state >= 0:
                target = step[state][code]
                link[new] = target if length[target] == length[state] + 1 else self._split(state, code, target)
            last = new

    def statistics(self, codes: Iterable[int]) -> Iterator[int]:
        """For each position the length of the longest run ending there that occurs in a sequence."""
        state, size, link, length, step = 0, 0, self.link, self.length, self.step
        for code in codes:
            while state and code not in step[state]:
                state = link[state]
                size = length[state]
            target = step[state].get(code)
            if target is None:
                size = 0
            else:
                state, size = target, size + 1
            yield size


def long_runs(statistics: Iterable[int], least: int) -> list[tuple[int, int]]:
    """Closed ranges of starts of the windows of ``least`` codes that lie inside a matched run."""
    out: list[list[int]] = []
    for end, size in enumerate(statistics):
        if size >= least:
            start = end - least + 1
            if out and out[-1][1] == start - 1:
                out[-1][1] = start
            else:
                out.append([start, start])
    return [(a, b) for a, b in out]


def shard_matches(blocks: DataFrame, min_words: int) -> DataFrame:
    """(doc, lo, hi) of windows met in a smaller document, from (g, doc, lo, words) of open blocks."""
    ordered = blocks.repartition("g").sortWithinPartitions("g", "doc", "lo")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, document, waiting, automaton = None, None, [], SuffixAutomaton()
        for batch in batches:
            found = []
            for g, doc, lo, words in zip(*(batch.column(c).to_pylist() for c in ("g", "doc", "lo", "words"))):
                if g != shard:
                    shard, document, waiting, automaton = g, doc, [], SuffixAutomaton()
                elif doc != document:
                    for earlier in waiting:
                        automaton.add(earlier)
                    document, waiting = doc, []
                if len(automaton.length) > 1:
                    found += [(doc, lo + a, lo + b) for a, b in long_runs(automaton.statistics(words), min_words)]
                waiting.append(words)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*found), (pa.int64(), pa.int32(), pa.int32()))],
                    names=["doc", "lo", "hi"])

    return ordered.mapInArrow(run, "doc bigint, lo int, hi int")


def block_words(open_docs: DataFrame, min_words: int) -> DataFrame:
    """(g, doc, lo, words): word hashes of the open blocks of (doc_id, text, spans of (lo, hi, g))."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for first, last in ta.slices(batch.column("text")):
                sequence, offsets = anchors.word_codes(*ta.text_bytes(batch.column("text")[first:last]))
                spans = batch.column("spans")[first:last]
                row, lo, hi = anchors.spans_of(spans)
                begin = offsets[row] + lo
                size = hi - lo + min_words
                _, at = anchors.ranges(begin, begin + size - 1)
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [spans.flatten().field("g"), pa.array(ids[first:last][row]), pa.array(lo.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(sequence[at].view(np.int64)))],
                    names=["g", "doc", "lo", "words"])

    return open_docs.mapInArrow(run, "g bigint, doc bigint, lo int, words array<bigint>")


def repeated_spans(texts: DataFrame, min_words: int = MIN_WORDS, k: int = K, max_shard: int = MAX_SHARD) -> DataFrame:
    """(doc, lo, hi): word windows lo..hi of (doc_id, text) that also start in a smaller document."""
    spark = texts.sparkSession
    path = shared_path(spark, "word-blocks")
    rows = anchors.block_rows(texts, anchors.word_codes, min_words, k, other_docs=True)
    anchors.judged_blocks(rows, other_docs=True).write.parquet(path, compression="zstd")
    judged = spark.read.parquet(path)
    known = judged.where(F.col("kind") == anchors.KNOWN).select("doc", "lo", "hi")
    crowd = F.col("crowd") | (F.col("size") > max_shard)
    edges = judged.where(F.col("kind") == anchors.OPEN)
    sharded = (edges.where(~crowd).groupBy("doc").agg(F.collect_list(F.struct("lo", "hi", "g")).alias("spans"))
               .withColumnRenamed("doc", "doc_id").hint("shuffle_hash"))
    matched = shard_matches(block_words(texts.join(sharded, "doc_id"), min_words), min_words)
    crowded = anchors.gather(edges.where(crowd).select("doc", "lo", "hi"))
    windows = anchors.window_rows(texts.join(crowded, "doc_id"), anchors.word_codes, min_words, other_docs=True)
    return known.unionByName(matched).unionByName(anchors.judged_windows(windows, other_docs=True))


def _cut(marked: DataFrame, min_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in ta.slices(batch.column("text")):
                data, at = ta.text_bytes(batch.column("text")[first:last])
                starts, ends, words = ta.word_spans(data, at)
                row, lo, hi = anchors.spans_of(batch.column("spans")[first:last])
                gone = anchors.cover(words, row, lo, hi, min_words)
                kept = joined(data, starts[~gone], ends[~gone], np.concatenate([[0], np.cumsum(~gone)])[words])
                run_at, start, end = anchors.runs(gone, words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[first:last], pa.array(np.diff(words)), kept,
                     anchors.lists(run_at, start, last - first), anchors.lists(run_at, end, last - first)],
                    names=["doc_id", "n_words", "kept", "span_starts", "span_ends"])

    kind = marked.schema["doc_id"].dataType.simpleString()
    return marked.select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, n_words bigint, kept string, span_starts array<int>, span_ends array<int>")


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> pa.Array:
    """Words joined by one space; ``rows`` holds each row's first word."""
    last = np.zeros(len(starts), bool)
    last[rows[1:][np.diff(rows) > 0] - 1] = True
    sizes = ends - starts + ~last  # a space behind every word but a row's last
    out_at = np.concatenate([[0], np.cumsum(sizes)])
    index = np.repeat(starts - out_at[:-1], sizes) + np.arange(int(out_at[-1]))
    text = np.append(data, np.uint8(32))[np.minimum(index, len(data))]
    text[out_at[1:][~last] - 1] = 32
    return pa.Array.from_buffers(pa.large_string(), len(rows) - 1, [
        None, pa.py_buffer(out_at[rows].astype(np.int64)), pa.py_buffer(text)]).cast(pa.string())


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, k: int = K, max_shard: int = MAX_SHARD,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, kept, span_starts, span_ends): kept words joined by a space, removed runs of words."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = one_row_per_id(docs, id_col, text_col).toDF("doc_id", "text").repartition(parts, "doc_id")
    spans = anchors.gather(repeated_spans(texts, min_words, k, max_shard))
    return _cut(texts.join(spans, "doc_id", "left"), min_words)


def remove_reference(docs: DataFrame, reference: DataFrame, min_words: int = MIN_WORDS,
                     max_words: int = MAX_REFERENCE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``remove_repeats``, against a reference table (text) whose words are proven to be at most ``max_words``."""
    spark = docs.sparkSession
    sequences = reference.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        _sequences, "words array<bigint>")
    total = sequences.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    if total > max_words:
        raise ValueError(f"the reference has {total} words, more than max_words={max_words}; use remove_repeats")
    automaton = SuffixAutomaton()
    for row in sequences.toLocalIterator():
        automaton.add(row["words"])
    shared = spark.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in ta.slices(batch.column("text")):
                sequence, offsets = anchors.word_codes(*ta.text_bytes(batch.column("text")[first:last]))
                codes = sequence.view(np.int64).tolist()
                spans = [[{"lo": a, "hi": b} for a, b in long_runs(shared.value.statistics(codes[x:y]), min_words)]
                         for x, y in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[first:last], batch.column("text")[first:last],
                     pa.array(spans, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))],
                    names=["doc_id", "text", "spans"])

    texts = one_row_per_id(docs, id_col, text_col).toDF("doc_id", "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    return _cut(texts.mapInArrow(run, f"doc_id {kind}, text string, spans array<struct<lo:int,hi:int>>"), min_words)


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last in ta.slices(batch.column("text")):
            sequence, offsets = anchors.word_codes(*ta.text_bytes(batch.column("text")[first:last]))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(sequence.view(np.int64)))],
                names=["words"])
