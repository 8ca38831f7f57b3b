"""SentencePiece encoding and decoding through a table of distinct chunks.

A text becomes marked words: every space is a marker, a marker stands before the text, and a chunk is a run of markers
with the word behind it. When no piece of the vocabulary holds a marker behind another character, no piece
crosses from one chunk into the next, so the text's ids are its chunks' ids in order. Each task keeps a table of the
distinct chunks it has met, has the library segment every new chunk once, and joins ids back by position with array
indexing. A vocabulary whose pieces do cross is encoded text by text.

There is no shuffle: a table per task costs a few segmentations of the same chunk in different tasks, while
one global table would send every word occurrence through a join. The table is emptied when it holds
``max_chunks`` entries; long chunks are never kept.

Defined cases: null and empty text have no ids and decode to empty text. Rows are independent: null or repeated
ids and repeated rows stay as they are, one output row per input row. Extra columns are kept; a clash with the
result columns (``ids``, ``decoded``) is resolved by the result replacing the input's column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from webloom.llm.tables import quoted
from webloom.llm.textarrays import slices

MAX_CHUNKS = 300_000
MAX_CHUNK_CHARS = 200
MARK = "▁"

_CHUNK = re.compile(" +[^ ]*")


def model_bytes(path: str) -> bytes:
    """A vocabulary file (well below a megabyte), read once by the driver and sent along with the tasks."""
    with open(path, "rb") as f:
        return f.read()


class ChunkTable:
    """Ids and decoded text of distinct chunks; a chunk's key lacks its first marker, which the library adds."""

    def __init__(self, model: bytes, max_chunks: int = MAX_CHUNKS):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.max_chunks = max_chunks
        pieces = (self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size()))
        crossing = re.compile(f"[^{MARK}]{MARK}")
        self.separable = not any(crossing.search(p) for p in pieces)
        self._empty()

    def _empty(self) -> None:
        self.index: dict[str, int] = {}
        self.decoded: list[str] = []
        self.starts, self.lens, self.pool = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)

    def _learn(self, new: list[str]) -> None:
        ids = self.sp.encode(new, num_threads=1)
        ids = [x if c else [self.sp.piece_to_id(MARK)] for c, x in zip(new, ids)]  # "": a marker alone
        self.index.update(zip(new, range(len(self.decoded), len(self.decoded) + len(new))))
        self.decoded += [self.sp.decode(x) if c else "" for c, x in zip(new, ids)]
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.pool = np.concatenate([self.pool, np.fromiter((i for x in ids for i in x), np.int32, int(lens.sum()))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(ids of all texts in order, number of ids per text, decoded texts)."""
        if not self.separable:
            ids = self.sp.encode(texts, num_threads=1)
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((i for x in ids for i in x), np.int32, int(counts.sum()))
            return flat, counts, [self.sp.decode(x) for x in ids]
        chunks = [[c[1:] for c in _CHUNK.findall(" " + t.replace(MARK, " "))] if t else [] for t in texts]
        fresh = [c for c in set().union(*chunks) if c not in self.index]
        if fresh:
            self._learn(fresh)
        index, decoded = self.index, self.decoded
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        at = np.fromiter((index[c] for row in chunks for c in row), np.int64, int(sizes.sum()))
        lens = self.lens[at]
        ends = np.cumsum(lens)
        flat = self.pool[np.repeat(self.starts[at] - (ends - lens), lens) + np.arange(int(lens.sum()))]
        row_ends = np.concatenate([[0], ends])[np.cumsum(sizes)]
        counts = np.diff(row_ends, prepend=0)
        out = [" ".join([decoded[index[c]] for c in row]) for row in chunks]
        if len(index) > self.max_chunks or any(len(c) > MAX_CHUNK_CHARS for c in fresh):
            self._empty()
        return flat, counts, out


def encode(docs: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """The table with ``ids`` (array<int>) and ``decoded`` (the text the library decodes from them), which replace columns of
    these names."""
    names = [c for c in docs.columns if c.lower() not in ("ids", "decoded")]
    kept = docs.select(*map(quoted, names)) if len(names) < len(docs.columns) else docs
    # the tasks see plain names: a name with dots or backticks cannot be passed on to them
    plain = kept.toDF(*[f"c{k}" for k in range(len(names))])
    place = names.index(text_col)
    schema = T.StructType([*plain.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model)
        for batch in batches:
            for first, last in slices(batch.column(place)):
                part = batch.slice(first, last - first)
                flat, counts, decoded = table.encode([t or "" for t in part.column(place).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, ids, pa.array(decoded, pa.string())],
                    names=[*part.schema.names, "ids", "decoded"])

    return plain.mapInArrow(run, schema).toDF(*names, "ids", "decoded")
