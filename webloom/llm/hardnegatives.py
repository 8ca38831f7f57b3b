"""Hard negatives by segment summaries: bounds on inner products decide most pairs, exact scores the rest.

Every anchor has positives, the best-scoring rows of its own label, and for each positive hard negatives: the best rows of
other labels whose score lies between ``low_percent`` of the positive's score and that score. Scores are integer inner
products; higher ones come first, ties go to the smaller id.

1. Summaries. Each vector is cut into segments, and every segment's mean and deviation are stored with the vector, for the
   segment counts of ``LEVELS``. For segments of L components with means p, q and deviations s, t the inner product lies in
   the sum of L p q plus or minus the sum of L s t (Cauchy-Schwarz on what the means leave), so the summaries alone bound
   the score from both sides. The bounds are widened by the rounding error that doubles can have.
2. Passes. Anchors are taken by id in blocks of ``ANCHOR_VALUES`` components, which bounds what is broadcast; each block meets
   all rows in one scan per phase, and rows are never shuffled. A task keeps the best rows per anchor, so its memory and
   its output are bounded by the block.
3. Filtering. A row counts for an anchor only if its upper bound reaches the anchor's worst kept score and, for
   negatives, if its bounds meet the range that a positive allows. Undecided pairs go to the next finer level; those left
   after the last are scored exactly. A level that leaves more than a quarter of a batch is scored as a whole.
4. The tasks' best rows meet in one aggregation per anchor (phase 1) or per anchor and positive (phase 2).

Defined cases: rows with a null id or label, a null vector or a null or non-finite component take no part; of rows that
repeat an id the smallest (label, vector) counts; rows whose vector has another length than the anchor's are never
compared with it, and empty vectors score 0; other columns are ignored; an empty table gives an empty result. Scores
that do not fit 64-bit integers raise an OverflowError instead of wrapping.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.tables import shared_path

LEVELS = (4, 16, 32)
ANCHOR_VALUES = 1 << 20
BATCH_VALUES = 1 << 18
N_POSITIVES = N_NEGATIVES = 5
LOW_PERCENT = 80


def usable(vector: str) -> Column:
    """True where the vector and all its components are there and finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(odd, F.lit(False))


def _bounds_of(dim: int, level: int) -> np.ndarray:
    """Starts of the segments, and the end: at most ``level`` of them, none empty."""
    return np.linspace(0, dim, min(level, dim) + 1).astype(int) if dim else np.zeros(1, dtype=int)


def summaries(x: np.ndarray, levels: tuple[int, ...] = LEVELS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level the segments' means and deviations, both times the root of the segment's length."""
    out = []
    for level in levels:
        cuts = _bounds_of(x.shape[1], level)
        means, devs = np.zeros((len(x), len(cuts) - 1)), np.zeros((len(x), len(cuts) - 1))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            part = x[:, a:b].astype(np.float64)
            means[:, k] = part.mean(axis=1) * np.sqrt(b - a)
            devs[:, k] = part.std(axis=1) * np.sqrt(b - a)
        out.append((means, devs))
    return out


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of two integer matrices, as 64-bit integers."""
    top = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (a, b)]
    worst = top[0] * top[1] * a.shape[1]
    if worst < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if worst < 1 << 63:
        return a @ b.T
    out = a.astype(object) @ b.astype(object).T
    if out.size and max(abs(out.max()), abs(out.min())) >= 1 << 63:
        raise OverflowError("a score does not fit 64 bits")
    return out.astype(np.int64)


def _paired(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Row-wise inner products of a[i] and b[j], in slices of bounded memory."""
    out, step = np.empty(len(i)), max(1, BATCH_VALUES * 4 // max(a.shape[1], 1))
    for k in range(0, len(i), step):
        s = slice(k, k + step)
        out[s] = np.einsum("ij,ij->i", a[i[s]], b[j[s]])
    return out


class Block:
    """Vectors of one length with their ids, labels and stored summaries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, marks: list | None = None):
        self.ids, self.labels, self.x = ids, labels, x
        self.marks = summaries(x) if marks is None else marks
        self.norms = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))

    def pairs(self, rows: Block, mask: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(own position, position in ``rows``, score) of the pairs of ``mask`` that may score from low to high."""
        i, j = np.nonzero(mask)
        for (means, devs), (row_means, row_devs) in zip(self.marks, rows.marks):
            if not len(i):
                break
            if len(i) * 4 > mask.size:
                mid, gap = (means @ row_means.T)[i, j], (devs @ row_devs.T)[i, j]
            else:
                mid, gap = _paired(means, row_means, i, j), _paired(devs, row_devs, i, j)
            gap = gap + 1e-12 * (4 + self.x.shape[1]) * self.norms[i] * rows.norms[j] + 1e-6
            stay = (mid + gap >= low[i]) & (mid - gap <= high[i])
            i, j = i[stay], j[stay]
        if not len(i):
            return i, j, np.zeros(0, dtype=np.int64)
        if len(i) * 4 > mask.size:
            scores = exact_scores(self.x, rows.x)[i, j]
        else:
            own, other = np.unique(i), np.unique(j)
            if len(own) * len(other) <= 8 * len(i) or float(np.abs(self.x).max()) * float(np.abs(rows.x).max()) * self.x.shape[1] >= 2**53:
                scores = exact_scores(self.x[own], rows.x[other])[np.searchsorted(own, i), np.searchsorted(other, j)]
            else:
                scores = _paired(self.x.astype(np.float64), rows.x.astype(np.float64), i, j).astype(np.int64)
        stay = (scores >= low[i]) & (scores <= high[i])
        return i[stay], j[stay], scores[stay]


def _best(key: np.ndarray, ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n best rows of each key, in (key, score descending, id) order."""
    order = np.lexsort((ids, -scores, key))
    k = key[order]
    starts = np.r_[0, np.nonzero(np.diff(k))[0] + 1] if len(k) else np.zeros(0, dtype=int)
    rank = np.arange(len(k)) - np.repeat(starts, np.diff(np.r_[starts, len(k)]))
    return order[rank < n]


class Keeper:
    """The n best (id, score) of each of a fixed number of keys."""

    def __init__(self, keys: int, n: int):
        self.n, self.floor = n, np.full(keys, -np.inf)
        self.key, self.ids, self.scores = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, key: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        key, ids, scores = (np.concatenate(x) for x in ((self.key, key), (self.ids, ids), (self.scores, scores)))
        best = _best(key, ids, scores, self.n)
        self.key, self.ids, self.scores = key[best], ids[best], scores[best]
        last = np.nonzero(np.r_[np.diff(self.key) != 0, True])[0] if len(self.key) else np.zeros(0, dtype=int)
        last = last[last >= self.n - 1]
        full = last[self.key[last - self.n + 1] == self.key[last]]
        self.floor[self.key[full]] = self.scores[full]


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[Block]:
    """Rows in batches of one vector length and a bounded number of components, with the stored summaries."""
    for frame in frames:
        sizes = frame["x"].map(len)
        for dim, rows in frame.groupby(sizes, sort=False):
            step = max(64, BATCH_VALUES // max(dim, 1))
            for k in range(0, len(rows), step):
                part = rows.iloc[k:k + step]
                x = np.array(part["x"].tolist(), dtype=np.int64).reshape(len(part), dim)
                marks, at = [], 0
                stored = np.array(part["marks"].tolist(), dtype=np.float64).reshape(len(part), -1)
                for level in LEVELS:
                    width = len(_bounds_of(dim, level)) - 1
                    marks.append((stored[:, at:at + width], stored[:, at + width:at + 2 * width]))
                    at += 2 * width
                yield Block(part["id"].to_numpy(), part["label"].to_numpy(), x, marks)


def _summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        frame["marks"] = None
        for dim, rows in frame.groupby(frame["x"].map(len), sort=False):
            x = np.array(rows["x"].tolist(), dtype=np.int64).reshape(len(rows), dim)
            flat = np.concatenate([y for pair in summaries(x) for y in pair], axis=1) if dim else np.zeros((len(rows), 0))
            frame.loc[rows.index, "marks"] = pd.Series(list(flat), index=rows.index, dtype=object)
        yield frame


def _positive_scan(shared, n: int) -> Callable:
    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors = [(at, Block(*rest)) for at, *rest in shared.value["anchors"]]
        best = Keeper(shared.value["count"], n)
        for rows in _blocks(frames):
            for at, own in anchors:
                if own.x.shape[1] == rows.x.shape[1]:
                    mask = (own.labels[:, None] == rows.labels[None, :]) & (own.ids[:, None] != rows.ids[None, :])
                    i, j, scores = own.pairs(rows, mask, best.floor[at], np.full(len(at), np.inf))
                    best.add(at[i], rows.ids[j], scores)
        yield pd.DataFrame({"key": best.key, "id": best.ids, "score": best.scores})

    return scan


def _negative_scan(shared, n: int, low_percent: int) -> Callable:
    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors = [(at, Block(*rest)) for at, *rest in shared.value["anchors"]]
        of, top = shared.value["positives"]  # the anchor and score of every positive, sorted by anchor
        best = Keeper(len(of), n)
        needed = np.array([-(-low_percent * int(s) // 100) for s in top], dtype=np.int64)  # smallest whole score of the range
        count = shared.value["count"]
        starts = np.searchsorted(of, np.arange(count + 1))
        for rows in _blocks(frames):
            for at, own in anchors:
                if own.x.shape[1] != rows.x.shape[1]:
                    continue
                low, high = np.full(count, np.inf), np.full(count, -np.inf)
                open_ = needed <= top
                np.minimum.at(low, of[open_], np.maximum(needed, best.floor)[open_])
                np.maximum.at(high, of[open_], top[open_].astype(float))
                mask = own.labels[:, None] != rows.labels[None, :]
                mask &= (own.ids[:, None] != rows.ids[None, :]) & (low <= high)[at][:, None]
                i, j, scores = own.pairs(rows, mask, low[at], high[at])
                # each surviving row meets the anchor's few positives
                n_of = np.diff(starts)[at[i]]
                k = np.repeat(np.arange(len(i)), n_of)
                p = np.repeat(starts[at[i]], n_of) + (np.arange(len(k)) - np.repeat(np.cumsum(n_of) - n_of, n_of))
                fits = (scores[k] <= top[p]) & (scores[k] >= needed[p]) & (scores[k] >= best.floor[p])
                best.add(p[fits], rows.ids[j[k[fits]]], scores[k[fits]])
        yield pd.DataFrame({"key": best.key, "id": best.ids, "score": best.scores})

    return scan


def _top(found: DataFrame, n: int) -> DataFrame:
    """The n best rows of each key over all tasks, with their rank."""
    order = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _packed(frame: pd.DataFrame) -> list[tuple]:
    """Anchors by vector length: (positions, ids, labels, vectors)."""
    out = []
    for dim, rows in frame.groupby(frame["x"].map(len), sort=True):
        x = np.array(rows["x"].tolist(), dtype=np.int64).reshape(len(rows), dim)
        out.append((rows.index.to_numpy(), rows["id"].to_numpy(), rows["label"].to_numpy(), x))
    return out


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "vector",
         n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES, low_percent: int = LOW_PERCENT,
         anchor_values: int = ANCHOR_VALUES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of integer vectors.

    ``is_anchor`` is a condition on the column ``id``. Ids and labels are integers.
    """
    spark = vectors.sparkSession
    path = shared_path(spark, "negatives")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).cast("array<bigint>").alias("x"))
    rows = rows.where("id is not null and label is not null and x is not null and not exists(x, v -> v is null)")
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.label", "r.x")
    rows.mapInPandas(_summarise, "id long, label long, x array<bigint>, marks array<double>").write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    rows.where(is_anchor).select("id", "label", "x").write.parquet(f"{path}/anchors")
    anchors = spark.read.parquet(f"{path}/anchors")
    out = "key long, id long, score long"
    width = anchors.agg(F.max(F.size("x"))).first()[0] or 1
    per_pass = max(1, anchor_values // width)
    last, done = None, []
    while True:
        block = anchors if last is None else anchors.where(F.col("id") > last)
        frame = block.orderBy("id").limit(per_pass).toPandas()  # bounded by anchor_values components
        if frame.empty:
            break
        last = int(frame["id"].iloc[-1])
        here = f"{path}/pass-{len(done)}"
        shared = spark.sparkContext.broadcast({"anchors": _packed(frame), "count": len(frame)})
        best = _top(rows.mapInPandas(_positive_scan(shared, n_positives), out), n_positives).toPandas()
        best = best.sort_values(["key", "rank"]).reset_index(drop=True)  # at most n_positives per anchor of the block
        shared.unpersist()
        pairs = pd.DataFrame({"key": best.index.astype("int64"), "anchor_id": frame["id"].to_numpy()[best["key"].to_numpy(dtype=int)],
                              "positive_id": best["id"], "positive_score": best["score"]})
        shared = spark.sparkContext.broadcast({
            "anchors": _packed(frame), "count": len(frame),
            "positives": (best["key"].to_numpy(dtype=np.int64), best["score"].to_numpy(dtype=np.int64))})
        found = _top(rows.mapInPandas(_negative_scan(shared, n_negatives, low_percent), out), n_negatives)
        keys = spark.createDataFrame(pairs, "key long, anchor_id long, positive_id long, positive_score long")
        found.join(F.broadcast(keys), "key").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")).write.parquet(here)
        shared.destroy()
        done.append(here)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)
