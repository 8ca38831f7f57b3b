"""Line dedup over levelled sorted runs.

The state is a set of runs on shared storage. A run is a table (key, n_docs, top) hashed on ``key`` into buckets and
sorted inside them: how many documents of its batches hold a line, and the largest doc_id among them. A new batch

1. reduces its lines to one entry a key,
2. is merge-anti-joined with every run, which leaves the keys nobody held before,
3. writes a ledger of its repeats: every line of the batch but the ones it is the first holder of,
4. adds its own entries as a run of level 0.

When a level holds ``fanout`` runs they are merged into one run of the next level, so a key is rewritten once per
level. Batches arrive in descending doc_id order, so the first holder of a line is the largest doc_id with it. At
the end the runs give every line's document count; a repeat of a line that reaches ``min_docs`` is dropped.

Keys are the MD5 of the normalised line (trimmed, A-Z lower-cased); only keys of ``min_chars`` code points or more
enter. Only narrow rows move, apart from one join of the texts to their dropped positions on doc_id. A hot line is
one row per document holding it; counts are partial aggregates and the joins on the key can be split by AQE.

Defined cases: null and empty text are one empty line, never dropped. Rows without doc_id are returned untouched and
hold no line. Rows that repeat a doc_id are one document: a line counts once for it, and a position judged a repeat
goes from each of these rows. Extra columns are kept as they are; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.tables import ascii_lower, free_name, lines_of, quoted, shared_path, trimmed

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 3


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, at) once per document and long line; ``at`` are the positions of the line in the document."""
    lines = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.posexplode(lines_of(F.col(text_col))).alias("at", "line"))
    lines = lines.select("doc_id", "at", trimmed(F.col("line")).alias("line")).where(F.char_length("line") >= min_chars)
    return (lines.select("doc_id", "at", line_key(F.col("line")).alias("key"))
            .groupBy("doc_id", "key").agg(F.collect_set("at").alias("at")))


def line_key(trimmed_line):
    return F.unhex(F.md5(ascii_lower(trimmed_line)))


class LineRuns:
    """Levelled sorted runs of line keys below ``path``."""

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.path = path or shared_path(spark, "line-runs")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, list[str]] = {}
        self.ledgers: list[str] = []
        self._made = 0

    def runs(self) -> list[DataFrame]:
        return [self.spark.read.parquet(p) for level in sorted(self.levels) for p in self.levels[level]]

    def add(self, rows: DataFrame) -> DataFrame:
        """Take a batch of (doc_id, key, ...); returns its repeats, those rows that are not the first holder of their key."""
        own = rows.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("top"))
        fresh = own
        for run in self.runs():
            fresh = fresh.join(run.select("key"), "key", "left_anti")
        first = fresh.select("key", F.col("top").alias("doc_id"))
        ledger = f"{self.path}/ledger-{len(self.ledgers)}"
        rows.join(first, ["key", "doc_id"], "left_anti").write.parquet(ledger, compression="zstd")
        self.ledgers.append(ledger)
        self._write(own, 0)
        return self.spark.read.parquet(ledger)

    def _write(self, entries: DataFrame, level: int) -> None:
        path = f"{self.path}/run-{level}-{self._made}"
        self._made += 1
        (entries.repartition(self.buckets, "key").sortWithinPartitions("key")
         .write.parquet(path, compression="zstd"))
        self.levels.setdefault(level, []).append(path)
        if len(self.levels[level]) >= self.fanout:
            merged = self._merge([self.spark.read.parquet(p) for p in self.levels[level]])
            self.levels[level] = []
            self._write(merged, level + 1)

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        every = runs[0]
        for run in runs[1:]:
            every = every.unionByName(run)
        return every.groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("top").alias("top"))

    def frequent(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """Keys that at least ``min_docs`` documents hold."""
        return self._merge(self.runs()).where(F.col("n_docs") >= min_docs).select("key")

    def repeats(self) -> DataFrame:
        return self.spark.read.parquet(*self.ledgers)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES,
                  fanout: int = FANOUT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, gone): the positions of the lines each document loses, found batch by batch over the runs."""
    spark = docs.sparkSession
    runs = LineRuns(spark, fanout=fanout)
    rows = line_keys(docs, min_chars, id_col, text_col)
    cuts = [k / batches for k in range(1, batches)]
    found = docs.agg(F.percentile_approx(F.col(id_col), F.array(*map(F.lit, cuts)), F.lit(1000)).alias("at")).first()
    edges = sorted(set(found["at"] or []))
    # descending doc_id: batch 0 holds the largest ids
    batch = F.lit(len(edges))
    for k, edge in enumerate(edges):
        batch = batch - F.when(F.col("doc_id") > F.lit(edge), 1).otherwise(0)
    staged = f"{runs.path}/lines"
    rows.withColumn("batch", batch.cast("int")).write.partitionBy("batch").parquet(staged, compression="zstd")
    schema = "doc_id {}, key binary, at array<int>, batch int".format(rows.schema["doc_id"].dataType.simpleString())
    stored = spark.read.schema(schema).parquet(staged)
    for k in range(len(edges) + 1):
        runs.add(stored.where(F.col("batch") == k).drop("batch"))
    gone = runs.repeats().join(runs.frequent(min_docs), "key", "left_semi")
    return gone.groupBy("doc_id").agg(F.flatten(F.collect_list("at")).alias("gone"))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES,
               fanout: int = FANOUT, id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """The documents with ``text_col`` reduced to the kept lines, and columns n_lines and n_dropped.

    Columns of these names that the documents bring are replaced. Without ``counts`` every other column stays as it is.
    """
    gone = dropped_lines(docs, min_chars, min_docs, batches, fanout, id_col, text_col)
    # columns of the documents keep their names, whatever they are; the inner ones step aside
    of, at, lines, kept = (free_name(docs, x) for x in ("_gone_of", "_gone_at", "_lines", "_kept"))
    gone = gone.select(F.col("doc_id").alias(of), F.col("gone").alias(at))
    # one plan at every size: the positions meet the texts by a merge join, not by a broadcast while they are few
    both = docs.join(gone.hint("merge"), quoted(id_col) == F.col(of), "left")
    both = both.withColumn(lines, lines_of(quoted(text_col)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(at))
    both = both.withColumn(kept, F.when(
        F.col(at).isNotNull(), F.transform(stay, lambda i: F.get(lines, i))).otherwise(F.col(lines)))
    added = [F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(kept)).cast("long").alias("n_dropped")] if counts else []
    replaced = {"n_lines", "n_dropped"} if counts else set()
    columns = [F.array_join(kept, "\n").alias(c) if c == text_col else quoted(c) for c in docs.columns if c.lower() not in replaced]
    return both.select(*columns, *added)
