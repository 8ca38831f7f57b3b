"""Batch ledger and seen log of incremental runs: what is committed, and which URLs earlier batches had."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = "batch_id BIGINT, sink STRING, n_rows BIGINT, digest STRING"
SEEN_SCHEMA = "url STRING, batch_id BIGINT, bucket INT"
BUCKETS = 64


def _seeded(spark: SparkSession, schema: str, path: str, first: str) -> None:
    """An empty first partition where there is no table yet, so that a read finds one."""
    keys = {part.split("=")[0] for part in first.split("/")}
    columns = [c for c in spark.createDataFrame([], schema).columns if c not in keys]
    spark.createDataFrame([], schema).select(*columns).coalesce(1).write.mode("ignore").parquet(f"{path}/{first}")


class BatchLedger:
    """One entry per batch and sink, written when all sinks of the batch are; a batch without an entry did not happen."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        _seeded(spark, LEDGER_SCHEMA, self.path, "batch_id=-1")

    def entries(self) -> DataFrame:
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    def batches(self) -> DataFrame:
        return self.entries().select("batch_id").distinct()

    def has(self, batch_id: int) -> bool:
        return self.entries().where(F.col("batch_id") == batch_id).limit(1).count() > 0

    def commit(self, batch_id: int, sinks: dict[str, tuple[int, str]]) -> None:
        """A handful of rows: (rows, digest) of each sink. One file, so the entry is there as a whole or not at all."""
        rows = [(name, n, digest) for name, (n, digest) in sinks.items()]
        entry = self.spark.createDataFrame(rows, "sink STRING, n_rows BIGINT, digest STRING").coalesce(1)
        entry.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def committed(self, table: DataFrame) -> DataFrame:
        """The rows of committed batches; ``table`` is partitioned by batch_id, so the others are not read."""
        return table.join(F.broadcast(self.batches().where("batch_id >= 0")), "batch_id", "left_semi")


def digest(*columns: str) -> list[Column]:
    """Row count and an order-free digest of a table, as two aggregates."""
    return [F.count("*").cast("bigint").alias("n_rows"),
            F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest")]


def bucket_of(url: str = "url", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


class SeenLog:
    """S11 at scale: URLs by batch and hash bucket. A run reads the buckets that its URLs fall into, no others.

    ``path/batch_id=N/bucket=K`` holds the URLs of batch N; ``path/merged/upto=N/bucket=K`` all of the batches up to N. A batch's
    own folder is overwritten when it is written again. Which batches count is the ledger's to say.
    """

    def __init__(self, spark: SparkSession, path: str, ledger: BatchLedger, buckets: int = BUCKETS):
        self.spark, self.path, self.ledger, self.buckets = spark, path.rstrip("/"), ledger, buckets
        self.merges = BatchLedger(spark, f"{self.path}/merges")
        _seeded(spark, SEEN_SCHEMA, f"{self.path}/batches", "batch_id=-1/bucket=0")

    def write(self, batch_id: int, urls: DataFrame) -> None:
        rows = urls.select("url").where("url is not null").distinct().withColumn("bucket", bucket_of("url", self.buckets))
        # a bucket's rows in one file per batch
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/batches/batch_id={batch_id}")

    def _merged_upto(self) -> int:
        """The last batch of the newest complete merge, -1 without one; merges are ledger entries of their own."""
        return int(self.merges.batches().agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0])

    def urls(self) -> DataFrame:
        """(url, bucket) of all committed batches."""
        upto = self._merged_upto()
        recent = self.ledger.committed(self.spark.read.schema(SEEN_SCHEMA).parquet(f"{self.path}/batches").where(F.col("batch_id") > upto))
        recent = recent.select("url", "bucket")
        if upto < 0:
            return recent
        merged = self.spark.read.schema("url STRING, bucket INT").parquet(f"{self.path}/merged/upto={upto}")
        return merged.unionByName(recent)

    def unseen(self, candidates: DataFrame) -> DataFrame:
        """The candidates whose URL no committed batch had (exact string)."""
        # at most one row per bucket; the buckets prune the partitions of the log at run time
        touched = candidates.select(bucket_of("url", self.buckets).alias("bucket")).distinct().where(F.col("bucket") < self.buckets)
        seen = self.urls().join(F.broadcast(touched), "bucket", "left_semi").select("url")
        return candidates.join(seen, "url", "left_anti").select(*candidates.columns)

    def compact(self) -> int:
        """Merge the committed batches into one folder per bucket; returns the last batch it holds."""
        last = self.ledger.batches().agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]
        if last <= self._merged_upto():
            return int(last)
        self.urls().distinct().repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/merged/upto={last}")
        self.merges.commit(last, {"merged": (0, "0")})
        return int(last)
