"""Incremental extraction with rules. New pages of a stream feed several sinks, each batch exactly once.

A micro-batch writes its documents, the html of its kept pages and its URLs into folders of its own, each with overwrite,
and then one ledger entry. Everything a batch reads from earlier ones (the seen URLs) and all that readers get is limited
to batches with an entry. So a batch that dies between two writes left nothing visible; it is run again from the
stream's checkpoint with the same rows and finds the same earlier batches, and its second run replaces what the first left. A
batch whose entry exists is skipped when it is replayed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions import urls as U
from webloom.operators import documents as DOC
from webloom.operators.dom import build_dom
from webloom.operators.links import dedup_first
from webloom.plans import presets as P
from webloom.sources.ledger import BatchLedger, SeenLog, digest
from webloom.sources.pages import html_only
from webloom.streaming.stream import FILES_PER_TRIGGER, page_stream

RECORDS_SCHEMA = "value STRING, batch_id BIGINT, site STRING"
HTML_SCHEMA = "snapshot_key STRING, page_id BIGINT, url STRING, html STRING, batch_id BIGINT"


class IncrementalExtraction:
    """The sinks of one incremental run below ``out``; an instance is the function of ``foreachBatch``.

    ``on_write(sink, batch_id)`` is called after each write and after the ledger entry, for logs and tests.
    """

    def __init__(self, spark: SparkSession, out: str, sites: DataFrame, rules: DataFrame,
                 on_write: Callable[[str, int], None] | None = None):
        self.spark, self.out, self.sites, self.rules = spark, out.rstrip("/"), sites, rules
        self.ledger = BatchLedger(spark, f"{self.out}/ledger")
        self.seen = SeenLog(spark, f"{self.out}/seen", self.ledger)
        self.on_write = on_write or (lambda sink, batch_id: None)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.ledger.has(batch_id):
            return
        pages = html_only(batch)
        # the first row of every URL that no committed batch had; only ids and URLs are compared
        new = self.seen.unseen(dedup_first(pages.select("url", "page_id"), order=["page_id"]))
        fresh = pages.join(new, ["page_id", "url"], "left_semi").persist(StorageLevel.MEMORY_AND_DISK)
        index = build_dom(fresh.select("page_id", "html")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            docs = DOC.documents(P.extraction(index, fresh, self.sites, self.rules))
            sinks = {"records": self._records(docs, batch_id)}
            self.on_write("records", batch_id)
            sinks["html"] = self._html(fresh, batch_id)
            self.on_write("html", batch_id)
            self.seen.write(batch_id, fresh.select("url"))
            sinks["seen"] = tuple(fresh.select("url").agg(*digest("url")).first())
            self.on_write("seen", batch_id)
            self.ledger.commit(batch_id, sinks)
            self.on_write("ledger", batch_id)
        finally:
            index.unpersist()
            fresh.unpersist()

    def _records(self, docs: DataFrame, batch_id: int) -> tuple[int, str]:
        path = f"{self.out}/records/batch_id={batch_id}"
        docs.select(DOC.json_text().alias("value"), "site").write.mode("overwrite").partitionBy("site").text(path)
        return tuple(self.records(batch_id).agg(*digest("value")).first())

    def _html(self, fresh: DataFrame, batch_id: int) -> tuple[int, str]:
        """The html of the pages that have a document."""
        kept = DOC.parse(self.records(batch_id)).select("page_id").distinct()
        rows = fresh.join(kept, "page_id", "left_semi").select(U.snapshot_key("url").alias("snapshot_key"), "page_id", "url", "html")
        path = f"{self.out}/html/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(path)
        return tuple(self.spark.read.schema(HTML_SCHEMA).parquet(path).agg(*digest("page_id", "url", "html")).first())

    def records(self, batch_id: int | None = None) -> DataFrame:
        """Lines of JSON documents with their site: of one batch, or of all committed ones."""
        if batch_id is not None:
            schema = "value STRING, site STRING"
            return self.spark.read.schema(schema).text(f"{self.out}/records/batch_id={batch_id}")
        return self.ledger.committed(self.spark.read.schema(RECORDS_SCHEMA).text(f"{self.out}/records"))

    def documents(self) -> DataFrame:
        """``(site, page_id, type, url, targets)`` of all committed batches."""
        return DOC.parse(self.records().drop("batch_id"))

    def snapshots(self) -> DataFrame:
        return self.ledger.committed(self.spark.read.schema(HTML_SCHEMA).parquet(f"{self.out}/html"))


def start(spark: SparkSession, source_dir: str, out: str, checkpoint: str, sites: DataFrame, rules: DataFrame, glob: str = "*.parquet",
          files_per_trigger: int = FILES_PER_TRIGGER, on_write: Callable[[str, int], None] | None = None):
    """The stream over the page files of ``source_dir``, up to what is there now; returns (query, sinks)."""
    run = IncrementalExtraction(spark, out, sites, rules, on_write)
    pages = page_stream(spark, source_dir, glob, files_per_trigger)
    query = pages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    return query, run
