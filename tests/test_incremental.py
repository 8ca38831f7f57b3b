"""Incremental extraction: batches killed between writes, replays, the ledger, the seen log and document manifests."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from webloom.operators import documents as DOC
from webloom.operators import rules as R
from webloom.operators.dom import build_dom
from webloom.operators.rules import step
from webloom.plans import presets as P
from webloom.sources import configs as C
from webloom.sources import sinks as K
from webloom.sources.ledger import BatchLedger, SeenLog
from webloom.streaming import incremental as INC

PAGES = "page_id long, url string, html string"
SITES = {"faqs": {"kind": "faq", "allowed_domains": ["a.com"], "data_deal": True},
         "shop": {"kind": "product", "allowed_domains": ["b.com"], "data_deal": False}}


def page(i, host, body):
    return (i, f"http://{host}/{i}", f"<html><body>{body}</body></html>")


BATCHES = [
    [page(1, "a.com", "<h1>één</h1><p>x</p>"), page(2, "b.com", "<h1> two </h1>"), page(3, "a.com", "<i>none</i>")],
    [page(4, "a.com", "<h1>four</h1>"), (5, "http://a.com/1", "<html><body><h1>again</h1></body></html>"),
     (6, "http://a.com/4", "<html><body><h1>twice in a batch</h1></body></html>"), (7, None, "<html>"), (8, "http://a.com/8", None)],
    [page(9, "c.com", "<h1>other site</h1>"), page(10, "b.com", "<h1>ten</h1><h1></h1>")],
]
WANT = {(1, "faqs", "faq", "http://a.com/1"): {"head": ["één"], "para": ["x"]},
        (2, "shop", "production-description", "http://b.com/2"): {"head": ["<h1> two </h1>"]},
        (4, "faqs", "faq", "http://a.com/4"): {"head": ["four"]},
        (10, "shop", "production-description", "http://b.com/10"): {"head": ["<h1>ten</h1>", "<h1></h1>"]}}


@pytest.fixture()
def feed(spark, tmp_path):
    """Adds the files of the given batches to the source, one file each."""
    def add(*which):
        for k in which:
            spark.createDataFrame(BATCHES[k], PAGES).coalesce(1).write.parquet(str(tmp_path / f"staged-{k}"))
            source = tmp_path / "source"
            source.mkdir(exist_ok=True)
            part, = glob.glob(str(tmp_path / f"staged-{k}" / "part-*.parquet"))
            os.rename(part, source / f"{k}.parquet")
    return add


def start(spark, tmp_path, on_write=None):
    sites = C.sites_from_dicts(spark, SITES)
    targets = {"head": [[step("desc", "h1")]], "para": [[step("desc", "p")]]}
    rules = R.rules_df(spark, {"faqs": targets, "shop": targets})
    return INC.start(spark, str(tmp_path / "source"), str(tmp_path / "out"), str(tmp_path / "checkpoint"), sites, rules,
                     files_per_trigger=1, on_write=on_write)


def found(run):
    return {(r["page_id"], r["site"], r["type"], r["url"]): dict(r["targets"]) for r in run.documents().collect()}


@pytest.mark.parametrize("at", ["records", "seen", "ledger"])
def test_a_batch_that_dies_after_any_write_leaves_the_same_result(spark, tmp_path, feed, at):
    feed(0, 1, 2)
    died = []

    def die(sink, batch_id):
        if sink == at and batch_id == 1:
            died.append(batch_id)
            raise RuntimeError("killed")

    query, run = start(spark, tmp_path, die)
    with pytest.raises(Exception, match="killed"):
        query.awaitTermination()
    assert died == [1]
    # what the dead batch wrote is not visible, unless it had its ledger entry
    assert set(found(run)) == {k for k in WANT if k[0] in ((1, 2, 4) if at == "ledger" else (1, 2))}
    query, run = start(spark, tmp_path)
    query.awaitTermination()
    assert found(run) == WANT and run.documents().count() == len(WANT)
    assert sorted(r["page_id"] for r in run.snapshots().collect()) == [1, 2, 4, 10]
    assert sorted(r["url"] for r in run.seen.urls().collect()) == sorted(
        ["http://a.com/1", "http://b.com/2", "http://a.com/3", "http://a.com/4", "http://c.com/9", "http://b.com/10"])
    entries = {(r["batch_id"], r["sink"]): r["n_rows"] for r in run.ledger.entries().collect()}
    assert entries == {(b, s): n for b, ns in enumerate([(2, 2, 3), (1, 1, 1), (1, 1, 2)]) for s, n in zip(("records", "html", "seen"), ns)}


def test_a_later_run_takes_new_urls_only_and_equals_the_batch_job(spark, tmp_path, feed):
    feed(0)
    query, run = start(spark, tmp_path)
    query.awaitTermination()
    run.seen.compact()
    feed(1, 2)
    query, run = start(spark, tmp_path)
    query.awaitTermination()
    assert found(run) == WANT
    first = spark.createDataFrame([r for b in BATCHES for r in b if r[0] not in (5, 6)], PAGES)
    targets = {"head": [[step("desc", "h1")]], "para": [[step("desc", "p")]]}
    rules = R.rules_df(spark, {"faqs": targets, "shop": targets})
    batch = DOC.documents(P.extraction(build_dom(first), first, C.sites_from_dicts(spark, SITES), rules))
    assert {(r["page_id"], r["site"], r["type"], r["url"]): dict(r["targets"]) for r in batch.collect()} == found(run)


def test_documents_name_their_fields_by_type(spark):
    rows = [(1, "s", "faq", "u1", "b", 1, "x"), (1, "s", "faq", "u1", "b", 0, "é"), (1, "s", "faq", "u1", "a", 0, ""),
            (2, "t", "js", "u2", "k", 0, "v")]
    long = spark.createDataFrame(rows, "page_id long, site string, type string, url string, target string, idx long, value string")
    docs = DOC.documents(long)
    lines = {r["page_id"]: r["j"] for r in docs.select("page_id", DOC.json_text().alias("j")).collect()}
    assert lines[1] == '{"page_id":1,"target_faq_div_xpath":{"a":[""],"b":["é","x"]},"faq_url":"u1","type":"faq"}'
    assert lines[2] == '{"page_id":2,"complex_web_target_js":{"k":["v"]},"complex_web_target_js_url":"u2","type":"js"}'
    back = DOC.parse(docs.select(DOC.json_text().alias("value")))
    assert {(r["page_id"], r["url"], str(r["targets"])) for r in back.collect()} == {
        (r["page_id"], r["url"], str(r["targets"])) for r in docs.collect()}


def test_a_manifest_shows_files_that_changed(spark, tmp_path):
    long = spark.createDataFrame([(i, f"s{i % 2}", "faq", f"u{i}", "t", 0, "line\nbreak") for i in range(40)],
                                 "page_id long, site string, type string, url string, target string, idx long, value string")
    path = str(tmp_path / "docs")
    assert K.write_documents(DOC.documents(long).repartition(3), path, ["site"]) == 40
    assert K.damaged_files(spark, path).count() == 0
    assert K.read_documents(spark, path, ["site"]).count() == 40
    files = sorted(glob.glob(path + "/site=*/part-*"))
    with open(files[0]) as f:
        lines = f.readlines()
    with open(files[0], "w") as f:
        f.writelines(lines[:-1])
    os.remove(files[1])
    for crc in glob.glob(path + "/site=*/.part-*.crc"):  # the local file system's own checksums
        os.remove(crc)
    with open(path + "/site=s1/part-new.txt", "w") as f:
        f.write("{}\n")
    bad = {r["file"]: (r["n_rows"], r["found_rows"]) for r in K.damaged_files(spark, path).collect()}
    assert len(bad) == 3 and bad["site=s1/part-new.txt"] == (None, 1)
    assert sorted(v for v in bad.values() if v[0] is not None)[0][0] is not None


def test_the_seen_log_reads_only_the_buckets_that_are_asked_for(spark, tmp_path):
    ledger = BatchLedger(spark, str(tmp_path / "ledger"))
    log = SeenLog(spark, str(tmp_path / "seen"), ledger, buckets=16)
    urls = spark.range(200).select(F.concat(F.lit("u"), "id").alias("url"))
    log.write(0, urls.where("id < 100"))
    ledger.commit(0, {"seen": (100, "0")})
    log.write(1, urls.where("id >= 100 and id < 150"))  # not committed
    ask = spark.createDataFrame([("u5",), ("u120",), ("new",), (None,)], "url string")
    out = log.unseen(ask)
    assert {r["url"] for r in out.collect()} == {"u120", "new", None}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"dynamicpruning#\d+ \[bucket#", plan) and re.search(r"dynamicpruning#\d+ \[batch_id#", plan)
    ledger.commit(1, {"seen": (50, "0")})
    assert log.compact() == 1 and log.compact() == 1
    assert {r["url"] for r in log.unseen(ask).collect()} == {"new", None}
    assert log.urls().count() == 150


def test_snapshots_of_kept_pages_only(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.com/x", "one"), (2, "http://a.com/x", "two"), (3, "http://a.com/y", "three")], PAGES)
    K.write_snapshots(pages, str(tmp_path / "all"))
    assert {r["html"] for r in spark.read.parquet(str(tmp_path / "all")).collect()} == {"two", "three"}
    K.write_snapshots(pages, str(tmp_path / "kept"), spark.createDataFrame([(1,), (1,)], "page_id long"))
    assert [r["html"] for r in spark.read.parquet(str(tmp_path / "kept")).collect()] == ["one"]
