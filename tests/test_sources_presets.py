"""Raw-file sources (S1, S10), deny-extension filter (F6/U2), ordered stages."""

from pyspark.sql import functions as F

from webloom.functions import urls as U
from webloom.plans import presets as P
from webloom.sources import sinks as K
from webloom.sources.pages import html_only, read_html_files


def test_read_html_files_and_guard(spark, tmp_path):
    (tmp_path / "a.html").write_text("<html><body><a href=\"x.pdf\">x</a></body></html>", encoding="utf-8")
    (tmp_path / "b.txt").write_text("plain text, no markup", encoding="utf-8")
    df = read_html_files(spark, str(tmp_path))
    assert df.count() == 2
    kept = html_only(df).collect()
    assert len(kept) == 1 and kept[0]["url"].endswith("a.html")


def test_binary_files_bytes_unchanged(spark, tmp_path):
    data = bytes(range(256)) * 3
    (tmp_path / "f.pdf").write_bytes(data)
    files = K.read_binary_files(spark, str(tmp_path), "*.pdf")
    out = str(tmp_path / "out")
    K.write_files(files.withColumn("save_path", U.file_save_path("files", "url", "pdf")), out)
    back = spark.read.parquet(out).first()
    assert bytes(back["content"]) == data and back["save_path"].endswith("f.pdf")


def test_file_preset_takes_the_bytes_of_linked_files_only(spark, tmp_path):
    store = str(tmp_path / "store")
    names = ["http://s.com/a.PDF?x=1", "http://s.com/not-linked.pdf", "http://s.com/p.html", "http://s.com/" + "é" * 3 + ".pdf"]
    texts = spark.createDataFrame([(u, f"bytes of {u}") for u in names], "url string, text string").withColumn("url", U.safe_url("url"))
    K.store_texts(texts, store)
    html = '<html><body><a href="/a.PDF?x=1">1</a><a href="/a.PDF?x=1">2</a><a href="/p.html">3</a><a href="/ééé.pdf">4</a><a href="/gone.pdf">5</a></body></html>'
    pages = spark.createDataFrame([(1, "http://s.com/", html), (2, "http://s.com/2", html)], "page_id long, url string, html string")
    got = {r["url"]: (r["save_path"], bytes(r["content"]).decode(), r["n_bytes"]) for r in P.files(pages, store, "pdf", None, "f", "*.txt").collect()}
    assert set(got) == {"http://s.com/a.PDF?x=1", "http://s.com/%C3%A9%C3%A9%C3%A9.pdf"}
    path, text, size = got["http://s.com/a.PDF?x=1"]
    assert text == "bytes of http://s.com/a.PDF?x=1\n" and size == len(text) and path.startswith("f/s.com/")
    assert P.files(pages, store, "zip", None, "f").count() == 0


def test_stored_files_are_bundled_and_keep_their_bytes(spark, tmp_path):
    store, n = str(tmp_path / "store"), 2500
    bodies = {f"http://s.com/{i}.pdf": ["", f"{i}", f"é,{i}:7\n\n", "x" * i][i % 4].encode() for i in range(n)}
    bodies["http://s.com/raw.pdf"] = bytes(range(256))  # no UTF-8
    rows = spark.createDataFrame([*bodies.items(), (None, b"lost"), ("http://s.com/null.pdf", None)], "url string, text binary")
    K.store_texts(rows.repartition(3).withColumn("text", F.col("text").cast("string")), store)
    K.store_texts(spark.createDataFrame([("http://s.com/later.pdf", "1")], "url string, text string"), store)
    bodies |= {"http://s.com/null.pdf": b"", "http://s.com/later.pdf": b"1"}
    # the driver lists what a job reads: a path per bundle, not one per URL
    assert K.read_binary_files(spark, store, "*.txt").count() <= 5
    links = spark.createDataFrame([(u, i) for i, u in enumerate([*bodies, "http://s.com/gone.pdf", None])], "url string, k long")
    got = K.fetch(links, store, "*.txt")
    assert got.columns == ["url", "k", "n_bytes", "content"]
    got = got.collect()
    assert len(got) == len(bodies) and {r["url"]: bytes(r["content"]) for r in got} == {u: b + b"\n" for u, b in bodies.items()}
    assert all(r["n_bytes"] == len(r["content"]) for r in got)


def test_stored_texts_of_a_url_make_one_file_in_their_order(spark, tmp_path):
    store = str(tmp_path / "store")
    texts = [("u", "z"), ("v", "b"), ("u", "a"), ("v", "b"), ("u", "m")]
    K.store_texts(spark.createDataFrame(texts, "url string, text string").coalesce(1), store)
    K.store_texts(spark.createDataFrame([("u", "more")], "url string, text string"), store)  # another file of the same URL
    links = spark.createDataFrame([("u",), ("v",)], "url string")
    assert sorted((r["url"], bytes(r["content"])) for r in K.fetch(links, store).collect()) == [
        ("u", b"more\n"), ("u", b"z\na\nm\n"), ("v", b"b\nb\n")]


def test_a_large_text_stays_whole_and_bundles_follow_the_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "BUNDLE_BYTES", 4000)
    store = str(tmp_path / "store")
    rows = spark.range(400).selectExpr("concat('u', id) url", "repeat('ab', if(id = 7, 50000, 50)) text")
    K.store_texts(rows, store)
    sizes = [r["n_bytes"] for r in K.read_binary_files(spark, store).collect()]
    assert 10 < len(sizes) <= 36 and sorted(sizes)[-2] < 20000
    got = {r["url"]: bytes(r["content"]) for r in K.fetch(rows.select("url"), store).collect()}
    assert got == {f"u{i}": b"ab" * (50000 if i == 7 else 50) + b"\n" for i in range(400)}


def test_a_store_with_a_folder_for_each_file_is_read_as_it_is(spark, tmp_path):
    for u in ("u", "v"):
        folder = tmp_path / "store" / f"name={spark.range(1).select(K.file_name(F.lit(u))).first()[0]}"
        folder.mkdir(parents=True)
        (folder / "f.pdf").write_bytes(u.encode() + bytes(range(256)))
    got = K.fetch(spark.createDataFrame([("u", 1), ("w", 2)], "url string, k long"), str(tmp_path / "store"), "*.pdf").collect()
    assert [(r["url"], r["k"], r["n_bytes"], bytes(r["content"])) for r in got] == [("u", 1, 257, b"u" + bytes(range(256)))]


def test_an_empty_store_has_no_files(spark, tmp_path):
    store, none = str(tmp_path / "store"), spark.createDataFrame([], "url string, text string")
    K.store_texts(none, store)
    assert K.fetch(spark.createDataFrame([("u",)], "url string"), store, "*.txt").collect() == []


def test_file_links_deny_list_keeps_own_extension(spark):
    html = ('<html><body><a href="/d/r.PDF?x=1">a</a><a href="/i.png">b</a><a href="/p.html">c</a>'
            '<a href="/z.zip">d</a></body></html>')
    pages = spark.createDataFrame([(1, "http://s.com/", html)], "page_id long, url string, html string")
    got = sorted(r["url"] for r in P.file_links(pages, "pdf", None, "files").collect())
    assert got == ["http://s.com/d/r.PDF?x=1"]
    # zip is its own preset's extension here: not denied for it
    got_zip = [r["url"] for r in P.file_links(pages, "zip", None, "files").collect()]
    assert got_zip == ["http://s.com/z.zip"]


def test_stages_run_in_priority_order(spark):
    df = spark.createDataFrame([(1,)], "x long")
    out = P.stages(df, [(300, lambda d: d.withColumn("x", F.col("x") * 10)),
                        (100, lambda d: d.withColumn("x", F.col("x") + 1))])
    assert out.first()["x"] == 20


def test_json_records_keep_non_ascii(spark):
    from webloom.operators.summary import to_json_record
    df = spark.createDataFrame([(1, "été ©")], "page_id long, value string")
    assert to_json_record(df).first()["json"] == '{"page_id":1,"value":"été ©"}'


def test_url_list_part_files_concatenate_sorted(spark, tmp_path):
    import glob
    urls = spark.createDataFrame([(f"http://h{i % 7}.com/{i:04d}",) for i in range(300)] + [("http://a.com/x",)] * 3,
                                 "url string").repartition(5)
    out = str(tmp_path / "urls")
    K.write_url_list(urls, out)
    lines = []
    for f in sorted(glob.glob(out + "/part-*")):
        lines += open(f, encoding="utf-8").read().splitlines()
    assert lines == sorted(set(lines)) and len(lines) == 301


def test_js_records_keep_the_last_state_and_its_middleware_data(spark):
    from webloom.operators import dom as D
    from webloom.operators import rules as R
    from webloom.operators.rules import step
    rows = [(1, "a", 1, "u1", "<h1>one</h1><p>p1</p>"), (2, "a", 2, "u2", "<h1>two</h1>"), (3, "b", 1, "u3", "<i>none</i>"), (4, "c", 9, "u4", "<p>c</p>")]
    df = spark.createDataFrame(rows, "page_id long, page_key string, step long, url string, html string").withColumn("site", F.lit("s"))
    dom = D.build_dom(df.select("page_id", "html")).cache()
    page_rules = R.rules_df(spark, {"s": {"para": [[step("desc", "p")]], "head": [[step("desc", "h1")]]}})
    middle = R.rules_df(spark, {"s": {"head": [[step("desc", "h1")]]}})
    states = df.drop("html")
    got = {r["page_key"]: r for r in P.js_records(states, dom, page_rules, middle, ["head", "gone"]).collect()}
    assert set(got) == {"a", "b", "c"}  # a configured middleware target keeps a page without any value
    assert (got["a"]["page_id"], got["a"]["url"], got["a"]["type"], got["a"]["target"]) == (2, "u2", "js", [])
    assert dict(got["a"]["targets"]) == {"head": ["two"]} and dict(got["a"]["middl_data"]) == {"gone": "", "head": "one\ntwo"}
    assert dict(got["b"]["targets"]) == {} and dict(got["b"]["middl_data"]) == {"gone": "", "head": ""}
    # without middleware targets only pages with values stay
    assert {r["page_key"] for r in P.js_records(states, dom, page_rules, middle, []).collect()} == {"a", "c"}


def test_archive_is_verified_by_its_lines(spark, tmp_path, monkeypatch):
    import pytest
    recs = spark.createDataFrame([(1, "é\n"), (2, None)], "page_id long, v string")
    ts = F.lit("2024-05-06 07:08:09").cast("timestamp")
    uri, n = K.archive(recs, str(tmp_path), "job", ts)
    assert uri.endswith("/job_20240506_0708") and n == 2
    assert sorted(r["page_id"] for r in spark.read.json(uri).collect()) == [1, 2]
    real = K.digest
    monkeypatch.setattr(K, "digest", lambda *c: [real(*c)[0], F.expr("cast(rand() as string)").alias("digest")][:1] + [
        F.max(F.lit(str(__import__("random").random()))).alias("digest")])
    with pytest.raises(IOError, match="read back"):
        K.archive(recs, str(tmp_path), "job", ts)
