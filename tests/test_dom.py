"""Element intervals on hand-built pages: quirks the corpus shows, plus properties."""

from pyspark.sql import functions as F

from webloom.operators import dom as D
from webloom.operators import extract as X
from webloom.operators import rules as R
from webloom.operators.rules import step

PAGES = [
    (1, "http://a.com/1",
     '<!DOCTYPE html><html><head><title>T &amp; U</title><script>var t="</p>";</script>'
     '<style>p{}</style></head><body>loose<div id="m" class="c">one<p>two<p>three</div>'
     '<ul><li>a<li>b<ul><li>c</li></ul></ul><div id="m">last <b>bold</div>'
     '<!-- <p>hidden</p> --><p><b>x<br><p>y</p></body></html>'),
    (2, "http://a.com/2", "<html><body><div class=\"c\"> </div><p>  </p></body>"),
]


def _dom(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return D.build_dom(pages).cache()


def test_script_comment_removed_and_implied_ends(spark):
    dom = _dom(spark)
    el = {(r["page_id"], r["start"]): r for r in D.elements(dom).collect()}
    tags = [r["tag"] for k, r in sorted(el.items()) if k[0] == 1]
    assert tags.count("script") == tags.count("style") == 1
    texts = [r["text"] for r in D.text_nodes(dom).filter("page_id = 1").orderBy("pos").collect()]
    assert "hidden" not in texts and 'var t="' not in "".join(texts)
    assert texts[0] == "T & U"  # entity decoded
    # p elements never contain another p; li elements never contain a sibling li
    e = D.elements(dom).filter("page_id = 1")
    a, b = e.alias("a"), e.alias("b")
    bad = a.join(b, (F.col("a.tag") == F.col("b.tag")) & F.col("a.tag").isin("p", "li")
                 & (F.col("b.start") > F.col("a.start")) & (F.col("b.start") <= F.col("a.end"))
                 & (F.col("b.parent") == F.col("a.parent")))
    assert bad.count() == 0


def test_intervals_nested_or_disjoint(spark):
    e = D.elements(_dom(spark))
    a, b = e.alias("a"), e.alias("b")
    crossing = a.join(b, (F.col("a.page_id") == F.col("b.page_id")) & (F.col("a.start") < F.col("b.start"))
                      & (F.col("b.start") <= F.col("a.end")) & (F.col("b.end") > F.col("a.end")))
    assert crossing.count() == 0


def test_body_text_excludes_direct_children(spark):
    dom = _dom(spark)
    got = [r["text"] for r in X.body_texts(dom).filter("page_id = 1").orderBy("pos").collect()]
    assert "loose" not in got and "one" in got and "bold" in got
    assert X.body_texts(dom).filter("page_id = 2").count() == 0  # blank texts dropped


def test_same_id_last_wins_and_all_listed(spark):
    dom = _dom(spark)
    sel = X.select_by_id(dom, "m")  # '#' optional
    assert X.select_by_id(dom, "#m").count() == sel.count() == 2
    last = X.last_match_text(sel, dom).first()["text"]
    assert last == "last bold"
    listed = [r["text"] for r in X.scoped_texts(sel, dom).orderBy("pos").collect()]
    assert listed == ["one", "two", "three", "last ", "bold"]


def test_rules_strip_keeps_blank_trim_drops(spark):
    dom = _dom(spark)
    ps = spark.createDataFrame([(1, "s"), (2, "s")], "page_id long, site string")
    rules = R.rules_df(spark, {"s": {"div_c": [[step("desc", "div", "class", ["c", "zz"])]],
                                     "nothing": [[step("desc", "table")]],
                                     "p_text": [[step("desc", "p"), step("child", "text()")]],
                                     "second_li": [[step("desc", "ul"), step("child", "li", pos=2)]]}})
    strip = {(r["page_id"], r["target"], r["idx"]): r["value"] for r in R.extract(dom, ps, rules, True).collect()}
    assert strip[(2, "div_c", 0)] == ""           # blank kept in strip mode
    assert strip[(1, "div_c", 0)] == "onetwothree"
    assert strip[(1, "second_li", 0)] == "bc"      # nested list text included
    assert not any(k[1] == "nothing" for k in strip)  # rule without hits: key absent
    trim = {(r["page_id"], r["target"]): r["value"] for r in R.extract(dom, ps, rules, False).collect()}
    assert strip[(2, "p_text", 0)] == ""          # blank text kept in strip mode
    assert (2, "p_text") not in trim              # blank text dropped in trim mode
    assert trim[(2, "div_c")] == '<div class="c"> </div>'  # element hit: markup kept
    assert trim[(1, "div_c")].startswith('<div id="m" class="c">one')


def test_page_without_hits_is_dropped(spark):
    dom = _dom(spark)
    ps = spark.createDataFrame([(1, "s"), (2, "s")], "page_id long, site string")
    rules = R.rules_df(spark, {"s": {"title": [[step("desc", "title")]]}})
    out = R.to_map(R.extract(dom, ps, rules, True)).collect()
    assert [r["page_id"] for r in out] == [1]
    assert out[0]["targets"] == {"title": ["T&U"]}


def test_saved_index_is_bucketed_no_exchange(spark, tmp_path):
    dom = _dom(spark)
    D.save_dom_index(dom, "dom_index_test", 4, str(tmp_path / "dom"))
    t = spark.table("dom_index_test")
    e = D.elements(t).groupBy("page_id").count()
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert e.count() == 2
    spark.sql("DROP TABLE dom_index_test")


def test_index_build_on_bucketed_pages_has_no_exchange(spark, tmp_path):
    """Pages stored bucketed by page_id: the whole index build runs without a shuffle."""
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    (pages.write.mode("overwrite").bucketBy(4, "page_id").option("path", str(tmp_path / "pages"))
     .saveAsTable("pages_bucketed_test"))
    dom = D.build_dom(spark.table("pages_bucketed_test"), repartition=False)
    dom.write.format("noop").mode("overwrite").save()
    plan = dom._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert D.elements(dom).filter("page_id = 1 and tag = 'li'").count() == 3
    spark.sql("DROP TABLE pages_bucketed_test")


def test_div_texts_document_scope_as_written(spark):
    """A8 scope='document': the page's whole text list once per matching element."""
    dom = _dom(spark)
    sel = X.select_by_id(dom, "m")
    doc = X.scoped_texts(sel, dom, scope="document").filter("page_id = 1")
    n_texts = D.text_nodes(dom).filter("page_id = 1").filter(F.col("text").rlike("[^ \\t\\r\\n]")).count()
    assert doc.count() == 2 * n_texts
    assert doc.select("start").distinct().count() == 2


def test_attribute_quoting_styles(spark):
    from webloom.operators.links import extract_links
    html = ("<html><body><div class='q s' id=u1>x</div><a href='/one'>1</a><a href=/two>2</a>"
            '<a title="t" href="/three">3</a></body></html>')
    pages = spark.createDataFrame([(9, "http://h.com/d/p", html)], "page_id long, url string, html string")
    dom = D.build_dom(pages)
    got = {(r["tag"], D_attr_pair) for r in D.elements(dom).collect()
           for D_attr_pair in [tuple((a["k"], a["v"]) for a in (r["attrs"] or []))]}
    assert ("div", (("class", "q s"), ("id", "u1"))) in got
    links = [r["url"] for r in extract_links(pages).orderBy("idx").collect()]
    assert links == ["http://h.com/one", "http://h.com/two", "http://h.com/three"]


def test_unbound_sites_add_no_hits_and_no_candidates(spark):
    html = "<html><body>" + "".join(f"<p>{i}</p>" for i in range(50)) + "</body></html>"
    dom = D.build_dom(spark.createDataFrame([(1, "http://a.com/", html)], "page_id long, url string, html string"))
    every = R.rules_df(spark, {f"s{k}": {"t": [[step("desc", "p")]]} for k in range(200)})
    bound = spark.createDataFrame([(1, "s7", True)], "page_id long, site string, strip boolean")
    hits = R.evaluate(dom, bound, every)
    assert hits.count() == 50 and {r["site"] for r in hits.select("site").distinct().collect()} == {"s7"}
    # the rules meet the nodes on site and tag
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert any("site" in line and "_key" in line for line in plan.splitlines() if "Join" in line)


def test_unset_flag_strips_faq_and_trims_the_others(spark):
    from webloom.plans.presets import default_strip
    kinds = spark.createDataFrame([("faq", None), ("product", None), ("complex", None), ("faq", False), ("product", True)],
                                  "kind string, strip boolean")
    got = [r["s"] for r in kinds.select(default_strip("strip", "kind").alias("s")).collect()]
    assert got == [True, False, False, False, True]


RAW_PAGES = [
    (1, "<html><head><title>a <b>&amp;</title><script type='x'>if (a</p>b) \"<!-- no\"</script><style></style></head>"
        "<body><div>x<SCRIPT>s1</Script >y<textarea><p>t &lt;</textarea></div><!-- <script>gone</script> --></body></html>"),
    (2, "<body><p>one<title-card>two</title-card><script src=a /></p><p>three"),   # a script never closed takes the rest
    (3, "<body><style>p{}</style >z<title>open <p>to the end</title"),
    (4, None),
    (5, ""),
]


def test_raw_text_bodies_are_one_token(spark):
    dom = D.build_dom(spark.createDataFrame(RAW_PAGES, "page_id long, html string")).cache()
    raw = {(r["page_id"], r["text"]) for r in dom.filter("kind = 'raw'").collect()}
    assert raw == {(1, 'if (a</p>b) "<!-- no"'), (1, "s1"), (2, "</p><p>three"), (3, "p{}")}
    texts = {(r["page_id"], r["text"]) for r in D.text_nodes(dom).collect()}
    assert texts == {(1, "a <b>&"), (1, "x"), (1, "y"), (1, "<p>t <"), (2, "one"), (2, "two"), (3, "z"), (3, "open <p>to the end</title")}
    assert {r["tag"] for r in D.elements(dom).filter("page_id = 1").collect()} == {
        "html", "head", "title", "script", "style", "body", "div", "textarea"}
    assert not {"s1", "p{}"} & {r["text"] for r in X.body_texts(dom).collect()}


def test_rules_see_raw_text(spark):
    dom = D.build_dom(spark.createDataFrame(RAW_PAGES, "page_id long, html string")).cache()
    ps = spark.createDataFrame([(1, "s"), (2, "s"), (3, "s")], "page_id long, site string")
    rules = R.rules_df(spark, {"s": {"div": [[step("desc", "div")]], "all": [[step("desc", "script"), step("child", "text()")]],
                                     "second": [[step("desc", "div"), step("child", "text()", pos=2)]]}})
    strip = {(r["page_id"], r["target"], r["idx"]): r["value"] for r in R.extract(dom, ps, rules, True).collect()}
    assert strip == {(1, "div", 0): "xs1y<p>t<", (1, "second", 0): "y", (1, "all", 0): 'if(a</p>b)"<!--no"', (1, "all", 1): "s1",
                     (2, "all", 0): "</p><p>three"}
    trim = {(r["page_id"], r["target"], r["idx"]): r["value"] for r in R.extract(dom, ps, rules, False).collect()}
    assert trim[(1, "div", 0)] == "<div>x<SCRIPT>s1</Script >y<textarea><p>t &lt;</textarea></div>" and trim[(1, "all", 1)] == "s1"


def test_markup_is_never_sorted(spark):
    """The windows sort positions, kinds and tags; markup, attributes and text meet them in a hash join."""
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    dom = D.build_dom(pages.select("page_id", "html"))
    dom.write.format("noop").mode("overwrite").save()
    plan = dom._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if " Sort " in line or "- Sort" in line]
    assert sorts and not any(c + "#" in line for line in sorts for c in ("tok", "attrs", "text", "_m", "_t"))
    windows = [line for line in plan.splitlines() if "Window " in line]
    assert windows and not any(c + "#" in line for line in windows for c in ("tok", "attrs", "text"))
    assert plan.count("ShuffledHashJoin") >= 1 and "SortMergeJoin" not in plan


def test_index_has_more_partitions_for_a_larger_corpus(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"<p>{i}</p>" * 50) for i in range(40)], "page_id long, html string")
    few = D.build_dom(pages)
    monkeypatch.setattr(D, "PARTITION_BYTES", 1000)
    many = D.build_dom(pages)
    assert many.rdd.getNumPartitions() == -(-sum(len(f"<p>{i}</p>" * 50) for i in range(40)) // 1000) > 4
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))
    assert D.index_partitions(pages.limit(0)) is None
