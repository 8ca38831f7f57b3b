"""Site configs (S2, S3, H17) and the shipped sample rules evaluated on hand-built pages."""

import json

import yaml
from pyspark.sql import functions as F

from webloom.operators import dom as D
from webloom.plans import presets as P
from webloom.sources import configs as C
from webloom.sources import samples as SA


def test_read_sites_from_directory(spark, tmp_path):
    for name, cfg in SA.SAMPLE_CONFIGS.items():
        if name == "js_spider":
            (tmp_path / f"{name}.json").write_text(json.dumps(cfg))
        else:
            (tmp_path / f"{name}.yml").write_text(yaml.safe_dump(cfg))
    (tmp_path / "notes.txt").write_text("ignored")
    sites = C.read_sites(spark, str(tmp_path))
    got = {r["site"]: r for r in sites.collect()}
    assert set(got) == set(SA.SAMPLE_CONFIGS)
    assert got["faq_spider"]["strip"] is False and got["complex_web_spider"]["strip"] is True
    assert got["complex_web_spider"]["start_urls"] == ["http://www.dajiabao.com/", "http://www.dajiabao.com/zixun"]
    only = C.read_sites(spark, str(tmp_path), names=["js_spider"])
    assert [r["site"] for r in only.collect()] == ["js_spider"]
    scroll = only.select(C.config_value("config_json", "$.scroll", "boolean").alias("s")).first()["s"]
    assert scroll is True


PAGE_FAQ = ('<html><body><div class="wjcon-1"><h3>Q1?</h3><p>A1 <b>x</b></p></div>'
            '<div class="wjcon-2 mb20"><p>A2</p></div><div class="wjcon-3"><p>no</p></div></body></html>')
PAGE_JS = ('<html><body><table class="m_table pd_detail_yh fixed_thead_table"><thead><tr><th>a</th><th>b</th>'
           '<th>c</th><th>d</th></tr></thead></table><table id="containerMain"><tr><td>1</td><td>2</td><td>3</td>'
           '<td>4</td></tr><tr><td>5</td><td>6</td><td>7</td><td>8</td></tr></table></body></html>')
PAGE_NEWS = ('<html><body><div class="cmsNewLt"><h1>Head</h1></div><div class="con"><p>one</p><p>two</p></div>'
             '<div id="p-cont"><div><section><p>deep</p></section></div></div></body></html>')


def test_sample_rules_on_pages(spark):
    pages = spark.createDataFrame([
        (1, "http://www.cignacmb.com/faq/1", PAGE_FAQ),
        (2, "http://fund.10jqka.com.cn/datacenter/jz/", PAGE_JS),
        (3, "http://www.dajiabao.com/zixun/9", PAGE_NEWS),
    ], "page_id long, url string, html string")
    dom = D.build_dom(pages)
    out = P.extraction(dom, pages, SA.sample_sites(spark), SA.sample_rules(spark))
    got = {}
    for r in out.orderBy("page_id", "target", "idx").collect():
        got.setdefault((r["page_id"], r["site"], r["type"], r["target"]), []).append(r["value"])
    # faq: trim mode, text() nodes of both divs, blank ones dropped
    assert got[(1, "faq_spider", "faq", "questions_answers")] == ["Q1?", "A1", "x", "A2"]
    # js: td[3], td[4] of each row and th[3], th[4] of the first header row, in document order
    assert got[(2, "js_spider", "js", "code-data")] == ["c", "d", "3", "4", "7", "8"]
    # complex: alternatives unioned in document order, whitespace removed (strip mode)
    assert got[(3, "complex_web_spider", "complex_get_data", "news")] == ["Head", "one", "two"]
    assert got[(3, "complex_web_spider", "complex_get_data", "production_description")] == ["deep"]
    # the product site has no page here, and pages of other sites are not bound to it
    assert not any(k[1] == "product_description_spider" for k in got)


def test_sample_rule_table_shape(spark):
    rules = SA.sample_rules(spark)
    assert rules.filter(F.col("site") == "product_description_spider").count() == 40
    assert rules.agg(F.max(F.size("steps"))).first()[0] == 5


def test_sites_and_rules_from_files_that_spark_reads(spark, tmp_path):
    import json

    from webloom.operators import rules as R
    from webloom.operators.rules import step
    rules = {"a": [[step("desc", "div", "class", ["x", "y"]), step("child", "text()")], [step("desc", "h1", pos=2)]], "b": [[step("child", "html")]]}
    (tmp_path / "faq.site.json").write_text(json.dumps({"kind": "faq", "allowed_domains": ["é.com"], "data_deal": True, "nested": {"x": [1, {"y": "z"}]}}), encoding="utf-8")
    (tmp_path / "other.json").write_text(C.config_text("named", {"further_allowed_domains": [], "start_urls": ["u"]}, rules), encoding="utf-8")
    (tmp_path / "third.json").write_text('{"further_allowed_domains": null, "rules": {}}')
    (tmp_path / "notes.txt").write_text("not a config")
    configs = C.read_configs(spark, str(tmp_path))
    sites = {r["site"]: r for r in C.config_sites(configs).collect()}
    assert set(sites) == {"faq", "named", "third"}
    assert (sites["faq"]["kind"], sites["faq"]["allowed_domains"], sites["faq"]["strip"], sites["faq"]["fragments"]) == ("faq", ["é.com"], True, None)
    assert (sites["named"]["fragments"], sites["named"]["start_urls"], sites["named"]["strip"]) == ([], ["u"], None)
    assert sites["third"]["fragments"] is None and sites["third"]["allowed_domains"] == []
    nested = C.config_sites(configs).where("site = 'faq'").select(C.config_value("config_json", "$.nested.x[1].y").alias("v")).first()["v"]
    assert nested == "z"
    got = C.config_rules(configs)
    want = R.rules_df(spark, {"named": rules})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select("site", "target", "alt", "steps").collect()))
    assert got.schema["steps"].dataType == want.schema["steps"].dataType and got.schema["alt"].dataType == want.schema["alt"].dataType
    assert [r["site"] for r in C.read_configs(spark, str(tmp_path), ["faq", "gone"]).collect()] == ["faq"]


def test_a_broken_config_fails(spark, tmp_path):
    import pytest
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(Exception, match="(?i)json"):
        C.config_sites(C.read_configs(spark, str(tmp_path))).collect()
