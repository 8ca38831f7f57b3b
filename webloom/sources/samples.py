"""The four sample site configs the reference ships, as ``sites`` rows and structured
``rules`` (the original selector of each rule is in the comment next to it).

Fixed values: domains, start URLs, URL fragments, class names and ids are the
sample configs' own values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webloom.operators.rules import rules_df, step
from webloom.sources.configs import sites_from_dicts


def d(tag, attr=None, values=None, pos=None):
    """Descendant step ``//tag[...]``."""
    return step("desc", tag, attr, [values] if isinstance(values, str) else values, pos)


def c(tag, attr=None, values=None, pos=None):
    """Child step ``/tag[...]``."""
    return step("child", tag, attr, [values] if isinstance(values, str) else values, pos)


def _in_div(cls, *rest):
    return [d("div", "class", cls), *rest]


# ---- fixed values: the shipped sample configs -----------------------------------------
SAMPLE_CONFIGS = {
    "faq_spider": {
        "kind": "faq",
        "allowed_domains": ["cignacmb.com"],
        "further_allowed_domains": ["http://www.cignacmb.com/faq/"],
        "start_urls": ["http://www.cignacmb.com/faq/"],
        "data_deal": False,
    },
    "product_description_spider": {
        "kind": "product",
        "start_urls": ["http://www.cignacmb.com/insurance/"],
        "allowed_domains": ["cignacmb.com"],
        "further_allowed_domains": ["http://www.cignacmb.com/shop/", "http://www.cignacmb.com/insurance/"],
        "data_deal": True,
    },
    "complex_web_spider": {
        "kind": "complex",
        "start_urls": ["http://www.dajiabao.com/", "http://www.dajiabao.com/zixun"],
        "allowed_domains": ["dajiabao.com"],
        "further_allowed_domains": ["https://mall.dajiabao.com/mall/product/", "http://www.dajiabao.com/zixun/"],
        "data_deal": True,
    },
    "js_spider": {
        "kind": "js",
        "allowed_domains": ["fund.10jqka.com.cn"],
        "further_allowed_domains": ["http://fund.10jqka.com.cn/datacenter/jz/"],
        "start_urls": ["http://fund.10jqka.com.cn/datacenter/jz/"],
        "complex_web_target_div_xpath": False, "aims": False, "scroll": True, "each_click": False,
        "mult_click_path": False, "change_url": False,
        "data_deal": True,
    },
}

_TABLE = "m_table pd_detail_yh fixed_thead_table"

SAMPLE_RULES = {
    "faq_spider": {
        # //div[@class="wjcon-1" or @class="wjcon-2 mb20"]//text()
        "questions_answers": [[d("div", "class", ["wjcon-1", "wjcon-2 mb20"]), d("text()")]],
    },
    "product_description_spider": {
        "production_description": [
            _in_div("form-title", c("h1")),                                   # //div[@class="form-title"]/h1
            _in_div("form-title", c("p")),                                    # //div[@class="form-title"]/p
            _in_div("floor features", d("ul"), c("li"), c("strong")),         # ...//ul/li/strong
            _in_div("floor features", d("ul"), c("li"), c("p")),              # ...//ul/li/p
            _in_div("floor case", c("h2")),                                   # //div[@class="floor case"]/h2
            _in_div("floor case", c("div"), d("dt")),                         # .../div//dt
            _in_div("floor case", c("div"), d("p")),                          # .../div//p
            _in_div("floor case", c("div"), d("div", "class", "case-inner")),  # .../div//div[@class="case-inner"]
            _in_div("floor case", c("div"), d("tbody"), c("tr"), c("td")),    # .../div//tbody/tr/td
            _in_div("floor instructions", d("h2")),
            _in_div("floor instructions", d("td")),
            _in_div("floor instructions", d("th")),
            _in_div("process1", c("h2")),
            _in_div("process1", d("ul"), c("li")),
            _in_div("floor process2", c("h2")),
            _in_div("floor process2", d("ul"), c("li")),
            _in_div("floor problem", c("h2")),
            _in_div("floor problem", d("dt")),
            _in_div("floor problem", d("dd")),
            *[_in_div("floor-box", d(t)) for t in ["dt", "td", "li", "h2", "h3", "h4", "dd", "p"]],
            _in_div("p-mbx", c("span", pos=2), c("h1")),                      # //div[@class="p-mbx"]/span[2]/h1
            *[_in_div("main", d(t)) for t in ["h2", "h4", "dt", "dd", "td", "li", "p"]],
            *[_in_div("product-detail-content", d(t)) for t in ["h2", "h3", "p", "dl", "td"]],
        ],
    },
    "complex_web_spider": {
        # //div[@class="cmsNewLt"]//h1 | //div[@class="con"]//p
        "news": [_in_div("cmsNewLt", d("h1")), _in_div("con", d("p"))],
        "production_description": [
            _in_div("f-r infos", c("h2")),                                    # //div[@class="f-r infos"]/h2
            [d("div", "class", "company")],                                   # //div[@class="company"]
            [d("menu", "class", "center-block content-width products-menu"), d("ul"), c("li")],
            [d("*", "id", "p-cont"), c("div"), d("p")],                       # //*[@id="p-cont"]/div//p
        ],
    },
    "js_spider": {
        "code-data": [
            [d("*", "id", "containerMain"), c("tr"), c("td", pos=3)],          # //*[@id="containerMain"]/tr/td[3]
            [d("*", "id", "containerMain"), c("tr"), c("td", pos=4)],          # //*[@id="containerMain"]/tr/td[4]
            [d("table", "class", _TABLE), c("thead"), c("tr", pos=1), c("th", pos=3)],
            [d("table", "class", _TABLE), c("thead"), c("tr", pos=1), c("th", pos=4)],
        ],
    },
}
# -------------------------------------------------------------------------------


def sample_sites(spark: SparkSession) -> DataFrame:
    return sites_from_dicts(spark, SAMPLE_CONFIGS)


def sample_rules(spark: SparkSession) -> DataFrame:
    return rules_df(spark, SAMPLE_RULES)
