"""Presets: the reference's job kinds as DataFrame -> DataFrame compositions.

Every preset runs all sites of its kind in one job (sites and rules are tables).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions import urls as U
from webloom.functions.text import add_page_text
from webloom.operators import documents as DOC
from webloom.operators import extract as X
from webloom.operators import links as L
from webloom.operators import naming as N
from webloom.operators import rules as R
from webloom.operators import summary as SM
from webloom.operators.common import cut_lineage
from webloom.sources import sinks as K
from webloom.sources.pages import html_only


def stages(df: DataFrame, steps: list[tuple[int, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Apply per-record stages in priority order (lower number first)."""
    for _, fn in sorted(steps, key=lambda s: s[0]):
        df = df.transform(fn)
    return df


def default_strip(strip: str, kind: str) -> F.Column:
    """A site without the flag strips if its kind is faq and trims if it is any other."""
    return F.coalesce(F.col(strip), F.col(kind) == "faq")


def bound_pages(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """F1/F2 + J1: HTML pages with the site(s) whose domains cover them."""
    p = html_only(pages).select("page_id", "url")
    return L.bind_sites(p, sites.select("site", "allowed_domains")).join(
        sites.select("site", "kind", default_strip("strip", "kind").alias("strip")), "site")


def extraction(dom: DataFrame, pages: DataFrame, sites: DataFrame, rules: DataFrame) -> DataFrame:
    """X3/X4/X5 (faq, product description, complex web): rules per site, each site's
    strip mode (X2), records tagged with their type (P3), one union table (U4).

    Long form ``(page_id, site, type, url, target, idx, value)``; pages with no
    value are absent (F8), targets with no value are absent (F7).
    """
    b = bound_pages(pages, sites)
    long = R.extract(dom, b.select("page_id", "site", "strip"), rules)
    types = F.create_map(*[F.lit(x) for kv in SM.RECORD_TYPES.items() for x in kv])
    meta = b.select("page_id", "site", "url", types[F.col("kind")].alias("type"))
    return long.join(meta, ["page_id", "site"]).select("page_id", "site", "type", "url", "target", "idx", "value")


def target_div(dom: DataFrame, pages: DataFrame, attr: str, value: str) -> DataFrame:
    """Per page the last matching element's text (A5), the body text list (A7),
    the text list inside the matches (A8) and the whole-page text (A6)."""
    sel = X.select_by_attr(dom, attr, value)
    last = X.last_match_text(sel, dom).withColumnRenamed("text", "bs_target_div")
    body = X.body_texts(dom).groupBy("page_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]).alias("xpath_all_text"))
    div = X.scoped_texts(sel, dom).groupBy("page_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]).alias("css_target_div"))
    allt = add_page_text(pages.select("page_id", "url", "html"), out="bs_all_text").drop("html")
    return (allt.join(last, "page_id", "left").join(body, "page_id", "left").join(div, "page_id", "left"))


def web(pages: DataFrame, base_dir: str, ts) -> DataFrame:
    """Crawl summary + versioned HTML save path of every HTML page, bulky columns dropped."""
    p = html_only(pages)
    names = N.html_save_names(p.select("page_id", "url"), ts).select(
        "page_id", F.concat_ws("/", F.lit(base_dir.rstrip("/")), "domain_dir", "save_name").alias("save_path"))
    return SM.drop_bulky(p).join(names, "page_id")


def file_links(pages: DataFrame, ext: str, denied: list[str] | None, base_dir: str) -> DataFrame:
    """Links of HTML pages, deny-listed extensions removed except the preset's own
    (F6/U2), the ones with the preset's extension (F5) and their save path (H11)."""
    denied = U.DEFAULT_DENIED_EXTENSIONS if denied is None else denied
    lk = L.extract_links(html_only(pages), denied=[d for d in denied if d.lower() != ext.lower()])
    return lk.filter(U.has_extension("url", ext)).select(
        "page_id", "url", U.file_save_path(base_dir, "url", ext).alias("save_path"))


def files(pages: DataFrame, store: str, ext: str, denied: list[str] | None, base_dir: str, glob: str | None = None) -> DataFrame:
    """X9 as one job: the matching links of all pages, each file once, with its bytes from ``store`` (S10) and its save path."""
    links = file_links(pages, ext, denied, base_dir).select("url", "save_path").distinct()
    return K.fetch(links, store, glob)


def url_scan(pages: DataFrame) -> DataFrame:
    """Every discovered URL once, sorted."""
    return L.url_scan(L.extract_links(html_only(pages)))


def js_snapshots(states: DataFrame, rules: DataFrame, targets: list[str], key: str = "page_key",
                 step: str = "step", dom: DataFrame | None = None) -> DataFrame:
    """X6 (A10 + A11 + F12): a page seen as ordered states ``(key, step, site, html)``.

    Every state gets its own element index; the middleware rules run on each state
    and their values are appended per target across states in step order (A11),
    with every configured target pre-seeded empty. A key is kept even when all
    lists are empty (F12: the map is non-empty as a map). ``rules`` are keyed by the
    states' ``site``; values use strip mode, as the browser text does.
    Returns ``(key, target, n_items, text)`` with values joined by newlines.
    When the states are rows of an already indexed corpus, pass that index as
    ``dom`` and keep ``page_id`` in ``states``: it is reused instead of rebuilt.
    """
    from webloom.operators import dom as D
    from webloom.operators import snapshots as S

    if dom is None:
        st = states.select(F.col(key).alias("_key"), F.col(step).alias("_step"), "site", "html").withColumn(
            "page_id", F.xxhash64("_key", "_step"))
        # the states' element index is read by every step join and the value join:
        # build it once (reliable checkpoint, keeps the page_id partitioning)
        dom = cut_lineage(D.build_dom(st.select("page_id", "html")))
    else:
        st = states.select(F.col(key).alias("_key"), F.col(step).alias("_step"), "site", "page_id")
    ps = st.select("page_id", "site")
    vals = R.extract(dom, ps, rules, True)
    vals = vals.join(st.select("page_id", "_key", "_step"), "page_id")
    # a value's order within its key: state step, then position within the state;
    # every key appears (with a null target) so it is seeded even without values
    vals = vals.select("_key", "target", "value", "_step", "idx")
    keys = st.select("_key").distinct().select(
        "_key", *[F.lit(None).cast(t).alias(c) for c, t in
                  [("target", "string"), ("value", "string"), ("_step", "bigint"), ("idx", "bigint")]])
    out = S.accumulate(vals.unionByName(keys), "_key", ["_step", "idx"], F.col("target"), "value", targets)
    return out.withColumnRenamed("_key", key).withColumnRenamed("value", "text")


def js_records(states: DataFrame, dom: DataFrame, page_rules: DataFrame, middle_rules: DataFrame, targets: list[str],
               key: str = "page_key", step: str = "step") -> DataFrame:
    """X6 as one job: a record per page seen as states ``(key, step, site, page_id, url)`` of the indexed corpus.

    The page rules run on the last state (X3 with strip mode); ``middl_data`` holds what the middleware rules gathered
    over all states (A11); ``target`` is empty, as the record has it. A record is kept if either has an entry (F12), so
    always when middleware targets are configured. Columns are those of ``documents`` and key, target, middl_data.
    """
    last = states.groupBy(key).agg(F.max(F.struct(step, "page_id", "url", "site")).alias("_l")).select(key, "_l.page_id", "_l.url", "_l.site")
    long = R.extract(dom, last.select("page_id", "site"), page_rules, True).join(last.select("page_id", "site", "url"), ["page_id", "site"])
    found = DOC.documents(long.withColumn("type", F.lit(SM.RECORD_TYPES["js"]))).select("page_id", "site", "targets")
    middle = js_snapshots(states.drop("url"), middle_rules, targets, key, step, dom)
    middle = middle.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("target", "text")))).alias("middl_data"))
    out = last.join(found, ["page_id", "site"], "left").join(middle, key, "left")
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    out = out.select("page_id", "site", F.lit(SM.RECORD_TYPES["js"]).alias("type"), "url", F.coalesce("targets", empty).alias("targets"), key,
                     F.array().cast("array<string>").alias("target"), F.coalesce("middl_data", none).alias("middl_data"))
    return out.where((F.size("targets") > 0) | (F.size("middl_data") > 0))


def web_run(exchanges: DataFrame, pages: DataFrame, out: str, job: str, ts) -> str:
    """X7 as one job: crawl summaries (P1) without bulky columns (P2), the html of every HTML page under its versioned
    path (S7), and the summaries archived and verified (S9). Returns the archive's path; html stands in ``out/html``."""
    summaries = SM.drop_bulky(SM.crawl_summary(exchanges))
    K.write_html(html_only(pages), f"{out}/html", ts)
    return K.archive(summaries, f"{out}/archive", job, ts)[0]
