"""Text extraction over the element intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import non_blank
from webloom.operators import dom as D


def _ordered_concat(struct_list_col, field: str = "text", sep: str = "") -> F.Column:
    """Concatenate ``field`` of collected (pos, field) structs in position order."""
    return F.array_join(F.transform(F.array_sort(struct_list_col), lambda x: x[field]), sep)


def string_values(hits: DataFrame, dom: DataFrame, keys: list[str]) -> DataFrame:
    """A4: string-value of each hit = its descendant text in document order.

    ``hits`` has ``page_id, start, end`` plus ``keys``. Equi join on page_id with the
    interval as residual: both sides are already partitioned by page_id, and each
    page is a bounded group, so no exchange and no cross-page pairs.
    """
    t = D.text_nodes(dom).select(F.col("page_id").alias("_pg"), F.col("pos").alias("_tp"), F.col("text").alias("_tt"))
    j = hits.join(t, (F.col("page_id") == F.col("_pg")) & (F.col("_tp") > F.col("start")) & (F.col("_tp") <= F.col("end")),
                  "left").drop("_pg")
    g = j.groupBy("page_id", "start", *keys).agg(
        F.collect_list(F.when(F.col("_tp").isNotNull(), F.struct(F.col("_tp").alias("pos"), F.col("_tt").alias("text")))).alias("_l"))
    return g.select("page_id", "start", *keys, _ordered_concat(F.col("_l")).alias("text"))


def markup(hits: DataFrame, dom: DataFrame, keys: list[str]) -> DataFrame:
    """Source markup of each hit (tokens start..end, unchanged)."""
    t = dom.select(F.col("page_id").alias("_pg"), F.col("pos").alias("_tp"), F.col("tok").alias("_tt"))
    j = hits.join(t, (F.col("page_id") == F.col("_pg")) & (F.col("_tp") >= F.col("start")) & (F.col("_tp") <= F.col("end")),
                  "left").drop("_pg")
    g = j.groupBy("page_id", "start", *keys).agg(
        F.collect_list(F.struct(F.col("_tp").alias("pos"), F.col("_tt").alias("text"))).alias("_l"))
    return g.select("page_id", "start", *keys, _ordered_concat(F.col("_l")).alias("markup"))


def select_by_attr(dom: DataFrame, name: str, value: str, tag: str | None = None) -> DataFrame:
    """Elements whose attribute ``name`` equals ``value`` (optionally of one tag)."""
    e = D.elements(dom)
    cond = D.attr("attrs", name) == F.lit(value)
    if tag:
        cond = cond & (F.col("tag") == tag)
    return e.filter(cond).select("page_id", "start", "end")


def select_by_id(dom: DataFrame, target_div: str) -> DataFrame:
    """J6+H19: ``#id`` selector; the '#' is optional in the config value."""
    return select_by_attr(dom, "id", target_div[1:] if target_div.startswith("#") else target_div)


def last_match_text(sel: DataFrame, dom: DataFrame) -> DataFrame:
    """A5: text of the last matching element per page (later matches overwrite)."""
    sv = string_values(sel, dom, [])
    return sv.groupBy("page_id").agg(F.max_by("text", "start").alias("text"))


def scoped_texts(sel: DataFrame, dom: DataFrame, scope: str = "div") -> DataFrame:
    """Non-blank text nodes (script/style excluded) inside the selected elements.

    ``scope='div'`` (default) lists the text inside each match; ``scope='document'``
    is the as-written behaviour: the whole page's text list once per match.
    """
    t = D.text_nodes(dom).filter(non_blank("text")).select("page_id", "pos", "text")
    s = sel.select("page_id", F.col("start").alias("_s"), F.col("end").alias("_e"))
    if scope == "document":
        return s.join(t, "page_id").select("page_id", F.col("_s").alias("start"), "pos", "text")
    j = s.join(t, "page_id").filter((F.col("pos") > F.col("_s")) & (F.col("pos") <= F.col("_e")))
    return j.select("page_id", "pos", "text").dropDuplicates(["page_id", "pos"])


def body_texts(dom: DataFrame) -> DataFrame:
    """A7+F9a+F10: non-blank text nodes whose parent is a strict descendant of body."""
    body = D.elements(dom).filter(F.col("tag") == "body").select(
        "page_id", F.col("start").alias("_bs"), F.col("end").alias("_be"))
    t = D.text_nodes(dom).filter(non_blank("text")).select("page_id", "pos", "parent", "text")
    j = t.join(body, "page_id").filter((F.col("parent") > F.col("_bs")) & (F.col("parent") <= F.col("_be")))
    return j.select("page_id", "pos", "text")


def all_text(dom: DataFrame) -> DataFrame:
    """A6 over the token table: concatenated text of every page."""
    t = D.text_nodes(dom)
    return t.groupBy("page_id").agg(_ordered_concat(F.collect_list(F.struct("pos", "text"))).alias("text"))
