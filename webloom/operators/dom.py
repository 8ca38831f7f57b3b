"""Markup as relational element intervals (W1, W2): no tree library, no per-row parser.

Pages are split into tokens with one regex; each element becomes an interval
``[start, end]`` of token positions, so structure questions turn into joins and
window functions (the pre/post-order "XPath accelerator" idea):

* descendant of ``a``:  ``a.start < d.start <= a.end``
* child of ``a``:       ``d.parent = a.start`` (``-1`` = document root)

Extents. Per ``(page, tag)`` a running sum of +1 (open) / -1 (close) gives a level;
an open whose next token at its level is a close is *matched*. An unmatched open
ends before the first later opener of its closing group in the same container (``p`` and inline formatting
tags: block openers; ``li``: ``li``; ``dt``/``dd``; ``tr``; ``td``/``th``; ``option``),
before the close of its nearest matched ancestor, or at the page end, whichever is
first. This is a documented simplification of browser error recovery; attribute
values containing ``>`` are outside it.

Raw text. Comments are removed before tokenizing. The body of a script, style, textarea or title is one token,
whatever it looks like, up to its own end tag or the page's end. Bodies of scripts and styles have the kind ``raw``:
they belong to string values, markup and the ``text()`` step of a rule, but not to the text lists. Bodies of textareas
and titles are text, with character references.

Every window is partitioned by ``page_id`` first; pages are hash-partitioned on
``page_id`` once, so all windows and the later structural joins reuse that exchange. The windows see positions, kinds
and tags only; markup, attributes and text join their rows by position, on the same partitioning, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.functions.text import decode_entities

# ---- fixed values ------------------------------------------------------------------
RAW_TEXT_TAGS = ["script", "style"]
ESCAPABLE_TEXT_TAGS = ["textarea", "title"]
# a start tag of these and all up to the end tag or the page's end
_RAW_ELEMENTS = "|".join(rf"<{t}(?:[\s/][^>]*)?>.*?(?:</{t}\s*>|\z)" for t in RAW_TEXT_TAGS + ESCAPABLE_TEXT_TAGS)
# comments outside such elements; the group keeps the elements
COMMENT_RE = rf"(?is)<!--.*?-->|({_RAW_ELEMENTS})"
TOKEN_RE = rf"(?is){_RAW_ELEMENTS}|<[A-Za-z/!?][^>]*>|[^<]+|<"
RAW_START_RE = rf"(?i)^<({'|'.join(RAW_TEXT_TAGS + ESCAPABLE_TEXT_TAGS)})(?:[\s/][^>]*)?>"
RAW_END_RE = rf"(?i)</(?:{'|'.join(RAW_TEXT_TAGS + ESCAPABLE_TEXT_TAGS)})\s*>\z"
TAG_NAME_RE = r"^</?([A-Za-z][A-Za-z0-9:-]*)"
# attribute name, then a double-quoted, single-quoted or unquoted value (groups 2-4)
ATTR_RE = r"""\s([A-Za-z_:][-A-Za-z0-9_:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+))"""
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
             "param", "source", "track", "wbr"]
BLOCK_OPENERS = ["address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset",
                 "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
                 "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section",
                 "table", "ul"]
INLINE_FORMATTING = ["a", "b", "big", "code", "em", "font", "i", "s", "small", "span", "strike",
                     "strong", "tt", "u"]
# closing group name -> (tags whose opener closes, tags that are closed)
CLOSE_GROUPS = {
    "block": (BLOCK_OPENERS, ["p"] + INLINE_FORMATTING),
    "li": (["li"], ["li"]),
    "dl": (["dt", "dd"], ["dt", "dd"]),
    "tr": (["tr"], ["tr"]),
    "cell": (["td", "th", "tr"], ["td", "th"]),
    "option": (["option"], ["option"]),
}
TEXT_TAG = "text()"
# markup that one task of the index takes: its sorts and its hash table are many times as large
PARTITION_BYTES = 8 << 20
# -------------------------------------------------------------------------------

_UNB = Window.unboundedPreceding


def _pieces(match: Column) -> Column:
    """The tokens of one match as (tok, body): an element with a raw body becomes its start tag, body and end tag.

    ``body`` is the element's tag at its body, empty elsewhere.
    """
    start = F.regexp_extract(match, RAW_START_RE, 0)
    end = F.regexp_extract(match, RAW_END_RE, 0)
    inner = F.substring(match, F.length(start) + 1, F.length(match) - F.length(start) - F.length(end))
    tag = F.lower(F.regexp_extract(match, RAW_START_RE, 1))
    piece = lambda tok, body: F.struct(tok.alias("tok"), body.alias("body"))
    three = F.filter(F.array(piece(start, F.lit("")), piece(inner, tag), piece(end, F.lit(""))), lambda x: x["tok"] != "")
    return F.when(match.rlike(RAW_START_RE), three).otherwise(F.array(piece(match, F.lit(""))))


def index_partitions(pages: DataFrame) -> int | None:
    """Partitions of the index, so that a task's share stays the same however large the corpus; None while it is so
    small that the session's own number gives each task no more than that."""
    spark = pages.sparkSession
    n = -(-(pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0) // PARTITION_BYTES)
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(n, usual) if n > min(usual, spark.sparkContext.defaultParallelism) else None


def tokenize(pages: DataFrame, repartition: bool = True) -> DataFrame:
    """``tokens(page_id, pos, last_pos, kind, tag, void, tok)``.

    kind: open / close / text / raw (script and style bodies); declarations and instructions only count as positions.
    """
    df = pages.select("page_id", F.regexp_replace("html", COMMENT_RE, "$1").alias("_m"))
    if repartition:
        n = index_partitions(pages)
        df = df.repartition(n, "page_id") if n else df.repartition("page_id")
    df = df.select("page_id", F.flatten(F.transform(F.regexp_extract_all("_m", F.lit(TOKEN_RE), 0), _pieces)).alias("_t"))
    df = df.select("page_id", (F.size("_t") - 1).cast("bigint").alias("last_pos"),
                   F.posexplode_outer("_t").alias("pos", "_x")).filter(F.col("pos").isNotNull())
    df = df.select("page_id", "last_pos", F.col("pos").cast("bigint").alias("pos"), F.col("_x.tok").alias("tok"), F.col("_x.body").alias("body"))
    tok = F.col("tok")
    kind = (F.when(F.col("body").isin(RAW_TEXT_TAGS), "raw")
            .when(F.col("body") != "", "text")
            .when(tok.startswith("</"), "close")
            .when(tok.rlike(r"^<[A-Za-z]"), "open")
            .when(tok.startswith("<") & (F.length(tok) > 1), "other")
            .otherwise("text"))
    df = df.withColumn("kind", kind)
    tag = F.when(F.col("kind").isin("text", "raw"), F.lit(TEXT_TAG)).otherwise(
        F.lower(F.regexp_extract(tok, TAG_NAME_RE, 1)))
    df = df.withColumn("tag", tag)
    df = df.withColumn("void", (F.col("kind") == "open") & (
        F.col("tag").isin(VOID_TAGS) | (tok.rlike(r"/\s*>$") & ~F.col("tag").isin(RAW_TEXT_TAGS + ESCAPABLE_TEXT_TAGS))))
    return df.filter(F.col("kind") != "other").select("page_id", "pos", "last_pos", "kind", "tag", "void", "tok")


def attributes(tok: Column) -> Column:
    """(k, v) of a start tag's attributes in order; tags without "=" skip the work."""
    names = F.regexp_extract_all(tok, F.lit(ATTR_RE), 1)
    # exactly one value group takes part; the others extract as ''
    vals = F.zip_with(F.zip_with(F.regexp_extract_all(tok, F.lit(ATTR_RE), 2),
                                 F.regexp_extract_all(tok, F.lit(ATTR_RE), 3), lambda a, b: F.concat(a, b)),
                      F.regexp_extract_all(tok, F.lit(ATTR_RE), 4), lambda a, b: F.concat(a, b))
    pairs = F.zip_with(names, vals, lambda k, v: F.struct(F.lower(k).alias("k"), v.alias("v")))
    return F.when(tok.contains("="), pairs).otherwise(F.array().cast("array<struct<k:string,v:string>>"))


def attr(attrs_col, name) -> F.Column:
    """Value of the first attribute called ``name`` (NULL when absent)."""
    a = F.col(attrs_col) if isinstance(attrs_col, str) else attrs_col
    n = F.lit(name) if isinstance(name, str) else name
    return F.try_element_at(F.filter(a, lambda x: x["k"] == F.lower(n)), F.lit(1))["v"]


def element_extents(tokens: DataFrame) -> DataFrame:
    """Adds ``end`` (inclusive last token position) to every open token; text, void
    and other tokens end where they start. Close tokens are kept (markup slices). Columns pass through."""
    kind = F.col("kind")
    paired_open = (kind == "open") & ~F.col("void")
    ptype = F.when(paired_open, "O").when(kind == "close", "C")
    df = tokens.withColumn("_pt", ptype)
    wt = Window.partitionBy("page_id", "tag").orderBy("pos").rowsBetween(_UNB, 0)
    run = F.sum(F.when(F.col("_pt") == "O", 1).when(F.col("_pt") == "C", -1).otherwise(0)).over(wt)
    df = df.withColumn("_run", run)
    df = df.withColumn("_lvl", F.when(F.col("_pt") == "C", F.col("_run") + 1).otherwise(F.col("_run")))
    wl = Window.partitionBy("page_id", "tag", "_lvl").orderBy("pos")
    df = df.withColumn("_nxt_t", F.lead("_pt").over(wl)).withColumn("_nxt_p", F.lead("pos").over(wl)) \
           .withColumn("_prv_t", F.lag("_pt").over(wl))
    df = df.withColumn("_mend", F.when((F.col("_pt") == "O") & (F.col("_nxt_t") == "C"), F.col("_nxt_p")))
    df = df.withColumn("_mclose", (F.col("_pt") == "C") & (F.col("_prv_t") == "O"))
    # depth among matched elements just before each token
    wp = Window.partitionBy("page_id").orderBy("pos").rowsBetween(_UNB, -1)
    md = F.when(F.col("_mend").isNotNull(), 1).when(F.col("_mclose"), -1).otherwise(0)
    df = df.withColumn("_md", F.coalesce(F.sum(md).over(wp), F.lit(0)))
    # first later opener of each closing group in the same container (same depth
    # among matched elements), so a nested list's <li> does not close an outer <li>
    wd = Window.partitionBy("page_id", "_md").orderBy(F.col("pos").desc()).rowsBetween(_UNB, -1)
    for g, (openers, _) in CLOSE_GROUPS.items():
        df = df.withColumn(f"_n_{g}", F.min(F.when((kind == "open") & F.col("tag").isin(openers), F.col("pos"))).over(wd))
    unclosed = (F.col("_pt") == "O") & F.col("_mend").isNull()
    df = df.withColumn("_ak", F.when(F.col("_mclose") | unclosed, F.col("_md")))
    wk = Window.partitionBy("page_id", "_ak").orderBy(F.col("pos").desc()).rowsBetween(_UNB, -1)
    df = df.withColumn("_anc", F.min(F.when(F.col("_mclose"), F.col("pos"))).over(wk))
    grp_next = F.lit(None).cast("bigint")
    for g, (_, closed) in CLOSE_GROUPS.items():
        grp_next = F.when(F.col("tag").isin(closed), F.col(f"_n_{g}")).otherwise(grp_next)
    unclosed_end = F.least(grp_next - 1, F.col("_anc") - 1, F.col("last_pos"))
    end = (F.when(F.col("_mend").isNotNull(), F.col("_mend"))
           .when(unclosed, unclosed_end)
           .otherwise(F.col("pos")))
    df = df.withColumn("end", end.cast("bigint"))
    return df.select(*tokens.columns, "end", F.col("_mclose").alias("matched_close"))


def nest(ext: DataFrame) -> DataFrame:
    """Depth (number of enclosing elements) and parent start (-1 = root) per token,
    plus ``sib_pos``: 1-based position among same-tag siblings (W1)."""
    # Events are generated from each row (explode, not union) so the token lineage is
    # computed once: the row itself (ord 0), its start (+1 after it) and its end (-1).
    # Only the ord-0 event carries the row; start/end events stay narrow.
    is_elem = F.col("kind") == "open"
    cols = [c for c in ext.columns if c not in ("page_id",)]
    row = F.struct(*cols)
    row_t = ext.select(row.alias("r")).schema["r"].dataType.simpleString()
    ev_t = f"struct<_p:bigint,_o:int,_d:int,_r:{row_t}>"
    none = F.lit(None).cast(row_t)
    evs = F.array(
        F.struct(F.col("pos").alias("_p"), F.lit(0).alias("_o"), F.lit(0).alias("_d"), row.alias("_r")),
        F.when(is_elem, F.struct(F.col("pos").alias("_p"), F.lit(1).alias("_o"), F.lit(1).alias("_d"), none.alias("_r"))),
        F.when(is_elem, F.struct(F.col("end").alias("_p"), F.lit(2).alias("_o"), F.lit(-1).alias("_d"), none.alias("_r"))),
    ).cast(f"array<{ev_t}>")
    ev = ext.select("page_id", F.explode(F.filter(evs, lambda x: x.isNotNull())).alias("_e"))
    w = Window.partitionBy("page_id").orderBy(F.col("_e._p"), F.col("_e._o")).rowsBetween(_UNB, 0)
    ev = ev.withColumn("depth", F.sum("_e._d").over(w)).filter(F.col("_e._o") == 0)
    ev = ev.select("page_id", "_e._r.*", "depth")
    # parent = latest element start one level up: each row is a child keyed depth-1,
    # each element is also a (narrow) candidate keyed by its own depth.
    cols = [c for c in ev.columns if c != "page_id"]
    row = F.struct(*cols)
    row_t = ev.select(row.alias("r")).schema["r"].dataType.simpleString()
    ks = F.array(
        F.struct((F.col("depth") - 1).alias("_k"), F.col("pos").alias("_p"), F.lit(0).alias("_o"),
                 F.lit(None).cast("bigint").alias("_c"), row.alias("_r")),
        F.when(is_elem, F.struct(F.col("depth").alias("_k"), F.col("pos").alias("_p"), F.lit(1).alias("_o"),
                                 F.col("pos").alias("_c"), F.lit(None).cast(row_t).alias("_r"))),
    ).cast(f"array<struct<_k:bigint,_p:bigint,_o:int,_c:bigint,_r:{row_t}>>")
    u = ev.select("page_id", F.explode(F.filter(ks, lambda x: x.isNotNull())).alias("_e"))
    wk = Window.partitionBy("page_id", F.col("_e._k")).orderBy(F.col("_e._p"), F.col("_e._o")).rowsBetween(_UNB, 0)
    u = u.withColumn("parent", F.coalesce(F.max("_e._c").over(wk), F.lit(-1).cast("bigint")))
    u = u.filter(F.col("_e._o") == 0).select("page_id", "_e._r.*", "parent")
    ws = Window.partitionBy("page_id", "parent", "tag").orderBy("pos")
    node = F.col("kind").isin("open", "text", "raw")
    u = u.withColumn("sib_pos", F.when(node, F.row_number().over(ws)).cast("bigint"))
    return u.withColumn("depth", F.col("depth").cast("bigint"))


def build_dom(pages: DataFrame, repartition: bool = True) -> DataFrame:
    """Token table with ``end``, ``depth``, ``parent``, ``sib_pos`` (html_elements).

    The structure is computed on narrow rows. The tokens meet it by position in a hash join whose build side is the
    structure of one partition of pages; so markup is never sorted, and pages are shuffled once for both sides.
    """
    tokens = tokenize(pages, repartition)
    shape = nest(element_extents(tokens.drop("tok"))).drop("last_pos", "kind", "tag", "void")
    wide = tokens.join(shape.hint("shuffle_hash"), ["page_id", "pos"])
    tok = F.col("tok")
    wide = wide.withColumn("attrs", F.when(F.col("kind") == "open", attributes(tok)))
    wide = wide.withColumn("text", F.when(F.col("kind") == "text", decode_entities(tok)).when(F.col("kind") == "raw", tok))
    return wide.select("page_id", "pos", "last_pos", "kind", "tag", "void", "tok", "attrs", "text", "end",
                       "matched_close", "depth", "parent", "sib_pos")


def elements(dom: DataFrame) -> DataFrame:
    return dom.filter(F.col("kind") == "open").select(
        "page_id", F.col("pos").alias("start"), "end", "tag", "depth", "parent", "sib_pos", "attrs")


def text_nodes(dom: DataFrame) -> DataFrame:
    return dom.filter(F.col("kind") == "text").select("page_id", "pos", "parent", "depth", "sib_pos", "text", "tok")


def save_dom_index(dom: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Write the element index once, bucketed and sorted by ``page_id``.

    Later queries read it with the bucketing known, so windows and structural joins
    on ``page_id`` need no exchange: the corpus html is shuffled once, when the
    index is built, and never per query.
    """
    w = dom.write.mode("overwrite").bucketBy(buckets, "page_id").sortBy("page_id", "pos")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
