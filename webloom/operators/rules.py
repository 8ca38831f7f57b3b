"""Extraction rules evaluated as joins over the element intervals (J1, J4, U1, U5, W1,
A2, A3, X2, F7, F8, H1, H2, H20, O2).

A rule is ``(site, target, alt, steps)``; a step is
``STRUCT<axis, tag, attr, values, pos>``:

* ``axis``: ``child`` (``/``) or ``desc`` (``//``)
* ``tag``: element name, ``*``, or ``text()``
* ``attr`` / ``values``: attribute equality, any of the values (``or``)
* ``pos``: same-tag sibling position ``[n]`` (1-based)

Alternatives of one target (``a | b``) are rules with the same target and different
``alt``; their hits are unioned without duplicates in document order.

Evaluation runs all rules of all sites in one job: pages join their sites' rules
(broadcast, size-checked), then one join per step index. A child step is an equi
join on ``(page_id, rule, parent = context start)``; a descendant step joins on
``(page_id, rule)`` with the interval as residual. The loop is over step positions
(a config bound), never over data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.functions.text import py_strip, strip_ws
from webloom.operators import dom as D
from webloom.operators.common import BROADCAST_MAX_ROWS

STEP_TYPE = T.StructType([
    T.StructField("axis", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("attr", T.StringType()),
    T.StructField("values", T.ArrayType(T.StringType())),
    T.StructField("pos", T.IntegerType()),
])
RULES_SCHEMA = T.StructType([
    T.StructField("site", T.StringType(), False),
    T.StructField("target", T.StringType(), False),
    T.StructField("alt", T.IntegerType(), False),
    T.StructField("steps", T.ArrayType(STEP_TYPE), False),
])
_KEYS = ["site", "target", "alt"]


def step(axis: str, tag: str, attr: str | None = None, values: list[str] | None = None,
         pos: int | None = None) -> tuple:
    return (axis, tag, attr, values, pos)


def rules_df(spark: SparkSession, rules: dict[str, dict[str, list[list[tuple]]]]) -> DataFrame:
    """``{site: {target: [alternative steps, ...]}}`` -> rules table."""
    rows = [(site, target, alt, steps)
            for site, targets in rules.items()
            for target, alts in targets.items()
            for alt, steps in enumerate(alts)]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def _nodes(dom: DataFrame) -> DataFrame:
    return dom.filter(F.col("kind").isin("open", "text", "raw")).select(
        "page_id", F.col("pos").alias("start"), "end", "tag", "kind", "parent", "sib_pos", "attrs")


def evaluate(dom: DataFrame, page_sites: DataFrame, rules: DataFrame) -> DataFrame:
    """All rule hits: ``(page_id, site, target, start, end, kind, strip)``.

    One chain of joins, one per step position: the context (matches so far) is
    left-joined with that step's candidates; rules that already finished pass
    through unmatched, continuing ones keep their matches. Each DataFrame is used
    once, so nothing is recomputed or materialized between steps.
    """
    rules = rules.withColumn("_n", F.size("steps"))
    # one aggregate row, whatever the rules table's size: the longest rule and the step
    # positions that use '*', and the row count that decides the broadcast
    stars = F.filter(F.transform("steps", lambda s, i: F.when(s["tag"] == "*", i + 1)), lambda x: x.isNotNull())
    meta = rules.agg(F.count("*").alias("rows"), F.max("_n").alias("n"),
                     F.array_distinct(F.flatten(F.collect_set(stars))).alias("stars")).first()
    bc = F.broadcast if meta["rows"] <= BROADCAST_MAX_ROWS else (lambda df: df)
    max_steps = meta["n"] or 0
    star_at = set(meta["stars"] or [])
    ps = page_sites.select("page_id", "site", (F.col("strip") if "strip" in page_sites.columns
                                              else F.lit(None).cast("boolean")).alias("_strip")).distinct()
    ctx = (ps.join(bc(rules.select(*_KEYS, "_n")), "site")
           .withColumn("start", F.lit(-1).cast("bigint")).withColumn("end", F.lit(2 ** 62).cast("bigint"))
           .withColumn("kind", F.lit("root")))
    # a page's nodes meet the rules of its own sites only, however many sites there are
    nodes = _nodes(dom).join(ps.select("page_id", "site"), "page_id")
    for k in range(1, max_steps + 1):
        sk = rules.filter(F.col("_n") >= k).select(*_KEYS, F.col("steps")[k - 1].alias("_st"))
        keyed = nodes.withColumn("_key", F.col("tag"))
        if k in star_at:  # '*' matches any element: add one keyed copy of the elements
            keyed = keyed.unionByName(nodes.filter(F.col("kind") == "open").withColumn("_key", F.lit("*")))
        cand = keyed.join(bc(sk.withColumn("_key", F.col("_st.tag"))), ["site", "_key"])
        av = D.attr("attrs", F.col("_st.attr"))
        cand = cand.filter(F.col("_st.attr").isNull() | F.coalesce(F.array_contains(F.col("_st.values"), av), F.lit(False)))
        cand = cand.filter(F.col("_st.pos").isNull() | (F.col("sib_pos") == F.col("_st.pos")))
        cand = cand.select(F.col("page_id").alias("_pg"), *[F.col(c).alias("_c" + c) for c in _KEYS],
                           F.col("_st.axis").alias("_ax"), F.col("start").alias("_s"), F.col("end").alias("_e"),
                           F.col("kind").alias("_k"), F.col("parent").alias("_p"))
        on = ((F.col("page_id") == F.col("_pg")) & (F.col("site") == F.col("_csite"))
              & (F.col("target") == F.col("_ctarget")) & (F.col("alt") == F.col("_calt"))
              & (F.col("_n") >= k)
              & (((F.col("_ax") == "child") & (F.col("_p") == F.col("start")))
                 | ((F.col("_ax") == "desc") & (F.col("_s") > F.col("start")) & (F.col("_s") <= F.col("end")))))
        j = ctx.join(cand, on, "left")
        done = F.col("_n") < k
        ctx = j.filter(done | F.col("_s").isNotNull()).select(
            "page_id", *_KEYS, "_strip", "_n",
            F.when(done, F.col("start")).otherwise(F.col("_s")).alias("start"),
            F.when(done, F.col("end")).otherwise(F.col("_e")).alias("end"),
            F.when(done, F.col("kind")).otherwise(F.col("_k")).alias("kind"),
        ).dropDuplicates(["page_id", *_KEYS, "start"])
    # Union of alternatives, duplicate-free
    return ctx.filter(F.col("kind") != "root").select(
        "page_id", "site", "target", "start", "end", "kind", F.col("_strip").alias("strip")
    ).dropDuplicates(["page_id", "site", "target", "start"])


def values(hits: DataFrame, dom: DataFrame, strip: bool | None = None) -> DataFrame:
    """X2 value of every hit, both modes in one equi join and one aggregation: a hit is
    spread over its own token positions, so the work is the size of the output.

    strip mode: string-value (descendant text, script and style bodies included; a text hit's own text) with
    spaces, newlines, tabs and CRs deleted, empties kept. trim mode: element hits give their
    source markup (H20), text hits their text; trimmed (H2), empties dropped.
    ``strip`` None takes each hit's own ``strip`` flag (default strip).
    """
    mode = F.lit(strip) if strip is not None else F.coalesce(F.col("strip"), F.lit(True))
    h = hits.select("page_id", "site", "target", "start", "end", F.col("kind").alias("_hk"), mode.alias("_strip"))
    t = dom.select("page_id", F.col("pos").alias("_tp"), F.col("kind").alias("_tk"),
                   F.col("tok").alias("_tok"), F.col("text").alias("_tt"))
    j = h.withColumn("_tp", F.explode(F.sequence("start", "end"))).join(t, ["page_id", "_tp"])
    is_text = F.col("_tk").isin("text", "raw")
    own_or_below = F.col("_hk").isin("text", "raw") | (F.col("_tp") > F.col("start"))
    sv = F.when(F.col("_strip") & is_text & own_or_below, F.struct(F.col("_tp").alias("p"), F.col("_tt").alias("s")))
    mk = F.when(~F.col("_strip"), F.struct(F.col("_tp").alias("p"),
                                          F.when(F.col("_hk").isin("text", "raw"), F.col("_tt")).otherwise(F.col("_tok")).alias("s")))
    g = j.groupBy("page_id", "site", "target", "start", "_strip").agg(
        F.collect_list(sv).alias("_sv"), F.collect_list(mk).alias("_mk"))
    cat = lambda c: F.array_join(F.transform(F.array_sort(F.col(c)), lambda x: x["s"]), "")
    out = g.select("page_id", "site", "target", "start",
                   F.when(F.col("_strip"), strip_ws(cat("_sv"))).otherwise(py_strip(cat("_mk"))).alias("value"),
                   "_strip")
    return out.filter(F.col("_strip") | (F.col("value") != "")).drop("_strip")


def ordered(vals: DataFrame) -> DataFrame:
    """A2/O2 long form: ``idx`` = document order within (page, site, target)."""
    w = Window.partitionBy("page_id", "site", "target").orderBy("start")
    return vals.withColumn("idx", (F.row_number().over(w) - 1).cast("bigint")).drop("start")


def extract(dom: DataFrame, page_sites: DataFrame, rules: DataFrame, strip: bool | None = None) -> DataFrame:
    """Rules -> long form ``(page_id, site, target, idx, value)``.

    ``strip`` None takes each site's ``strip`` flag from ``page_sites`` (X2).
    Targets without values are absent (F7); pages without any target are absent (F8).
    """
    return ordered(values(evaluate(dom, page_sites, rules), dom, strip))


def to_map(long: DataFrame) -> DataFrame:
    """A3: ``(page_id, site, targets MAP<target, ARRAY<value>>)`` from the long form."""
    per_target = long.groupBy("page_id", "site", "target").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "value"))), lambda x: x["value"]).alias("vals"))
    return per_target.groupBy("page_id", "site").agg(
        F.map_from_entries(F.collect_list(F.struct("target", "vals"))).alias("targets"))
