"""Result naming: collision versioning (W6, H14) and latest-per-key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions import urls as U
from webloom.functions.urls import versioned_parts
from webloom.operators.common import cut_lineage
from webloom.operators.scan import keyed_running, keyed_scan


def version_names(df: DataFrame, name: str, order: list[str], group: list[str] | None = None,
                  out: str = "versioned_name") -> DataFrame:
    """The first row of a name keeps it; every further row takes the next version of it that no row has.

    ``base-N.ext`` names become ``base-M.ext`` with M above N; other names get ``-M`` with M from 2 on. All names of a
    ``base``/``ext`` share their version numbers, so versions that rows brought along are skipped, and the further rows
    of a base take the free numbers in the order of where they may start, then of ``order``. Names are unique in
    their group after a fixed number of ordered scans, whatever chains the names form:

    1. the rows of equal names are numbered; from here on only bases with further rows take part;
    2. rows and taken numbers in one order give each start its rank among the free numbers;
    3. a running maximum gives each row a free rank of its own, at or above that of its start;
    4. ranks and taken numbers in one order turn the ranks back into numbers.
    """
    group = group or []
    d = keyed_scan(df, [*group, name], order, step_col="_k")
    base, ver, ext = versioned_parts(name)
    d = cut_lineage(d.withColumns({"_base": base, "_ver": ver, "_ext": ext}))
    family = [*group, "_base", "_ext"]
    kept = d.where("_k = 1").withColumn(out, F.col(name))
    further = d.where("_k > 1").withColumn("_at", F.coalesce(F.col("_ver") + 1, F.lit(2).cast("bigint")))
    if further.isEmpty():
        return kept.select(*df.columns, out)
    taken = d.where("_ver is not null").select(*family, F.col("_ver").alias("_at")).distinct()
    taken = taken.join(further.select(*family).distinct(), family, "left_semi")
    # a taken number at a start is not below it: rows come first
    both = further.withColumn("_is", F.lit(0)).unionByName(taken.withColumn("_is", F.lit(1)), allowMissingColumns=True)
    both = both.withColumn("_row", 1 - F.col("_is"))
    both = keyed_running(both, family, ["_at", "_is", *order], {"_below": "_is", "_rows": "_row"})
    slots = both.where("_is = 1").select(*family, (F.col("_at") - F.col("_below") + 1).alias("_rank"))
    rows = both.where("_is = 0").withColumn("_room", F.col("_at") - F.col("_below") - F.col("_rows"))
    rows = keyed_running(rows, family, ["_at", *order], maxes={"_most": "_room"})
    rows = rows.withColumn("_rank", F.col("_most") + F.col("_rows")).drop("_below", "_is")
    # taken numbers come first: one of the same rank lies below the free number of that rank
    both = rows.withColumn("_is", F.lit(0)).unionByName(slots.withColumn("_is", F.lit(1)), allowMissingColumns=True)
    both = keyed_running(both.withColumn("_last", 1 - F.col("_is")), family, ["_rank", "_last", *order], {"_below": "_is"})
    number = (F.col("_rank") + F.col("_below")).cast("string")
    versioned = F.when(F.col("_ver").isNotNull(), F.concat("_base", F.lit("-"), number, "_ext")).otherwise(F.concat(name, F.lit("-"), number))
    done = both.where("_is = 0").withColumn(out, versioned)
    return kept.select(*df.columns, out).unionByName(done.select(*df.columns, out))


def html_save_names(pages: DataFrame, ts) -> DataFrame:
    """``(page_id, domain_dir, save_name)`` of the pages' HTML files, versioned within their folder."""
    named = pages.select("page_id", U.domain_dir("url").alias("domain_dir"), U.html_inner_name("url", ts).alias("_name"))
    return version_names(named, "_name", ["page_id"], ["domain_dir"], "save_name").drop("_name")


def latest_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last-written row per key (later write replaces).

    ``max(struct(order..., row))`` per key: a partial (map-side) aggregate, so a hot
    key is reduced in every task before the shuffle, never sorted in one task.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    agg = df.groupBy(*key).agg(F.max(packed).alias("_r"))
    return agg.select(*key, *[F.col("_r")[c].alias(c) for c in order + rest])
