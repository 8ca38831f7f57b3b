"""Substring joins of URLs with large fragment tables (F4, J2): a q-gram filter in front of ``contains``.

A fragment can only be in a URL that holds each of its q-grams, so it is filed under one of them: the one that the
fewest URLs hold. URLs are exploded to their distinct q-grams, an equality join on the q-gram gives the candidates, and
``contains`` decides. Fragments shorter than q are filed under themselves, and URLs also meet them by the substrings of
those lengths; there the join is exact. Rare q-grams keep the candidates few; a q-gram that most URLs hold is
only used by fragments that have no other. No pair is formed that does not share a q-gram, and adaptive execution can split a
hot one, as the join is a plain equality join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Q = 4


def grams(text: str, size: int) -> Column:
    """The distinct substrings of one length."""
    last = F.char_length(text) - size + 1
    every = F.transform(F.when(last >= 1, F.sequence(F.lit(1), last)), lambda i: F.substring(F.col(text), i, F.lit(size)))
    return F.array_distinct(F.coalesce(every, F.array().cast("array<string>")))


def substring_pairs(urls: DataFrame, fragments: DataFrame, url: str = "url", fragment: str = "fragment", q: int = Q) -> DataFrame:
    """``(url, fragment)``, each pair once: the fragments that each URL contains, case-sensitive.

    Nulls match nothing; the empty fragment is in every URL.
    """
    u = urls.select(F.col(url).alias("url")).where("url is not null").distinct()
    f = fragments.select(F.col(fragment).alias("fragment")).where("fragment is not null").distinct()
    f = f.withColumn("size", F.least(F.char_length("fragment"), F.lit(q)))
    long = f.where(F.col("size") == q).select("fragment", F.explode(grams("fragment", q)).alias("gram"))
    # how many URLs hold each q-gram of a fragment; others are not counted
    held = u.select(F.explode(grams("url", q)).alias("gram")).join(long.select("gram").distinct(), "gram", "left_semi")
    held = held.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = long.join(held, "gram", "left").groupBy("fragment").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r"))
    # a fragment with a q-gram that no URL holds is in none
    filed = rarest.where("r.n > 0").select("fragment", F.col("r.gram").alias("gram"))
    filed = filed.unionByName(f.where(F.col("size") < q).select("fragment", F.col("fragment").alias("gram")))
    sizes = sorted(r["size"] for r in f.select("size").distinct().collect())  # at most q + 1 values
    parts = [grams("url", k) if k else F.array(F.lit("")) for k in sizes]
    keyed = u.select("url", F.explode(F.concat(*parts) if parts else F.array().cast("array<string>")).alias("gram"))
    return keyed.join(filed, "gram").where(F.contains(F.col("url"), F.col("fragment"))).select("url", "fragment")


def fragment_join(bound: DataFrame, sites: DataFrame, url: str = "url", q: int = Q) -> DataFrame:
    """F4 for fragment lists of any length: rows of ``bound`` (site, url, ...) whose URL holds a fragment of their site.

    ``fragments`` NULL keeps every row of the site, an empty list none (``links.fragment_filter`` does the same on
    short lists, inside the row).
    """
    free = sites.where("fragments is null").select("site").distinct()
    listed = sites.select("site", F.explode("fragments").alias("fragment")).where("fragment is not null").distinct()
    pairs = substring_pairs(bound.select(F.col(url).alias("url")), listed, q=q)
    allowed = pairs.join(listed, "fragment").select("site", F.col("url").alias(url)).distinct()
    return bound.join(free, "site", "left_semi").unionByName(
        bound.join(free, "site", "left_anti").join(allowed, ["site", url], "left_semi"))
