"""Link graph operators: extraction, site binding, fragment / seen filters, frontier.

Everything is keyed by exact URL strings (no canonicalisation), like the seen filter
being re-expressed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from webloom.functions import urls as U
from webloom.functions.text import clean_markup, decode_entities
from webloom.operators.common import cut_lineage, maybe_broadcast, scratch_path

# a / area start tags up to their href value (double-quoted, single-quoted or unquoted)
HREF_PATTERN = r"""(?i)<(?:a|area)\b[^>]*?\shref\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
BASE_PATTERN = HREF_PATTERN.replace("(?:a|area)", "base")
# the value at the end of such a match: groups 1-3, exactly one takes part
HREF_VALUE = r"""(?i)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))$"""

# hops of the frontier in one job: at most so many, and one where more nodes are to be expanded; rounds per merge of their files
ROUND_HOPS = 8
FEW_NODES = 100_000
MERGED_ROUNDS = 16


def extract_links(pages: DataFrame, unique: bool = True, denied: list[str] | None = None) -> DataFrame:
    """H4+H6+F6: ``links(page_id, src_url, idx, href, url)``; ``url`` is resolved and made
    safe (percent-encoded like a link extractor does), ``href`` is the raw value.

    Links are taken from the markup without comments, scripts and styles; the attribute value's character
    references are decoded; relative references resolve against the page's first ``<base href>`` where it has one.
    Only links with a link scheme (U.LINK_SCHEMES) whose path does not end in a denied extension stay
    (``denied=None``: U.DEFAULT_DENIED_EXTENSIONS).

    With ``unique`` a page keeps the first occurrence of every resolved URL, in
    document order. The dedup runs inside the page row (sort the link array, drop
    adjacent repeats, sort back) so it needs no shuffle and is O(n log n) per page.
    """
    # one pass over the page finds the links; the value is then cut from each short match
    denied = U.DEFAULT_DENIED_EXTENSIONS if denied is None else denied
    value = lambda m: F.concat(*[F.regexp_extract(m, HREF_VALUE, i) for i in (1, 2, 3)])
    df = pages.select("page_id", F.col("url").alias("src_url"), clean_markup("html").alias("_m"))
    hrefs = F.transform(F.regexp_extract_all(F.col("_m"), F.lit(HREF_PATTERN), 0), value)
    base = value(F.regexp_extract("_m", BASE_PATTERN, 0))
    df = df.select("page_id", "src_url", hrefs.alias("_h"), base.alias("_b"))
    # step by step, each in a projection of its own, so no step's expression is copied into the next
    df = df.withColumn("_b", decode_entities("_b")).withColumn("_d", F.transform("_h", decode_entities))
    df = df.withColumn("_b", F.when(F.col("_b") == "", F.col("src_url")).otherwise(U.resolve("src_url", "_b")))
    df = df.withColumn("_p", U.base_parts("_b"))
    df = df.withColumn("_j", F.transform("_d", lambda h: U.join_reference(F.col("_p"), h)))
    df = df.withColumn("_j", F.transform("_j", lambda j, i: U.without_dots(j, F.get("_d", i))))
    df = df.withColumn("_l", F.transform("_j", lambda u, i: F.struct(
        U.safe_url(u).alias("url"), i.alias("pos"), F.get("_h", i).alias("href"))))
    df = df.withColumn("_l", F.filter("_l", lambda x: x["url"].rlike("(?i)^(?:" + "|".join(U.LINK_SCHEMES) + "):")
                                      & ~U.denied_extension(x["url"], denied)))
    if unique:
        df = df.withColumn("_s", F.sort_array("_l"))  # by url, then first position
        df = df.withColumn(
            "_l",
            F.filter("_s", lambda x, i: (i == 0) | (F.get(F.col("_s"), i - 1)["url"] != x["url"])),
        )
        df = df.withColumn(
            "_l", F.sort_array(F.transform("_l", lambda x: F.struct(x["pos"].alias("pos"), x["url"].alias("url"),
                                                                     x["href"].alias("href")))))
    # explode_outer: no inferred size() filter, so the regex runs once per page
    out = df.select("page_id", "src_url", F.posexplode_outer("_l").alias("idx", "_x")).filter(F.col("idx").isNotNull())
    return out.select("page_id", "src_url", F.col("idx").cast("bigint").alias("idx"),
                      F.col("_x.href").alias("href"), F.col("_x.url").alias("url"))


def url_scan(links: DataFrame) -> DataFrame:
    """A1+O1: distinct discovered URLs in code-point order (UTF8_BINARY)."""
    return links.select("url").distinct().orderBy("url")


def host_suffixes(url_col) -> F.Column:
    """All dot-boundary suffixes of the host: a.b.c -> [a.b.c, b.c, c]."""
    labels = F.split(U.host(url_col), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))


def bind_sites(df: DataFrame, sites: DataFrame, url_col: str = "url") -> DataFrame:
    """Attach every site whose allowed domains cover the row's host.

    Domain coverage (host == d or host endswith '.d') becomes an equi join on the
    host's dot suffixes, so it scales as a hash join; the sites side is broadcast
    only when its row count is checked small.
    """
    dom = sites.select("site", F.explode("allowed_domains").alias("_dom")).select(
        "site", F.lower("_dom").alias("_dom")).distinct()
    keyed = df.withColumn("_dom", F.explode(host_suffixes(F.col(url_col))))
    return keyed.join(maybe_broadcast(dom), "_dom").drop("_dom").dropDuplicates()


def fragment_filter(df: DataFrame, sites: DataFrame, url_col: str = "url") -> DataFrame:
    """Keep rows whose URL contains any fragment of their site.

    ``fragments`` NULL keeps everything, an empty list keeps nothing. The per-site
    fragment arrays arrive by an equi join on ``site``; no nested-loop join.
    """
    fr = sites.select("site", "fragments")
    j = df.join(maybe_broadcast(fr), "site")
    return j.filter(U.fragment_allowed(F.col(url_col), F.col("fragments"))).drop("fragments")


def dedup_first(df: DataFrame, key: str = "url", order: list[str] | None = None) -> DataFrame:
    """Exact-string in-batch dedup: the first row per key by ``order`` wins."""
    order = order or ["page_id", "idx"]
    cols = [c for c in df.columns if c != key]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in cols if c not in order])
    agg = df.groupBy(key).agg(F.min(packed).alias("_r"))
    return agg.select(key, *[F.col("_r")[c].alias(c) for c in cols]).select(*df.columns)


def seen_anti(candidates: DataFrame, seen: DataFrame, key: str = "url") -> DataFrame:
    """Drop URLs already in the seen table (exact string), then in-batch dedup."""
    s = seen.select(F.col(key)).distinct()
    return dedup_first(candidates.join(s, key, "left_anti"), key)


def seed_exempt(requests: DataFrame, seen: DataFrame, first_seed_col: str = "first_seed") -> DataFrame:
    """the first start URL bypasses the seen check; every other URL is checked."""
    s = seen.select("url").distinct().withColumn("_seen", F.lit(True))
    j = requests.join(s, "url", "left")
    return j.filter((F.col("url") == F.col(first_seed_col)) | F.col("_seen").isNull()).drop("_seen")


def seeds(sites: DataFrame) -> DataFrame:
    """All start URLs of all sites, duplicate-free."""
    return sites.select(F.explode("start_urls").alias("url")).distinct()


def frontier(seed_nodes: DataFrame, edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """J5+A9: breadth-first expansion with seen-set dedup; depth of seeds = 1. Runs until a round finds nothing new.

    One job per round of one or more hops: the newest nodes are expanded, each node's smallest depth is kept, the nodes
    found in earlier rounds are dropped and the others are written to the session's shared folder and counted on the way. A
    deep graph has few new nodes per hop, so while at most FEW_NODES are to be expanded the next one takes twice the hops, up to
    ROUND_HOPS. The plan stays as short as one round and a lost executor costs one round; the rounds' files are merged
    every MERGED_ROUNDS rounds, so that their number does not grow with the depth. First arrival wins, so depth is the minimum.
    ``max_depth`` is for callers who want fewer hops.
    """
    spark = seed_nodes.sparkSession
    base = scratch_path(spark, "frontier")
    schema = f"node {seed_nodes.schema['node'].dataType.simpleString()}, depth INT"
    read = lambda paths: spark.read.schema(schema).parquet(*paths)
    # every node also leads to itself at no cost, so what a round has found stays in its chain of joins; written once
    links = edges.select("src", "dst").where("src is not null").distinct()
    nodes = links.select(F.explode(F.array("src", "dst")).alias("src")).unionByName(
        seed_nodes.select(F.col("node").alias("src"))).distinct()
    links.select("src", "dst", F.lit(1).alias("hop")).unionByName(
        nodes.select("src", F.col("src").alias("dst"), F.lit(0).alias("hop"))).write.parquet(f"{base}/edges")
    links = spark.read.parquet(f"{base}/edges")

    def write(found: DataFrame, path: str, depth: int) -> int:
        seen = Observation()
        found = found.select("node", F.col("depth").cast("int").alias("depth"))
        found.observe(seen, F.count_if(F.col("depth") == depth).alias("n")).write.parquet(path)
        return seen.get["n"]  # the newest, which the next round expands

    rounds, merges, hops, depth = [f"{base}/round-0"], 0, 1, 1
    n = write(seed_nodes.select("node").distinct().withColumn("depth", F.lit(1)), rounds[0], depth)
    while n and (max_depth is None or depth < max_depth):
        hops = min(2 * hops, ROUND_HOPS) if n <= FEW_NODES else 1
        if max_depth is not None:
            hops = min(hops, max_depth - depth)
        found = read(rounds[-1:]).where(F.col("depth") == depth)
        for _ in range(hops):
            found = found.hint("shuffle_hash").join(links, found["node"] == links["src"]).groupBy(F.col("dst").alias("node")).agg(
                F.min(F.col("depth") + F.col("hop")).alias("depth"))
        depth += hops
        path = f"{base}/round-{depth}"
        visited = read(rounds).select(F.col("node").alias("_visited"))
        n = write(found.join(visited, F.col("node").eqNullSafe(F.col("_visited")), "left_anti"), path, depth)
        if len(rounds) == MERGED_ROUNDS:
            merges += 1
            read(rounds).coalesce(spark.sparkContext.defaultParallelism).write.parquet(f"{base}/merged-{merges}")
            rounds = [f"{base}/merged-{merges}"]
        rounds.append(path)
    return read(rounds)


def link_frontier(links: DataFrame, sites: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """J5 on URLs: from the sites' start URLs along extracted links that the sites' domains and fragments allow,
    each URL once, those of ``seen`` never again (the start URLs are exempt)."""
    pairs = links.select("src_url", "url").distinct()
    allowed = fragment_filter(bind_sites(pairs, sites), sites).select("src_url", "url").distinct()
    if seen is not None:
        allowed = allowed.join(seen.select("url").distinct(), "url", "left_anti")
    # read once per hop: materialised, so a hop never extracts links again
    edges = cut_lineage(allowed.select(F.col("src_url").alias("src"), F.col("url").alias("dst")))
    found = frontier(seeds(sites).select(F.col("url").alias("node")), edges)
    return found.select(F.col("node").alias("url"), "depth")
