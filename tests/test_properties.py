"""Property checks: frontier vs. a plain BFS, intervals on the real corpus, scan vs. window."""

from collections import deque

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from webloom.operators import dom as D
from webloom.operators.links import frontier
from webloom.operators.scan import keyed_scan

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def _bfs(edges, seeds, max_depth):
    adj = {}
    for s, t in edges:
        adj.setdefault(s, []).append(t)
    depth = {s: 1 for s in seeds}
    q = deque(seeds)
    while q:
        u = q.popleft()
        if depth[u] >= max_depth:
            continue
        for v in adj.get(u, []):
            if v not in depth:
                depth[v] = depth[u] + 1
                q.append(v)
    return depth


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 15), st.integers(0, 15)), min_size=1, max_size=40),
       st.sets(st.integers(0, 15), min_size=1, max_size=3), st.integers(1, 5))
def test_frontier_equals_bfs(spark, edges, seeds, max_depth):
    e = spark.createDataFrame(edges, "src long, dst long").distinct()
    s = spark.createDataFrame([(x,) for x in seeds], "node long")
    got = {r["node"]: r["depth"] for r in frontier(s, e, max_depth).collect()}
    assert got == _bfs(edges, sorted(seeds), max_depth)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "hot"]), st.integers(0, 50), st.integers(0, 3)),
                min_size=1, max_size=80))
def test_keyed_scan_equals_window(spark, rows):
    df = spark.createDataFrame(rows, "k string, t long, v long").dropDuplicates(["k", "t"])
    got = keyed_scan(df, ["k"], ["t"], ["v"], partitions=5)
    w = Window.partitionBy("k").orderBy("t")
    want = df.withColumn("step", F.row_number().over(w).cast("bigint")).withColumn("prev_v", F.lag("v").over(w))
    cols = ["k", "t", "step", "prev_v"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert got.count() == want.count()


def test_corpus_intervals_nested_or_disjoint(spark):
    dom = D.build_dom(spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "html"))
    e = D.elements(dom).select("page_id", "start", "end", "parent")
    a, b = e.alias("a"), e.alias("b")
    crossing = a.join(b, (F.col("a.page_id") == F.col("b.page_id")) & (F.col("a.start") < F.col("b.start"))
                      & (F.col("b.start") <= F.col("a.end")) & (F.col("b.end") > F.col("a.end")))
    assert crossing.count() == 0
    # every parent is an element that contains its child
    par = a.join(b, (F.col("a.page_id") == F.col("b.page_id")) & (F.col("b.parent") == F.col("a.start")))
    assert par.filter(~((F.col("b.start") > F.col("a.start")) & (F.col("b.start") <= F.col("a.end")))).count() == 0
