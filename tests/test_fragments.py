"""The substring join against brute force, and its plan."""

import random

import pytest

from webloom.operators.fragments import fragment_join, substring_pairs
from webloom.operators.links import fragment_filter


@pytest.mark.parametrize("q", [1, 3, 4])
def test_pairs_equal_brute_force(spark, q):
    rng = random.Random(q)
    text = lambda n: "".join(rng.choice("ab/é") for _ in range(n))
    urls = [text(rng.randint(0, 30)) for _ in range(150)] + [None, "", "http" * 9, "x" * 3000 + "needle" + "y" * 3000]
    frags = [text(rng.randint(0, 6)) for _ in range(80)] + [None, "", "a", "needle", "zzzz", "http", "xxxxn", "é/", "longer than any url"]
    got = substring_pairs(spark.createDataFrame([(u,) for u in urls * 2], "url string"),
                          spark.createDataFrame([(f,) for f in frags * 2], "fragment string"), q=q).collect()
    want = {(u, f) for u in urls if u is not None for f in frags if f is not None and f in u}
    assert len(got) == len(want) and {(r["url"], r["fragment"]) for r in got} == want


def test_pairs_of_empty_tables(spark):
    urls, frags = spark.createDataFrame([("abcd",)], "url string"), spark.createDataFrame([], "fragment string")
    assert substring_pairs(urls, frags).collect() == []
    assert substring_pairs(urls.limit(0), spark.createDataFrame([("a",)], "fragment string")).collect() == []


def test_fragment_join_equals_the_filter_in_the_row(spark):
    sites = spark.createDataFrame([("any", None), ("none", []), ("some", ["/en/", "x"]), ("blank", [""])], "site string, fragments array<string>")
    rows = [(i, s, u) for i, u in enumerate(["http://h/en/1", "http://h/de/x", "http://h/fr/2"]) for s in ("any", "none", "some", "blank", "gone")]
    bound = spark.createDataFrame(rows, "page_id long, site string, url string")
    kept = lambda df: sorted((r["page_id"], r["site"]) for r in df.collect())
    assert kept(fragment_join(bound, sites)) == kept(fragment_filter(bound, sites)) != []


def test_no_nested_loop(spark):
    urls = spark.range(100).selectExpr("concat('http://h/', id) as url")
    out = substring_pairs(urls, spark.range(50).selectExpr("concat('h/', id) as fragment"))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
