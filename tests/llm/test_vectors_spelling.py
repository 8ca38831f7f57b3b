"""Near-duplicate vectors, hard negatives and spelling variants against brute force, and the cases their docstrings define."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom.llm import hardnegatives, spelling, vectordedup

VECTORS = "vec_id long, embedding array<double>, label int"


# -- near-duplicate vectors -----------------------------------------------------------------------------------------

def clouds(seed, groups, dim=16, spread=0.08, single=150):
    """Groups of near copies of the given sizes and single vectors."""
    rng = np.random.default_rng(seed)
    out = [rng.standard_normal(dim) * rng.uniform(0.5, 3) for _ in range(single)]
    for size in groups:
        centre = rng.standard_normal(dim)
        out += [centre + spread * np.linalg.norm(centre) / np.sqrt(dim) * rng.standard_normal(dim) * 2 for _ in range(size)]
    return [(i, [float(y) for y in x], 0) for i, x in enumerate(out)]


def links_brute(rows, cosine=0.9):
    n, low = {}, {i: i for i, _, _ in rows}
    fit = [(i, np.array(v) / max(map(abs, v))) for i, v, _ in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    edges = [(i, j) for i, v in fit for j, w in fit
             if i != j and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= cosine]
    for i, _ in edges:
        n[i] = n.get(i, 0) + 1
    changed = True
    while changed:
        changed = False
        for i, j in edges:
            if low[j] < low[i]:
                low[i], changed = low[j], True
    return {i: (n.get(i, 0), low[i], low[i] == i) for i, _, _ in rows}


def linked(df, **options):
    out = vectordedup.link_vectors(df, **options).collect()
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out}


def test_links_of_small_large_and_equal_groups(spark):
    rows = clouds(3, [2, 3, 9, 60])
    rows += [(len(rows) + k, rows[151][1], 1) for k in range(30)]  # equal vectors
    rows += [(2000, None, 0), (2001, [], 0), (2002, [0.0] * 16, 0), (2003, [float("nan")] + [1.0] * 15, 0),
             (2004, [None] + [1.0] * 15, 0), (2005, [float("inf")] + [1.0] * 15, 0), (2006, [1.0, 2.0], 0), (2007, [2.0, 4.0], 0),
             (2008, [1e-300] * 16, 0), (2009, [1e300] * 16, 0)]
    df = spark.createDataFrame(rows, VECTORS)
    assert linked(df) == links_brute(rows)


def test_a_stretched_group_is_counted_exactly(spark, monkeypatch):
    # a chain of saturated lists whose ends are not linked: many balls, none of them sure, several tiles
    monkeypatch.setattr(vectordedup, "PIVOT_MEMBERS", 20)
    monkeypatch.setattr(vectordedup, "TILE", 16)
    turn = np.linspace(0, 1.8, 240)
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.cos(a)), float(np.sin(a)), *(0.05 * rng.standard_normal(6)).tolist()], 0) for i, a in enumerate(turn)]
    assert linked(spark.createDataFrame(rows, VECTORS)) == links_brute(rows)


def test_vector_ids_that_are_null_or_repeat_and_extra_columns(spark):
    rows = [(1, [1.0, 0.0], 5), (1, [0.5, 0.1], 6), (2, [1.0, 0.2], 7), (None, [1.0, 0.0], 8), (3, None, 9), (3, [-1.0, 0.0], 9)]
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in ("id", "u", "comp", "n_links", "a.b")})
    # of id 1 the smallest vector counts, (0.5, 0.1)
    assert linked(df) == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), None: (0, None, True)}
    assert linked(spark.createDataFrame([], VECTORS)) == {}


# -- hard negatives ---------------------------------------------------------------------------------------------------

def negatives_brute(rows, anchors, low=80, n_pos=5, n_neg=5):
    out = []
    for a, la, va in rows:
        if a not in anchors:
            continue
        scored = [(sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in rows if i != a and len(v) == len(va)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for ps, p, _ in [s for s in scored if s[2] == la][:n_pos]:
            fits = [s for s in scored if s[2] != la and low * ps <= 100 * s[0] <= 100 * ps][:n_neg]
            out += [(a, p, k, i, ps, s) for k, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("values,dim,scale", [(1 << 20, 64, 40), (70, 7, 3), (40, 1, 2)])
def test_negatives_equal_brute_force(spark, values, dim, scale):
    rng = random.Random(dim)
    rows = [(i, rng.randrange(3), [rng.randint(-scale, scale) for _ in range(dim)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>").repartition(5)
    got = hardnegatives.mine(df, F.col("id") % 9 == 0, anchor_values=values)
    assert sorted(map(tuple, got.collect())) == negatives_brute(rows, {i for i in range(0, 300, 9)})


def test_negatives_with_scores_beyond_doubles_and_beyond_longs(spark):
    big = [(0, 0, [1 << 31, 1]), (1, 0, [1 << 31, 2]), (2, 1, [1 << 31, 1]), (3, 1, [1 << 31, 0]), (4, 1, [(1 << 31) - 1, 5])]
    df = spark.createDataFrame(big, "vec_id long, label int, vector array<long>")
    assert sorted(map(tuple, hardnegatives.mine(df, F.col("id") == 0).collect())) == negatives_brute(big, {0})
    over = spark.createDataFrame([(0, 0, [1 << 62]), (1, 0, [1 << 62])], df.schema)
    with pytest.raises(Exception, match="64 bits"):
        hardnegatives.mine(over, F.col("id") == 0).collect()


def test_negative_rows_that_take_no_part(spark):
    schema = "vec_id long, label int, vector array<long>, id int, x int"
    rows = [(0, 0, [2, 2]), (1, 0, [2, 1]), (1, 1, [9, 9]), (2, 1, [2, 1]), (3, None, [2, 1]), (4, 1, None), (5, 1, [2, None]),
            (6, 1, [2, 1, 1]), (None, 1, [2, 1]), (7, 1, [])]
    got = hardnegatives.mine(spark.createDataFrame([(*r, 1, 1) for r in rows], schema), F.col("id") == 0)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 2, 6, 6)]
    assert hardnegatives.mine(spark.createDataFrame([], schema), F.col("id") == 0).collect() == []


def test_usable_vectors(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None), (3, [None]), (4, [float("nan")]), (5, [float("-inf")]), (6, [])], "k int, v array<float>")
    assert sorted(r["k"] for r in df.where(hardnegatives.usable("v")).collect()) == [1, 6]


# -- spelling variants ------------------------------------------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variants_brute(words, factor=5):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= factor * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("block", [4, 512])
def test_variants_equal_brute_force(spark, block):
    rng = random.Random(block)
    words = {}
    for _ in range(400):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(1, 9)))
        words[w] = rng.choice([5, 6, 25, 30, 125, 700, 3500])
    words |= {"x" * 300: 5, "x" * 301: 40, "x" * 299 + "y": 5, "x" * 302: 300}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert set(map(tuple, spelling.variants(df, block=block).select("word", "form", "root", "n", "n_near", "form_n").collect())) == variants_brute(words)


def test_vocabulary_with_planted_deletions(spark):
    import re
    import zlib

    rng = random.Random(5)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [" ".join("".join(rng.choice("aaBÉ") for _ in range(rng.randint(4, 7))) + rng.choice([" ", "1", "_", "×ʼ"]) for _ in range(300)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(20, None), (21, ""), (3, texts[3]), (None, "nonames " * 9)]
    count = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 7 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += 1
    want = {(w, n) for w, n in count.items() if len(w) >= 6 and n >= 5}
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("z"), "n": F.lit(1), "id": F.lit(2)})
    got = spelling.vocabulary(df, plant_every=7)
    assert set(map(tuple, got.collect())) == want and len(want) > 20


def test_variants_of_nothing(spark):
    empty = spelling.vocabulary(spark.createDataFrame([], "doc_id long, text string"))
    assert spelling.variants(empty).collect() == []
    lone = spark.createDataFrame([("unique", 9)], "word string, n long")
    assert list(map(tuple, spelling.variants(lone).collect())) == [("unique", None, "unique", 9, 0, None)]
