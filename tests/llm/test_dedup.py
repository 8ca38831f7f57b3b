"""Suffix, substring and Jaccard dedup against brute force, and the cases their docstrings define."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from webloom.llm import anchors, jaccard, linededup, substring, suffixdedup
from webloom.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0d]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string"


def near_copies(seed, n=60, words=("a", "b", "é", "Long", "x"), size=80, edits=6, join=" "):
    rng = random.Random(seed)
    base = [rng.choice(words) for _ in range(size)]
    rows = []
    for i in range(n):
        t = list(base)
        for _ in range(rng.randint(0, edits)):
            t[rng.randrange(size)] = rng.choice("pqr")
        rows.append((i, join.join(t)[rng.randint(0, 30):]))
    return rows + [(n, ""), (n + 1, None), (n + 2, " \n"), (n + 3, "x" * 400), (n + 4, "x y " * 60)]


def bytes_brute(rows, length):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        mark = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p:p + length] in seen:
                mark[p:p + length] = b"\1" * length
            seen.add(data[p:p + length])
        spans = sum(1 for p, m in enumerate(mark) if m and (p == 0 or not mark[p - 1]))
        out[i] = (len(data), spans, bytes(x for x, m in zip(data, mark) if not m))
    return out


def words_brute(rows, length):
    first = {}
    for i, text in sorted(rows):
        w = WORDS.findall(text or "")
        for p in range(len(w) - length + 1):
            first.setdefault(tuple(w[p:p + length]), i)
    out = {}
    for i, text in rows:
        w = WORDS.findall(text or "")
        mark = [0] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p:p + length])] < i:
                mark[p:p + length] = [1] * length
        out[i] = (len(w), sum(mark), " ".join(x for x, m in zip(w, mark) if not m))
    return out


def sets_brute(rows):
    sets = {}
    for i, text in rows:
        w = WORDS.findall((text or "").translate(LOW))
        sets[i] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 90 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("length,k,seed", [(10, 3, 1), (24, 6, 2)])
def test_suffix_dedup(spark, length, k, seed):
    rows = near_copies(seed)
    done = suffixdedup.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5), length, k)
    got = {r["doc_id"]: (r["n_bytes"], len(r["span_starts"]), bytes(r["kept"])) for r in done.collect()}
    assert got == bytes_brute(rows, length)
    for r in done.where("size(span_starts) > 0").limit(5).collect():
        assert r["n_bytes"] - sum(b - a for a, b in zip(r["span_starts"], r["span_ends"])) == len(r["kept"])


@pytest.mark.parametrize("length,k,cap", [(6, 2, 400), (6, 2, 3)])
def test_substring_dedup_shards_and_spread_windows_agree(spark, length, k, cap):
    rows = near_copies(3, join=" \n")
    done = substring.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5), length, k, cap)
    got = {r["doc_id"]: (r["n_words"], sum(b - a for a, b in zip(r["span_starts"], r["span_ends"])), r["kept"])
           for r in done.collect()}
    assert got == words_brute(rows, length)


def test_suffix_automaton_statistics():
    rng = random.Random(4)
    for _ in range(200):
        known = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 4))]
        automaton = substring.SuffixAutomaton()
        for s in known:
            automaton.add(s)
        probe = "".join(rng.choice("abc") for _ in range(12))
        want = [max(n for n in range(e + 2) if n == 0 or any(probe[e + 1 - n:e + 1] in s for s in known)) for e in range(12)]
        assert list(automaton.statistics(probe)) == want


def test_reference_form_checks_its_size(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "x c d e f y"), (3, None)], SCHEMA)
    reference = spark.createDataFrame([("q c d e f",), (None,)], "text string")
    got = {r["doc_id"]: r["kept"] for r in substring.remove_reference(docs, reference, 3).collect()}
    assert got == {1: "a b g", 2: "x y", 3: ""}
    with pytest.raises(ValueError, match="max_words"):
        substring.remove_reference(docs, reference, 3, max_words=2)


def test_task_reduction_keeps_the_answer(spark):
    """A phrase with a different neighbourhood in every document: many contents under one anchor in one task."""
    phrase = " ".join(f"w{i}" for i in range(8))
    rows = [(i, f"{i} {i}a {phrase} {i}b {i}c {i % 5} tail one two three four") for i in range(40)]
    done = substring.remove_repeats(spark.createDataFrame(rows, SCHEMA).coalesce(1), 6, 2)
    got = {r["doc_id"]: r["kept"] for r in done.collect()}
    assert got == {i: v[2] for i, v in words_brute(rows, 6).items()}
    done = suffixdedup.remove_repeats(spark.createDataFrame(rows, SCHEMA).coalesce(1), 12, 4)
    assert {r["doc_id"]: bytes(r["kept"]) for r in done.collect()} == {i: v[2] for i, v in bytes_brute(rows, 12).items()}


def test_blocks_cover_every_window_once():
    import numpy as np

    rng = np.random.default_rng(1)
    codes = rng.integers(0, 3, 500).astype(np.uint64)
    offsets = np.array([0, 7, 7, 90, 91, 300, 500])
    _, _, doc, lo, hi = anchors.blocks(codes, offsets, 12, 4)
    met = sorted((d, p) for d, a, b in zip(doc, lo, hi) for p in range(a, b + 1))
    assert met == [(d, p) for d, n in enumerate(np.diff(offsets)) for p in range(max(n - 11, 0))]


def test_jaccard_components(spark):
    rng = random.Random(5)
    bases = [[f"w{rng.randrange(300)}" for _ in range(100)] for _ in range(4)]
    rows = []
    for i in range(120):
        t = list(rng.choice(bases))
        for _ in range(rng.randint(0, 5)):
            t[rng.randrange(100)] = f"z{rng.randrange(50)}"
        rows.append((i, " ".join(t) if i % 13 else rng.choice(["", "a", "A b", "a B", None, " \n", "x Y z"])))
    done = jaccard.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert {r[0]: (r[1], r[2]) for r in done.collect()} == sets_brute(rows)


def test_jaccard_links_sets_of_different_sizes(spark):
    """Rare words appended or inserted push common n-grams out of the larger set's prefix."""
    rng = random.Random(7)
    rows = []
    for k in range(40):
        base = [f"b{k}x{i}" for i in range(rng.randint(40, 200))]
        more = list(base)
        for i in range(rng.randint(1, 12)):
            more.insert(len(more) if k % 2 else rng.randrange(len(more)), f"m{k}x{i}")
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(more))]
    rows += [(100, " ".join(f"w{i}" for i in range(102))), (101, " ".join(f"w{i}" for i in range(109)))]
    want = sets_brute(rows)
    assert want[101] == (107, 100) and sum(i != c for i, (_, c) in want.items()) > 15
    done = jaccard.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert {r[0]: (r[1], r[2]) for r in done.collect()} == want


def test_jaccard_links_long_sets(spark):
    """Sets on both sides of a step in the sketches' width, and long ones that share much but too little."""
    rng = random.Random(23)
    rows = []
    for size in (505, 1010, 2030):
        whole = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for extra in (0, 12, 25, 90, 400):
            rows.append(" ".join(whole + [f"z{rng.randrange(10**6)}" for _ in range(extra)]))
        rows.append(" ".join(whole[:size // 2] + [f"y{rng.randrange(10**6)}" for _ in range(size // 2)]))
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    done = jaccard.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in done.collect()} == sets_brute(rows)


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    sets = []
    for size in (0, 1, 40, 511, 512, 513, 1023, 1025, 4000):
        other = rng.integers(0, 1 << 63, size // 20, dtype=np.uint64)
        sets += [np.unique(base[:size]), np.unique(np.concatenate([base[:size], other]))]
    size = np.array([len(s) for s in sets])
    made = jaccard.sketches(np.repeat(np.arange(len(sets)), size), np.concatenate(sets), size).to_pylist()
    assert all(len(m) >= n / 4 and len(m) & (len(m) - 1) == 0 for m, n in zip(made, size))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert jaccard.unequal(made[i], made[j]) <= len(np.setxor1d(a, b))


class Workers:
    """In place of a table: gives what its Python workers would run."""

    def withColumn(self, *_):
        return self

    def mapInArrow(self, run, _):
        return run


@pytest.mark.parametrize("step", ["profile", "prefixes", "fragments"])
def test_jaccard_workers_take_little_memory(spark, step):
    """Two workers share an executor's memory with its JVM: one batch of many texts must not need much more than itself."""
    rng = random.Random(29)
    texts = [" ".join(str(rng.randrange(10**5)) for _ in range(500)) for _ in range(1500)]
    batch = pa.record_batch({"doc_id": pa.array(range(1500), pa.int64()), "text": pa.array(texts),
                             "slot": pa.array([0] * 1500, pa.int64())})

    class Counts:
        value = np.ones(jaccard.COUNTERS, np.int64)

    class Picked:
        value = np.full(jaccard.SLOTS // 64, (1 << 64) - 1, np.uint64)

    more = {"profile": (), "prefixes": (Counts,), "fragments": (Counts, Picked)}[step]
    run = getattr(jaccard, step)(Workers(), *more)
    jaccard.ta._CACHE.clear()
    tracemalloc.start()
    try:
        ids = [i for out in run(iter([batch])) for i in out.column(0).to_pylist() if i is not None]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sorted(set(ids)) == list(range(1500)) and batch.nbytes > 4 << 20
    assert peak < 60 << 20


def test_components(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(0, 30)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(30)] + [(5, 5)]
    root = {x: x for p in links for x in p}
    for _ in range(len(root)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: r for x, r in root.items() if x != r}


def test_line_runs_levels(spark):
    """Compaction keeps counts; the first holder of a line is not in the ledger."""
    runs = linededup.LineRuns(spark, fanout=2, buckets=2)
    for ids in ([9, 8], [7], [6, 5], [4]):
        batch = spark.createDataFrame([(i, bytes([k]), [0]) for i in ids for k in (1, i)], "doc_id long, key binary, at array<int>")
        runs.add(batch)
    assert {k: len(v) for k, v in runs.levels.items() if v} == {2: 1}
    assert [bytes(r["key"]) for r in runs.frequent(6).collect()] == [b"\1"]
    assert sorted(r["doc_id"] for r in runs.repeats().collect()) == [4, 5, 6, 7, 8]


LINE = "A line that is long enough to be compared with others."


def test_line_dedup_defined_cases(spark):
    rows = [(i, f"{LINE if i % 2 else ' ' + LINE.upper() + chr(9)}\nown {i}", "s", i) for i in range(6)]
    rows += [(None, LINE, "s", 0), (20, None, None, None), (21, "", "s", 1), (5, rows[5][1], "s", 5), (22, "É" * 60 + "\né" * 60, "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, at long")
    got = {(r["doc_id"], r["at"]): (r["text"], r["n_lines"], r["n_dropped"]) for r in linededup.drop_lines(docs).collect()}
    assert got[(5, 5)] == (rows[5][1], 2, 0)  # the largest doc_id keeps the line
    assert all(got[(i, i)] == (f"own {i}", 2, 1) for i in range(5))
    assert got[(None, 0)] == (LINE, 1, 0) and got[(20, None)] == ("", 1, 0) and got[(21, 1)] == ("", 1, 0)
    assert got[(22, 2)][2] == 0
    assert linededup.drop_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("remove", [
    lambda d: suffixdedup.remove_repeats(d, 10, 3), lambda d: substring.remove_repeats(d, 4, 2), jaccard.jaccard_components])
def test_ids_nulls_extra_columns_and_empty_tables(spark, remove):
    rows = [(1, "a b c d e f g h", "x", 1), (None, "a b c d e f g h", "x", 1), (2, "a b c d e f g h", "x", 1),
            (2, "a b c d e f g h", "y", 2), (2, None, "z", 3), (3, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n long")
    got = {r["doc_id"]: r for r in remove(docs).collect()}
    assert sorted(got) == [1, 2, 3]
    if "kept" in got[1]:
        assert len(got[1]["kept"]) > 0 and len(got[2]["kept"]) == 0 and len(got[3]["kept"]) == 0
    else:
        assert got[2]["component_id"] == 1 and got[3]["n_shingles"] == 0
    assert remove(docs.limit(0)).count() == 0


def test_digests_of_the_queries(spark, tmp_path):
    """The thin queries derive the contract's columns from the operators' outputs."""
    from webloom.llm.queries import QUERIES

    text = "x" * 150
    spark.createDataFrame([(1, text), (2, text + "y"), (3, None)], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op3_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert (got[1]["n_bytes"], got[1]["n_removed"], got[1]["n_spans"]) == (150, 149, 1)  # all but the first byte: earlier starts in the same document count
    assert (got[2]["n_bytes"], got[2]["n_removed"]) == (151, 150)
    assert got[2]["kept_sha256"] == hashlib.sha256(b"y").hexdigest()
    assert got[3]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
