"""Decontamination, WARC, SentencePiece, toxicity, licences, quality rules and the pipeline."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from webloom.llm import decontaminate, licenses, pieces, quality, toxicity, warc
from webloom.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, source string"


def prose(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(90)}" for _ in range(n)]


# decontamination

def leaks_brute(docs, items):
    def shingles(w):
        out = {}
        for k in range(len(w) - 4):
            g = tuple(w[k:k + 5])
            out[g] = out.get(g, 0) + sum(map(len, g))
        return out

    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    found = set()
    for i, t in docs:
        w = words(t)
        for j, q in items:
            v = words(q)
            b = shingles(v)
            for s in range(max(len(w) - len(v), 0) + 1):
                a = shingles(w[s:s + len(v)])
                small = sum(min(a.get(g, 0), b[g]) for g in b)
                if b and small and small >= 0.8 * (sum(a.values()) + sum(b.values()) - small):
                    found.add((i, j))
    return found


def test_decontamination_against_every_window(spark):
    rng = random.Random(1)
    items = [(j, " ".join(prose(rng, rng.randint(30, 60)))) for j in range(12)] + [(50, "too short"), (51, None)]
    docs = []
    for i in range(60):
        w = prose(rng, rng.randint(0, 120))
        if i % 3 == 0:
            q = items[rng.randrange(12)][1].split()
            if i % 6 == 0:
                q[rng.randrange(len(q))] = "changed"
            if i % 9 == 0:
                q.insert(len(q) // 2, "inserted")
            q = [x.upper() + "," for x in q] if i % 12 == 0 else q
            at = rng.randint(0, len(w))
            w = w[:at] + q + w[at:]
        docs.append((i, " ".join(w), "s"))
    docs += [(None, items[0][1], "s"), (100, None, "s"), (101, "", "s"), (102, items[3][1], "s"), (102, items[3][1], "s")]
    got = decontaminate.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    rows = got.collect()
    want = leaks_brute([d[:2] for d in docs if d[0] is not None], items)
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want and len(rows) == len(want) and len(want) >= 8
    exact = [r for r in rows if r["doc_id"] == 102 and r["item_id"] == 3]
    assert [(r["start_word"], r["similarity"]) for r in exact] == [(0, 1.0)]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(spark.createDataFrame(docs, DOCS), none).count() == 0


def test_hamming_blocks_reach_every_print_within_radius(spark):
    rng = random.Random(2)
    rows = []
    for k in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), decontaminate.RADIUS):
            b ^= 1 << bit
        rows.append((k, a - (1 << 63), b - (1 << 63)))
    pairs = spark.createDataFrame(rows, "k long, a long, b long")
    met = F.arrays_overlap(decontaminate.blocks("a", False), decontaminate.blocks("b", True))
    assert pairs.where(met).count() == 300


def test_changed_passages_are_found_whatever_their_prints(spark):
    """Passages near the threshold, some of whose prints are more than 15 bits from the item's."""
    rng = random.Random(3)
    items, docs = [], []
    for j in range(1200):
        w = [f"{rng.choice('abcdefgh')}{rng.randrange(10 ** 6)}" for _ in range(rng.choice((40, 50, 104)))]
        items.append((j, " ".join(w)))
        w[0] = "changed"
        for _ in range(len(w) // 50):
            w[rng.randrange(len(w))] = f"new{rng.randrange(100)}"
        docs.append((j, " ".join(w), "s"))
    want = {(j, j) for (j, t, _), (_, q) in zip(docs, items) if leaks_brute([(j, t)], [(j, q)])}
    schema = "item_id long, text string"
    rows = decontaminate.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, schema)).collect()
    assert len(want) > 600 and {(r["doc_id"], r["item_id"]) for r in rows} == want


# WARC

def test_warc_round_trip_over_small_ranges(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, f"http://h/{i} ü\n", "é" * rng.randint(0, 300) + str(i % 7) * rng.randint(0, 3)) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", "same"), (103, "u", "same"), (104, "u", "same"), (None, "u", "same")]
    rows += [(105, "u", "twice"), (105, "u", "once"), (106, "u", "".join(chr(rng.randrange(33, 500)) for _ in range(90_000)))]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, file string")
    manifest = warc.write(pages.repartition(2), str(tmp_path / "archives"))
    got = {r["page_id"]: r for r in warc.read(manifest, split_bytes=700).collect()}
    want = {r[0]: (r[2] or "").encode() for r in rows if r[0] is not None}
    want[105] = b"twice"
    keeper = {v: max(k for k in want if want[k] == v) for v in want.values()}
    assert sorted(got) == sorted(want)
    for k, v in want.items():
        r = got[k]
        assert r["payload_bytes"] == len(v) and r["intact"]
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(v).digest()).decode()
        assert (r["record_type"], r["refers_to"]) == (("response", None) if keeper[v] == k else ("revisit", keeper[v]))
        assert r["html"].encode() == (v if keeper[v] == k else b"")
    ranges = warc.read(manifest, split_bytes=700, payload=False)
    tasks = ranges.where("file = '" + manifest.first()["file"] + "'").select(F.spark_partition_id()).distinct().count()
    assert tasks > 1  # the ranges of one file are read by several tasks
    only = warc.read(warc.write(pages, str(tmp_path / "large"), min_bytes=5), payload=False)
    assert {r["record_type"] for r in only.where("page_id in (102, 103, 104)").collect()} == {"response"}
    assert warc.read(warc.write(pages.limit(0), str(tmp_path / "none"))).count() == 0


def test_member_is_found_only_at_a_record(tmp_path):
    import io

    fake = warc.member(b"not a record" * 10)
    real = warc.member(warc.record(7, "u", b"payload", None))
    data = b"\x1f\x8b\x08junk" + fake + real
    path = tmp_path / "f.warc.gz"
    path.write_bytes(data)
    assert [at for at, _ in warc.members(str(path), 0, len(data), len(data))] == [len(data) - len(real)]
    assert warc.inflate(io.BytesIO(data[:-20]), len(data) - len(real), len(data) - 20) is None


# SentencePiece

def test_pieces_equal_the_library(spark):
    table = pieces.ChunkTable(pieces.model_bytes(MODEL), max_chunks=500)
    rng = random.Random(4)
    parts = ["a", "b", " ", "  ", "▁", "\n", "é", "the", "ing", "\t", "\x00", "<s>", "<0x41>", "日本", "😀", "́", " "]
    for _ in range(300):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 15))) for _ in range(6)]
        flat, counts, decoded = table.encode(texts)
        want = [table.sp.encode(t) for t in texts]
        assert flat.tolist() == [i for x in want for i in x] and counts.tolist() == [len(x) for x in want]
        assert decoded == [table.sp.decode(x) for x in want]
    table.separable = False  # a vocabulary whose pieces cross markers: text by text, the same result
    assert table.encode(["a b", ""])[1].tolist() == [len(table.sp.encode("a b")), 0]
    rows = [(1, "one two", "s", 1), (1, "one two", "s", 1), (None, None, None, None), (3, "", "s", 2), (4, "x" * 50_000, "s", 3)]
    docs = spark.createDataFrame(rows, DOCS + ", ids long")
    got = pieces.encode(docs, pieces.model_bytes(MODEL)).collect()
    assert sorted(len(r["ids"]) for r in got)[:2] == [0, 0] and len(got) == 5
    assert all(r["decoded"] == (r["text"] or "") for r in got)
    assert pieces.encode(docs.limit(0), pieces.model_bytes(MODEL)).count() == 0


def test_piece_digests(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in QUERIES["op7_sentencepiece"](spark, SF_SMALL).collect():
        ids = sp.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert r["decoded_sha256"] == sha(sp.decode(ids))


# toxicity

def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train, held = labels.where("pmod(hash(doc_id), 2) = 0"), labels.where("pmod(hash(doc_id), 2) = 1")
    model = toxicity.fit(docs, train)
    rows = toxicity.score(docs, model).withColumnRenamed("toxic", "said").join(held, "doc_id").collect()
    right = np.mean([r["said"] == bool(r["toxic"]) for r in rows])
    caught = np.mean([r["said"] for r in rows if r["toxic"]])
    assert right > 0.95 and caught > 0.75, (right, caught)
    assert all(0 <= r["expected_severity"] <= 2 for r in rows)


def test_ordinal_regression_learns_ordered_grades():
    rng = np.random.default_rng(5)
    grade = rng.integers(0, 4, 1500)
    row = np.concatenate([np.repeat(np.arange(1500), grade * 2), np.arange(1500)])
    words = np.concatenate([rng.integers(1, 9, int(grade.sum()) * 2), rng.integers(100, 160, 1500)])
    pair = np.unique(row * 1000 + words)
    row, words = pair // 1000, (pair % 1000).astype(np.uint64)
    model = toxicity.fit_rows(grade, row, words)
    assert len(model.cuts) == 3 and (np.diff(model.cuts) > 0).all()
    at = np.searchsorted(model.words, words).clip(max=len(model.words) - 1)
    score = np.bincount(row, np.where(model.words[at] == words, model.weights[at], 0), 1500)
    expected = model.above(score).sum(axis=1)
    assert np.corrcoef(expected, grade)[0, 1] > 0.85
    assert [expected[grade == g].mean() for g in range(4)] == sorted(expected[grade == g].mean() for g in range(4))


def test_toxicity_without_labels_or_texts(spark):
    docs = spark.createDataFrame([(1, "a", "s"), (None, None, None), (1, "a", "s")], DOCS)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, empty)).collect()
    assert len(got) == 3 and not any(r["toxic"] for r in got)
    odd = spark.createDataFrame([(None, 1, 1), (1, 1, None), (1, 0, 0)], "doc_id long, quality int, toxic int")
    assert not any(r["toxic"] for r in toxicity.score(docs, toxicity.fit(docs, odd)).collect())
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, odd)).count() == 0


# licences

def test_licenses(spark):
    mit = next(t for n, t in licenses.TEMPLATES if n == "mit" and len(t) > 100)
    rows = [(1, "text of another kind before the notice\nLICENSED under the apache license version 2.0\nand behind it", "s"), (2, "some words before\n\n" + mit.replace(", ", ",\n") + "\n\nafter it", "s"),
            (3, "Licensed", "s"), (4, None, "s"), (5, "", "s"), (None, "All rights reserved.", "s"),
            (6, "All rights reserved.", "s"), (6, "All rights reserved.", "t"), (7, "nothing of the kind here " * 2000, "s")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], DOCS + ", dice double")
    got = {(r["doc_id"], r["license"]): (r["dice"], r["n_units"]) for r in licenses.licenses(docs).collect()}
    assert got == {(1, "apache-2.0"): (1.0, 1), (2, "mit"): (1.0, 2), (6, "proprietary"): (1.0, 1)}  # paragraph and whole text
    assert licenses.licenses(docs.limit(0)).count() == 0


# quality rules

def test_quality_rules_defined_cases(spark):
    rng = random.Random(8)
    line = "this footer line comes with every page of the host and says nothing"
    rows = [(i, " ".join(prose(rng, 60)) + "\n" + line, "h") for i in range(8)]
    rows += [(20 + i, "\n".join([line] * 8 + [" ".join(prose(rng, 10))]), "h") for i in range(3)]
    rows += [(30, None, "h"), (31, "", None), (None, " ".join(prose(rng, 70)), "h"), (32, "a b c " * 30, "h"),
             (33, " \t\nx # y\n x # y\nx # y z", "h"), (34, " ".join(prose(rng, 60)), None), (34, " ".join(prose(rng, 60)), None)]
    docs = spark.createDataFrame([(*r, True) for r in rows], DOCS + ", kept boolean")
    got = {}
    for r in quality.quality_rules(docs, max_docs=5).collect():
        got.setdefault(r["doc_id"], r)
    assert all(got[i]["kept"] for i in range(8)) and got[None]["kept"] and got[34]["kept"]
    assert not any(got[20 + i]["kept"] for i in range(3))
    assert got[30]["n_words"] == 0 and got[31]["base_failed"] and not got[32]["kept"]
    assert got[32]["n_repeat_words"] == 90 and got[33]["n_dup_lines"] == 0 and got[33]["n_symbols"] == 3
    assert quality.quality_rules(docs.limit(0)).count() == 0


def test_first_holder_keeps_the_boilerplate(spark):
    text = "\n".join(f"boilerplate line number {k} with a few more words in it so that it is long" for k in range(6))
    docs = spark.createDataFrame([(i, text, "h") for i in range(10)], DOCS)
    lost = {r["doc_id"] for r in quality.depleted(docs, max_docs=5).collect()}
    assert lost == set(range(1, 10))


def test_boilerplate_lines_leave_the_texts(spark, tmp_path):
    rng = random.Random(10)
    body = {i: " ".join(prose(rng, 60)) for i in range(130)}
    rows = [(i, f"  HOME | Menu\n{body[i]}\n\nown line {i}\nhome | menu\n", "h") for i in range(120)]
    rows += [(i, f"{body[i]}\nhome | menu", "other" if i % 2 else None) for i in range(120, 129)]
    rows += [(129, "home | menu\n" * 99, "h"), (None, f"{body[129]}\nhome | menu", "h"), (200, None, "h")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], DOCS + ", n_chars long")
    want = {i: t for i, t, _ in rows if i not in (129, 200)}
    want |= {i: f"{body[i]}\n\nown line {i}\n" for i in range(1, 120)}
    got = {r["doc_id"]: r["text"] for r in quality.clean_texts(docs, str(tmp_path / "verdicts")).collect()}
    assert got == want
    staged = corpus_pipeline.quality_rules(spark, docs, "").collect()
    assert {r["doc_id"]: r["text"] for r in staged} == want and all(r["n_chars"] == len(r["text"]) for r in staged)


def test_triples_of_a_long_text_are_told_apart(spark):
    """Triples whose xxhash64 values agree in their upper 47 bits, in a text whose positions take 17 bits."""
    pairs = [(5660448, 22427805), (3517263, 15057237), (17206723, 30913130), (11561070, 24801857)]
    words = [w for j, k in pairs for w in ("a", "b", str(j), f"x{j}", "a", "b", str(k), f"x{k}")]
    words += [f"w{i}" for i in range(70_000)]
    docs = spark.createDataFrame([(1, " ".join(words), "h"), (2, " ".join([*words, "w5", "w6", "w7"]), "h")], DOCS)
    got = {r["doc_id"]: (r["n_words"], r["n_repeat_words"]) for r in quality.base_columns(docs).collect()}
    assert got == {1: (70_032, 0), 2: (70_035, 6)}


# pipeline

def test_pipeline_against_brute_force(spark, tmp_path):
    from test_dedup import sets_brute

    rng = random.Random(9)
    items = [(j, " ".join(prose(rng, 30))) for j in range(3)]
    shared = "this line is shared by many documents and long enough to count"
    rows = []
    for i in range(40):
        w = prose(rng, 80)
        if i % 7 == 0:
            w[20:20] = items[i % 3][1].split()
        rows.append((i, " ".join(w) + "\n" + (shared if i % 2 else f"its own last line {i}"), "en", f"s{i % 3}", 0))
    rows += [(50, rows[3][1] + " tail", "en", "s1", 0), (51, rows[3][1], "en", "s1", 0), (52, "short", "en", "s1", 0),
             (53, None, None, None, None), (54, "x y z " * 40, "en", "s1", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = {i: t for i, t, *_ in rows if t and len(t.split()) >= 50 and not t.startswith("x y z")}
    holders = [i for i, t in left.items() if shared in t.split("\n")]
    left = {i: t if i == max(holders) else "\n".join(x for x in t.split("\n") if x != shared) for i, t in left.items()}
    groups = sets_brute(list(left.items()))
    left = {i: t for i, t in left.items() if groups[i][1] == i}
    left = {i: t for i, t in left.items() if not any(q in t for _, q in items)}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {i: r["text"] for i, r in got.items()} == left
    table = pieces.ChunkTable(pieces.model_bytes(MODEL))
    assert all(r["ids"] == table.sp.encode(r["text"]) and r["decoded"] == r["text"] for r in got.values())
    assert all(r["n_chars"] == len(r["text"]) and r["n_tokens"] == len(r["ids"]) for r in got.values())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "ngram_jaccard", "benchmark_decontamination", "sentencepiece"]


def test_pipeline_on_an_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
