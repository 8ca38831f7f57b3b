"""Documents that bring columns under the names that operators use, names with dots, and one very long text."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from webloom.llm import linededup, pieces, quality
from webloom.llm.queries import tokenizer_path

CLASHES = ["n_lines", "n_dropped", "_gone", "_keys", "_lines", "_kept", "__gone", "__lines", "gone", "kept", "key", "at", "ids", "decoded",
           "component_id", "n_shingles", "host", "n_tokens", "_gone_id", "_gone_of", "_rejected", "a.b", "c`d"]
LINE = "a line that many documents share, word for word, of some length"


@pytest.fixture(scope="module")
def plain(spark):
    words = lambda i: " ".join(f"w{i}x{k}" for k in range(80))
    rows = [(i, f"{LINE}\n{words(i)}", "en", "host", 9) for i in range(8)] + [(8, f"{LINE}\n{words(7)}", "en", "host", 9), (9, None, "en", None, 9), (None, words(9), "en", "h", 9)]
    rows += [(10, "\n".join(words(k) for k in range(100, 2000)), "en", "other", 9)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def clashing(df):
    return df.select(*df.columns, *[F.lit(f"own {c}").alias(c) for c in CLASHES])


def own_kept(df, but=()):
    """Every row still has the values it came with."""
    quoted = [f"`{c.replace('`', '``')}`" for c in CLASHES if c not in but]
    bad = df.where(" or ".join(f"{q} != 'own {c}'" for q, c in zip(quoted, [c for c in CLASHES if c not in but])))
    return bad.count() == 0


def rows(df, columns=("doc_id", "text")):
    return sorted(map(str, df.select(*columns).collect()))


def test_line_dedup(spark, plain):
    got = linededup.drop_lines(clashing(plain))
    assert rows(got, ("doc_id", "text", "n_lines", "n_dropped")) == rows(linededup.drop_lines(plain), ("doc_id", "text", "n_lines", "n_dropped"))
    assert got.columns.count("n_lines") == 1 and own_kept(got, ("n_lines", "n_dropped"))


def test_clean_texts(spark, plain, tmp_path):
    got = quality.clean_texts(clashing(plain), str(tmp_path / "a"), max_docs=3)
    assert rows(got) == rows(quality.clean_texts(plain, str(tmp_path / "b"), max_docs=3)) and own_kept(got)
    assert got.columns == clashing(plain).columns


def test_sentencepiece(spark, plain):
    model = pieces.model_bytes(tokenizer_path())
    got = pieces.encode(clashing(plain), model)
    assert rows(got, ("doc_id", "ids", "decoded")) == rows(pieces.encode(plain, model), ("doc_id", "ids", "decoded"))
    assert own_kept(got, ("ids", "decoded"))


@pytest.mark.parametrize("stage,gone", [("line_dedup", set()), ("ngram_jaccard", {8}), ("benchmark_decontamination", {3})])
def test_pipeline_stages(spark, plain, tmp_path, stage, gone):
    spark.createDataFrame([(1, " ".join(f"w3x{k}" for k in range(30)))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = clashing(plain)
    got = dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
    assert got.columns == docs.columns and own_kept(got)
    ids = [r["doc_id"] for r in got.collect()]
    assert len(ids) == 12 - len(gone) and set(range(11)) - set(ids) == gone
