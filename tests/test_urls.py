"""URL scalars: save-path rules, extension test, resolution, quoting, versioning."""

from pyspark.sql import functions as F

from webloom.functions import urls as U
from webloom.operators.naming import version_names


def _one(spark, col, url):
    return spark.createDataFrame([(url,)], "url string").select(col.alias("x")).first()["x"]


def TS():
    return F.lit("2024-05-06 07:08:09").cast("timestamp")


def test_html_save_path_cases(spark):
    cases = {
        "http://a.com": "html.html2024-05-06_07-08-09",
        "http://a.com/": "html.html2024-05-06_07-08-09",
        "http://a.com/a/b/": "ab.html2024-05-06_07-08-09",
        "http://a.com/a.HTM": "a.HTM2024-05-06_07-08-09",
        "http://a.com/a b": "ab.html2024-05-06_07-08-09".replace("ab", "a%20b"),
        "http://a.com/ü": "%C3%BC.html2024-05-06_07-08-09",
    }
    for url, want in cases.items():
        assert _one(spark, U.html_inner_name(F.col("url"), TS()), url) == want, url
    assert _one(spark, U.html_save_path("out", F.col("url"), TS()), "http://a.com:8080/x") == \
        "out/a.com_8080/x.html2024-05-06_07-08-09"


def test_file_save_path_keeps_slashes(spark):
    assert _one(spark, U.file_save_path("f", F.col("url"), "pdf"), "http://a.com/d/r.PDF?x=1") == "f/a.com/d/r.PDF"
    assert _one(spark, U.file_save_path("f", F.col("url"), "pdf"), "http://a.com/d/") == "f/a.com/d.pdf"
    assert _one(spark, U.file_save_path("f", F.col("url"), "pdf"), "http://a.com") == "f/a.com/html.html.pdf"


def test_extension_is_on_path_only(spark):
    assert _one(spark, U.has_extension(F.col("url"), "pdf"), "http://a.com/x.PDF?x=1") is True
    assert _one(spark, U.has_extension(F.col("url"), "pdf"), "http://a.com/a.pdf/") is False
    assert _one(spark, U.has_extension(F.col("url"), "pdf"), "http://a.com/a.pdf#p") is True
    assert _one(spark, U.has_extension(F.col("url"), "pdf"), "http://a.com/q?f=a.pdf") is False


def test_quote_matches_python(spark):
    from urllib.parse import quote
    s = "a b/c~d*e+f/ü(x)"
    assert _one(spark, U.quote_path(F.col("url")), s) == quote(s)


def test_resolve(spark):
    base = "http://h.com/a/b/c.html?q=1#f"
    cases = {"/x": "http://h.com/x", "y": "http://h.com/a/b/y", "../z": "http://h.com/a/z",
             "//o.org/p": "http://o.org/p", "?k=2": "http://h.com/a/b/c.html?k=2",
             "#g": "http://h.com/a/b/c.html?q=1#g", "https://e.com/": "https://e.com/", "./w": "http://h.com/a/b/w"}
    df = spark.createDataFrame([(base, h) for h in cases], "b string, h string")
    got = {r["h"]: r["u"] for r in df.select("h", U.resolve(F.col("b"), F.col("h")).alias("u")).collect()}
    assert got == cases


def test_fragment_three_way(spark):
    df = spark.createDataFrame([("http://a.com/faq/1",)], "url string")
    f = lambda arr: df.select(U.fragment_allowed(F.col("url"), arr).alias("k")).first()["k"]
    assert f(F.lit(None).cast("array<string>")) is True
    assert f(F.array().cast("array<string>")) is False
    assert f(F.array(F.lit("/shop/"))) is False
    assert f(F.array(F.lit("/shop/"), F.lit("/faq/"))) is True


def versions_brute(names):
    """Further rows in the order of (where they may start, row) take the next number of their base that is free."""
    import re
    part = re.compile(r"^(.+)-([0-9]+)([.]\w+)?$")
    split = lambda n: (m[1], int(m[2]), m[3] or "") if (m := part.match(n)) else (n, None, "")
    out, seen, further, taken = {}, set(), [], {}
    for i, n in names:
        base, ver, ext = split(n)
        if ver is not None:
            taken.setdefault((base, ext), set()).add(ver)
        if n in seen:
            further.append((2 if ver is None else ver + 1, i, n))
        else:
            seen.add(n)
            out[i] = n
    for at, i, n in sorted(further):
        base, ver, ext = split(n)
        used = taken.setdefault((base, ext), set())
        while at in used:
            at += 1
        used.add(at)
        out[i] = f"{n}-{at}" if ver is None else f"{base}-{at}{ext}"
    return out


def test_versioned_names(spark):
    rows = list(enumerate(["x", "x", "x", "x-2", "x-2", "x-9.html", "x-9.html", "y", "y", "y-2", "y-2", "y-3", "x-2-2", "x-2-2"], 1))
    got = {r["id"]: r["v"] for r in version_names(spark.createDataFrame(rows, "id long, name string"), "name", ["id"], out="v").collect()}
    # a name that a row brings along stays its own; further rows take the numbers that are free
    assert got == {1: "x", 2: "x-3", 3: "x-4", 4: "x-2", 5: "x-5", 6: "x-9.html", 7: "x-10.html",
                   8: "y", 9: "y-4", 10: "y-2", 11: "y-5", 12: "y-3", 13: "x-2-2", 14: "x-2-3"}
    assert got == versions_brute(rows)


def test_versioned_names_equal_brute_force_and_split_a_hot_base(spark):
    import random
    rng = random.Random(6)
    names = ["n"] * 150 + [rng.choice(["n", "n-2", "n-3", "n-7", "n-05", "m.html", "m-1.html", "m-2.html", "k-1"]) for _ in range(250)]
    rng.shuffle(names)
    rows = list(enumerate(names))
    df = spark.createDataFrame(rows, "id long, name string").repartition(7)
    got = {r["id"]: r["v"] for r in version_names(df, "name", ["id"], out="v").collect()}
    assert got == versions_brute(rows) and len(set(got.values())) == len(rows)
    grouped = spark.createDataFrame([(i, f"g{i % 3}", n) for i, n in rows], "id long, g string, name string")
    got = {r["id"]: r["v"] for r in version_names(grouped, "name", ["id"], ["g"], "v").collect()}
    for k in range(3):
        assert {i: v for i, v in got.items() if i % 3 == k} == versions_brute([(i, n) for i, n in rows if i % 3 == k])


def test_versioned_names_of_nothing(spark):
    assert version_names(spark.createDataFrame([], "id long, name string"), "name", ["id"]).collect() == []


def test_url_find_long_match(spark):
    long_url = "http://a.com/" + "x" * 20000
    got = _one(spark, U.find_urls(F.col("url")), "see " + long_url + "#frag")
    assert got == [long_url]


def test_run_folder(spark):
    df = spark.createDataFrame([(["fund.example.com", "x.org"],)], "d array<string>")
    ts = F.lit("2024-05-06 07:08:09").cast("timestamp")
    r = df.select(U.run_folder("out/", F.col("d")[0], ts).alias("a"),
                  U.run_folder("out", F.col("d")[0], ts, dashes=True).alias("b")).first()
    assert r["a"] == "out/fund.example.com20240506_0708"
    assert r["b"] == "out/fund-example-com20240506_0708"


def test_numeric_character_references(spark):
    from webloom.functions.text import decode_entities
    got = _one(spark, decode_entities(F.col("url")), "a&#65;&#x42;&#x1F600;&#0;&#xD800;&amp;#66;&#233;&copy;")
    assert got == "aAB\U0001F600&#0;&#xD800;&#66;é©"


def test_safe_url_keeps_reserved_and_escapes(spark):
    got = _one(spark, U.safe_url(F.col("url")), "http://h.com/für x?a=1&b=%41#f~*")
    assert got == "http://h.com/f%C3%BCr%20x?a=1&b=%41#f~*"


def test_clean_markup_single_pass(spark):
    from webloom.functions.text import page_text
    html = ('<html><body><script>var a="<!--";</script><p>kept</p><!-- <script>x</script> -->'
            '<p>also</p><style>p{}</style></body></html>')
    assert _one(spark, page_text(F.col("url")), html) == "keptalso"


def test_resolve_against_urljoin(spark):
    from urllib.parse import urljoin
    base = "http://h.com/a/b/c/d/e/f.html?q=1#top"
    refs = ["../../../../../x", "../../../../../../../x", "/q?r=/a/../b", "/q?u=http://x/./y", "./././z", "a/b/../../c/./d",
            "..", "../", ".", "./", "a/..", "a/../", "/a/b/..", "?x=../y", "g#s/../x", "//e.com/a/../b", "https://e.com/a/b/../../../c",
            "a/.hidden/x", "...", "a...b/../c", "g;x=1/../y"]
    df = spark.createDataFrame([(base, r) for r in refs], "b string, h string")
    got = {r["h"]: r["u"] for r in df.select("h", U.resolve(F.col("b"), F.col("h")).alias("u")).collect()}
    assert got == {r: urljoin(base, r) for r in refs}


def test_references_against_unescape(spark):
    from html import unescape
    from webloom.functions.text import decode_entities
    texts = ["&#38;lt;b", "&amp;lt;", "&#00000065;&#x000041;", "&eacute;&Eacute;&hellip;&nbsp;&notin;x", "a & b &unknown; &", "&#x1F600;&#128512;",
             "&amp;amp;#65;", "&lt;&gt;&quot;&apos;&#39;", "no reference", "&#x;&#;&;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["u"] for r in df.select("t", decode_entities("t").alias("u")).collect()}
    assert got == {t: unescape(t) for t in texts}


def test_page_text_keeps_comparisons_and_drops_open_scripts(spark):
    from webloom.functions.text import page_text
    assert _one(spark, page_text(F.col("url")), "<p>3 < 5 and 6 > 2</p>") == "3 < 5 and 6 > 2"
    assert _one(spark, page_text(F.col("url")), "<p>a</p><script>var b = 1;") == "a"


def test_extract_links_of_real_markup(spark):
    from webloom.operators.links import extract_links
    html = ("<html><head><base href='/dir/'></head><!-- <a href='/no1'> --><script>'<a href=\"/no2\">'</script>"
            "<a href='x?a=1&amp;b=2'>1</a><a href=mailto:a@b.c>2</a><a href='javascript:void(0)'>3</a><a href='y.ZIP'>4</a>"
            "<a href='/p/../q.html#f'>5</a><area href='ftp://f.org/z'><a href='x?a=1&#38;b=2'>again</a></html>")
    pages = spark.createDataFrame([(1, "http://h.com/a/b.html", html)], "page_id long, url string, html string")
    got = [r["url"] for r in extract_links(pages).orderBy("idx").collect()]
    assert got == ["http://h.com/dir/x?a=1&b=2", "http://h.com/q.html#f", "ftp://f.org/z"]
    assert "http://h.com/dir/y.ZIP" in [r["url"] for r in extract_links(pages, denied=[]).collect()]


def test_seen_log_appends_only_new_urls(spark, tmp_path):
    from webloom.sources.pages import append_seen_log, read_seen_log
    path = str(tmp_path / "seen")
    for urls in (["a", "b", "a"], ["b", "c"], []):
        append_seen_log(spark.createDataFrame([(u,) for u in urls], "url string"), path)
    assert sorted(r["url"] for r in read_seen_log(spark, path).collect()) == ["a", "b", "c"]
