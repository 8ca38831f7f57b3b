"""Independent DuckDB SQL for each registered query (the correctness oracle).

Written directly in DuckDB's dialect over the pre-registered views; shares no
code with the Spark side except fixed values (patterns, constants).
"""

from __future__ import annotations

from html.entities import html5

from webloom.functions.urls import URL_FIND_PATTERN
from webloom.sources.pages import HTML_MARKUP
from webloom.functions import text as _T
from webloom.operators import dom as _D
from webloom.functions.urls import VERSIONED_NAME_PATTERN as _VP

SCHEME = "[A-Za-z][A-Za-z0-9+.-]*"
RUN_TS = "2024-01-02 03:04:05"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def authority(u: str) -> str:
    return f"regexp_extract({u}, {q('^' + SCHEME + '://([^/?#]*)')}, 1)"


def path(u: str) -> str:
    return f"regexp_extract({u}, {q('^(?:' + SCHEME + ':)?(?://[^/?#]*)?([^?#]*)')}, 1)"


def query(u: str) -> str:
    return f"regexp_extract({u}, {q('^[^?#]*[?]([^#]*)')}, 1)"


def host(u: str) -> str:
    return f"lower(regexp_replace(regexp_replace({authority(u)}, '^.*@', ''), ':[0-9]*$', ''))"


def safe_url(s: str) -> str:
    from webloom.functions.urls import URL_SAFE_CHARS
    e = f"url_encode({s})"
    for ch in URL_SAFE_CHARS:
        e = f"replace({e}, {q('%%%02X' % ord(ch))}, {q(ch)})"
    return f"replace({e}, '%25', '%')"


def quote(s: str) -> str:
    return f"replace(url_encode({s}), '%2F', '/')"


def resolve(b: str, h0: str) -> str:
    h = f"trim({h0})"
    no_frag = f"regexp_replace({b}, '#.*$', '')"
    no_query = f"regexp_replace({no_frag}, '[?].*$', '')"
    bdir0 = f"regexp_extract({no_query}, {q('^(' + SCHEME + '://[^/?#]*(?:/[^?#]*/)?)')}, 1)"
    bdir = f"(CASE WHEN ends_with({bdir0}, '/') THEN {bdir0} ELSE {bdir0} || '/' END)"
    joined = f"""(CASE WHEN regexp_matches({h}, {q('^' + SCHEME + ':')}) THEN {h}
        WHEN starts_with({h}, '//') THEN lower(regexp_extract({b}, {q('^(' + SCHEME + '):')}, 1)) || ':' || {h}
        WHEN starts_with({h}, '/') THEN regexp_extract({b}, {q('^(' + SCHEME + '://[^/?#]*)')}, 1) || {h}
        WHEN starts_with({h}, '?') THEN {no_query} || {h}
        WHEN starts_with({h}, '#') THEN {no_frag} || {h}
        WHEN {h} = '' THEN {no_frag}
        ELSE {bdir} || {h} END)"""
    # the path is folded as a string: ".." cuts the last "/segment" off; a final dot segment leaves a "/"
    head = f"regexp_extract(_j, {q('^(' + SCHEME + '://[^/?#]*)')}, 1)"
    path_ = f"regexp_extract(_j, {q('^' + SCHEME + '://[^/?#]*([^?#]*)')}, 1)"
    tail = "regexp_extract(_j, '^[^?#]*([?#].*)$', 1)"
    folded = (f"list_reduce(string_split(_p, '/'), lambda acc, x: CASE WHEN x = '..' THEN regexp_replace(acc, '/[^/]*$', '') "
              f"WHEN x = '.' THEN acc ELSE acc || '/' || x END)")
    clean_path = (f"(CASE WHEN starts_with(_p, '/') AND contains(_p, '/.') THEN (SELECT CASE WHEN regexp_matches(_p, '/[.][.]?$') "
                  f"OR _f = '' THEN _f || '/' ELSE _f END FROM (SELECT {folded} AS _f)) ELSE _p END)")
    whole = f"regexp_matches({h}, {q('^(' + SCHEME + ':|//)')})"
    return (f"(SELECT CASE WHEN _h = '' OR {whole} THEN _j ELSE _h || {clean_path} || _t END "
            f"FROM (SELECT _j, {head} AS _h, {path_} AS _p, {tail} AS _t FROM (SELECT {joined} AS _j)))")


HTML_PAGES = f"SELECT * FROM pages WHERE url IS NOT NULL AND html IS NOT NULL AND regexp_matches(html, {q(HTML_MARKUP)})"

_QUOTED = """(?:"[^"]*"|'[^']*'|[^\\s"'>]+)"""
_DENIED = ("7z 7zip bz2 rar tar tar.gz xz zip mng pct bmp gif jpg jpeg png pst psp tif tiff ai drw dxf eps ps svg cdr ico webp "
           "mp3 wma ogg wav ra aac mid au aiff 3gp asf asx avi mov mp4 mpg qt rm swf wmv m4a m4v flv webm "
           "xls xlsm xlsx xltm xltx potm potx ppt pptm pptx pps doc docb docm docx dotm dotx odt ods odg odp "
           "css pdf exe bin rss dmg iso apk jar sh rb js hta bat cpl msi msp py")
_NOT_TEXT = "(?is)<!--.*?-->|<script\\b[^>]*>.*?(?:</script\\s*>|\\z)|<style\\b[^>]*>.*?(?:</style\\s*>|\\z)"
_NAMES = "MAP {" + ", ".join(f"{q(k[:-1])}: {q(v)}" for k, v in html5.items() if k.endswith(";")) + "}"


def decode(s: str) -> str:
    """Each reference replaced once: the text cut at the references, the pieces and the characters joined again."""
    ref = q("&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);")
    digits = "ltrim(regexp_extract(e, '^&#[xX]?([0-9A-Fa-f]+);$', 1), '0')"
    code = (f"(CASE WHEN regexp_matches(e, '^&#[xX]') AND length({digits}) BETWEEN 1 AND 6 THEN ('0x' || {digits})::BIGINT "
            f"WHEN regexp_matches(e, '^&#[0-9]') AND length({digits}) BETWEEN 1 AND 7 THEN {digits}::BIGINT END)")
    one = (f"(CASE WHEN {code} BETWEEN 1 AND 1114111 AND NOT ({code} BETWEEN 55296 AND 57343) THEN chr({code}::INTEGER) "
           f"WHEN starts_with(e, '&#') THEN e ELSE coalesce({_NAMES}[e[2:-2]], e) END)")
    return (f"(CASE WHEN contains({s}, '&') THEN list_reduce(list_concat([''], list_transform(list_zip("
            f"string_split_regex({s}, {ref}), list_concat(list_transform(regexp_extract_all({s}, {ref}, 0), lambda e: {one}), [''])), "
            f"lambda x: x[1] || x[2])), lambda a, b: a || b) ELSE {s} END)")


def _value(m: str) -> str:
    """The attribute value at the end of a matched start tag, without its quotes."""
    v = f"regexp_extract({m}, {q('(?i)[[:space:]]href[[:space:]]*=[[:space:]]*(' + _QUOTED + ')$')}, 1)"
    return f"(CASE WHEN {v} <> '' AND {v}[1] IN (chr(34), chr(39)) THEN {v}[2:-2] ELSE {v} END)"


def _start_tag(names: str) -> str:
    return q("(?i)<(?:" + names + ")\\b[^>]*?\\shref\\s*=\\s*" + _QUOTED)


def links_sql(pages: str) -> str:
    return f"""
WITH hp AS (SELECT page_id, url, regexp_replace(html, {q(_NOT_TEXT)}, '', 'g') AS m FROM ({pages})),
based AS (SELECT page_id, url, m, {_value(f"regexp_extract(m, {_start_tag('base')}, 0)")} AS b FROM hp),
raw AS (
  SELECT page_id, url AS src_url, b, {_value('unnest(h)')} AS href, generate_subscripts(h, 1) - 1 AS pos
  FROM (SELECT page_id, url, b, regexp_extract_all(m, {_start_tag('a|area')}, 0) AS h FROM based)
),
decoded AS (SELECT page_id, src_url, pos, href, {decode('b')} AS bd, {decode('href')} AS d FROM raw),
plain AS (SELECT page_id, src_url, pos, href, d, CASE WHEN bd = '' THEN src_url ELSE {resolve('src_url', 'bd')} END AS b FROM decoded),
every AS (SELECT page_id, src_url, pos, href, {safe_url(resolve('b', 'd'))} AS url FROM plain),
res AS (SELECT * FROM every WHERE regexp_matches(url, '(?i)^(http|https|ftp|file):')
        AND NOT regexp_matches({path('url')}, '(?i)[.]({_DENIED.replace(".", "[.]").replace(" ", "|")})$')),
firsts AS (SELECT page_id, src_url, url, min(pos) AS pos, arg_min(href, pos) AS href FROM res GROUP BY ALL)
SELECT page_id, src_url, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS BIGINT) AS idx,
       href, url FROM firsts
"""


LINKS = links_sql(HTML_PAGES)

CORPUS_SITES_SQL = """
SELECT * FROM (VALUES
  ('news_com', ['example.com'], NULL::VARCHAR[]),
  ('news_net', ['example.net'], ['/en/', '/de/', 'utm_source']),
  ('blogs_org', ['example.org'], []::VARCHAR[]),
  ('spam', ['spam-farm.example.org', 'cheap-pills.example.com'], ['.html', '#top'])
) AS t(site, allowed_domains, fragments)
"""

BOUND_PAGES = f"""
SELECT DISTINCT p.page_id, p.url, s.site FROM pages p JOIN ({CORPUS_SITES_SQL}) s
  ON list_bool_or(list_transform(s.allowed_domains,
       lambda d: {host('p.url')} = lower(d) OR ends_with({host('p.url')}, '.' || lower(d))))
"""

SQL: dict[str, str] = {}

SQL["html_pages"] = f"SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM ({HTML_PAGES})"

SQL["link_extract"] = LINKS

SQL["url_scan"] = f"SELECT DISTINCT url FROM ({LINKS}) ORDER BY url"

SQL["url_parts"] = f"""
SELECT page_id, url, {authority('url')} AS authority, {host('url')} AS host, {path('url')} AS path,
  {query('url')} AS query, replace({authority('url')}, ':', '_') AS domain_dir,
  replace({host('url')}, '.', '-') AS run_domain,
  translate(url, ':/', '') || '.html' AS snapshot_key, {quote(path('url'))} AS quoted_path
FROM pages
"""


def _html_inner(u: str) -> str:
    p = path(u)
    p1 = f"(CASE WHEN starts_with({p}, '/') THEN replace(substr({p}, 2), '/', '') ELSE {p} END)"
    p2 = f"(CASE WHEN {p1} = '' THEN 'html.html' ELSE {p1} END)"
    p3 = f"regexp_replace({p2}, '/$', '')"
    p4 = f"(CASE WHEN ends_with(lower({p3}), '.html') OR ends_with(lower({p3}), '.htm') THEN {p3} ELSE {p3} || '.html' END)"
    return quote(f"{p4} || strftime(TIMESTAMP '{RUN_TS}', '%Y-%m-%d_%H-%M-%S')")


def _file_inner(u: str, ext: str) -> str:
    p = path(u)
    p1 = f"(CASE WHEN starts_with({p}, '/') THEN substr({p}, 2) ELSE {p} END)"
    p2 = f"(CASE WHEN {p1} = '' THEN 'html.html' ELSE {p1} END)"
    p3 = f"regexp_replace({p2}, '/$', '')"
    p4 = f"(CASE WHEN ends_with(lower({p3}), '.{ext}') THEN {p3} ELSE {p3} || '.{ext}' END)"
    return quote(p4)


def _versioned(name: str, k: str) -> str:
    return (f"CASE WHEN {k} = 1 THEN {name} WHEN regexp_matches({name}, {q(_VP)}) THEN "
            f"regexp_extract({name}, {q(_VP)}, 1) || '-' || CAST(CAST(regexp_extract({name}, {q(_VP)}, 2) AS BIGINT) + {k} - 1 AS VARCHAR)"
            f" || regexp_extract({name}, {q(_VP)}, 3) ELSE {name} || '-' || CAST({k} AS VARCHAR) END")


def _save_names(pages: str) -> str:
    """(page_id, url, domain_dir, save_name): the k-th page of a folder with a name gets version k."""
    return f"""(SELECT page_id, url, domain_dir, {_versioned('_n', '_k')} AS save_name FROM (
  SELECT *, row_number() OVER (PARTITION BY domain_dir, _n ORDER BY page_id) AS _k FROM (
    SELECT page_id, url, replace({authority('url')}, ':', '_') AS domain_dir, {_html_inner('url')} AS _n FROM ({pages}))))"""


SQL["save_path_html"] = f"""
SELECT page_id, 'out/html/' || domain_dir || '/' || save_name AS save_path FROM {_save_names("SELECT * FROM pages")}"""

SQL["save_path_file"] = f"""
WITH u AS (SELECT url FROM ({LINKS}) UNION SELECT url FROM pages)
SELECT url, 'out/files/' || replace({authority('url')}, ':', '_') || '/' || {_file_inner('url', 'pdf')} AS save_path,
  ends_with(lower({path('url')}), '.pdf') AS is_pdf
FROM u
"""

SQL["url_find"] = f"""
SELECT page_id, 'url' AS src, CAST(generate_subscripts(m, 1) - 1 AS BIGINT) AS idx, unnest(m) AS match
FROM (SELECT page_id, regexp_extract_all(url, {q(URL_FIND_PATTERN)}, 0) AS m FROM pages)
UNION ALL
SELECT page_id, 'html' AS src, CAST(generate_subscripts(m, 1) - 1 AS BIGINT) AS idx, unnest(m) AS match
FROM (SELECT page_id, regexp_extract_all(html, {q(URL_FIND_PATTERN)}, 0) AS m FROM pages)
"""

SQL["domain_filter"] = f"SELECT page_id, site FROM ({BOUND_PAGES})"

SQL["fragment_semi"] = f"""
SELECT b.page_id, b.site FROM ({BOUND_PAGES}) b JOIN ({CORPUS_SITES_SQL}) s USING (site)
WHERE s.fragments IS NULL OR list_bool_or(list_transform(s.fragments, lambda f: contains(b.url, f)))
"""

SQL["fragment_join"] = SQL["fragment_semi"]

SQL["fragment_pairs"] = f"""
WITH u AS (SELECT url FROM ({LINKS}) UNION SELECT url FROM pages),
f AS (SELECT DISTINCT unnest(list_append(string_split({path('url')}, '/'), {query('url')})) AS fragment FROM pages)
SELECT url, fragment FROM u JOIN f ON contains(url, fragment) WHERE fragment <> ''"""

SQL["extension_filter"] = f"SELECT page_id, url FROM pages WHERE ends_with(lower({path('url')}), '.html')"

SQL["seen_anti"] = f"""
WITH cand AS (SELECT page_id, CAST(-1 AS BIGINT) AS idx, url FROM pages
              UNION ALL SELECT page_id, idx, url FROM ({LINKS})),
seen AS (SELECT DISTINCT regexp_replace(url, '#.*$', '') AS url FROM pages)
SELECT url, first(page_id ORDER BY page_id, idx) AS page_id, first(idx ORDER BY page_id, idx) AS idx
FROM cand WHERE url NOT IN (SELECT url FROM seen) GROUP BY url
"""

SQL["seed_exempt"] = f"""
WITH b AS ({BOUND_PAGES}),
first_seed AS (SELECT site, arg_min(url, page_id) AS first_seed FROM b GROUP BY site),
lk AS (SELECT DISTINCT src_url, url FROM ({LINKS})),
reqs AS (SELECT site, url FROM b
         UNION SELECT b.site, lk.url FROM lk JOIN b ON b.url = lk.src_url)
SELECT r.site, r.url FROM reqs r JOIN first_seed f USING (site)
WHERE r.url = f.first_seed OR r.url NOT IN (SELECT url FROM pages)
"""

SQL["frontier"] = f"""
WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages),
edges AS (SELECT page_id AS src, (page_id * 7 + 3) % n.n AS dst FROM pages, n
          UNION SELECT page_id AS src, (page_id * 3 + 1) % n.n AS dst FROM pages, n),
seeds AS (SELECT min(page_id) AS node FROM pages GROUP BY {host('url')}),
walk(node, depth) AS (
  SELECT node, 1 FROM seeds
  UNION SELECT e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.node, n WHERE w.depth < n.n
)
SELECT node AS page_id, CAST(min(depth) AS BIGINT) AS depth FROM walk GROUP BY node
"""


SQL["link_forms"] = f"""
SELECT page_id, idx, url FROM ({links_sql(f"""
  SELECT page_id, url, replace(concat({", ".join(q(a + "@@" + b) for a, b in [
      ('<a href="../../../../../../', '/x.html">'), ("<a href='/q?r=/a/../", "/./b#/../c'>"),
      ("<A class=k href=/s?a=1&amp;b=", "&#38;lt;>"), ("<!-- <a href='/comment", "'> -->"),
      ('<script>var s = "<a href=\'/script', '\'>";</script>'), ("<a href='mailto:", "'>"), ("<a href='JAVASCRIPT:", "'>"),
      ("<area href='HTTPS://e.com/a/./b/../", "/'>"), ("<a href='/file/", ".PDF?x'>"), ("<a href='a/b/../", "/..'>"),
      ("<a href='/dir/", "/.'>"), ("<a href='&#x2F;&#0000000047;h.org/", "&eacute;'>"), ("<a href='.", "'>")])}),
    '@@', 'p' || page_id) AS html FROM ({HTML_PAGES})""")})"""

SQL["frontier_links"] = f"""
WITH RECURSIVE s AS ({CORPUS_SITES_SQL}),
lk AS MATERIALIZED (SELECT DISTINCT src_url, url FROM ({LINKS})),
edges AS MATERIALIZED (
  SELECT DISTINCT lk.src_url AS src, lk.url AS dst FROM lk JOIN s
  ON list_bool_or(list_transform(s.allowed_domains, lambda d: {host('lk.url')} = d OR ends_with({host('lk.url')}, '.' || d)))
  WHERE s.fragments IS NULL OR list_bool_or(list_transform(s.fragments, lambda f: contains(lk.url, f)))),
top AS (SELECT count(*) AS n FROM edges),
walk(url, depth) AS (
  SELECT DISTINCT b.url, 1 FROM ({BOUND_PAGES}) b JOIN ({HTML_PAGES}) p ON p.page_id = b.page_id
  UNION SELECT e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.url, top WHERE w.depth <= top.n)
SELECT url, CAST(min(depth) AS BIGINT) AS depth FROM walk GROUP BY url
"""


# ---- DOM: the same interval encoding, written as a DuckDB CTE chain ------------------


def _inlist(xs) -> str:
    return "(" + ", ".join(q(x) for x in xs) + ")"


def clean(h: str) -> str:
    return f"regexp_replace({h}, {q(_NOT_TEXT)}, '', 'g')"


def page_text(h: str) -> str:
    return decode(f"regexp_replace({clean(h)}, '<[A-Za-z/!?][^>]*>', '', 'g')")


def py_strip(s: str) -> str:
    ws = _T.PY_WHITESPACE_CLASS
    return f"regexp_replace(regexp_replace({s}, {q('^' + ws + '+')}, ''), {q(ws + '+$')}, '')"


def strip_ws(s: str) -> str:
    return f"translate({s}, ' ' || chr(10) || chr(9) || chr(13), '')"


_groups = _D.CLOSE_GROUPS
_grp_next = "CASE " + " ".join(
    f"WHEN tag IN {_inlist(closed)} THEN _n_{g}" for g, (_, closed) in _groups.items()) + " END"
_next_cols = ",\n  ".join(
    f"min(CASE WHEN kind = 'open' AND tag IN {_inlist(op)} THEN pos END) OVER wd AS _n_{g}"
    for g, (op, _) in _groups.items())

# start tag, body and end tag of the elements whose body is one token; the patterns are the SQL's own
_RAW_TAGS = ("script", "style", "textarea", "title")
_RAW = "|".join(f"<{t}>.*?</{t}[[:space:]]*>|<{t}[[:space:]/][^>]*>.*?</{t}[[:space:]]*>|<{t}>.*|<{t}[[:space:]/][^>]*>.*" for t in _RAW_TAGS)
_RAW_PARTS = f"(?is)^(<({'|'.join(_RAW_TAGS)})(?:[[:space:]/][^>]*)?>)(.*?)(</(?:{'|'.join(_RAW_TAGS)})[[:space:]]*>)?$"
_PARTS = f"regexp_extract(m, {q(_RAW_PARTS)}, ['open', 'tag', 'body', 'close'])"
DOM_CTE = f"""
_m AS (SELECT page_id, regexp_extract_all(regexp_replace(html, {q('(?is)<!--.*?-->|(' + _RAW + ')')}, '\\1', 'g'),
                                          {q('(?is)' + _RAW + '|<[a-z/!?][^>]*>|[^<]+|<')}, 0) AS t FROM pages),
_s AS (SELECT page_id, flatten(list_transform(t, lambda m: CASE WHEN regexp_matches(m, {q(_RAW_PARTS)})
         THEN list_filter([{{'tok': {_PARTS}.open, 'body': ''}}, {{'tok': {_PARTS}.body, 'body': lower({_PARTS}.tag)}},
                           {{'tok': {_PARTS}.close, 'body': ''}}], lambda x: x.tok <> '')
         ELSE [{{'tok': m, 'body': ''}}] END)) AS t FROM _m),
_t0 AS (SELECT page_id, last_pos, pos, x.tok AS tok, x.body AS body FROM (
          SELECT page_id, CAST(len(t) - 1 AS BIGINT) AS last_pos, unnest(t) AS x,
                 CAST(generate_subscripts(t, 1) - 1 AS BIGINT) AS pos FROM _s)),
_t1 AS (SELECT *, CASE WHEN body IN ('script', 'style') THEN 'raw' WHEN body <> '' THEN 'text'
                       WHEN starts_with(tok, '</') THEN 'close'
                       WHEN regexp_matches(tok, '^<[A-Za-z]') THEN 'open'
                       WHEN starts_with(tok, '<') AND length(tok) > 1 THEN 'other'
                       ELSE 'text' END AS kind FROM _t0),
_t2 AS (SELECT *, CASE WHEN kind IN ('text', 'raw') THEN {q(_D.TEXT_TAG)}
                       ELSE lower(regexp_extract(tok, {q(_D.TAG_NAME_RE)}, 1)) END AS tag
        FROM _t1 WHERE kind <> 'other'),
_t3 AS (SELECT *, (kind = 'open' AND (tag IN {_inlist(_D.VOID_TAGS)} OR (regexp_matches(tok, '/\\s*>$') AND tag NOT IN {_inlist(_RAW_TAGS)}))) AS void,
               CASE WHEN kind = 'text' THEN {decode('tok')} WHEN kind = 'raw' THEN tok END AS text FROM _t2),
_t4 AS (SELECT *, CASE WHEN kind = 'open' AND NOT void THEN 'O' WHEN kind = 'close' THEN 'C' END AS _pt FROM _t3),
_t5 AS (SELECT *, sum(CASE _pt WHEN 'O' THEN 1 WHEN 'C' THEN -1 ELSE 0 END)
                  OVER (PARTITION BY page_id, tag ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _run
        FROM _t4),
_t6 AS (SELECT *, CASE WHEN _pt = 'C' THEN _run + 1 ELSE _run END AS _lvl FROM _t5),
_t7 AS (SELECT *, lead(_pt) OVER w AS _nxt_t, lead(pos) OVER w AS _nxt_p, lag(_pt) OVER w AS _prv_t
        FROM _t6 WINDOW w AS (PARTITION BY page_id, tag, _lvl ORDER BY pos)),
_t8 AS (SELECT *, CASE WHEN _pt = 'O' AND _nxt_t = 'C' THEN _nxt_p END AS _mend,
               coalesce(_pt = 'C' AND _prv_t = 'O', false) AS _mclose FROM _t7),
_t9 AS (SELECT *, coalesce(sum(CASE WHEN _mend IS NOT NULL THEN 1 WHEN _mclose THEN -1 ELSE 0 END)
                  OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _md,
               coalesce(_pt = 'O' AND _mend IS NULL, false) AS _unclosed
        FROM _t8),
_t10 AS (SELECT *,
  {_next_cols},
  CASE WHEN _mclose OR _unclosed THEN _md END AS _ak
  FROM _t9 WINDOW wd AS (PARTITION BY page_id, _md ORDER BY pos DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
_t11 AS (SELECT *, min(CASE WHEN _mclose THEN pos END)
                   OVER (PARTITION BY page_id, _ak ORDER BY pos DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _anc
         FROM _t10),
_ex AS (SELECT page_id, pos, last_pos, kind, tag, void, tok, text,
          CAST(CASE WHEN _mend IS NOT NULL THEN _mend
                    WHEN _unclosed THEN least(({_grp_next}) - 1, _anc - 1, last_pos)
                    ELSE pos END AS BIGINT) AS "end"
        FROM _t11),
_ev AS (SELECT page_id, pos AS _p, 0 AS _o, 0 AS _d FROM _ex
        UNION ALL SELECT page_id, pos, 1, 1 FROM _ex WHERE kind = 'open'
        UNION ALL SELECT page_id, "end", 2, -1 FROM _ex WHERE kind = 'open'),
_dp AS (SELECT page_id, _p AS pos, _o, sum(_d) OVER (PARTITION BY page_id ORDER BY _p, _o
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS depth FROM _ev),
_dx AS (SELECT e.*, CAST(d.depth AS BIGINT) AS depth FROM _ex e JOIN _dp d ON d.page_id = e.page_id AND d.pos = e.pos AND d._o = 0),
_kd AS (SELECT page_id, pos, depth - 1 AS _k, 0 AS _o, NULL::BIGINT AS _c FROM _dx
        UNION ALL SELECT page_id, pos, depth, 1, pos FROM _dx WHERE kind = 'open'),
_pa AS (SELECT page_id, pos, _o, coalesce(max(_c) OVER (PARTITION BY page_id, _k ORDER BY pos, _o
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS parent FROM _kd),
dom AS (SELECT x.*, CAST(p.parent AS BIGINT) AS parent,
          CAST(CASE WHEN x.kind IN ('open', 'text', 'raw') THEN
             row_number() OVER (PARTITION BY x.page_id, p.parent, x.tag ORDER BY x.pos) END AS BIGINT) AS sib_pos
        FROM _dx x JOIN _pa p ON p.page_id = x.page_id AND p.pos = x.pos AND p._o = 0)
"""


def attr_sql(name: str, tok: str = "tok") -> str:
    """First attribute ``name`` of an open tag (same pattern as the Spark side); NULL if absent."""
    g = [f"regexp_extract_all({tok}, {q(_D.ATTR_RE)}, {i})" for i in (1, 2, 3, 4)]
    return (f"list_extract(list_transform(list_filter(list_zip(list_transform({g[0]}, lambda k: lower(k)), "
            f"{g[1]}, {g[2]}, {g[3]}), lambda a: a[1] = {q(name)}), "
            f"lambda a: coalesce(a[2], '') || coalesce(a[3], '') || coalesce(a[4], '')), 1)")


SQL["dom_elements"] = f"""WITH {DOM_CTE}
SELECT page_id, pos AS start, "end", tag, depth, parent, sib_pos FROM dom WHERE kind = 'open'"""

SQL["dom_text"] = f"""WITH {DOM_CTE}
SELECT page_id, pos, depth, parent, sib_pos, text FROM dom WHERE kind = 'text'"""

SQL["page_text"] = f"""
SELECT page_id, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS text_md5
FROM (SELECT page_id, {page_text('html')} AS t FROM pages)"""

SQL["strip_text"] = f"""
SELECT page_id, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS text_md5
FROM (SELECT page_id, {strip_ws(page_text('html'))} AS t FROM pages)"""

SQL["trim_text"] = f"""
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, md5(array_to_string(ls, chr(10))) AS text_md5
FROM (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)),
        lambda x: {py_strip('x')}), lambda x: x <> '') AS ls FROM documents)"""

SQL["body_texts"] = f"""WITH {DOM_CTE}
SELECT t.page_id, t.pos, t.text FROM dom t JOIN dom b ON b.page_id = t.page_id AND b.kind = 'open' AND b.tag = 'body'
WHERE t.kind = 'text' AND t.parent > b.pos AND t.parent <= b."end" AND regexp_matches(t.text, {q(_T.XML_NON_SPACE)})"""

_SCOPE = f"""sel AS (SELECT page_id, pos AS start, "end" FROM dom
                WHERE kind = 'open' AND {attr_sql('class')} = 'ad')"""

SQL["div_text_last"] = f"""WITH {DOM_CTE}, {_SCOPE},
sv AS (SELECT s.page_id, s.start, coalesce(string_agg(t.text, '' ORDER BY t.pos), '') AS text
       FROM sel s LEFT JOIN dom t ON t.page_id = s.page_id AND t.kind = 'text' AND t.pos > s.start AND t.pos <= s."end"
       GROUP BY s.page_id, s.start)
SELECT page_id, arg_max(text, start) AS text FROM sv GROUP BY page_id"""

SQL["div_texts"] = f"""WITH {DOM_CTE}, {_SCOPE}
SELECT DISTINCT s.page_id, t.pos, t.text FROM sel s
JOIN dom t ON t.page_id = s.page_id AND t.kind = 'text' AND t.pos > s.start AND t.pos <= s."end"
WHERE regexp_matches(t.text, {q(_T.XML_NON_SPACE)})"""


# ---- extraction rules: each path written out as joins on the dom CTE -------------------
_HITS = {
    "headline": """SELECT h.page_id, h.pos AS start, h."end", h.kind FROM _el a
        JOIN _el h ON h.page_id = a.page_id AND h.parent = a.pos WHERE a.tag = 'article' AND h.tag = 'h1'""",
    "title": """SELECT t.page_id, t.pos AS start, t."end", t.kind FROM _el x
        JOIN _el hd ON hd.page_id = x.page_id AND hd.parent = x.pos
        JOIN _el t ON t.page_id = hd.page_id AND t.parent = hd.pos
        WHERE x.tag = 'html' AND x.parent = -1 AND hd.tag = 'head' AND t.tag = 'title'""",
    "nav_second": """SELECT DISTINCT a.page_id, a.pos AS start, a."end", a.kind FROM _el n
        JOIN _el l ON l.page_id = n.page_id AND l.pos > n.pos AND l.pos <= n."end"
        JOIN _el a ON a.page_id = l.page_id AND a.parent = l.pos
        WHERE n.tag = 'nav' AND l.tag = 'li' AND l.sib_pos = 2 AND a.tag = 'a'""",
    "ad_text": f"""SELECT DISTINCT t.page_id, t.pos AS start, t."end", t.kind FROM _el d
        JOIN _tn t ON t.page_id = d.page_id AND t.pos > d.pos AND t.pos <= d."end"
        WHERE d.tag = 'div' AND {attr_sql('class', 'd.tok')} IN ('ad', 'promo')""",
    "lead_para": """SELECT p.page_id, p.pos AS start, p."end", p.kind FROM _el a
        JOIN _el p ON p.page_id = a.page_id AND p.parent = a.pos
        WHERE a.tag = 'article' AND p.tag = 'p' AND p.sib_pos = 1""",
    "any_ad": f"""SELECT page_id, pos AS start, "end", kind FROM _el WHERE {attr_sql('class')} = 'ad'""",
    "head": """SELECT page_id, pos AS start, "end", kind FROM _el WHERE tag = 'head'""",
    "script_text": """SELECT t.page_id, t.pos AS start, t."end", t.kind FROM _el s
        JOIN _tn t ON t.page_id = s.page_id AND t.parent = s.pos WHERE s.tag = 'script'""",
    "style_text": """SELECT DISTINCT t.page_id, t.pos AS start, t."end", t.kind FROM _el h JOIN _el s ON s.page_id = h.page_id
        AND s.parent = h.pos JOIN _tn t ON t.page_id = s.page_id AND t.pos > s.pos AND t.pos <= s."end"
        WHERE h.tag = 'head' AND s.tag = 'style'""",
}
_HITS["heading"] = f"""SELECT DISTINCT * FROM ({_HITS['headline']} UNION ALL
    SELECT page_id, pos AS start, "end", kind FROM _el WHERE tag = 'title')"""


def _rules_sql(targets, strip: bool) -> str:
    hits = "\n  UNION ALL ".join(
        f"SELECT {q(t)} AS target, * FROM ({_HITS[t]}) WHERE page_id IN (SELECT page_id FROM _bound)" for t in targets)
    if strip:
        vals = f"""
  SELECT h.page_id, h.target, h.start, {strip_ws("coalesce(string_agg(t.text, '' ORDER BY t.pos), '')")} AS value
  FROM hits h LEFT JOIN _tn t ON t.page_id = h.page_id AND t.pos > h.start AND t.pos <= h."end"
  WHERE h.kind = 'open' GROUP BY h.page_id, h.target, h.start
  UNION ALL
  SELECT h.page_id, h.target, h.start, {strip_ws('t.text')} FROM hits h JOIN _tn t ON t.page_id = h.page_id AND t.pos = h.start
  WHERE h.kind IN ('text', 'raw')"""
    else:
        vals = f"""
  SELECT * FROM (
  SELECT h.page_id, h.target, h.start, {py_strip("string_agg(d.tok, '' ORDER BY d.pos)")} AS value
  FROM hits h JOIN dom d ON d.page_id = h.page_id AND d.pos >= h.start AND d.pos <= h."end"
  WHERE h.kind = 'open' GROUP BY h.page_id, h.target, h.start
  UNION ALL
  SELECT h.page_id, h.target, h.start, {py_strip('t.text')} FROM hits h JOIN _tn t ON t.page_id = h.page_id AND t.pos = h.start
  WHERE h.kind IN ('text', 'raw')) WHERE value <> ''"""
    return f"""WITH {DOM_CTE},
_el AS (SELECT * FROM dom WHERE kind = 'open'),
_tn AS (SELECT * FROM dom WHERE kind IN ('text', 'raw')),
_bound AS (SELECT page_id FROM pages WHERE list_bool_or(list_transform(['example.com', 'example.net', 'example.org'],
             lambda d: {host('url')} = d OR ends_with({host('url')}, '.' || d)))),
hits AS ({hits}),
vals AS ({vals})
SELECT page_id, 'corpus' AS site, target,
       CAST(row_number() OVER (PARTITION BY page_id, target ORDER BY start) - 1 AS BIGINT) AS idx, value
FROM vals"""


_MAIN = ["headline", "title", "nav_second", "ad_text", "lead_para", "any_ad"]
SQL["rule_strip"] = _rules_sql(_MAIN, True)
SQL["rule_trim"] = _rules_sql(_MAIN, False)
SQL["rule_union"] = _rules_sql(["heading"], False)
SQL["rule_or"] = _rules_sql(["ad_text", "any_ad"], True)
SQL["rule_raw_text"] = _rules_sql(["head", "script_text", "style_text"], True)
SQL["rule_raw_markup"] = _rules_sql(["head", "script_text", "style_text"], False)


# ---- snapshots ------------------------------------------------------------------------
SQL["snapshot_concat"] = """
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_states, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS text_md5 FROM (
  SELECT conv_id, count(*) OVER (PARTITION BY conv_id) AS c,
         string_agg(text, chr(10) ORDER BY turn, text) OVER (PARTITION BY conv_id) AS t FROM conversations)
GROUP BY conv_id, t"""

def _rope_sql(rows: str, keys: str) -> str:
    """The chunks of 500 characters, cut out of the whole joined string at the starts of its states."""
    return f"""
  WITH r AS (SELECT *, length(text) + 1 AS len FROM ({rows}) WHERE text IS NOT NULL),
  s AS (SELECT *, sum(len) OVER (PARTITION BY {keys} ORDER BY turn, text ROWS UNBOUNDED PRECEDING) - len AS start FROM r),
  whole AS (SELECT {keys}, string_agg(text, chr(10) ORDER BY turn, text) AS t FROM r GROUP BY {keys}),
  c AS (SELECT {keys}, CAST(start // 500 AS BIGINT) AS chunk, CAST(min(start) AS BIGINT) AS start, count(*) AS n_states FROM s GROUP BY {keys}, start // 500),
  e AS (SELECT *, greatest(start - 1, 0) AS "offset", lead(start) OVER (PARTITION BY {keys} ORDER BY chunk) - 1 AS stop FROM c)
  SELECT e.*, substr(t, "offset" + 1, coalesce(stop, length(t)) - "offset") AS text FROM e JOIN whole USING ({keys})"""


SQL["snapshot_rope"] = f"""
SELECT conv_id, chunk, "offset", n_states, md5(text) AS text_md5 FROM ({_rope_sql("SELECT conv_id, turn, text FROM conversations", "conv_id")})"""

SQL["snapshot_rope_digest"] = f"""
WITH tg AS (SELECT * FROM (VALUES ('user', 'user_text'), ('assistant', 'assistant_text'), ('system', 'system_text')) t(role, target)),
rope AS ({_rope_sql("SELECT conv_id, target, turn, text FROM conversations JOIN tg USING (role)", "conv_id, target")}),
grid AS (SELECT DISTINCT conv_id, tg.target FROM conversations, tg),
every AS (SELECT conv_id, target, coalesce(n_states, 0) AS n_states, coalesce("offset", 0) AS "offset", coalesce(text, '') AS text
          FROM grid LEFT JOIN rope USING (conv_id, target))
SELECT conv_id, target, CAST(sum(n_states) AS BIGINT) AS n_states, CAST(sum(length(text)) AS BIGINT) AS n_chars, count(*) AS n_chunks,
       CAST(sum(CAST(('0x' || substr(md5("offset" || ':' || text), 1, 12)) AS BIGINT)) AS VARCHAR) AS digest
FROM every GROUP BY conv_id, target"""

SQL["snapshot_accumulate"] = """
WITH tg AS (SELECT * FROM (VALUES ('user', 'user_text'), ('assistant', 'assistant_text'), ('system', 'system_text')) t(role, target)),
k AS (SELECT DISTINCT conv_id FROM conversations),
grid AS (SELECT k.conv_id, tg.target FROM k, tg),
acc AS (SELECT c.conv_id, tg.target, count(*) AS n, string_agg(c.text, chr(10) ORDER BY c.turn, c.text) AS t
        FROM conversations c JOIN tg USING (role) GROUP BY c.conv_id, tg.target)
SELECT g.conv_id, g.target, CAST(coalesce(a.n, 0) AS BIGINT) AS n_items, md5(coalesce(a.t, '')) AS text_md5
FROM grid g LEFT JOIN acc a USING (conv_id, target)"""

_EV_STEP = """SELECT user_id, event_id, ts, event_type, value,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS step FROM events"""

SQL["converged"] = f"""
WITH s AS ({_EV_STEP}),
l AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM s),
f AS (SELECT user_id, min(CASE WHEN event_type = prev THEN step END) AS stop FROM l GROUP BY user_id)
SELECT l.user_id, l.event_id, l.step FROM l JOIN f USING (user_id) WHERE f.stop IS NULL OR l.step <= f.stop"""

SQL["page_cap"] = """
SELECT conv_id, turn, step FROM (SELECT conv_id, turn,
  CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS BIGINT) AS step FROM conversations) WHERE step <= 3"""

SQL["progress_cut"] = f"""
WITH s AS (SELECT *, CAST(step AS VARCHAR) || '/10' AS marker FROM ({_EV_STEP})),
d AS (SELECT *, coalesce(max(CASE WHEN CAST(split_part(marker, '/', 1) AS BIGINT) >= CAST(split_part(marker, '/', 2) AS BIGINT)
        THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM s)
SELECT user_id, event_id, marker FROM d WHERE before = 0"""

SQL["unchanged"] = """
SELECT user_id, event_id, event_type FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
WHERE prev IS NULL OR event_type IS DISTINCT FROM prev"""


# ---- naming, run folders, crawl summary ---------------------------------------------------


def _html_base(u: str) -> str:
    p = path(u)
    p1 = f"(CASE WHEN starts_with({p}, '/') THEN replace(substr({p}, 2), '/', '') ELSE {p} END)"
    p2 = f"(CASE WHEN {p1} = '' THEN 'html.html' ELSE {p1} END)"
    p3 = f"regexp_replace({p2}, '/$', '')"
    return f"(CASE WHEN ends_with(lower({p3}), '.html') OR ends_with(lower({p3}), '.htm') THEN {p3} ELSE {p3} || '.html' END)"


SQL["versioned_names"] = f"""
WITH n AS (SELECT page_id, replace({authority('url')}, ':', '_') AS domain_dir, {_html_inner('url')} AS html_name FROM pages),
n2 AS (SELECT *, html_name || '-FAQ.json' AS json_name FROM n),
k AS (SELECT *, row_number() OVER (PARTITION BY domain_dir, html_name ORDER BY page_id) AS k1,
               row_number() OVER (PARTITION BY domain_dir, json_name ORDER BY page_id) AS k2 FROM n2)
SELECT page_id, domain_dir, {_versioned('html_name', 'k1')} AS html_name_v, {_versioned('json_name', 'k2')} AS json_name_v FROM k"""

SQL["latest_per_key"] = f"""
SELECT domain_dir, save_key, max(page_id) AS page_id, arg_max(url, page_id) AS url FROM (
  SELECT replace({authority('url')}, ':', '_') AS domain_dir, {_html_base('url')} AS save_key, page_id, url FROM pages)
GROUP BY domain_dir, save_key"""

SQL["run_paths"] = """
SELECT event_id, strftime(ts, '%Y%m%d_%H%M') AS run_ts, strftime(ts, '%Y-%m-%d_%H-%M-%S') AS name_ts,
       event_type || '_' || strftime(ts, '%Y%m%d_%H%M') AS archive_name FROM events"""

SQL["crawl_summary"] = """
SELECT event_id, page_id, url AS req_url, CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END AS req_method,
  'text/html,' || event_type AS accept, lang AS language, CAST(CASE event_type WHEN 'error' THEN 500 ELSE 200 END AS BIGINT) AS status,
  'text/html; charset=' || regexp_extract(html, '(?i)<meta\\s+charset="([^"]*)"', 1) AS content_type,
  CAST(strlen(html) AS VARCHAR) AS content_length, CASE WHEN event_type = 'signup' THEN props || ';' || lang END AS cookies,
  CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS meta_k, replace(props, ' ', '') AS meta_json,
  CASE WHEN event_type IN ('error', 'signup') THEN event_type || ',' || upper(lang) ELSE '' END AS flags
FROM (SELECT *, regexp_extract(html, '(?i)<html\\s+lang="([^"]*)"', 1) AS lang FROM pages JOIN events ON user_id = page_id) WHERE url IS NOT NULL"""


# ---- presets ------------------------------------------------------------------------------
_SITE_TARGETS = {"news_com": (["headline", "nav_second"], False, "faq"),
                 "news_net": (["title", "lead_para"], True, "production-description"),
                 "blogs_org": (["ad_text"], True, "complex_get_data"),
                 "spam": (["any_ad"], True, "js")}


def _values_sql(hits: str, strip: bool) -> str:
    if strip:
        return f"""
  SELECT h.page_id, h.site, h.target, h.start, {strip_ws("coalesce(string_agg(t.text, '' ORDER BY t.pos), '')")} AS value
  FROM ({hits}) h LEFT JOIN _tn t ON t.page_id = h.page_id AND t.pos > h.start AND t.pos <= h."end"
  WHERE h.kind = 'open' GROUP BY h.page_id, h.site, h.target, h.start
  UNION ALL
  SELECT h.page_id, h.site, h.target, h.start, {strip_ws('t.text')} FROM ({hits}) h
  JOIN _tn t ON t.page_id = h.page_id AND t.pos = h.start WHERE h.kind IN ('text', 'raw')"""
    return f"""
  SELECT * FROM (
  SELECT h.page_id, h.site, h.target, h.start, {py_strip("string_agg(d.tok, '' ORDER BY d.pos)")} AS value
  FROM ({hits}) h JOIN dom d ON d.page_id = h.page_id AND d.pos >= h.start AND d.pos <= h."end"
  WHERE h.kind = 'open' GROUP BY h.page_id, h.site, h.target, h.start
  UNION ALL
  SELECT h.page_id, h.site, h.target, h.start, {py_strip('t.text')} FROM ({hits}) h
  JOIN _tn t ON t.page_id = h.page_id AND t.pos = h.start WHERE h.kind IN ('text', 'raw')) WHERE value <> ''"""


def _preset_union_sql() -> str:
    parts, types = [], []
    for site, (targets, strip, typ) in _SITE_TARGETS.items():
        hits = " UNION ALL ".join(
            f"SELECT {q(site)} AS site, {q(t)} AS target, x.* FROM ({_HITS[t]}) x "
            f"WHERE x.page_id IN (SELECT page_id FROM bound WHERE site = {q(site)})" for t in targets)
        parts.append(_values_sql(hits, strip))
        types.append(f"({q(site)}, {q(typ)})")
    return f"""WITH {DOM_CTE},
_el AS (SELECT * FROM dom WHERE kind = 'open'),
_tn AS (SELECT * FROM dom WHERE kind IN ('text', 'raw')),
bound AS ({BOUND_PAGES.replace('p.url', 'p.url')}),
vals AS ({' UNION ALL '.join('SELECT * FROM (' + p + ')' for p in parts)}),
types AS (SELECT * FROM (VALUES {', '.join(types)}) t(site, type))
SELECT v.page_id, v.site, ty.type, b.url, v.target,
       CAST(row_number() OVER (PARTITION BY v.page_id, v.site, v.target ORDER BY v.start) - 1 AS BIGINT) AS idx, v.value
FROM vals v JOIN types ty USING (site) JOIN bound b ON b.page_id = v.page_id AND b.site = v.site"""


SQL["preset_union"] = _preset_union_sql()

SQL["preset_target_div"] = f"""WITH {DOM_CTE}, {_SCOPE},
sv AS (SELECT s.page_id, s.start, coalesce(string_agg(t.text, '' ORDER BY t.pos), '') AS text
       FROM sel s LEFT JOIN dom t ON t.page_id = s.page_id AND t.kind = 'text' AND t.pos > s.start AND t.pos <= s."end"
       GROUP BY s.page_id, s.start),
last AS (SELECT page_id, arg_max(text, start) AS bs_target_div FROM sv GROUP BY page_id),
body AS (SELECT t.page_id, count(*) AS n, string_agg(t.text, chr(10) ORDER BY t.pos) AS s
         FROM dom t JOIN dom b ON b.page_id = t.page_id AND b.kind = 'open' AND b.tag = 'body'
         WHERE t.kind = 'text' AND t.parent > b.pos AND t.parent <= b."end" AND regexp_matches(t.text, {q(_T.XML_NON_SPACE)})
         GROUP BY t.page_id),
divt AS (SELECT page_id, count(*) AS n, string_agg(text, chr(10) ORDER BY pos) AS s FROM (
           SELECT DISTINCT s.page_id, t.pos, t.text FROM sel s
           JOIN dom t ON t.page_id = s.page_id AND t.kind = 'text' AND t.pos > s.start AND t.pos <= s."end"
           WHERE regexp_matches(t.text, {q(_T.XML_NON_SPACE)})) GROUP BY page_id)
SELECT p.page_id, l.bs_target_div, CAST(coalesce(b.n, 0) AS BIGINT) AS n_all_text, md5(coalesce(b.s, '')) AS all_text_md5,
       CAST(coalesce(v.n, 0) AS BIGINT) AS n_div_text, md5(coalesce(v.s, '')) AS div_text_md5,
       md5({page_text('p.html')}) AS bs_all_text_md5
FROM pages p LEFT JOIN last l USING (page_id) LEFT JOIN body b USING (page_id) LEFT JOIN divt v USING (page_id)"""

SQL["preset_web"] = f"""
SELECT page_id, url, 'out/html/' || domain_dir || '/' || save_name AS save_path FROM {_save_names(HTML_PAGES)}"""


# ---- sinks and streams: the read-back equals the data written ---------------------------
SQL["sink_json"] = SQL["preset_union"]
SQL["sink_urls"] = SQL["url_scan"]
SQL["sink_seen"] = f"SELECT DISTINCT url FROM ({LINKS})"
SQL["archive"] = SQL["page_text"]
SQL["sink_html"] = f"SELECT page_id, domain_dir, save_name FROM {_save_names(HTML_PAGES)}"
SQL["sink_snapshot"] = """
SELECT snapshot_key, max(page_id) AS page_id, arg_max(url, page_id) AS url FROM (
  SELECT translate(url, ':/', '') || '.html' AS snapshot_key, page_id, url FROM pages) GROUP BY snapshot_key"""
SQL["file_preset"] = f"""
SELECT DISTINCT url, 'files/' || replace({authority('url')}, ':', '_') || '/' || {_file_inner('url', 'html')} AS save_path,
  CAST(strlen(html) + 1 AS BIGINT) AS n_bytes, md5(html || chr(10)) AS content_md5
FROM (SELECT {safe_url('url')} AS url, html FROM ({HTML_PAGES})) WHERE ends_with(lower({path('url')}), '.html')"""
SQL["preset_config"] = SQL["preset_union"]
_DOCUMENTS = f"""
SELECT page_id, site, type, url, string_agg(DISTINCT target, ',' ORDER BY target) AS targets, count(*) AS n_values,
       md5(string_agg(value, chr(10) ORDER BY target, idx)) AS values_md5
FROM ({SQL['preset_union']}) GROUP BY page_id, site, type, url"""
SQL["sink_documents"] = _DOCUMENTS
SQL["stream_rules"] = f"SELECT page_id, site, type, url, target, idx, value FROM ({SQL['preset_union']})"
SQL["stream_snapshots"] = f"""
SELECT translate(url, ':/', '') || '.html' AS snapshot_key, page_id, url, md5(html) AS html_md5
FROM pages WHERE page_id IN (SELECT page_id FROM ({SQL['preset_union']}))"""
SQL["seen_log"] = f"""
WITH seen AS (SELECT url FROM pages UNION SELECT regexp_replace(url, '#.*$', '') FROM pages)
SELECT DISTINCT url FROM ({LINKS}) WHERE url NOT IN (SELECT url FROM seen)"""
SQL["stream_dedup"] = f"SELECT DISTINCT url FROM ({LINKS})"
SQL["stream_extract"] = SQL["page_text"]


# ---- js preset: pages of a host = ordered states of one page -----------------------------
SQL["preset_js"] = f"""WITH {DOM_CTE},
_el AS (SELECT * FROM dom WHERE kind = 'open'),
_tn AS (SELECT * FROM dom WHERE kind IN ('text', 'raw')),
hits AS (SELECT 'headline' AS target, * FROM ({_HITS['headline']})
         UNION ALL SELECT 'nav_second' AS target, * FROM ({_HITS['nav_second']})),
sv AS (SELECT h.page_id, h.target, h.start, {strip_ws("coalesce(string_agg(t.text, '' ORDER BY t.pos), '')")} AS value
       FROM hits h LEFT JOIN _tn t ON t.page_id = h.page_id AND t.pos > h.start AND t.pos <= h."end"
       GROUP BY h.page_id, h.target, h.start),
keyed AS (SELECT {host('p.url')} AS page_key, p.page_id FROM pages p
          WHERE list_bool_or(list_transform(['example.com', 'example.net', 'example.org'],
                lambda d: {host('p.url')} = d OR ends_with({host('p.url')}, '.' || d)))),
acc AS (SELECT k.page_key, sv.target, count(*) AS n, string_agg(sv.value, chr(10) ORDER BY k.page_id, sv.start) AS t
        FROM sv JOIN keyed k USING (page_id) GROUP BY k.page_key, sv.target),
grid AS (SELECT DISTINCT k.page_key, tg.target FROM keyed k,
         (VALUES ('headline'), ('nav_second'), ('missing')) tg(target))
SELECT g.page_key, g.target, CAST(coalesce(a.n, 0) AS BIGINT) AS n_items, md5(coalesce(a.t, '')) AS text_md5
FROM grid g LEFT JOIN acc a USING (page_key, target)"""


def _rule_map_sql() -> str:
    base = _rules_sql(_MAIN, True)
    return f"""SELECT page_id, site, CAST(count(DISTINCT target) AS BIGINT) AS n_targets,
       CAST(count(*) AS BIGINT) AS n_values, md5(string_agg(value, chr(10) ORDER BY target, idx)) AS values_md5
FROM ({base}) GROUP BY page_id, site"""


SQL["rule_map"] = _rule_map_sql()


SQL["staged_records"] = f"""
SELECT page_id, url AS faq_url, 'faq' AS type, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS text_md5
FROM (SELECT page_id, url, {page_text('html')} AS t FROM ({HTML_PAGES}))"""


SQL["sink_run"] = f"""
WITH r AS ({SQL['preset_union']}),
cfg AS (SELECT * FROM (VALUES ('news_com', 'faq', 'example.com'), ('news_net', 'product', 'example.net'),
                              ('blogs_org', 'complex', 'example.org'),
                              ('spam', 'js', 'cheap-pills.example.com,spam-farm.example.org')) t(site, kind, allowed_domains))
SELECT r.site, '20240102_0304' AS run_ts, CAST(count(*) AS BIGINT) AS n_records, cfg.kind, cfg.allowed_domains
FROM r JOIN cfg USING (site) GROUP BY r.site, cfg.kind, cfg.allowed_domains"""


SQL["preset_js_record"] = f"""
WITH last AS (
  SELECT max(page_id) AS page_id FROM pages
  WHERE list_bool_or(list_transform(['example.com', 'example.net', 'example.org'], lambda d: {host('url')} = d OR ends_with({host('url')}, '.' || d)))
  GROUP BY {host('url')}),
v AS (SELECT * FROM ({_rules_sql(["lead_para", "heading"], True)}) WHERE page_id IN (SELECT page_id FROM last)),
docs AS (SELECT page_id, string_agg(DISTINCT target, ',' ORDER BY target) AS targets, count(*) AS n_values,
                md5(string_agg(value, chr(10) ORDER BY target, idx)) AS values_md5 FROM v GROUP BY page_id),
middle AS (SELECT page_key, string_agg(target || '=' || text_md5, ',' ORDER BY target) AS middle FROM ({SQL['preset_js']}) GROUP BY page_key)
SELECT last.page_id, 'middleware' AS site, 'js' AS type, url, coalesce(targets, '') AS targets, coalesce(n_values, 0) AS n_values,
       coalesce(values_md5, md5('')) AS values_md5, CAST(0 AS BIGINT) AS n_target, middle,
       translate(url, ':/', '') || '.html' AS snapshot_key, md5(html) AS html_md5
FROM last JOIN pages USING (page_id) JOIN middle ON middle.page_key = {host('url')} LEFT JOIN docs ON docs.page_id = last.page_id"""

SQL["records_variant"] = f"""
SELECT page_id, site, type, url, CASE type WHEN 'faq' THEN 'target_faq_div_xpath' WHEN 'production-description' THEN 'production_description_div'
       WHEN 'complex_get_data' THEN 'complex_web_target' ELSE 'complex_web_target_js' END AS field, target, idx, value
FROM ({SQL['preset_union']})"""

SQL["preset_web_run"] = f"""
SELECT c.event_id, c.page_id, c.req_method AS method, c.status, c.meta_k,
       'out/' || replace({host('c.req_url')}, '.', '-') || strftime(TIMESTAMP '{RUN_TS}', '%Y%m%d_%H%M') AS run_folder, n.domain_dir, n.save_name
FROM ({SQL['crawl_summary']}) c LEFT JOIN {_save_names(HTML_PAGES)} n ON n.page_id = c.page_id"""
