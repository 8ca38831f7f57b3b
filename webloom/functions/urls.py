"""URL column builders (all JVM-side expressions, no UDFs).

Parsing follows Python ``urllib.parse.urlsplit`` conventions: ``authority`` keeps the
port, ``path`` stops at ``?`` or ``#``. Regex extraction is used instead of
``parse_url`` because the latter returns NULL for URLs with spaces or non-ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's behaviour) --------------------------
# URL finder: "http" or "https", "://", then one or more characters from the set
#   letters a-z A-Z, digits, the range "$" to "_", "@ . & +", "! * ( ) ," and space,
#   or a %XX escape.
# Every member of that alternation is one character of one class, so it is written
# here as a single class: Java's regex engine recurses once per repetition of an
# alternation and overflows its stack on long matches; a plain class does not.
URL_FIND_PATTERN = r"https?://[a-z$-_@.&+!*(), ]+"
# Versioned file name: base, "-", version digits, optional ".ext" (word characters).
VERSIONED_NAME_PATTERN = r"^(.+)-([0-9]+)([.][\p{L}\p{N}_]+)?$"
# Timestamp formats used in names.
TS_NAME_FORMAT = "yyyy-MM-dd_HH-mm-ss"  # %Y-%m-%d_%H-%M-%S
RUN_TS_FORMAT = "yyyyMMdd_HHmm"  # %Y%m%d_%H%M
# Suffixes added after the save path per record type.
JSON_SUFFIXES = {"faq": "-FAQ.json", "production-description": "-Description.json",
                 "complex_get_data": "-Complex.json", "js": "-JS.json", "target_div": ".json"}
# Schemes a link may have.
LINK_SCHEMES = ["http", "https", "ftp", "file"]
# Path endings that a link extractor ignores by default: archives, images, audio, video, office documents, other.
DEFAULT_DENIED_EXTENSIONS = [
    "7z", "7zip", "bz2", "rar", "tar", "tar.gz", "xz", "zip",
    "mng", "pct", "bmp", "gif", "jpg", "jpeg", "png", "pst", "psp", "tif", "tiff", "ai", "drw", "dxf", "eps", "ps",
    "svg", "cdr", "ico", "webp",
    "mp3", "wma", "ogg", "wav", "ra", "aac", "mid", "au", "aiff",
    "3gp", "asf", "asx", "avi", "mov", "mp4", "mpg", "qt", "rm", "swf", "wmv", "m4a", "m4v", "flv", "webm",
    "xls", "xlsm", "xlsx", "xltm", "xltx", "potm", "potx", "ppt", "pptm", "pptx", "pps", "doc", "docb", "docm",
    "docx", "dotm", "dotx", "odt", "ods", "odg", "odp",
    "css", "pdf", "exe", "bin", "rss", "dmg", "iso", "apk", "jar", "sh", "rb", "js", "hta", "bat", "cpl", "msi",
    "msp", "py",
]
# Characters left as they are when a link URL is made safe (RFC 3986 reserved set plus
# "~"); everything else outside letters, digits and "-_." is percent-encoded as UTF-8.
URL_SAFE_CHARS = "!#$&'()*+,/:;=?@[]~"
# -------------------------------------------------------------------------------

_SCHEME = r"[A-Za-z][A-Za-z0-9+.-]*"
_AUTHORITY_RE = r"^" + _SCHEME + r"://([^/?#]*)"
_PATH_RE = r"^(?:" + _SCHEME + r":)?(?://[^/?#]*)?([^?#]*)"
_QUERY_RE = r"^[^?#]*\?([^#]*)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def authority(url) -> Column:
    """netloc: host with port and user info (empty when not absolute)."""
    return F.regexp_extract(_c(url), _AUTHORITY_RE, 1)


def url_path(url) -> Column:
    return F.regexp_extract(_c(url), _PATH_RE, 1)


def url_query(url) -> Column:
    return F.regexp_extract(_c(url), _QUERY_RE, 1)


def url_scheme(url) -> Column:
    return F.lower(F.regexp_extract(_c(url), r"^(" + _SCHEME + r"):", 1))


def host(url) -> Column:
    """Lower-cased host, user info and port removed."""
    a = F.regexp_replace(authority(url), r"^.*@", "")
    return F.lower(F.regexp_replace(a, r":[0-9]*$", ""))


def domain_dir(url) -> Column:
    """Per-domain directory name: netloc with ':' replaced by '_'."""
    return F.replace(authority(url), F.lit(":"), F.lit("_"))


def run_domain(url) -> Column:
    """Run-folder domain of the js preset: '.' replaced by '-'."""
    return F.replace(host(url), F.lit("."), F.lit("-"))


def snapshot_key(url) -> Column:
    """Raw-HTML snapshot file name: URL without ':' and '/', plus '.html'."""
    return F.concat(F.translate(_c(url), ":/", ""), F.lit(".html"))


def quote_path(s) -> Column:
    """Percent-encode with '/' safe (Python ``quote``); url_encode is form encoding."""
    e = F.url_encode(_c(s))
    e = F.replace(e, F.lit("+"), F.lit("%20"))
    e = F.replace(e, F.lit("%2F"), F.lit("/"))
    e = F.replace(e, F.lit("%7E"), F.lit("~"))
    return F.replace(e, F.lit("*"), F.lit("%2A"))


def html_base_name(url) -> Column:
    """The HTML file name before the timestamp: the save key of a page."""
    p = url_path(url)
    p = F.when(p.startswith("/"), F.replace(F.substring(p, 2, 1 << 30), F.lit("/"), F.lit(""))).otherwise(p)
    p = F.when(p == "", F.lit("html.html")).otherwise(p)
    p = F.regexp_replace(p, "/$", "")
    low = F.lower(p)
    return F.when(low.endswith(".html") | low.endswith(".htm"), p).otherwise(F.concat(p, F.lit(".html")))


def html_inner_name(url, ts) -> Column:
    """File name part of the HTML save path (before versioning).

    path with leading '/' -> drop it and every other '/'; empty -> 'html.html';
    one trailing '/' cut; '.html' added unless it ends in .html/.htm (any case);
    then the timestamp ``yyyy-MM-dd_HH-mm-ss`` and percent-encoding.
    """
    return quote_path(F.concat(html_base_name(url), F.date_format(_c(ts), TS_NAME_FORMAT)))


def html_save_path(base_dir: str, url, ts) -> Column:
    return F.concat_ws("/", F.lit(base_dir.rstrip("/")), domain_dir(url), html_inner_name(url, ts))


def file_inner_name(url, ext: str) -> Column:
    """File save name: like the HTML one but slashes kept, own extension, no timestamp."""
    suffix = "." + ext
    p = url_path(url)
    p = F.when(p.startswith("/"), F.substring(p, 2, 1 << 30)).otherwise(p)
    p = F.when(p == "", F.lit("html.html")).otherwise(p)
    p = F.regexp_replace(p, "/$", "")
    p = F.when(F.lower(p).endswith(suffix), p).otherwise(F.concat(p, F.lit(suffix)))
    return quote_path(p)


def file_save_path(base_dir: str, url, ext: str) -> Column:
    return F.concat_ws("/", F.lit(base_dir.rstrip("/")), domain_dir(url), file_inner_name(url, ext))


def has_extension(url, ext: str) -> Column:
    """lower-cased URL *path* ends with '.ext' (query and fragment ignored)."""
    return F.lower(url_path(url)).endswith("." + ext.lower())


def denied_extension(url, denied: list[str]) -> Column:
    """The URL path ends with one of the denied extensions, in any case."""
    names = "|".join(x.replace(".", "[.]") for x in denied)
    return url_path(url).rlike("(?i)[.](?:" + names + ")$") if denied else F.lit(False)


def fragment_allowed(url, fragments) -> Column:
    """F4 three-way rule: NULL list -> keep all; empty -> keep none; else any substring."""
    fr = _c(fragments)
    return F.when(fr.isNull(), F.lit(True)).otherwise(
        F.coalesce(F.exists(fr, lambda f: F.contains(_c(url), f)), F.lit(False)))


def find_urls(text) -> Column:
    """H3: all http(s) runs in a text, as an array."""
    return F.regexp_extract_all(_c(text), F.lit(URL_FIND_PATTERN), 0)


def versioned_parts(name) -> tuple[Column, Column, Column]:
    """(base, version or NULL, ext) of ``base-N.ext`` names."""
    n = _c(name)
    matched = n.rlike(VERSIONED_NAME_PATTERN)
    base = F.when(matched, F.regexp_extract(n, VERSIONED_NAME_PATTERN, 1)).otherwise(n)
    ver = F.when(matched, F.regexp_extract(n, VERSIONED_NAME_PATTERN, 2).cast("bigint"))
    ext = F.when(matched, F.regexp_extract(n, VERSIONED_NAME_PATTERN, 3)).otherwise(F.lit(""))
    return base, ver, ext


def remove_dot_segments(path) -> Column:
    """RFC 3986 5.2.4: '.' segments go, '..' takes the segment before it along, at any depth.

    One fold over the path's segments; paths without '/.' are passed through.
    """
    p = _c(path)
    parts = F.split(p, "/", -1)
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(x == ".", acc).otherwise(F.array_append(acc, x)))
    # a path that ends in a dot segment names a folder
    tail = F.when(p.rlike(r"/\.{1,2}$") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.when(p.startswith("/") & p.contains("/."),
                  F.concat(F.lit("/"), F.array_join(kept, "/"), tail)).otherwise(p)


def base_parts(base) -> Column:
    """What references resolve against: scheme, origin, URL without fragment, without query, and its folder."""
    b = _c(base)
    no_frag = F.regexp_replace(b, r"#.*$", "")
    no_query = F.regexp_replace(b, r"[?#].*$", "")
    folder = F.regexp_extract(no_query, r"^(" + _SCHEME + r"://[^/?#]*(?:/[^?#]*/)?)", 1)
    return F.struct(
        url_scheme(b).alias("scheme"), F.regexp_extract(b, r"^(" + _SCHEME + r"://[^/?#]*)", 1).alias("origin"),
        no_frag.alias("no_frag"), no_query.alias("no_query"),
        F.regexp_replace(folder, "([^/])$", "$1/").alias("folder"))


def join_reference(parts: Column, href) -> Column:
    """``href`` joined to the parts of its base, dot segments not yet removed."""
    h = F.trim(_c(href))
    return (
        F.when(h.rlike(r"^" + _SCHEME + r":"), h)
        .when(h.startswith("//"), F.concat(parts["scheme"], F.lit(":"), h))
        .when(h.startswith("/"), F.concat(parts["origin"], h))
        .when(h.startswith("?"), F.concat(parts["no_query"], h))
        .when(h.startswith("#"), F.concat(parts["no_frag"], h))
        .when(h == "", parts["no_frag"])
        .otherwise(F.concat(parts["folder"], h))
    )


def without_dots(joined, href) -> Column:
    """A joined URL without the dot segments of its path; query and fragment stay as written, and so do
    absolute and network-path references, like urljoin does."""
    j = _c(joined)
    path = F.regexp_extract(j, r"^" + _SCHEME + r"://[^/?#]*([^?#]*)", 1)
    clean = F.concat(F.regexp_extract(j, r"^(" + _SCHEME + r"://[^/?#]*)", 1), remove_dot_segments(path),
                     F.regexp_extract(j, r"^[^?#]*([?#].*)$", 1))
    whole = F.trim(_c(href)).rlike(r"^(?:" + _SCHEME + r":|//)")
    return F.when(j.contains("/.") & ~whole & path.contains("/."), clean).otherwise(j)


def resolve(base, href) -> Column:
    """H6: resolve ``href`` against page URL ``base`` (RFC 3986 reference forms).

    absolute (has scheme) -> as is; '//x' -> base scheme; '/x' -> base origin;
    '?q' -> base without query/fragment; '#f' -> base without fragment; '' -> base
    without fragment; otherwise relative to the base directory. Dot segments of a relative reference are
    removed, from the path only; query and fragment stay as written.
    """
    return without_dots(join_reference(base_parts(base), href), href)


def run_folder(save_dir: str, first_domain, ts, dashes: bool = False) -> Column:
    """Run output folder ``<save_dir>/<first allowed domain><yyyyMMdd_HHmm>``;
    the js preset writes the domain with '.' replaced by '-' (``dashes=True``)."""
    dom = _c(first_domain)
    if dashes:
        dom = F.replace(dom, F.lit("."), F.lit("-"))
    return F.concat(F.lit(save_dir.rstrip("/") + "/"), dom, F.date_format(_c(ts), RUN_TS_FORMAT))


# a character that safe_url has to escape
_UNSAFE_RE = "[^A-Za-z0-9_.\\-" + "".join("\\" + c for c in URL_SAFE_CHARS) + "%]"


def safe_url(url) -> Column:
    """Percent-encode a URL's unsafe characters (spaces, non-ASCII as UTF-8, quotes,
    angle brackets...) and keep reserved characters and existing %XX escapes.

    url_encode is form encoding: spaces become '+' and every reserved character is
    escaped; the escapes of the safe set are undone again, '%' last, so an escape that
    was already in the URL comes back unchanged. A URL of safe characters only skips the work."""
    u = _c(url)
    e = F.replace(F.url_encode(u), F.lit("+"), F.lit("%20"))
    for ch in URL_SAFE_CHARS:
        e = F.replace(e, F.lit("%%%02X" % ord(ch)), F.lit(ch))
    return F.when(u.rlike(_UNSAFE_RE), F.replace(e, F.lit("%25"), F.lit("%"))).otherwise(u)
