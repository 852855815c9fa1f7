"""URL handling as native expressions (PR7, URL1-URL8).

Reference resolution follows RFC 3986 as Python's ``urljoin`` applies it: control
characters are dropped, an absent path keeps the base path, ``;params`` belong to
the last segment, and an empty query or fragment is not written back.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from resultlake.functions.text import bind, strip_text

# Generic URI syntax: scheme, authority, path, query, fragment.
_URI = (
    r"(?s)\A(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?"
    r"([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
)
_SCHEME, _AUTHORITY, _PATH, _QUERY, _FRAGMENT = 1, 2, 3, 4, 5

# Schemes whose references may be relative.
_RELATIVE_SCHEMES = (
    "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms",
    "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss",
)

# References most links have, whose resolution needs no taking apart: complete web
# addresses stay as they are, rooted paths without dot segments follow the origin.
_REST = r"(?:\?[^#\x00-\x20]+)?(?:#[^\x00-\x20]+)?\z"
_COMPLETE = r"\Ahttps?://[^/?#;\x00-\x20]+(?:/[^?#;\x00-\x20]*)?" + _REST
_ROOTED = r"\A(?=/)(?!//)(?:(?!/\.)[^?#;\x00-\x20])+" + _REST
_WEB_ORIGIN = r"\Ahttps?://[^/?#]+"


@lru_cache(maxsize=1)
def _authority_breakers() -> str:
    """Non-ASCII characters that turn into a URL delimiter under NFKC."""
    return "".join(
        chr(c)
        for c in range(0x80, 0x10000)
        if not 0xD800 <= c < 0xE000
        and set("/?#@:") & set(unicodedata.normalize("NFKC", chr(c)))
    )


def _col(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _clean(url: Column) -> Column:
    """What a URL splitter looks at: no leading controls, no tab or line break."""
    return F.regexp_replace(url, r"\A[\x00-\x20]+|[\t\r\n]", "")


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _URI, group)


def _prefixed(mark: str, text: Column) -> Column:
    return F.when(text == "", F.lit("")).otherwise(F.concat(F.lit(mark), text))


def _drop_empty_params(path: Column) -> Column:
    """``a;`` is written back as ``a``; ``a;p`` and ``a;;`` keep their parameters."""
    return F.regexp_replace(path, r"(?s)\A((?:.*/)?[^;/]*);\z", "$1")


def _without_dots(path: Column) -> Column:
    """Remove ``.`` and ``..`` segments of an absolute path."""
    walked = F.aggregate(
        F.split(path, "/", -1),
        F.expr("cast(array() as array<string>)"),
        lambda done, seg: F.when(seg == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(seg == ".", done)
        .otherwise(F.array_append(done, seg)),
    )
    joined = F.concat(
        F.array_join(walked, "/"),
        F.when(path.rlike(r"/\.\.?\z"), F.lit("/")).otherwise(F.lit("")),
    )
    rooted = F.concat(F.lit("/"), F.regexp_replace(joined, r"\A/", ""))
    return F.when(path.rlike(r"(\A|/)\.\.?(/|\z)"), rooted).otherwise(path)


def usable_href(href: Column) -> Column:
    """Stripped href, or NULL for blank, ``#`` and ``javascript:`` (PR7)."""
    return bind(
        strip_text(href),
        lambda h: F.when((h != "") & (h != "#") & ~h.startswith("javascript:"), h),
    )


def resolve_url(base: Column | str, href: Column) -> Column:
    """Resolve ``href`` against ``base``; an empty href is the base itself."""
    base = _col(base)
    on_web = base.rlike(_WEB_ORIGIN)
    return bind(
        href,
        lambda h: F.when(h.isNull(), h)
        .when(h == "", base)
        .when(on_web & h.rlike(_COMPLETE), h)
        .when(on_web & h.rlike(_ROOTED), F.concat(F.regexp_extract(base, _WEB_ORIGIN, 0), h))
        .otherwise(bind(_clean(h), lambda ref: _resolve_any(base, h, ref))),
    )


def _resolve_any(base: Column, href: Column, ref: Column) -> Column:
    base_scheme = F.lower(_part(base, _SCHEME))
    ref_scheme = F.lower(_part(ref, _SCHEME))
    foreign = ((ref_scheme != "") & (ref_scheme != base_scheme)) | ~base_scheme.isin(
        *_RELATIVE_SCHEMES
    )

    query = _part(ref, _QUERY)
    tail = F.concat(_prefixed("?", query), _prefixed("#", _part(ref, _FRAGMENT)))
    path_params = _drop_empty_params(_part(ref, _PATH))
    with_authority = F.concat(F.lit("//"), _part(ref, _AUTHORITY), path_params, tail)
    path = F.regexp_extract(path_params, r"(?s)\A(?:.*/)?[^/;]*", 0)
    params = F.regexp_extract(path_params, r";[^/]*\z", 0)

    root = F.concat(F.lit("//"), _part(base, _AUTHORITY))
    base_path = _part(base, _PATH)
    same_document = F.concat(
        root,
        _drop_empty_params(base_path),
        _prefixed("?", F.when(query == "", _part(base, _QUERY)).otherwise(query)),
        _prefixed("#", _part(ref, _FRAGMENT)),
    )
    # The base folder joined with a relative path loses its inner empty segments.
    folder = F.regexp_extract(base_path, r"(?s)\A(.*/)", 1)
    relative = F.concat(
        F.lit("/"),
        F.regexp_replace(
            F.regexp_replace(F.concat(folder, path), r"\A/+", ""), r"/{2,}", "/"
        ),
    )
    merged = F.concat(
        root,
        _without_dots(F.when(path.startswith("/"), path).otherwise(relative)),
        params,
        tail,
    )
    same_scheme = F.concat(
        base_scheme,
        F.lit(":"),
        F.when(_part(ref, _AUTHORITY) != "", with_authority)
        .when(path_params == "", same_document)
        .otherwise(merged),
    )
    return F.when(foreign, href).otherwise(same_scheme)


def absolute_url(base: Column | str, href: Column) -> Column:
    """Usable href resolved against ``base``, else NULL (URL1, URL4)."""
    return resolve_url(base, usable_href(href))


def canonical_url(base: Column | str, href: Column) -> Column:
    """``absolute_url`` without query and fragment, scheme in lower case (URL2)."""
    bare = F.regexp_extract(_clean(absolute_url(base, href)), r"\A[^?#]*", 0)
    scheme = r"\A[A-Za-z][A-Za-z0-9+.\-]*:"
    return bind(
        bare,
        lambda url: F.concat(
            F.lower(F.regexp_extract(url, scheme, 0)),
            _drop_empty_params(F.regexp_replace(url, scheme, "")),
        ),
    )


def is_malformed_url(href: Column) -> Column:
    """True where a URL splitter refuses the authority (unbalanced or bad brackets,
    characters that normalize to a delimiter); such a link fails its whole page."""
    authority = _part(_clean(usable_href(href)), _AUTHORITY)
    bracketed = r"\A(?:[^@]*@)*\[(?:v[0-9a-fA-F]+\..+|[0-9a-fA-F.]*:[0-9a-fA-F:.]*(?:%[^\]]+)?)\](?::[^\]]*)?\z"
    bad = (authority.rlike(r"[\[\]]") & ~authority.rlike(bracketed)) | authority.rlike(
        f"[{_authority_breakers()}]"
    )
    harmless = href.rlike(r"\A[\x00-\x5a\x5c\x5e-\x7f]*\z")  # ASCII without brackets
    return ~F.coalesce(harmless, F.lit(True)) & F.coalesce(bad, F.lit(False))


def is_unfetchable_url(url: Column) -> Column:
    """True where an HTTP client refuses the request line before any connection:
    blanks or controls, a path that is not ASCII, a port that is no number."""
    sent = F.regexp_extract(url, r"(?s)\A[^#]*", 0)
    refused = (
        sent.rlike(r"[\x00-\x20\x7f]")
        | F.concat(_part(sent, _PATH), _part(sent, _QUERY)).rlike(r"[^\x00-\x7f]")
        | _part(sent, _AUTHORITY).rlike(r":[^\]:]*[^0-9\]:][^\]:]*\z")
    )
    return F.coalesce(sent.rlike(r"(?i)\Ahttps?:") & refused, F.lit(False))


def form_encode(text: Column) -> Column:
    """``application/x-www-form-urlencoded`` value: space is ``+``, ``~`` is kept."""
    return F.replace(
        F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
    )


def percent_encode(text: Column) -> Column:
    """Percent-encode everything but letters, digits and ``_.-~``."""
    return F.replace(form_encode(text), F.lit("+"), F.lit("%20"))


def percent_decode(text: Column) -> Column:
    """Decode valid escapes; ``+`` and broken escapes stay as they are."""
    guarded = F.regexp_replace(
        F.replace(text, F.lit("+"), F.lit("%2B")), r"%(?![0-9A-Fa-f]{2})", "%25"
    )
    return F.try_url_decode(guarded)


def _before(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, 1)


# Markers of a question-and-answer block and its opened state.
_LB_MARK = "#lb_api="
_QA_TAB = "ssc=tab.itb.qab"
_QA_OPENED = "faq_opened=1"


def lb_trigger_url(page_url: Column, trigger: Column) -> Column:
    """Page URL carrying a lazily loaded block's address in its fragment (URL6)."""
    return bind(
        strip_text(trigger),
        lambda t: F.when(
            (t != "") & ~t.startswith("javascript:"),
            F.concat(
                _before(page_url, "#"), F.lit(_LB_MARK), percent_encode(resolve_url(page_url, t))
            ),
        ),
    )


def finish_more_url(url: Column) -> Column:
    """Open the question-and-answer block a lazily loaded address points to (URL7)."""
    return bind(percent_decode(url), lambda decoded: _opened(decoded, url))


def _opened(decoded: Column, url: Column) -> Column:
    page = _before(decoded, _LB_MARK)
    api = F.substr(decoded, F.length(page) + len(_LB_MARK) + 1)
    opened = F.concat(
        api, F.when(api.contains("?"), F.lit("&")).otherwise(F.lit("?")), F.lit(_QA_OPENED)
    )
    return F.when(
        decoded.contains(_LB_MARK)
        & decoded.contains(_QA_TAB)
        & ~decoded.contains(_QA_OPENED),
        F.concat(page, F.lit(_LB_MARK), percent_encode(opened)),
    ).otherwise(url)
