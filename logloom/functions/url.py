"""URL functions (F-01..F-04) as built-in expressions.

They follow Python's ``urllib.parse`` semantics (``unquote``, ``urlparse``,
``parse_qsl``) without a Python worker: every function returns a Column
that stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.logformat import UNKNOWN_DOMAIN

# The schemes whose last path segment may carry ``;params``
# (besides no scheme at all).
PARAM_SCHEMES = ["ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps", "rtspu", "sip", "sips",
                 "mms", "sftp", "tel"]

_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"
_NETLOC = r"^//[^/?#]*"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _escape_stray_percent(c: Column) -> Column:
    # A '%' not followed by two hex digits is literal text: escape it so
    # the decoder does not reject the whole string.
    return F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25")


def decode_uri(c: Column | str) -> Column:
    """F-01 percent-decoding with ``unquote`` semantics: '+' stays '+'."""
    return F.try_url_decode(F.replace(_escape_stray_percent(_c(c)), F.lit("+"), F.lit("%2B")))


def decode_form(c: Column | str) -> Column:
    """Percent-decoding of a query component: '+' is a space."""
    return F.try_url_decode(_escape_stray_percent(_c(c)))


def _clean(c: Column | str) -> Column:
    """What ``urlsplit`` does first: leading controls and spaces go, and tab,
    CR and LF go wherever they are."""
    return F.regexp_replace(F.regexp_replace(_c(c), r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def _after_netloc(c: Column | str) -> Column:
    no_scheme = F.regexp_replace(_clean(c), _SCHEME, "")
    return F.regexp_replace(no_scheme, _NETLOC, "")


def url_path(c: Column | str) -> Column:
    """F-02 ``urlparse(u).path``: drop scheme, netloc, query, fragment and,
    for the schemes that have them, the ``;params`` of the last segment. An
    unclosed ``[`` in the netloc, at which ``urlparse`` raises, is part of
    the netloc here."""
    path = F.regexp_extract(_after_netloc(c), r"^([^?#]*)", 1)
    scheme = F.lower(F.regexp_extract(_clean(c), r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1))
    return F.when(scheme.isin("", *PARAM_SCHEMES), F.regexp_replace(path, r";[^/]*$", "")).otherwise(path)


def url_query(c: Column | str) -> Column:
    """``urlparse(u).query``."""
    return F.regexp_extract(_after_netloc(c), r"^[^?#]*\?([^#]*)", 1)


def query_list(c: Column | str) -> Column:
    """F-03 ``k=v`` items of ``parse_qsl``: split on '&', omit items with no
    '=' or a blank value, decode key and value ('+' is a space)."""
    items = F.filter(F.split(url_query(c), "&"), lambda x: x.rlike(r"(?s)=."))
    return F.transform(
        items,
        lambda x: F.concat(
            decode_form(F.regexp_extract(x, r"^([^=]*)=", 1)),
            F.lit("="),
            decode_form(F.regexp_extract(x, r"(?s)^[^=]*=(.*)$", 1)),
        ),
    )


def url_netloc(c: Column | str) -> Column:
    """``urlparse(u).netloc`` (user and port kept)."""
    return F.regexp_extract(_clean(c), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)


def referer_domain(c: Column | str) -> Column:
    """F-04: netloc of the referer; missing, blank or '-' gives 'Unknown'."""
    host = url_netloc(c)
    return F.when(host.isNull() | host.isin("", "-"), F.lit(UNKNOWN_DOMAIN)).otherwise(host)


def param_key(c: Column | str) -> Column:
    """F-11 key of one ``k=v`` item."""
    return F.split(_c(c), "=")[0]


def flat_query_words(items: Column | str) -> Column:
    """F-13: keys and values of all ``k=v`` items in one flat array."""
    return F.flatten(F.transform(_c(items), lambda x: F.split(x, "=")))
