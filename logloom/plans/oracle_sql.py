"""DuckDB building blocks for the oracle SQL of each registered query.

They restate, in DuckDB's dialect, the semantics the Spark operators
implement (RE2 regex, 0-based ``dayofweek``, ``url_decode`` that keeps
'+'), so a query and its oracle are checked value for value."""

from __future__ import annotations

from logloom.functions.logformat import LOG_FIELDS, LOG_PATTERN
from logloom.plans.weblog_fixture import WEBLOG_SQL

PATTERN_SQL = LOG_PATTERN.replace("'", "''")
NETLOC_RE = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)"

PARSED_SQL = f"""
raw AS (
  SELECT regexp_extract(value, '{PATTERN_SQL}', [{', '.join(repr(f) for f in LOG_FIELDS)}]) AS r
  FROM weblog
),
parsed AS (
  SELECT r.remote_addr, r.remote_usr, r.date_time,
         substring(r.date_time, 1, 11) AS date, substring(r.date_time, 13, 8) AS time,
         r.req_method, r.req_uri, r.http_ver,
         TRY_CAST(r.status AS INTEGER) AS status,
         TRY_CAST(r.body_bytes_sent AS BIGINT) AS body_bytes_sent,
         r.http_referer, r.user_agent
  FROM raw
)"""

PARSED_COLS = ["remote_addr", "remote_usr", "date_time", "date", "time", "req_method",
               "req_uri", "http_ver", "status", "body_bytes_sent", "http_referer", "user_agent"]


def to_null(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL OR coalesce(isnan(TRY_CAST({c} AS DOUBLE)), false) "
            f"OR trim(CAST({c} AS VARCHAR)) = '' THEN NULL ELSE {c} END AS {c}")


NULLED_SQL = ("nulled AS (SELECT " + ", ".join(to_null(c) for c in PARSED_COLS)
              + " FROM parsed)")
CLEANED_SQL = ("cleaned AS (SELECT * FROM nulled WHERE "
               + " AND ".join(f"{c} IS NOT NULL" for c in PARSED_COLS) + ")")


def domain_sql(c: str) -> str:
    h = f"regexp_extract({c}, '{NETLOC_RE}', 1)"
    return f"CASE WHEN {c} IS NULL OR {h} IN ('', '-') THEN 'Unknown' ELSE {h} END"


def fix_percent(c: str) -> str:
    """'%' not followed by two hex digits -> '%25' (RE2 has no look-ahead)."""
    marked = f"regexp_replace({c}, '%([0-9A-Fa-f]{{2}})', chr(1) || '\\1', 'g')"
    return f"replace(replace({marked}, '%', '%25'), chr(1), '%')"


def decode_uri(c: str) -> str:
    return f"url_decode({fix_percent(c)})"


def decode_form(c: str) -> str:
    return f"url_decode(replace({fix_percent(c)}, '+', ' '))"


def after_netloc(c: str) -> str:
    return (f"regexp_replace(regexp_replace({c}, '^[a-zA-Z][a-zA-Z0-9+.-]*:', ''), "
            f"'^//[^/?#]*', '')")


def url_path(c: str) -> str:
    return f"regexp_replace(regexp_extract({after_netloc(c)}, '^([^?#]*)', 1), ';[^/]*$', '')"


def url_query(c: str) -> str:
    return f"regexp_extract({after_netloc(c)}, '^[^?#]*\\?([^#]*)', 1)"


def query_list(c: str) -> str:
    k = decode_form("regexp_extract(x, '^([^=]*)=', 1)")
    v = decode_form("regexp_extract(x, '(?s)^[^=]*=(.*)$', 1)")
    items = f"list_filter(string_split({url_query(c)}, '&'), lambda x: regexp_matches(x, '(?s)=.'))"
    return f"list_transform({items}, lambda x: {k} || '=' || {v})"



def weblog_with(*stages: str) -> str:
    """``WITH weblog, parsed, ...`` plus extra named stages."""
    parts = [WEBLOG_SQL, PARSED_SQL]
    return "WITH " + ",\n".join(parts + list(stages)) + "\n"


def cleaned_with(*stages: str) -> str:
    return weblog_with(NULLED_SQL, CLEANED_SQL, *stages)


# ---- murmur3 (public algorithm, 32 bits) -------------------------------------
# Its multipliers and the seed that Spark's feature hashing uses.
_C1, _C2, _N, _F1, _F2, _HASH_SEED = 3432918353, 461845907, 3864292196, 2246822507, 3266489909, 42
_M32 = 4294967296


def _rotated(x: str, by: int) -> str:
    return f"(((({x}) << {by}) | (({x}) >> {32 - by})) % {_M32})"


def _mixed(k: str) -> str:
    """One four-byte block before it joins the hash."""
    return f"(({_rotated(f'({k}) * {_C1} % {_M32}', 15)}) * {_C2} % {_M32})"


def hash_buckets(terms: str, n: int, name: str = "buckets") -> str:
    """CTEs ending in ``name(term, bucket)``: the bucket of ``n`` in which
    feature hashing puts each term of the CTE ``terms(term)``."""
    byte = lambda i: f"CAST(('0x' || substr(h, CAST(2 * ({i}) + 1 AS BIGINT), 2)) AS UBIGINT)"
    block = " + ".join(f"({byte(f'4 * i + {j}')} << {8 * j})" for j in range(4))
    tail = " + ".join(f"(CASE WHEN n % 4 > {j} THEN {byte(f'n // 4 * 4 + {j}')} << {8 * j} ELSE 0::UBIGINT END)" for j in range(3))
    step = f"((({_rotated('xor(a, x)', 13)}) * 5 + {_N}) % {_M32})"
    return f"""{name}_0 AS (SELECT term, hex(term) AS h, CAST(octet_length(encode(term)) AS BIGINT) AS n FROM (SELECT DISTINCT term FROM {terms})),
{name}_1 AS (SELECT term, n, list_transform(range(0, n // 4), lambda i: CAST({_mixed(block)} AS UBIGINT)) AS blocks, CAST({tail} AS UBIGINT) AS t FROM {name}_0),
{name}_2 AS (SELECT term, n, t, list_reduce(list_prepend({_HASH_SEED}::UBIGINT, blocks), lambda a, x: CAST({step} AS UBIGINT)) AS a FROM {name}_1),
{name}_3 AS (SELECT term, xor(xor(a, CAST({_mixed('t')} AS UBIGINT)), CAST(n AS UBIGINT)) AS a FROM {name}_2),
{name}_4 AS (SELECT term, xor(a, a >> 16) * {_F1}::UBIGINT % {_M32}::UBIGINT AS a FROM {name}_3),
{name}_5 AS (SELECT term, xor(a, a >> 13) * {_F2}::UBIGINT % {_M32}::UBIGINT AS a FROM {name}_4),
{name}_6 AS (SELECT term, CAST(xor(a, a >> 16) AS BIGINT) AS a FROM {name}_5),
{name} AS (SELECT term, (((a - CASE WHEN a >= 2147483648 THEN {_M32} ELSE 0 END) % {n}) + {n}) % {n} AS bucket FROM {name}_6)"""


def joined_runs(words: str, n: int) -> str:
    """All runs of ``n`` neighbouring list elements, joined by a space."""
    return f"list_transform(range(1, CAST(len({words}) AS BIGINT) - {n} + 2), lambda i: array_to_string(({words})[i:i + {n - 1}], ' '))"
