"""Operator 2: judge URLs by host and path-prefix rules, as a sort-merge range join.

The canonical key of a host and a path is the host's labels from the top-level domain down, then a separator, then the
path. A rule's key is a prefix of the keys that it fits, so a rule is the interval of all keys that begin with its own.
A rule also fits subdomains: a URL is therefore looked up under the suffixes of its host with as many labels as some
rule has at most (a longer suffix fits nothing, so a host of many labels costs no more). Rules and URL keys are sorted
together, and one sweep keeps a stack of the rules whose intervals are open (prefix intervals are nested or disjoint);
the top of the stack is the longest rule for a key.

The key space is cut into ranges at keys of a seeded sample of distinct keys (the sample decides balance only), several
ranges for each shuffle partition; bounds are the first ``BOUND_CHARS`` characters of a key. A rule is sent to each range that its interval meets, so every range is swept on its
own. Only distinct (host, path) pairs are swept; a URL that many rows repeat is swept once and joined back.

The longest rule is the one with the longest host and path together, then the longest host, then block before allow.

Defined cases: a null URL, or one without ``://``, has empty host and path and gets the default verdict; so does every
URL without a fitting rule or with an empty rule table. A URL without a path doesn't begin with ``/``, so a rule with a
path doesn't fit it. Repeated rows are judged alike. Null rule hosts or paths count as empty; a rule with an empty host
fits nothing. Other columns are kept, whatever their names; host, path, rule and verdict are replaced."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGES_A_PARTITION = 8
SAMPLED_A_RANGE = 16
BOUND_CHARS = 256
JUDGED = ("host", "path", "rule", "verdict")
SWEPT = "host string, path string, rule string, verdict string, rule_host int, rule_length int"


def host_and_path(url: str = "url"):
    """(host, path) columns of a URL column: from the first ``://`` on."""
    rest = F.expr(f"substring({url}, locate('://', {url}) + 3)")
    rest = F.when(F.col(url).isNull() | (F.locate("://", F.col(url)) == 0), F.lit("")).otherwise(rest)
    rest = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/]*)", 1)
    return lower_ascii(host), F.substr(rest, F.length(host) + 1)


def lower_ascii(c):
    """A-Z of a column lower-cased."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def canonical_key(labels, path):
    """Key of host labels (an array column, top-level domain last) and a path. The separator sorts before, and the
    escape keeps, whatever a label holds."""
    return F.concat(F.replace(F.replace(F.array_join(F.reverse(labels), "."), F.lit("\x01"), F.lit("\x01\x02")), F.lit("\x00"), F.lit("\x01\x01")), F.lit("\x00"), path)


def _range_of(bounds: list[str]):
    @F.pandas_udf("int")
    def run(keys: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, k) for k in keys], dtype="int32")
    return run


def _ranges_met(bounds: list[str]):
    """The ranges that the interval of a rule key meets: its own, and each later one that begins inside it."""
    @F.pandas_udf("array<int>")
    def run(keys: pd.Series) -> pd.Series:
        out = []
        for k in keys:
            n = bisect_right(bounds, k)
            met = [n]
            while n < len(bounds) and bounds[n].startswith(k):
                n += 1
                met.append(n)
            out.append(np.array(met, np.int32))
        return pd.Series(out)
    return run


def _sweep(batches):
    """Rows in order of (range, key, rules first); the stack holds the open rules of the range."""
    stack: list[tuple] = []
    at = None
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        columns = [batch.column(n).to_pylist() for n in ("range", "key", "is_url", "host", "path", "rule", "verdict", "rule_host", "rule_length")]
        for number, key, is_url, host, path, *rule in zip(*columns, strict=True):
            if number != at:
                at, stack = number, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                if not (stack and stack[-1][0] == key):  # of equal rules the first, a block, stands
                    stack.append((key, *rule))
            else:
                for o, v in zip(out, (host, path, *(stack[-1][1:] if stack else (None, None, None, None))), strict=True):
                    o.append(v)
        yield pa.RecordBatch.from_arrays([*(pa.array(o, pa.string()) for o in out[:4]), *(pa.array(o, pa.int32()) for o in out[4:])],
                                         ["host", "path", "rule", "verdict", "rule_host", "rule_length"])


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (host and path of the longest fitting rule, else null) and verdict.

    ``rules`` has host, path and verdict (allow or block)."""
    spark = pages.sparkSession
    host, path = host_and_path(url)
    inner = pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("_row"), host.alias("host"), path.alias("path"))
    rules = rules.select(lower_ascii(F.coalesce("host", F.lit(""))).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host <> ''")
    labels = F.split("host", "[.]")
    most = rules.agg(F.max(F.size(labels))).first()[0] or 1
    suffixes = F.sequence(F.greatest(F.lit(1), F.size(labels) - most + 1), F.size(labels))
    urls = inner.select("host", "path").distinct()
    urls = urls.withColumn("key", F.explode(F.transform(suffixes, lambda i: canonical_key(F.slice(labels, i, F.size(labels)), F.col("path")))))
    rules = rules.select("host", "path", canonical_key(F.split("host", "[.]"), F.col("path")).alias("key"), F.concat("host", "path").alias("rule"), "verdict",
                         F.length("host").alias("rule_host"), F.length(F.concat("host", "path")).alias("rule_length")).distinct()

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = RANGES_A_PARTITION * partitions
    drawn = urls.select("key", F.xxhash64("key", F.lit(5)).alias("draw")).orderBy("draw", "key").limit(SAMPLED_A_RANGE * ranges).select(F.left("key", F.lit(BOUND_CHARS)).alias("key")).toPandas()["key"]
    drawn = sorted(set(drawn))
    bounds = [drawn[len(drawn) * k // ranges] for k in range(1, ranges)] if len(drawn) >= 2 * ranges else drawn[1::2]
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    both = urls.select(_range_of(bounds)("key").alias("range"), "key", F.lit(True).alias("is_url"), "host", "path", none("rule", "string"), none("verdict", "string"), none("rule_host", "int"), none("rule_length", "int")).unionByName(
        rules.select(F.explode(_ranges_met(bounds)("key")).alias("range"), "key", F.lit(False).alias("is_url"), "host", "path", "rule", "verdict", "rule_host", "rule_length"))
    order = F.when(F.col("verdict") == "block", 0).otherwise(1)
    swept = both.withColumn("order", order).repartition(partitions, "range").sortWithinPartitions("range", "key", "is_url", "order").drop("order").mapInArrow(_sweep, SWEPT)
    best = swept.where("rule is not null").groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.struct("rule_length", "rule_host")).alias("best"))
    others = [F.col(f"_row.`{c}`") for c in pages.columns if c.lower() not in JUDGED]
    return inner.join(best, ["host", "path"], "left").select(*others, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


#: The rules of the registered query.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def oracle_sql(rules=RULES, default: str = "allow") -> str:
    """The same result in DuckDB SQL, by holding every rule against every URL."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""WITH r(rh, rp, rv) AS (VALUES {values}),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^([^?#]*)', 1) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  substr(rest, length(regexp_extract(rest, '^([^/]*)', 1)) + 1) AS path FROM u)
SELECT page_id, host, path,
  (SELECT max_by(rh || rp, length(rh || rp)) FROM r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS rule,
  coalesce((SELECT max_by(rv, length(rh || rp)) FROM r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)), '{default}') AS verdict
FROM h"""
