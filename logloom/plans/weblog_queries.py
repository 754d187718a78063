"""Registered queries over the ``weblog`` fixture and the extracted log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions import url
from logloom.operators import weblog as W
from logloom.plans import oracle_sql as O
from logloom.plans.weblog_fixture import weblog_text
from logloom.sources import staging
from logloom.sources.tables import read_table, table_path

KNOWN_SUFFIX = ".example.com"  # fixture rule: hosts under example.com are "known"
EXCLUDED_DOMAIN = "Unknown"    # params_by_domain leaves this domain out


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.clean_log(W.parse_access_log(weblog_text(spark, sf_dir)))


def _featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.add_time_columns(W.add_url_columns(_cleaned(spark, sf_dir)))


def domain_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered domains: page hosts under the known suffix."""
    pages = read_table(spark, sf_dir, "pages", "url")
    host = url.url_netloc("url")
    return pages.select(host.alias("domain")).filter(F.col("domain").endswith(KNOWN_SUFFIX)).distinct()


def _with_path_features(df: DataFrame) -> DataFrame:
    """``df`` with the path features before its index columns."""
    index = [c for c in df.columns if c.endswith(("_index", "_onehot"))]
    wide = W.add_path_features(df)
    return wide.select(*[c for c in wide.columns if c not in index], *index)


def extracted_tables(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Run the full extract once and stage it: known rows partitioned by
    domain, unknown rows unpartitioned (K-01, K-02). Returns both roots."""
    key = staging.fingerprint(spark, table_path(sf_dir, "events"), table_path(sf_dir, "pages"))
    known_root = staging.staged_dir(spark, "extract-known", key)
    unknown_root = staging.staged_dir(spark, "extract-unknown", key)
    if not (staging.path_exists(spark, f"{known_root}/_SUCCESS")
            and staging.path_exists(spark, f"{unknown_root}/_SUCCESS")):
        # Built only when needed: the index fits inside run jobs. The log is
        # parsed once, into a scratch table of the plain columns that the
        # index fits and both writes read; the path features, which are many
        # times as wide, are computed by the tasks that write them.
        plain = staging.materialize(W.extract_columns(weblog_text(spark, sf_dir)), "extract")
        ext = W.add_indexed_columns(plain)
        known, unknown = W.split_known(ext, domain_registry(spark, sf_dir))
        known_root = staging.stage_parquet(spark, known, "extract-known", key, ["domain"], finish=_with_path_features)
        unknown_root = staging.stage_parquet(spark, unknown, "extract-unknown", key, finish=_with_path_features)
    return known_root, unknown_root


# ---- queries ---------------------------------------------------------------

def q_hits_by_domain(spark, sf_dir):
    return W.hits_by_domain(_cleaned(spark, sf_dir))


def q_parse_access_log(spark, sf_dir):
    return W.parse_access_log(weblog_text(spark, sf_dir))


def q_rejected_lines(spark, sf_dir):
    return W.rejected_lines(weblog_text(spark, sf_dir))


def q_blank_to_null(spark, sf_dir):
    return W.blank_to_null(W.parse_access_log(weblog_text(spark, sf_dir)))


def q_clean_log(spark, sf_dir):
    return _cleaned(spark, sf_dir)


_SPLIT_COLS = ["remote_addr", "req_method", "clean_path", "status", "body_bytes_sent",
               "domain", "dateunixtimest"]


def q_known_domains(spark, sf_dir):
    known, _ = W.split_known(_featured(spark, sf_dir), domain_registry(spark, sf_dir))
    return known.select(*_SPLIT_COLS)


def q_unknown_domains(spark, sf_dir):
    _, unknown = W.split_known(_featured(spark, sf_dir), domain_registry(spark, sf_dir))
    return unknown.select(*_SPLIT_COLS)


def q_rows_with_query(spark, sf_dir):
    df = _featured(spark, sf_dir)
    return (df.filter(F.size("clean_query_list") > 0)
              .select("clean_path", "domain", F.size("clean_query_list").cast("bigint").alias("n_params")))


def q_params_by_domain(spark, sf_dir):
    df = _featured(spark, sf_dir).select(
        "domain", F.explode_outer("clean_query_list").alias("query_param"))
    return (df.filter((F.col("domain") != EXCLUDED_DOMAIN) & F.col("query_param").isNotNull())
              .groupBy("domain").agg(F.count(F.lit(1)).alias("n_params")))


def q_log_time_features(spark, sf_dir):
    df = _featured(spark, sf_dir)
    return df.select("date_time", F.col("fdate_time").cast("timestamp_ntz").alias("fdate_time"),
                     "dateunixtimest", "fabstime",
                     F.col("day_of_week").cast("bigint").alias("day_of_week"))


def q_log_url_columns(spark, sf_dir):
    df = _featured(spark, sf_dir)
    return df.select("req_uri", "dec_req_uri", "clean_path",
                     F.array_join("clean_query_list", "&").alias("query_items"), "domain")


def q_project_known(spark, sf_dir):
    known_root, _ = extracted_tables(spark, sf_dir)
    return spark.read.parquet(known_root).select(
        "domain", "clean_path", "status", "body_bytes_sent", "fabstime",
        F.col("day_of_week").cast("bigint").alias("day_of_week"))


def q_partition_scan(spark, sf_dir):
    """S-05/P-10: one domain partition. The domain (the first known one) is a
    scalar subquery, so the partition filter is applied at run time."""
    known_root, _ = extracted_tables(spark, sf_dir)
    df = spark.read.parquet(known_root)
    first = df.select(F.min("domain")).scalar()
    return df.filter(F.col("domain") == first).select(
        "domain", "clean_path", "req_method", "status", "body_bytes_sent")


def q_string_index(spark, sf_dir):
    """M-05 as a distributed rank (no label list on the driver); equals
    StringIndexer's frequency order with alphabetical ties."""
    from logloom.operators.features import index_labels
    df = _featured(spark, sf_dir).select("domain")
    return index_labels(df, "domain", "domain_index")


def q_one_hot(spark, sf_dir):
    """M-06 by the extract's own operator."""
    from pyspark.ml.functions import vector_to_array
    df = W.add_indexed_columns(_featured(spark, sf_dir).select("req_method"), ["req_method"])
    arr = vector_to_array(F.col("req_method_onehot"))
    return df.select(
        "req_method", F.col("req_method_index").cast("bigint").alias("req_method_index"),
        F.size(arr).cast("bigint").alias("onehot_size"),
        F.when(F.array_position(arr, 1.0) > 0, F.array_position(arr, 1.0) - 1)
         .alias("hot_position")).distinct()


# ---- oracle SQL --------------------------------------------------------------

_FEATURED = O.cleaned_with(f"""featured AS (
  SELECT *, {O.decode_uri('req_uri')} AS dec_req_uri, {O.domain_sql('http_referer')} AS domain,
         CASE WHEN regexp_matches(date_time, '^\\d{{2}}/[A-Za-z]{{3}}/\\d{{4}}:\\d{{2}}:\\d{{2}}:\\d{{2}} [+-]\\d{{4}}$')
              THEN try_strptime(substr(date_time, 1, 20), '%d/%b/%Y:%H:%M:%S')
                   - to_minutes(CAST((CASE WHEN substr(date_time, 22, 1) = '-' THEN -1 ELSE 1 END)
                     * (CAST(substr(date_time, 23, 2) AS INTEGER) * 60
                        + CAST(substr(date_time, 25, 2) AS INTEGER)) AS BIGINT)) END AS fdate_time
  FROM cleaned
), featured2 AS (
  SELECT *, {O.url_path('dec_req_uri')} AS clean_path, {O.query_list('dec_req_uri')} AS clean_query_list,
         CAST(epoch(fdate_time) AS BIGINT) AS dateunixtimest,
         hour(fdate_time) + minute(fdate_time) / 60.0 AS fabstime,
         CAST(dayofweek(fdate_time) + 1 AS BIGINT) AS day_of_week
  FROM featured
), registry AS (
  SELECT DISTINCT regexp_extract(url, '{O.NETLOC_RE}', 1) AS domain FROM pages
  WHERE regexp_extract(url, '{O.NETLOC_RE}', 1) LIKE '%{KNOWN_SUFFIX}'
)""")

_SPLIT_SQL_COLS = ", ".join(_SPLIT_COLS)

SQL = {
    "hits_by_domain": O.cleaned_with() + f"""
SELECT {O.domain_sql('http_referer')} AS domain, count(*) AS hits FROM cleaned GROUP BY 1""",
    "parse_access_log": O.weblog_with() + "SELECT * FROM parsed",
    "rejected_lines": "WITH " + O.WEBLOG_SQL + f"""
SELECT value FROM weblog WHERE NOT regexp_matches(value, '{O.PATTERN_SQL}')""",
    "blank_to_null": O.weblog_with(O.NULLED_SQL) + "SELECT * FROM nulled",
    "clean_log": O.cleaned_with() + "SELECT * FROM cleaned",
    "known_domains": _FEATURED + f"""
SELECT {_SPLIT_SQL_COLS} FROM featured2 WHERE domain IN (SELECT domain FROM registry)""",
    "unknown_domains": _FEATURED + f"""
SELECT {_SPLIT_SQL_COLS} FROM featured2 WHERE domain NOT IN (SELECT domain FROM registry)""",
    "rows_with_query": _FEATURED + """
SELECT clean_path, domain, CAST(len(clean_query_list) AS BIGINT) AS n_params
FROM featured2 WHERE len(clean_query_list) > 0""",
    "params_by_domain": _FEATURED + f"""
SELECT domain, count(*) AS n_params
FROM (SELECT domain, unnest(clean_query_list) AS query_param FROM featured2)
WHERE domain <> '{EXCLUDED_DOMAIN}' AND query_param IS NOT NULL GROUP BY domain""",
    "log_time_features": _FEATURED + """
SELECT date_time, fdate_time, dateunixtimest, fabstime, day_of_week FROM featured2""",
    "log_url_columns": _FEATURED + """
SELECT req_uri, dec_req_uri, clean_path, array_to_string(clean_query_list, '&') AS query_items, domain
FROM featured2""",
    "project_known": _FEATURED + """
SELECT domain, clean_path, status, body_bytes_sent, fabstime, day_of_week
FROM featured2 WHERE domain IN (SELECT domain FROM registry)""",
    "partition_scan": _FEATURED + """
SELECT domain, clean_path, req_method, status, body_bytes_sent FROM featured2
WHERE domain = (SELECT min(domain) FROM featured2 WHERE domain IN (SELECT domain FROM registry))""",
    "string_index": _FEATURED + """
SELECT domain, CAST(row_number() OVER (ORDER BY n DESC, domain) - 1 AS BIGINT) AS domain_index
FROM (SELECT domain, count(*) AS n FROM featured2 GROUP BY domain)""",
    "one_hot": _FEATURED + """
SELECT req_method, idx AS req_method_index, CAST(k - 1 AS BIGINT) AS onehot_size,
       CASE WHEN idx < k - 1 THEN idx END AS hot_position
FROM (SELECT req_method, CAST(row_number() OVER (ORDER BY n DESC, req_method) - 1 AS BIGINT) AS idx,
             count(*) OVER () AS k
      FROM (SELECT req_method, count(*) AS n FROM featured2 GROUP BY req_method))""",
}

QUERIES = {
    "hits_by_domain": q_hits_by_domain,
    "parse_access_log": q_parse_access_log,
    "rejected_lines": q_rejected_lines,
    "blank_to_null": q_blank_to_null,
    "clean_log": q_clean_log,
    "known_domains": q_known_domains,
    "unknown_domains": q_unknown_domains,
    "rows_with_query": q_rows_with_query,
    "params_by_domain": q_params_by_domain,
    "log_time_features": q_log_time_features,
    "log_url_columns": q_log_url_columns,
    "project_known": q_project_known,
    "partition_scan": q_partition_scan,
    "string_index": q_string_index,
    "one_hot": q_one_hot,
}


# ---- similarity joins (J-01) -------------------------------------------------

PATH_MAX_DISTANCE = 2


def q_similar_paths(spark, sf_dir):
    from logloom.operators.similarity import similar_pairs
    df = _featured(spark, sf_dir).select("domain", "clean_path")
    return similar_pairs(df, "clean_path", ["domain"], k=PATH_MAX_DISTANCE,
                         left="path_a", right="path_b")


SQL["similar_paths"] = _FEATURED + f""", p AS (SELECT DISTINCT domain, clean_path FROM featured2)
SELECT a.domain, a.clean_path AS path_a, b.clean_path AS path_b,
       CAST(levenshtein(a.clean_path, b.clean_path) AS BIGINT) AS levenshtein_distance
FROM p a JOIN p b ON a.domain = b.domain AND a.clean_path <> b.clean_path
WHERE levenshtein(a.clean_path, b.clean_path) <= {PATH_MAX_DISTANCE}"""
QUERIES["similar_paths"] = q_similar_paths
