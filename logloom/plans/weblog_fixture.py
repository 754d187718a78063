"""The ``weblog`` fixture: one access-log line per event, built from
``events`` and ``pages`` (see FIXTURES.md section C).

The Spark plan and the DuckDB text below implement the same definition;
keep them together. The lines are written once as text to the shared
checkpoint folder and read back, as a real job reads its logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.sources import staging
from logloom.sources.tables import read_table, spread, table_path


def weblog_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # spread() on the scan (cheap to inspect) so the join output, and the
    # text files written from it, use every task slot.
    ev = spread(read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type"))
    pages = read_table(spark, sf_dir, "pages", "page_id", "url")
    # Page count as a scalar subquery: one row, so the join below stays an
    # equi-join (broadcast or sort-merge, AQE's choice by measured size).
    n_pages = pages.select(F.count(F.lit(1))).scalar()
    joined = (ev.withColumn("page_key", F.col("event_id") % n_pages)
                .join(pages, F.col("page_key") == F.col("page_id")))
    e, u = F.col("event_id"), F.col("user_id")
    uri = F.regexp_replace("url", r"^https?://[^/]*", "")
    line = F.concat(
        F.lit("10."), (u % 200).cast("string"), F.lit(".0.1 - "),
        F.when(u % 3 == 0, F.lit("-")).otherwise(F.concat(F.lit("u"), u.cast("string"))),
        F.lit(" ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000] \""),
        F.when(F.col("event_type") == "purchase", F.lit("POST"))
         .when(F.col("event_type") == "signup", F.lit("PUT")).otherwise(F.lit("GET")),
        F.lit(" "), F.when(uri == "", F.lit("/")).otherwise(uri), F.lit(" HTTP/1.1\" "),
        F.when(e % 17 == 0, F.lit("404")).otherwise(F.lit("200")), F.lit(" "),
        (e * 37 % 100000).cast("string"), F.lit(" \""),
        F.when(e % 11 == 0, F.lit("-")).when(e % 13 == 0, F.lit("")).otherwise(F.col("url")),
        F.lit("\" \"ua/"), (u % 7).cast("string"), F.lit("\""),
    )
    value = (F.when(F.col("event_type") == "error",
                    F.concat(F.lit("upstream error id="), e.cast("string")))
              .otherwise(line))
    return joined.select(value.alias("value"))


def weblog_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture as a text table in the shared folder (written once)."""
    key = staging.fingerprint(spark, table_path(sf_dir, "events"), table_path(sf_dir, "pages"))
    return staging.stage_text(spark, lambda: weblog_lines(spark, sf_dir), "weblog", key)


def weblog_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the staged text (written when missing)."""
    weblog_text(spark, sf_dir)
    key = staging.fingerprint(spark, table_path(sf_dir, "events"), table_path(sf_dir, "pages"))
    return staging.staged_dir(spark, "weblog", key)


# DuckDB form of the same lines, as a CTE named ``weblog(value)``.
WEBLOG_SQL = r"""
weblog AS (
  SELECT CASE WHEN e.event_type = 'error'
              THEN 'upstream error id=' || CAST(e.event_id AS VARCHAR)
         ELSE
           '10.' || CAST(e.user_id % 200 AS VARCHAR) || '.0.1 - '
           || CASE WHEN e.user_id % 3 = 0 THEN '-' ELSE 'u' || CAST(e.user_id AS VARCHAR) END
           || ' [' || strftime(e.ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "'
           || CASE e.event_type WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'PUT' ELSE 'GET' END
           || ' ' || CASE WHEN regexp_replace(p.url, '^https?://[^/]*', '') = '' THEN '/'
                          ELSE regexp_replace(p.url, '^https?://[^/]*', '') END
           || ' HTTP/1.1" '
           || CASE WHEN e.event_id % 17 = 0 THEN '404' ELSE '200' END
           || ' ' || CAST(e.event_id * 37 % 100000 AS VARCHAR) || ' "'
           || CASE WHEN e.event_id % 11 = 0 THEN '-' WHEN e.event_id % 13 = 0 THEN '' ELSE p.url END
           || '" "ua/' || CAST(e.user_id % 7 AS VARCHAR) || '"'
         END AS value
  FROM events e
  CROSS JOIN (SELECT count(*) AS n FROM pages) c
  JOIN pages p ON e.event_id % c.n = p.page_id
)"""
