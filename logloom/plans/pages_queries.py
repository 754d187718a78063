"""Registered queries over ``pages``: URL functions, path words, n-grams."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.functions import text, url
from logloom.operators.stats import length_stats
from logloom.plans import oracle_sql as O
from logloom.sources.tables import read_table


def _pages(spark, sf_dir):
    return read_table(spark, sf_dir, "pages", "page_id", "url")


def _decoded(spark, sf_dir):
    return _pages(spark, sf_dir).withColumn("dec_url", url.decode_uri("url"))


def q_url_parts(spark, sf_dir):
    return _decoded(spark, sf_dir).select(
        "page_id", "dec_url", url.url_path("dec_url").alias("path"),
        url.url_query("dec_url").alias("query"), url.url_netloc("url").alias("netloc"))


def q_query_params(spark, sf_dir):
    df = _decoded(spark, sf_dir)
    return df.select("page_id", F.posexplode(url.query_list("dec_url")).alias("pos", "param")) \
             .select("page_id", F.col("pos").cast("bigint").alias("pos"), "param")


def q_referer_domain(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", url.referer_domain("url").alias("domain"))


def _exploded(df, arr, name):
    return df.select("page_id", F.posexplode(arr).alias("pos", name)).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), name)


def _path(spark, sf_dir):
    return _decoded(spark, sf_dir).withColumn("path", url.url_path("dec_url"))


def q_path_char_ngrams(spark, sf_dir):
    df = _path(spark, sf_dir)
    return _exploded(df, text.ngrams(text.characters("path"), 9), "ngram")


def q_path_word_ngrams(spark, sf_dir):
    df = _path(spark, sf_dir)
    return _exploded(df, text.ngrams(text.path_words("path"), 2), "ngram")


def q_url_features(spark, sf_dir):
    df = _path(spark, sf_dir)
    feats = F.concat(text.ngrams(text.characters("path"), 9),
                     F.transform(url.query_list("dec_url"), url.param_key))
    return _exploded(df, feats, "feature")


def q_query_kv(spark, sf_dir):
    df = _decoded(spark, sf_dir).select(
        "page_id", F.explode_outer(url.query_list("dec_url")).alias("query_param"))
    kv = F.split("query_param", "=")
    return df.select("page_id", "query_param",
                     F.try_element_at(kv, F.lit(1)).alias("query_key"),
                     F.try_element_at(kv, F.lit(2)).alias("query_value"))


def q_path_word_stats(spark, sf_dir):
    words = _path(spark, sf_dir).select(F.explode(text.path_words("path")).alias("word"))
    return words.agg(F.count(F.lit(1)).alias("n_words"),
                     F.count_distinct("word").alias("n_distinct_words"),
                     *length_stats(F.length("word"), "word_length"))


def q_path_depth_stats(spark, sf_dir):
    d = _path(spark, sf_dir).select(F.size(text.path_words("path")).alias("depth"))
    return d.agg(*length_stats(F.col("depth"), "depth"))


_DEC = f"SELECT page_id, url, {O.decode_uri('url')} AS dec_url FROM pages"
_PATH = f"SELECT *, {O.url_path('dec_url')} AS path FROM ({_DEC})"


def _chars(c):
    return f"string_split({c}, '')"


def _ngrams(arr, n):
    return (f"list_transform(range(1, len({arr}) - {n} + 2), "
            f"lambda i: array_to_string({arr}[i:i + {n - 1}], ' '))")


def _words(c):
    return f"string_split(regexp_replace({c}, '^/', ''), '/')"


def _explode(src, arr, name):
    return (f"SELECT page_id, CAST(unnest(range(len(a))) AS BIGINT) AS pos, unnest(a) AS {name} "
            f"FROM (SELECT page_id, {arr} AS a FROM ({src}))")


SQL = {
    "url_parts": f"""SELECT page_id, dec_url, {O.url_path('dec_url')} AS path,
        {O.url_query('dec_url')} AS query, regexp_extract(url, '{O.NETLOC_RE}', 1) AS netloc FROM ({_DEC})""",
    "query_params": _explode(_DEC, O.query_list("dec_url"), "param"),
    "referer_domain": f"SELECT page_id, {O.domain_sql('url')} AS domain FROM pages",
    "path_char_ngrams": _explode(_PATH, _ngrams(_chars("path"), 9), "ngram"),
    "path_word_ngrams": _explode(_PATH, _ngrams(_words("path"), 2), "ngram"),
    "url_features": _explode(
        _PATH, f"list_concat({_ngrams(_chars('path'), 9)}, "
               f"list_transform({O.query_list('dec_url')}, lambda x: string_split(x, '=')[1]))",
        "feature"),
    "query_kv": f"""SELECT page_id, query_param, string_split(query_param, '=')[1] AS query_key,
        string_split(query_param, '=')[2] AS query_value
        FROM (SELECT page_id, unnest(CASE WHEN len(l) = 0 THEN [NULL] ELSE l END) AS query_param
              FROM (SELECT page_id, {O.query_list('dec_url')} AS l FROM ({_DEC})))""",
    "path_word_stats": f"""SELECT count(*) AS n_words, count(DISTINCT word) AS n_distinct_words,
        CAST(min(length(word)) AS BIGINT) AS min_word_length, CAST(max(length(word)) AS BIGINT) AS max_word_length,
        round(avg(length(word)), 6) AS avg_word_length, round(stddev_samp(length(word)), 6) AS stddev_word_length
        FROM (SELECT unnest({_words('path')}) AS word FROM ({_PATH}))""",
    "path_depth_stats": f"""SELECT CAST(min(d) AS BIGINT) AS min_depth, CAST(max(d) AS BIGINT) AS max_depth,
        round(avg(d), 6) AS avg_depth, round(stddev_samp(d), 6) AS stddev_depth
        FROM (SELECT len({_words('path')}) AS d FROM ({_PATH}))""",
}

QUERIES = {
    "url_parts": q_url_parts,
    "query_params": q_query_params,
    "referer_domain": q_referer_domain,
    "path_char_ngrams": q_path_char_ngrams,
    "path_word_ngrams": q_path_word_ngrams,
    "url_features": q_url_features,
    "query_kv": q_query_kv,
    "path_word_stats": q_path_word_stats,
    "path_depth_stats": q_path_depth_stats,
}


# ---- similarity join over all page URLs (J-02) ---------------------------------

URL_MAX_DISTANCE = 3


def q_url_pair_distance(spark, sf_dir):
    from logloom.operators.similarity import similar_pairs
    return similar_pairs(_pages(spark, sf_dir), "url", k=URL_MAX_DISTANCE,
                         left="url_a", right="url_b")


SQL["url_pair_distance"] = f"""WITH u AS (SELECT DISTINCT url FROM pages)
SELECT a.url AS url_a, b.url AS url_b, CAST(levenshtein(a.url, b.url) AS BIGINT) AS levenshtein_distance
FROM u a JOIN u b ON a.url <> b.url AND abs(length(a.url) - length(b.url)) <= {URL_MAX_DISTANCE}
WHERE levenshtein(a.url, b.url) <= {URL_MAX_DISTANCE}"""
QUERIES["url_pair_distance"] = q_url_pair_distance
