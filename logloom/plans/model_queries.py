"""Registered classifier, metrics, clustering and vectorizer queries
(M-03, M-04, M-24..M-27)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from logloom.functions import text, url
from logloom.operators import classify as C
from logloom.operators import features as FE
from logloom.operators import sampling as S
from logloom.plans import oracle_sql as O
from logloom.plans.weblog_queries import _featured, extracted_tables
from logloom.sources.tables import read_table

TRAIN_FRACTION = 0.8
HASH_BUCKETS = 16384


def q_classify_domains(spark, sf_dir):
    """Classifier over the staged known-domain table: deterministic key
    split, label index fitted on the training rows, scored test rows."""
    known_root, _ = extracted_tables(spark, sf_dir)
    df = spark.read.parquet(known_root).select(
        "dateunixtimest", "clean_path", "domain", *C.CLASSIFIER_FEATURES)
    key = F.concat_ws("|", "dateunixtimest", "clean_path")
    df = df.withColumn("_key", key)
    train, test = S.hash_split(df, [TRAIN_FRACTION, 1 - TRAIN_FRACTION], "_key")
    model = C.train_domain_classifier(train)
    return model.transform(test).select("domain", "label", "prediction")


def q_classification_metrics(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels", "quality", "toxic")
    pred = lab.select(F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))
    m = C.classification_metrics(pred)
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


def q_kmeans_traffic(spark, sf_dir):
    df = _featured(spark, sf_dir).filter(F.size("clean_query_list") > 0).select(
        "clean_path", "fabstime", F.col("body_bytes_sent").cast("double").alias("body_bytes_sent"))
    _, out = C.kmeans_clusters(df, ["fabstime", "body_bytes_sent"], k=25, seed=1)
    return out.select("clean_path", "fabstime", "body_bytes_sent", "cluster")


def q_hashed_url_features(spark, sf_dir):
    """M-03 per page: each bucket of the hashed path 9-grams and parameter
    keys with its weight, read from the vector's own sparse form."""
    pages = read_table(spark, sf_dir, "pages", "page_id", "url").withColumn(
        "dec", url.decode_uri("url"))
    feats = pages.withColumn("url_features", F.concat(
        text.ngrams(text.characters(url.url_path("dec")), 9),
        F.transform(url.query_list("dec"), url.param_key)))
    hashed = FE.hash_features(feats, "url_features", "hash_url_features", HASH_BUCKETS)
    return FE.hashed_entries(hashed, ["page_id"], "hash_url_features")


def q_param_vocabulary(spark, sf_dir):
    """M-04 vocabulary: every term, its count and index."""
    pages = read_table(spark, sf_dir, "pages", "url").select(
        url.query_list(url.decode_uri("url")).alias("params"))
    return FE.vocabulary(pages, "params")


SQL = {
    "hashed_url_features": f"""WITH p AS (SELECT page_id, {O.url_path(O.decode_uri('url'))} AS path, {O.query_list(O.decode_uri('url'))} AS items FROM pages),
terms AS (SELECT page_id, unnest(list_concat(list_transform(range(1, CAST(length(path) AS BIGINT) - 7), lambda i: array_to_string([substr(path, CAST(i + k AS BIGINT), 1) FOR k IN range(0, 9)], ' ')),
                                             list_transform(items, lambda x: string_split(x, '=')[1]))) AS term FROM p),
{O.hash_buckets('terms', HASH_BUCKETS)}
SELECT page_id, bucket, CAST(count(*) AS DOUBLE) AS weight FROM terms JOIN buckets USING (term) GROUP BY page_id, bucket""",
    "param_vocabulary": f"""SELECT term, CAST(row_number() OVER (ORDER BY n DESC, term) - 1 AS BIGINT) AS term_index, n
FROM (SELECT term, count(*) AS n FROM (SELECT unnest({O.query_list(O.decode_uri('url'))}) AS term FROM pages) GROUP BY term)""",
    "classification_metrics": """WITH p AS (SELECT CAST(quality AS DOUBLE) AS y, CAST(1 - toxic AS DOUBLE) AS p FROM labels),
conf AS (SELECT y, p, count(*) AS n FROM p GROUP BY y, p),
lab AS (SELECT y, sum(n) AS n_label, sum(CASE WHEN y = p THEN n ELSE 0 END) AS tp FROM conf GROUP BY y),
prd AS (SELECT p AS y, sum(n) AS n_pred FROM conf GROUP BY p),
cls AS (SELECT n_label, tp, CASE WHEN coalesce(n_pred, 0) > 0 THEN tp / n_pred ELSE 0.0 END AS prec,
               tp / n_label AS rec FROM lab LEFT JOIN prd USING (y)),
cls2 AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM cls)
SELECT round(sum(tp) / sum(n_label), 6) AS accuracy,
       round(sum(prec * n_label) / sum(n_label), 6) AS weighted_precision,
       round(sum(rec * n_label) / sum(n_label), 6) AS weighted_recall,
       round(sum(f1 * n_label) / sum(n_label), 6) AS f1 FROM cls2""",
}

QUERIES = {
    "classify_domains": q_classify_domains,
    "classification_metrics": q_classification_metrics,
    "kmeans_traffic": q_kmeans_traffic,
    "hashed_url_features": q_hashed_url_features,
    "param_vocabulary": q_param_vocabulary,
}
