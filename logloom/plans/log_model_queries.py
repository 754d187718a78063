"""Registered queries that train and score models on the extracted log:
SOM and autoencoder over one domain's rows, fitted label indexes, the
classifier's held-out rows, a k-means step, and a saved pipeline."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from logloom.functions import url
from logloom.operators import autoencoder as AE
from logloom.operators import classify as C
from logloom.operators import features as FE
from logloom.operators import sampling as S
from logloom.operators import som as SOM
from logloom.operators import stages as ST
from logloom.operators import weblog as W
from logloom.plans import oracle_sql as O
from logloom.plans.autoencoder_queries import fixed_autoencoder
from logloom.plans.weblog_fixture import weblog_text
from logloom.plans.weblog_queries import _FEATURED, _cleaned, _featured, domain_registry, extracted_tables
from logloom.sources.staging import scratch_dir

GRID_M, GRID_N, BUCKETS, SIGMA = 3, 4, 1000, 1.0
NODES = GRID_M * GRID_N
AE_FEATURES, AE_HIDDEN = ["fabstime", "body_bytes_sent"], 3
TRAIN_HIDDEN, TRAIN_EPOCHS, AE_THRESHOLD = [64, 32, 16, 32, 64], 5, 0.1
K_MEANS = 25
SOFTMAX_FEATURES = ["fabstime", "day_of_week", "sent"]
SPLIT_KEY = "split_key"


def _one_domain(spark, sf_dir):
    """The partition of the first known domain."""
    root, _ = extracted_tables(spark, sf_dir)
    known = spark.read.parquet(root)
    return known.where(F.col("domain") == known.select(F.min("domain")).scalar())


def log_codebook(lo: np.ndarray, hi: np.ndarray, nodes: int = NODES) -> np.ndarray:
    """A fixed codebook inside the feature bounds, reproducible in SQL:
    w[j][d] = lo_d + ((37 j + 11 d) mod 101) / 100 (hi_d - lo_d)."""
    j, d = np.arange(nodes)[:, None], np.arange(len(lo))[None, :]
    return lo + ((j * 37 + d * 11) % 101) / 100.0 * (hi - lo)


def _log_som(spark, sf_dir):
    rows = FE.log_vectors(_one_domain(spark, sf_dir), BUCKETS)
    return rows, SOM.SomModel(GRID_M, GRID_N, log_codebook(*SOM.feature_bounds(rows, "features")))


_ROW = ["date_time", "clean_path", "body_bytes_sent"]


def q_som_log_bmu(spark, sf_dir):
    """M-15/M-17 on sparse log vectors of one domain."""
    rows, model = _log_som(spark, sf_dir)
    return model.score(rows, "features", _ROW).select(*_ROW, "bmu", F.round("distance", 6).alias("distance"))


def q_som_log_flags(spark, sf_dir):
    """M-18 on the same vectors."""
    rows, model = _log_som(spark, sf_dir)
    flagged = SOM.som_anomalies(model, rows, "features", _ROW, p=0.95)
    return flagged.where("is_anomaly").select(*_ROW, "bmu", F.round("distance", 6).alias("distance"))


def q_som_log_step(spark, sf_dir):
    """M-13/M-16: one batch step over the sparse vectors."""
    rows, model = _log_som(spark, sf_dir)
    s, c = SOM.bmu_statistics(rows, "features", model.weights)
    w1 = SOM.batch_update(model.weights, s, c, SOM.neighbourhood(GRID_M, GRID_N, SIGMA))
    return SOM.SomModel(GRID_M, GRID_N, w1).to_frame(spark).select(
        "node", F.posexplode("weights").alias("d", "weight")).select(
        "node", F.col("d").cast("bigint").alias("d"), F.round("weight", 6).alias("weight"))


def q_som_log_train(spark, sf_dir):
    """M-13 as it is used: constant rate 0.4, no decay, the radius cut off,
    mini-batches over the log vectors of one domain; flagged rows."""
    rows = FE.log_vectors(_one_domain(spark, sf_dir), BUCKETS)
    model = SOM.train_som(rows, "features", 10, 10, iterations=8, sigma=5, learning_rate=0.4, decay=False, cutoff=5, seed=3, bands=4)
    return SOM.som_anomalies(model, rows, "features", _ROW, p=0.95).select(*_ROW, "bmu", "distance", "is_anomaly")


def q_autoencoder_log_errors(spark, sf_dir):
    """M-22 over one log partition: fixed weights, scaling fitted on it."""
    rows = _one_domain(spark, sf_dir)
    model = fixed_autoencoder(len(AE_FEATURES), AE_HIDDEN)
    model.lo, model.hi = AE.feature_range(rows, AE_FEATURES)
    return model.score(rows, AE_FEATURES, _ROW).select(*_ROW, F.round("reconstruction_error", 6).alias("reconstruction_error"))


def q_autoencoder_log_flags(spark, sf_dir):
    """M-20 to M-23 over one log partition: trained, saved, loaded, flagged
    above a fixed threshold."""
    rows = _one_domain(spark, sf_dir)
    path = scratch_dir(spark, "log-autoencoder")
    AE.train_autoencoder(rows, AE_FEATURES, TRAIN_HIDDEN, TRAIN_EPOCHS, seed=1, steps=2).save(spark, path)
    return AE.flag_reconstruction(AE.Autoencoder.load(spark, path), rows, AE_FEATURES, _ROW, threshold=AE_THRESHOLD)


def _stored_index(spark, df, column):
    path = scratch_dir(spark, f"index-{column}")
    FE.LabelIndex.fit(df, column).save(path)
    return FE.LabelIndex.load(spark, path)


def q_fitted_label_index(spark, sf_dir):
    """M-05 fitted on the known domains' rows, stored, and joined to all rows:
    other domains get the index after all labels."""
    every = _featured(spark, sf_dir).select("domain")
    known, _ = W.split_known(every, domain_registry(spark, sf_dir))
    out = _stored_index(spark, known, "domain").transform(every, unseen="keep")
    return out.groupBy("domain", F.col("domain_index").cast("bigint").alias("domain_index")).agg(F.count(F.lit(1)).alias("n"))


def q_fitted_one_hot(spark, sf_dir):
    """M-06 by an index of the known rows, on the unknown ones."""
    from pyspark.ml.functions import vector_to_array
    known, unknown = W.split_known(_featured(spark, sf_dir).select("domain", "req_method"), domain_registry(spark, sf_dir))
    hot = _stored_index(spark, known, "req_method").one_hot(unknown, unseen="keep")
    arr = vector_to_array("req_method_onehot")
    return hot.select("req_method", F.col("req_method_index").cast("bigint").alias("req_method_index"), F.size(arr).cast("bigint").alias("onehot_size"),
                      F.when(F.array_position(arr, 1.0) > 0, F.array_position(arr, 1.0) - 1).alias("hot_position")).distinct()


def _keyed(spark, sf_dir):
    root, _ = extracted_tables(spark, sf_dir)
    return spark.read.parquet(root).withColumn(SPLIT_KEY, F.concat_ws("|", "dateunixtimest", "clean_path"))


def q_heldout_split(spark, sf_dir):
    """O-07 for the classifier: rows of each domain on either side."""
    df = _keyed(spark, sf_dir).select("domain", S.split_label(SPLIT_KEY, 0.8, portable=True).alias("split"))
    return df.groupBy("domain").agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))


def q_heldout_metrics(spark, sf_dir):
    """M-24 to M-26 end to end: metrics of the domain classifier on its own
    held-out rows."""
    df = _keyed(spark, sf_dir).select(SPLIT_KEY, "domain", *C.CLASSIFIER_FEATURES)
    return C.train_and_hold_out(df, SPLIT_KEY, max_iter=20, portable=True).metrics()


def softmax_start(classes: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed coefficients, reproducible in SQL: c[k][d] = ((7 k + 3 d) mod 11
    - 5) / 20, intercept ((k mod 5) - 2) / 10."""
    k, d = np.arange(classes)[:, None], np.arange(features)[None, :]
    return ((k * 7 + d * 3) % 11 - 5) / 20.0, (np.arange(classes) % 5 - 2) / 10.0


def q_softmax_gradient(spark, sf_dir):
    """M-24 check: loss and gradient of fixed coefficients over all known
    rows."""
    rows = _keyed(spark, sf_dir).withColumn("sent", F.col("body_bytes_sent") / 100000.0).select("domain", *SOFTMAX_FEATURES)
    index = FE.LabelIndex.fit(rows, "domain")
    ready = FE.assemble(index.transform(rows), SOFTMAX_FEATURES)
    loss, slope, shift = C.softmax_loss(ready, "features", "domain_index", *softmax_start(index.size, len(SOFTMAX_FEATURES)))
    out = [(k, d, float(v)) for (k, d), v in np.ndenumerate(np.column_stack([slope, shift]))]
    return spark.createDataFrame(out, "class bigint, feature bigint, g double").select(
        "class", "feature", F.round("g", 8).alias("gradient"), F.round(F.lit(loss), 8).alias("loss"))


def q_kmeans_step(spark, sf_dir):
    """M-27, one step from fixed centers on a 5 x 5 grid of (decimal hour,
    bytes)."""
    df = _featured(spark, sf_dir).filter(F.size("clean_query_list") > 0).select("fabstime", F.col("body_bytes_sent").cast("double").alias("body_bytes_sent"))
    centers = [[k % 5 * 5 + 2, k // 5 * 20000 + 10000] for k in range(K_MEANS)]
    out = C.lloyd_step(df, ["fabstime", "body_bytes_sent"], centers)
    return out.select("cluster", "n", F.round("fabstime", 6).alias("fabstime"), F.round("body_bytes_sent", 4).alias("body_bytes_sent"))


def q_blank_domain_rows(spark, sf_dir):
    """P-13: rows whose referer has no host."""
    rows = _cleaned(spark, sf_dir).withColumn("domain", url.url_netloc("http_referer"))
    return W.without_domain(rows).select("remote_addr", "req_uri", "http_referer", "domain")


def q_pipeline_flags(spark, sf_dir):
    """M-11: one pipeline from raw lines to flags, fitted, saved, loaded and
    applied."""
    lines = weblog_text(spark, sf_dir)
    stages = [ST.LogParser(), ST.LabelIndexer(inputCol="req_method", oneHotCol="req_method_onehot"), ST.LogVectors(numFeatures=BUCKETS),
              ST.SomFlagger(gridRows=4, gridCols=5, iterations=3, bands=3, seed=2)]
    path = scratch_dir(spark, "log-pipeline")
    Pipeline(stages=stages).fit(lines).write().save(path)
    return PipelineModel.load(path).transform(lines).select("remote_addr", "date_time", "req_uri", "bmu", "distance", "is_anomaly")


# ---- oracle SQL ------------------------------------------------------------------

_ONE = """one AS MATERIALIZED (SELECT row_number() OVER (ORDER BY date_time, clean_path, body_bytes_sent, remote_addr, user_agent) AS r, * FROM featured2
  WHERE domain = (SELECT min(domain) FROM featured2 WHERE domain IN (SELECT domain FROM registry)))"""
_METHODS = """methods AS (SELECT req_method, row_number() OVER (ORDER BY n DESC, req_method) - 1 AS idx, count(*) OVER () - 1 AS slots
  FROM (SELECT req_method, count(*) AS n FROM featured2 GROUP BY req_method))"""
_VECTORS = f"""{_ONE}, {_METHODS},
slots AS (SELECT any_value(slots) AS k FROM methods),
terms AS (SELECT r, unnest(list_concat({O.joined_runs("string_split(regexp_replace(clean_path, '^/', ''), '/')", 2)}, clean_query_list)) AS term FROM one),
{O.hash_buckets('terms', BUCKETS)},
entry AS (SELECT r, idx AS d, 1.0 AS v FROM one JOIN methods USING (req_method) WHERE idx < slots
  UNION ALL SELECT r, k, CAST(status AS DOUBLE) FROM one, slots
  UNION ALL SELECT r, k + 1, CAST(body_bytes_sent AS DOUBLE) FROM one, slots
  UNION ALL SELECT r, k + 2 + bucket, CAST(count(*) AS DOUBLE) FROM terms JOIN buckets USING (term), slots GROUP BY r, k, bucket
  UNION ALL SELECT r, k + 2 + {BUCKETS}, fabstime FROM one, slots
  UNION ALL SELECT r, k + 3 + {BUCKETS}, CAST(day_of_week AS DOUBLE) FROM one, slots),
dims AS (SELECT unnest(range(0, k + 4 + {BUCKETS})) AS d FROM slots),
x AS MATERIALIZED (SELECT r, d, coalesce(v, 0.0) AS v FROM (SELECT r, d FROM one, dims) LEFT JOIN entry USING (r, d)),
w AS MATERIALIZED (SELECT j, d, lo + ((j * 37 + d * 11) % 101) / 100.0 * (hi - lo) AS wv
  FROM (SELECT d, min(v) AS lo, max(v) AS hi FROM x GROUP BY d), range(0, {NODES}) t(j)),
dist AS (SELECT r, j, sum((v - wv) * (v - wv)) AS d2 FROM x JOIN w USING (d) GROUP BY r, j),
best AS MATERIALIZED (SELECT r, arg_min(j, d2) AS bmu, sqrt(min(d2)) AS distance FROM dist GROUP BY r)"""
_AE_W1 = f"SELECT i, h, ((i * 7 + h * 13) % 23 - 11) / 50.0 AS w FROM range(0, {len(AE_FEATURES)}) a(i), range(0, {AE_HIDDEN}) b(h)"
_AE_W2 = f"SELECT h, o, ((h * 5 + o * 3) % 19 - 9) / 40.0 AS w FROM range(0, {AE_HIDDEN}) a(h), range(0, {len(AE_FEATURES)}) b(o)"
_KNOWN_RANKS = """known AS (SELECT * FROM featured2 WHERE domain IN (SELECT domain FROM registry))"""


def _ranks(column: str) -> str:
    return f"""ranks AS (SELECT {column}, row_number() OVER (ORDER BY n DESC, {column}) - 1 AS idx FROM (SELECT {column}, count(*) AS n FROM known GROUP BY {column})),
size AS (SELECT count(*) AS k FROM ranks)"""


_MD5 = "CAST(('0x' || substr(md5(CAST(dateunixtimest AS VARCHAR) || '|' || clean_path), 1, 8)) AS BIGINT) / 4294967296.0"
_SOFTMAX_X = ", ".join(["fabstime", "CAST(day_of_week AS DOUBLE)", "body_bytes_sent / 100000.0", "1.0"])

SQL = {
    "som_log_bmu": f"{_FEATURED}, {_VECTORS}\nSELECT {', '.join(_ROW)}, bmu, round(distance, 6) AS distance FROM one JOIN best USING (r)",
    "som_log_flags": f"""{_FEATURED}, {_VECTORS}
SELECT {', '.join(_ROW)}, bmu, round(distance, 6) AS distance FROM one JOIN best USING (r)
WHERE distance > (SELECT quantile_cont(distance, 0.95) FROM best)""",
    "som_log_step": f"""{_FEATURED}, {_VECTORS},
sums AS (SELECT bmu, d, sum(v) AS sv FROM x JOIN best USING (r) GROUP BY bmu, d),
cnt AS (SELECT bmu, count(*) AS n FROM best GROUP BY bmu),
hk AS (SELECT b.j AS b, t.j AS j, exp(-(power(b.j // {GRID_N} - t.j // {GRID_N}, 2) + power(b.j % {GRID_N} - t.j % {GRID_N}, 2)) / (2.0 * {SIGMA} * {SIGMA})) AS h
  FROM range(0, {NODES}) b(j), range(0, {NODES}) t(j)),
num AS (SELECT hk.j, s.d, sum(hk.h * s.sv) AS num FROM hk JOIN sums s ON s.bmu = hk.b GROUP BY hk.j, s.d),
den AS (SELECT hk.j, sum(hk.h * c.n) AS den FROM hk JOIN cnt c ON c.bmu = hk.b GROUP BY hk.j)
SELECT w.j AS node, w.d, round(CASE WHEN den.den > 0 THEN num.num / den.den ELSE w.wv END, 6) AS weight
FROM w LEFT JOIN den ON den.j = w.j LEFT JOIN num ON num.j = w.j AND num.d = w.d""",
    "autoencoder_log_errors": f"""{_FEATURED}, {_ONE},
x AS (SELECT r, 0 AS i, fabstime AS v FROM one UNION ALL SELECT r, 1, CAST(body_bytes_sent AS DOUBLE) FROM one),
mm AS (SELECT i, min(v) AS lo, max(v) AS hi FROM x GROUP BY i),
xs AS (SELECT r, i, CASE WHEN hi = lo THEN 0.5 ELSE (v - lo) / (hi - lo) END AS s FROM x JOIN mm USING (i)),
hid AS (SELECT r, h, greatest(sum(s * w) + ((h % 3) - 1) / 10.0, 0.0) AS a FROM xs JOIN ({_AE_W1}) USING (i) GROUP BY r, h),
y AS (SELECT r, o AS i, 1.0 / (1.0 + exp(-sum(a * w))) AS y FROM hid JOIN ({_AE_W2}) USING (h) GROUP BY r, o),
err AS (SELECT r, avg((s - y) * (s - y)) AS e FROM xs JOIN y USING (r, i) GROUP BY r)
SELECT {', '.join(_ROW)}, round(e, 6) AS reconstruction_error FROM one JOIN err USING (r)""",
    "fitted_label_index": f"""{_FEATURED}, {_KNOWN_RANKS}, {_ranks('domain')}
SELECT domain, coalesce(idx, k) AS domain_index, count(*) AS n FROM featured2 LEFT JOIN ranks USING (domain), size GROUP BY 1, 2""",
    "fitted_one_hot": f"""{_FEATURED}, {_KNOWN_RANKS}, {_ranks('req_method')}
SELECT DISTINCT req_method, coalesce(idx, k) AS req_method_index, k AS onehot_size, idx AS hot_position
FROM (SELECT * FROM featured2 WHERE domain NOT IN (SELECT domain FROM registry)) LEFT JOIN ranks USING (req_method), size""",
    "heldout_split": f"""{_FEATURED}, {_KNOWN_RANKS}
SELECT domain, count(*) FILTER (u < 0.8) AS n_train, count(*) FILTER (u >= 0.8) AS n_test FROM (SELECT domain, {_MD5} AS u FROM known) GROUP BY domain""",
    "softmax_gradient": f"""{_FEATURED}, {_KNOWN_RANKS}, {_ranks('domain')},
rows AS (SELECT row_number() OVER () AS r, idx AS y, [{_SOFTMAX_X}] AS x FROM known JOIN ranks USING (domain)),
z AS (SELECT r, y, x, c, (SELECT sum(x[d + 1] * ((c * 7 + d * 3) % 11 - 5) / 20.0) FROM range(0, 3) t(d)) + (c % 5 - 2) / 10.0 AS z FROM rows, size, range(0, k) u(c)),
p AS (SELECT *, z - ln(sum(exp(z)) OVER (PARTITION BY r)) AS logp FROM z)
SELECT c AS class, d AS feature, round(avg((exp(logp) - CASE WHEN c = y THEN 1.0 ELSE 0.0 END) * x[d + 1]), 8) AS gradient,
       (SELECT round(avg(-logp), 8) FROM p WHERE c = y) AS loss FROM p, range(0, 4) t(d) GROUP BY c, d""",
    "kmeans_step": f"""{_FEATURED},
rows AS (SELECT row_number() OVER () AS r, fabstime, CAST(body_bytes_sent AS DOUBLE) AS body_bytes_sent FROM featured2 WHERE len(clean_query_list) > 0),
placed AS (SELECT r, any_value(fabstime) AS fabstime, any_value(body_bytes_sent) AS body_bytes_sent,
  arg_min(j, power(fabstime - (j % 5 * 5 + 2), 2) + power(body_bytes_sent - (j // 5 * 20000 + 10000), 2)) AS cluster FROM rows, range(0, {K_MEANS}) t(j) GROUP BY r)
SELECT cluster, count(*) AS n, round(avg(fabstime), 6) AS fabstime, round(avg(body_bytes_sent), 4) AS body_bytes_sent FROM placed GROUP BY cluster""",
    "blank_domain_rows": O.cleaned_with() + f"""
SELECT remote_addr, req_uri, http_referer, regexp_extract(http_referer, '{O.NETLOC_RE}', 1) AS domain FROM cleaned
WHERE regexp_extract(http_referer, '{O.NETLOC_RE}', 1) = ''""",
}

QUERIES = {
    "som_log_bmu": q_som_log_bmu,
    "som_log_flags": q_som_log_flags,
    "som_log_step": q_som_log_step,
    "som_log_train": q_som_log_train,
    "autoencoder_log_errors": q_autoencoder_log_errors,
    "autoencoder_log_flags": q_autoencoder_log_flags,
    "fitted_label_index": q_fitted_label_index,
    "fitted_one_hot": q_fitted_one_hot,
    "heldout_split": q_heldout_split,
    "heldout_metrics": q_heldout_metrics,
    "softmax_gradient": q_softmax_gradient,
    "kmeans_step": q_kmeans_step,
    "blank_domain_rows": q_blank_domain_rows,
    "pipeline_flags": q_pipeline_flags,
}
