"""Registered queries on training steps and scale options: an autoencoder's
gradient and storage, mini-batch draws and a mini-batch SOM step, exact
percentiles in one go, distinct sketches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from logloom.operators import autoencoder as AE
from logloom.operators import sampling as S
from logloom.operators import som as SOM
from logloom.operators import stats as ST
from logloom.operators import wordcount as WC
from logloom.plans import oracle_sql as O
from logloom.plans.autoencoder_queries import _ERR, DIM, _emb, _fixed_scaled
from logloom.plans.som_queries import GRID_M, GRID_N, SIGMA, SQL as SOM_SQL, fixed_codebook
from logloom.plans.weblog_fixture import weblog_path
from logloom.plans.weblog_queries import _cleaned
from logloom.sources.staging import scratch_dir
from logloom.sources.tables import read_table, read_text

BANDS = 8
PERCENTILES = [0.0, 0.01, 0.25, 0.5, 0.95, 0.999, 1.0]
LEARNING_RATE = 1e-3
SCALE = 1e4  # gradients are of the order 1e-3: shown in ten-thousandths


def q_autoencoder_gradient(spark, sf_dir):
    """M-20, one fixed step: the gradient of the mean squared error over all
    vectors at fixed weights, summed on the executors."""
    model = _fixed_scaled(_emb(spark, sf_dir))
    total, loss, n = AE.gradient_sums(model, _emb(spark, sf_dir), "embedding")
    gradient = AE.Autoencoder(model.weights, model.biases).with_flat(total / n)
    rows = [(i, part, int(a), int(b), float(v)) for i, (w, bias) in enumerate(zip(gradient.weights, gradient.biases))
            for part, grid in (("weight", w), ("bias", bias[None, :])) for (a, b), v in np.ndenumerate(grid)]
    out = spark.createDataFrame(rows, "layer bigint, part string, n_in bigint, n_out bigint, g double")
    return out.select("layer", "part", "n_in", "n_out", F.round(F.col("g") * SCALE, 6).alias("gradient"), F.lit(n).cast("bigint").alias("n"), F.round(F.lit(loss / n), 8).alias("loss"))


def q_autoencoder_reloaded(spark, sf_dir):
    """K-04: the fixed model saved, loaded and used."""
    emb = _emb(spark, sf_dir)
    path = scratch_dir(spark, "autoencoder")
    _fixed_scaled(emb).save(spark, path)
    return AE.Autoencoder.load(spark, path).score(emb, "embedding", ["vec_id"]).select(
        "vec_id", F.round("reconstruction_error", 6).alias("reconstruction_error"))


def q_minibatch_draw(spark, sf_dir):
    """O-06: the band that holds each vector; a mini-batch step reads one."""
    dealt = S.hash_bands(read_table(spark, sf_dir, "embeddings", "vec_id"), BANDS, "vec_id", portable=True)
    return dealt.table.select("vec_id", F.col("_band").cast("bigint").alias("band"))


def q_som_minibatch_step(spark, sf_dir):
    """M-12 by mini-batches, one step: the update of a fixed codebook from
    one band's rows."""
    dealt = S.hash_bands(_emb(spark, sf_dir), BANDS, "vec_id", portable=True)
    w0 = fixed_codebook()
    s, c = SOM.bmu_statistics(dealt.read(0), "embedding", w0)
    w1 = SOM.batch_update(w0, s, c, SOM.neighbourhood(GRID_M, GRID_N, SIGMA))
    return SOM.SomModel(GRID_M, GRID_N, w1).to_frame(spark).select(
        "node", F.posexplode("weights").alias("d", "weight")).select(
        "node", F.col("d").cast("bigint").alias("d"), F.round("weight", 6).alias("weight"))


def q_exact_percentiles(spark, sf_dir):
    """A-08: seven percentiles of the prices from the same radix passes."""
    lines = read_table(spark, sf_dir, "lineitem", "l_extendedprice")
    found = ST.exact_percentiles(lines, "l_extendedprice", PERCENTILES)
    out = spark.createDataFrame(list(zip(PERCENTILES, found)), "p double, v double")
    return out.select("p", F.round("v", 6).alias("value"))


def q_distinct_visitors(spark, sf_dir):
    """A-05: addresses sketched by day, stored, read again and merged over
    all days."""
    path = scratch_dir(spark, "sketches")
    ST.distinct_sketches(_cleaned(spark, sf_dir), ["date"], "remote_addr").write.parquet(path)
    days = spark.read.parquet(path)
    total = ST.merge_sketches(days).withColumn("date", F.lit("all"))
    return days.unionByName(total).select("date", "rows", ST.sketch_estimate().alias("visitors"))


def q_log_word_count(spark, sf_dir):
    """S-01 and A-01 over text files."""
    return WC.word_count(read_text(spark, weblog_path(spark, sf_dir)))


_BAND = f"CAST(floor(CAST(('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 * {BANDS}) AS BIGINT)"

SQL = {
    "autoencoder_gradient": _ERR + f""",
n AS (SELECT count(*) AS n FROM embeddings),
d2 AS (SELECT y.vec_id, o, 2.0 * (y - s) / ((SELECT n FROM n) * {DIM}) * y * (1.0 - y) AS d FROM y JOIN xs ON xs.vec_id = y.vec_id AND xs.i = y.o),
d1 AS (SELECT vec_id, h, sum(d * w) * CASE WHEN any_value(a) > 0 THEN 1.0 ELSE 0.0 END AS d FROM d2 JOIN w2 USING (o) JOIN hid USING (vec_id, h) GROUP BY vec_id, h),
g AS (SELECT 0 AS layer, 'weight' AS part, i AS n_in, h AS n_out, sum(s * d) AS g FROM xs JOIN d1 USING (vec_id) GROUP BY i, h
      UNION ALL SELECT 0, 'bias', 0, h, sum(d) FROM d1 GROUP BY h
      UNION ALL SELECT 1, 'weight', h, o, sum(a * d) FROM hid JOIN d2 USING (vec_id) GROUP BY h, o
      UNION ALL SELECT 1, 'bias', 0, o, sum(d) FROM d2 GROUP BY o)
SELECT CAST(layer AS BIGINT) AS layer, part, n_in, n_out, round(g * {SCALE}, 6) AS gradient, (SELECT n FROM n) AS n, (SELECT round(avg(e), 8) FROM err) AS loss FROM g""",
    "autoencoder_reloaded": _ERR + "\nSELECT vec_id, round(e, 6) AS reconstruction_error FROM err",
    "minibatch_draw": f"SELECT vec_id, {_BAND} AS band FROM embeddings",
    "som_minibatch_step": SOM_SQL["som_batch_step"].replace("FROM embeddings)", f"FROM embeddings WHERE {_BAND} = 0)", 1),
    "exact_percentiles": " UNION ALL ".join(f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(l_extendedprice, {p}), 6) AS value FROM lineitem" for p in PERCENTILES),
    "distinct_visitors": O.cleaned_with() + """
SELECT date, count(*) AS rows, count(DISTINCT remote_addr) AS visitors FROM cleaned GROUP BY date
UNION ALL SELECT 'all', count(*), count(DISTINCT remote_addr) FROM cleaned""",
    "log_word_count": "WITH " + O.WEBLOG_SQL + """
SELECT word, count(*) AS count FROM (SELECT unnest(string_split(value, ' ')) AS word FROM weblog) GROUP BY word""",
}

QUERIES = {
    "autoencoder_gradient": q_autoencoder_gradient,
    "autoencoder_reloaded": q_autoencoder_reloaded,
    "minibatch_draw": q_minibatch_draw,
    "som_minibatch_step": q_som_minibatch_step,
    "exact_percentiles": q_exact_percentiles,
    "distinct_visitors": q_distinct_visitors,
    "log_word_count": q_log_word_count,
}
