"""Registered autoencoder queries (M-20, M-22, M-23)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from logloom.operators import autoencoder as AE
from logloom.sources.tables import read_table

DIM, HIDDEN = 64, 8
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TRAIN_HIDDEN = [64, 32, 16, 32, 64]
TRAIN_EPOCHS = 5


def fixed_autoencoder(dim: int = DIM, hidden: int = HIDDEN) -> AE.Autoencoder:
    """Deterministic 64-8-64 weights, reproducible in SQL:
    W1[i][h] = ((7 i + 13 h) mod 23 - 11) / 50, b1[h] = (h mod 3 - 1) / 10,
    W2[h][o] = ((5 h + 3 o) mod 19 - 9) / 40, b2 = 0."""
    i = np.arange(dim)[:, None]; h = np.arange(hidden)[None, :]
    w1 = ((i * 7 + h * 13) % 23 - 11) / 50.0
    b1 = (np.arange(hidden) % 3 - 1) / 10.0
    hh = np.arange(hidden)[:, None]; o = np.arange(dim)[None, :]
    w2 = ((hh * 5 + o * 3) % 19 - 9) / 40.0
    return AE.Autoencoder([w1, w2], [b1, np.zeros(dim)])


def _emb(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")


def _fixed_scaled(emb):
    model = fixed_autoencoder()
    model.lo, model.hi = AE.feature_range(emb, "embedding")
    return model


def q_reconstruction_error(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    return _fixed_scaled(emb).score(emb, "embedding", ["vec_id"]).select(
        "vec_id", F.round("reconstruction_error", 6).alias("reconstruction_error"))


def q_reconstruction_flags(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    flagged = AE.flag_reconstruction(_fixed_scaled(emb), emb, "embedding", ["vec_id"], p=0.95)
    return flagged.filter("is_anomaly").select(
        "vec_id", F.round("reconstruction_error", 6).alias("reconstruction_error"))


def q_autoencoder_train(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", *LINE_FEATURES)
    model = AE.train_autoencoder(li, LINE_FEATURES, TRAIN_HIDDEN, epochs=TRAIN_EPOCHS, seed=1)
    flagged = AE.flag_reconstruction(model, li, LINE_FEATURES, ["l_orderkey", "l_linenumber"])
    return flagged.select("l_orderkey", "l_linenumber", "reconstruction_error", "is_anomaly")


_ERR = f"""WITH x AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS i,
                        CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
mm AS (SELECT i, min(v) AS lo, max(v) AS hi FROM x GROUP BY i),
xs AS (SELECT vec_id, i, CASE WHEN hi = lo THEN 0.5 ELSE (v - lo) / (hi - lo) END AS s FROM x JOIN mm USING (i)),
w1 AS (SELECT i, h, ((i * 7 + h * 13) % 23 - 11) / 50.0 AS w FROM range(0, {DIM}) a(i), range(0, {HIDDEN}) b(h)),
hid AS (SELECT vec_id, h, greatest(sum(s * w) + ((h % 3) - 1) / 10.0, 0.0) AS a
        FROM xs JOIN w1 USING (i) GROUP BY vec_id, h),
w2 AS (SELECT h, o, ((h * 5 + o * 3) % 19 - 9) / 40.0 AS w FROM range(0, {HIDDEN}) a(h), range(0, {DIM}) b(o)),
y AS (SELECT vec_id, o, 1.0 / (1.0 + exp(-sum(a * w))) AS y FROM hid JOIN w2 USING (h) GROUP BY vec_id, o),
err AS (SELECT xs.vec_id, avg((xs.s - y.y) * (xs.s - y.y)) AS e
        FROM xs JOIN y ON xs.vec_id = y.vec_id AND xs.i = y.o GROUP BY xs.vec_id)"""

SQL = {
    "reconstruction_error": _ERR + "\nSELECT vec_id, round(e, 6) AS reconstruction_error FROM err",
    "reconstruction_flags": _ERR + """,
th AS (SELECT quantile_cont(e, 0.95) AS t FROM err)
SELECT vec_id, round(e, 6) AS reconstruction_error FROM err, th WHERE e > th.t""",
}

QUERIES = {
    "reconstruction_error": q_reconstruction_error,
    "reconstruction_flags": q_reconstruction_flags,
    "autoencoder_train": q_autoencoder_train,
}
