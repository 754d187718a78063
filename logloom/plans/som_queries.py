"""Registered SOM queries over ``embeddings`` (M-12, M-15..M-18)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from logloom.operators import som as SOM
from logloom.sources.tables import read_table

GRID_M, GRID_N, DIM = 10, 10, 64
SIGMA = 1.0
TRAIN_ITERATIONS = 10


def fixed_codebook(m: int = GRID_M, n: int = GRID_N, dim: int = DIM) -> np.ndarray:
    """A deterministic start codebook, reproducible in SQL:
    w[j][d] = ((37 j + 11 d) mod 101) / 500 - 0.1."""
    j = np.arange(m * n)[:, None]
    d = np.arange(dim)[None, :]
    return ((j * 37 + d * 11) % 101) / 500.0 - 0.1


def _emb(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")


def _model():
    return SOM.SomModel(GRID_M, GRID_N, fixed_codebook())


def q_som_bmu(spark, sf_dir):
    return _model().score(_emb(spark, sf_dir), "embedding", ["vec_id"]).select(
        "vec_id", "bmu", "bmu_row", "bmu_col")


def q_som_distance(spark, sf_dir):
    return _model().score(_emb(spark, sf_dir), "embedding", ["vec_id"]).select(
        "vec_id", F.round("distance", 6).alias("distance"))


def q_som_anomalies(spark, sf_dir):
    flagged = SOM.som_anomalies(_model(), _emb(spark, sf_dir), "embedding", ["vec_id"], p=0.95)
    return flagged.filter("is_anomaly").select("vec_id", "bmu", F.round("distance", 6).alias("distance"))


def q_som_batch_step(spark, sf_dir):
    w0 = fixed_codebook()
    s, c = SOM.bmu_statistics(_emb(spark, sf_dir), "embedding", w0)
    w1 = SOM.batch_update(w0, s, c, SOM.neighbourhood(GRID_M, GRID_N, SIGMA))
    model = SOM.SomModel(GRID_M, GRID_N, w1)
    return model.to_frame(spark).select(
        "node", F.posexplode("weights").alias("d", "weight")).select(
        "node", F.col("d").cast("bigint").alias("d"), F.round("weight", 6).alias("weight"))


def q_som_train(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    model = SOM.train_som(emb, "embedding", GRID_M, GRID_N, iterations=TRAIN_ITERATIONS,
                          sigma=2.0, seed=7)
    return model.to_frame(spark)


_X = """x AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS d,
                 CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"""
_W = f"""w AS (SELECT j, d, ((j * 37 + d * 11) % 101) / 500.0 - 0.1 AS wv
        FROM range(0, {GRID_M * GRID_N}) t1(j), range(0, {DIM}) t2(d))"""
_BEST = f"""WITH {_X}, {_W},
dist AS (SELECT vec_id, j, sum((v - wv) * (v - wv)) AS d2 FROM x JOIN w USING (d) GROUP BY vec_id, j),
best AS (SELECT vec_id, arg_min(j, d2) AS bmu, min(d2) AS d2 FROM dist GROUP BY vec_id)"""

SQL = {
    "som_bmu": _BEST + f"""
SELECT vec_id, bmu, bmu // {GRID_N} AS bmu_row, bmu % {GRID_N} AS bmu_col FROM best""",
    "som_distance": _BEST + "\nSELECT vec_id, round(sqrt(d2), 6) AS distance FROM best",
    "som_anomalies": _BEST + """,
th AS (SELECT quantile_cont(sqrt(d2), 0.95) AS t FROM best)
SELECT vec_id, bmu, round(sqrt(d2), 6) AS distance FROM best, th WHERE sqrt(d2) > th.t""",
    "som_batch_step": _BEST + f""",
sums AS (SELECT b.bmu, x.d, sum(x.v) AS sv FROM x JOIN best b USING (vec_id) GROUP BY b.bmu, x.d),
cnt AS (SELECT bmu, count(*) AS n FROM best GROUP BY bmu),
hk AS (SELECT b.j AS b, t.j AS j,
              exp(-(power(b.j // {GRID_N} - t.j // {GRID_N}, 2) + power(b.j % {GRID_N} - t.j % {GRID_N}, 2))
                  / (2.0 * {SIGMA} * {SIGMA})) AS h
       FROM range(0, {GRID_M * GRID_N}) b(j), range(0, {GRID_M * GRID_N}) t(j)),
num AS (SELECT hk.j, s.d, sum(hk.h * s.sv) AS num FROM hk JOIN sums s ON s.bmu = hk.b GROUP BY hk.j, s.d),
den AS (SELECT hk.j, sum(hk.h * c.n) AS den FROM hk JOIN cnt c ON c.bmu = hk.b GROUP BY hk.j)
SELECT w.j AS node, w.d, round(CASE WHEN den.den > 0 THEN num.num / den.den ELSE w.wv END, 6) AS weight
FROM w LEFT JOIN den ON den.j = w.j LEFT JOIN num ON num.j = w.j AND num.d = w.d""",
}

QUERIES = {
    "som_bmu": q_som_bmu,
    "som_distance": q_som_distance,
    "som_anomalies": q_som_anomalies,
    "som_batch_step": q_som_batch_step,
    "som_train": q_som_train,
}
