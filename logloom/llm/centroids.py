"""Operator 12: clustering of integer vectors around centroids, in JVM expressions only.

Vectors become arrays of integers, floor(scale * x). A round is one job over them: ``zip_with`` and ``aggregate`` give the
squared distance of a vector to each literal centroid array, ``array_min`` over (distance, number) structs takes the
nearest with the smaller number on ties, and one hash aggregate of column sums by cluster, pre-summed in every task,
gives the new centroids. Only clusters x (dimensions + 1) numbers reach the driver, and the literal centroids are
bounded by ``MAX_CENTROID_VALUES``.

The distance to a centroid c is |x|^2 + |c|^2 - 2 x.c, so a lambda multiplies and adds once for each component; all is
exact integer arithmetic: a component whose square could make a distance of 2**62 or more raises, nothing wraps.

Defined cases: a vector that is null, has another length, or a null or non-finite component is left out; repeated rows
count each; fewer vectors than centroids give as many centroids as there are vectors; equal seeds (repeated ids) are
taken in order of their components; without vectors there are no rows; clashing names of other columns don't matter."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from logloom.llm.scratch import Scratch

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = "1"
MAX_CENTROID_VALUES = 1 << 16


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(id, v array<bigint>) of the rows whose vector has ``dimensions`` finite components."""
    v = F.col("x")
    inner = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = inner.where(v.isNotNull() & (F.size(v) == dimensions) & F.coalesce(finite, F.lit(False)))
    most = float(math.isqrt((1 << 60) // dimensions))  # a difference is twice that at most
    too_large = F.raise_error(F.lit("a component is too large for exact distances")).cast("long")
    whole = F.transform(v, lambda x: F.when(F.abs(x * float(scale)) < most, F.floor(x * float(scale)).cast("long")).otherwise(too_large))
    return kept.select("id", whole.alias("v"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: str = SEED) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``seed:id``, in that order: one top-k, ``clusters`` rows."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [list(r["v"]) for r in vectors.orderBy(draw, "v").limit(clusters).collect()]


def nearest(centroids: list[list[int]], v: str = "v") -> Column:
    """struct(distance, cluster) of the centroid nearest to the bigint array column ``v``."""
    if sum(map(len, centroids)) > MAX_CENTROID_VALUES:
        raise ValueError("too many centroid values for literals")
    own = f"aggregate({v}, 0L, (total, a) -> total + a * a)"
    apart = []
    for n, c in enumerate(centroids):
        products = f"zip_with({v}, array({', '.join(f'{x}L' for x in c)}), (a, b) -> a * b)"
        distance = f"own + {sum(x * x for x in c)}L - 2L * aggregate({products}, 0L, (total, p) -> total + p)"
        apart.append(f"struct({distance} AS distance, {n} AS cluster)")
    # The vector's own square is taken once, as the only element that the structs are made from.
    return F.expr(f"array_min(transform(array({own}), own -> array_min(array({', '.join(apart)}))))")


def assign(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``vectors`` with cluster and distance."""
    return vectors.withColumn("near", nearest(centroids)).select(*vectors.columns, "near.cluster", "near.distance")


def cluster_sums(assigned: DataFrame, dimensions: int) -> list[Row]:
    """Per cluster its vectors' column sums and count: one grouped aggregate with partial sums in every task."""
    sums = [F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(dimensions)]
    return assigned.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect()


def updated(centroids: list[list[int]], sums: list[Row]) -> list[list[int]]:
    """floor(sum / count) of each component; a centroid without vectors stays."""
    out = [list(c) for c in centroids]
    for r in sums:
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(len(out[r["cluster"]]))]
    return out


@dataclass
class Clustering:
    centroids: list[list[int]]
    assigned: DataFrame  # id, cluster, distance


def fit_centroids(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED) -> Clustering:
    """``rounds`` of assignment and update over (id, v), then one more assignment."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "centroids")
    held = scratch.save(vectors, "vectors")  # each round reads integers, not the source and its checks
    centroids = first_centroids(held, clusters, seed)
    if not centroids:
        return Clustering([], held.select("id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")))
    for _ in range(rounds):
        centroids = updated(centroids, cluster_sums(assign(held, centroids), len(centroids[0])))
    return Clustering(centroids, assign(held, centroids).select("id", "cluster", "distance"))


def cluster_report(found: Clustering) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each vector.

    The sums by cluster are at most ``clusters`` rows, so they are collected and come back as literals."""
    scratch = Scratch(found.assigned.sparkSession, "centroids")
    rows = scratch.save(found.assigned, "assigned")
    inertia = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [F.sha2(F.lit(",".join(map(str, c))), 256) for c in found.centroids]
    at = F.col("cluster") + 1
    own = F.element_at(F.array(*(F.lit(inertia.get(k, 0)).cast("long") for k in range(len(digest)))), at) if digest else F.lit(None).cast("long")
    sha = F.element_at(F.array(*digest), at) if digest else F.lit(None).cast("string")
    return rows.select(F.col("id").alias("vec_id"), "cluster", "distance", own.alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"), sha.alias("centroid_sha256"))


def oracle_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE) -> str:
    """The same result in DuckDB SQL, one step of CTEs a round."""
    parts = [f"""kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id, embedding) AS r, [CAST(floor({scale}::DOUBLE * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {dimensions} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(CAST(x AS DOUBLE))]) = {dimensions})""",
             f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)), v) - 1 AS INTEGER) AS cluster, v AS c
  FROM kept QUALIFY row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)), v) <= {clusters})"""]
    for k in range(rounds + 1):
        parts.append(f"""a{k} AS MATERIALIZED (SELECT r, min({{'d': d, 'cluster': cluster}}) AS near FROM (
  SELECT r, cluster, CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v, c)]) AS BIGINT) AS d FROM kept CROSS JOIN c{k}) GROUP BY r)""")
        if k < rounds:
            parts.append(f"""m{k} AS (SELECT cluster, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM (
  SELECT near.cluster AS cluster, unnest(range(1, {dimensions + 1})) AS i, unnest(v) AS x FROM a{k} JOIN kept USING (r)) GROUP BY cluster, i),
c{k + 1} AS MATERIALIZED (SELECT cluster, coalesce(u, c) AS c FROM c{k} LEFT JOIN (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS u FROM m{k} GROUP BY cluster) USING (cluster))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, near.cluster AS cluster, near.d AS distance, CAST(sum(near.d) OVER (PARTITION BY near.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(near.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} ON c{rounds}.cluster = near.cluster"""
