import hashlib
import math

import duckdb
import pytest

from logloom.llm.centroids import cluster_report, fit_centroids, integer_vectors, nearest, oracle_sql, updated
from logloom.llm.queries import op12_centroids


def plain(rows, dimensions, clusters, rounds, scale=64, seed="1"):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    centroids = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        own = [[] for _ in centroids]
        for _, v in kept:
            own[near(v)[1]].append(v)
        centroids = [[sum(x) // len(vs) for x in zip(*vs, strict=True)] if vs else c for c, vs in zip(centroids, own, strict=True)]
    last = [(i, *near(v)) for i, v in kept]
    return [(i, k, d, sum(e for _, e, n in last if n == k), sum(e for _, e, _ in last), hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()) for i, d, k in last]


def check(rows, docs, dimensions, clusters=16, rounds=3):
    found = cluster_report(fit_centroids(integer_vectors(docs, dimensions=dimensions), clusters, rounds))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain(rows, dimensions, clusters, rounds), key=str)


def test_the_query_equals_sql_and_the_plain_version(spark):
    from tests.conftest import SF_SMALL
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    found = sorted(map(tuple, op12_centroids(spark, SF_SMALL).collect()))
    assert found == sorted(plain(rows, 64, 16, 3))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    assert sorted(db.execute(oracle_sql()).fetchall()) == found


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25]), (2, [0.5, -0.25]), (3, None), (4, []), (5, [1.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [1.0, inf]), (9, [-inf, 0.0]),
            (None, [0.1, 0.2]), (10, [-1e-9, 3.0]), (10, [-1e-9, 3.0]), (11, [100000.0, -100000.0]), (11, [7.0, 7.0]), (12, [0.0, 0.0]), (13, [-0.0, 1.0])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, v string, cluster int")
    rows = [(i, [None if x is None else float(x) for x in v] if v is not None else None) for i, v, *_ in frame.collect()]
    for clusters in (1, 3, 40):
        check(rows, frame, 2, clusters)
    check([rows[0]], frame.where("vec_id = 1"), 2)
    assert cluster_report(fit_centroids(integer_vectors(frame.limit(0), dimensions=2))).collect() == []
    assert cluster_report(fit_centroids(integer_vectors(frame.where("vec_id in (3, 4, 5)"), dimensions=2))).collect() == []


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    v = spark.createDataFrame([([0, 0],), ([4, 0],)], "v array<bigint>")
    got = v.select("v", nearest([[2, 0], [-2, 0], [2, 0]]).alias("n")).collect()
    assert [(r.n.distance, r.n.cluster) for r in got] == [(4, 0), (4, 0)]
    from pyspark.sql import Row
    assert updated([[1, 1], [9, 9]], [Row(cluster=0, n=2, s0=-3, s1=3)]) == [[-2, 1], [9, 9]]


def test_components_too_large_raise_and_do_not_wrap(spark):
    rows = spark.createDataFrame([(1, [1e30]), (2, [0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        cluster_report(fit_centroids(integer_vectors(rows, dimensions=1))).collect()


def test_no_python_in_the_plan(spark, capsys):
    from tests.conftest import SF_SMALL
    op12_centroids(spark, SF_SMALL).explain()
    fit_centroids(integer_vectors(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))).assigned.explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
