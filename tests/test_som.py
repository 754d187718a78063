"""SOM properties (S-07 literal tables from the survey's fixtures)."""

import numpy as np

from logloom.operators import som as SOM

NORMAL = [(0, 1.0, 2.0, 3.0), (1, 2.0, 3.0, 4.0), (2, 3.0, 4.0, 5.0), (3, 4.0, 5.0, 6.0)]
ANOMALIES = [(4, 50.0, 60.0, 70.0), (5, 100.0, 200.0, 300.0)]
SCHEMA = "id bigint, feature1 double, feature2 double, feature3 double"
FEATS = ["feature1", "feature2", "feature3"]


def test_marked_rows_are_farthest(spark):
    train = spark.createDataFrame(NORMAL, SCHEMA)
    model = SOM.train_som(train, FEATS, 3, 3, iterations=30, sigma=1.0, learning_rate=0.5, seed=1)
    allrows = spark.createDataFrame(NORMAL + ANOMALIES, SCHEMA)
    scored = sorted(model.score(allrows, FEATS, ["id"]).collect(), key=lambda r: -r["distance"])
    assert {scored[0]["id"], scored[1]["id"]} == {4, 5}
    flagged = SOM.som_anomalies(model, allrows, FEATS, ["id"], threshold=3.0)
    assert {r["id"] for r in flagged.filter("is_anomaly").collect()} == {4, 5}


def test_quantization_error_does_not_rise(spark):
    rng = np.random.default_rng(0)
    rows = [(i, *map(float, rng.normal(size=3))) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    w0 = SOM.initial_codebook(df, FEATS, 4, 4, seed=3)
    qe0 = SOM.SomModel(4, 4, w0).quantization_error(df, FEATS)
    model = SOM.train_som(df, FEATS, 4, 4, iterations=10, sigma=1.5, init=w0)
    assert model.quantization_error(df, FEATS) < qe0


def test_bmu_matches_numpy_and_winner(spark):
    w = np.array([[0.0, 0.0, 0.0], [10.0, 10.0, 10.0], [3.0, 4.0, 5.0]])
    model = SOM.SomModel(1, 3, w)
    df = spark.createDataFrame(NORMAL, SCHEMA)
    got = {r["id"]: r["bmu"] for r in model.score(df, FEATS, ["id"]).collect()}
    for i, a, b, c in NORMAL:
        assert got[i] == int(np.argmin(((w - [a, b, c]) ** 2).sum(1)))
    assert model.winner([3.0, 4.0, 5.0]) == (0, 2)


def test_cutoff_kernel_and_round_trip(spark, tmp_path):
    h = SOM.neighbourhood(10, 10, 5.0, cutoff=5.0)
    assert h[0, 0] == 1.0 and h[0, 5] == 0.0 and h[0, 4] > 0
    model = SOM.SomModel(2, 2, np.arange(8, dtype=float).reshape(4, 2))
    model.save(spark, str(tmp_path / "som"))
    back = SOM.SomModel.load(spark, str(tmp_path / "som"))
    assert back.m == 2 and back.n == 2 and np.array_equal(back.weights, model.weights)


def test_batch_update_keeps_empty_nodes():
    w = np.array([[0.0], [5.0]])
    s = np.array([[4.0], [0.0]])
    c = np.array([2.0, 0.0])
    k = np.eye(2)
    assert np.allclose(SOM.batch_update(w, s, c, k), [[2.0], [5.0]])


def test_variant_without_decay_and_with_cutoff(spark):
    """M-13: constant rate 0.4, no decay, neighbourhood cut at the radius
    (half the larger grid side), on a wide grid. Each update is a convex
    combination of the old weights and weighted data means, so weights stay
    inside the data's bounding box; a seeded run is reproducible."""
    rng = np.random.default_rng(4)
    rows = [(i, *map(float, rng.random(3))) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    m, n = 2, 12
    args = dict(iterations=8, sigma=max(m, n) // 2, learning_rate=0.4, decay=False,
                cutoff=max(m, n) // 2, seed=2)
    model = SOM.train_som(df, FEATS, m, n, **args)
    again = SOM.train_som(df, FEATS, m, n, **args)
    x = np.array([r[1:] for r in rows])
    assert model.weights.shape == (24, 3)
    assert np.all(model.weights >= x.min(0) - 1e-12) and np.all(model.weights <= x.max(0) + 1e-12)
    assert np.allclose(model.weights, again.weights)


def test_grid_smoothing_equals_the_kernel_product():
    rng = np.random.default_rng(2)
    for m, n in ((3, 7), (7, 3), (1, 5), (4, 4)):
        for cutoff in (None, 2.5):
            values = rng.random((m * n, 4))
            assert np.allclose(SOM.grid_smooth(values, m, n, 1.3, cutoff), SOM.neighbourhood(m, n, 1.3, cutoff).T @ values)


def test_product_form_keeps_the_plain_winner_and_ties():
    rng = np.random.default_rng(6)
    w = rng.integers(0, 3, (40, 5)).astype(float) + 1e6
    x = rng.integers(0, 3, (300, 5)).astype(float) + 1e6
    idx, dist = SOM._bmu_and_dist(x, w)
    d2 = ((x[:, None, :] - w[None, :, :]) ** 2).sum(axis=2)
    assert np.array_equal(idx, d2.argmin(axis=1)) and np.allclose(dist, np.sqrt(d2.min(axis=1)))


def test_wide_grid_with_a_thousand_features(spark):
    """M-13's own grid, 10 x 1013, with 1,006 features: blocks stay at 32 MB."""
    from pyspark.sql import functions as F
    df = spark.range(60).select(F.transform(F.sequence(F.lit(0), F.lit(1005)), lambda k: ((F.col("id") * 7 + k) % 13).cast("double")).alias("f"))
    model = SOM.train_som(df, "f", 10, 1013, iterations=1, sigma=506, learning_rate=0.4, decay=False, cutoff=506, seed=2)
    assert model.weights.shape == (10130, 1006) and np.isfinite(model.weights).all()


def _sparse_table(spark, n=300, dim=1005, seed=3):
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(seed)
    rows, dense = [], np.zeros((n, dim))
    for i in range(n):
        at = np.sort(rng.choice(dim, rng.integers(0, 12), replace=False))
        values = rng.integers(1, 4, len(at)).astype(float)
        dense[i, at] = values
        rows.append((i, Vectors.dense(dense[i]) if i % 7 == 0 else Vectors.sparse(dim, at.tolist(), values.tolist())))
    return spark.createDataFrame(rows, ["id", "f"]), dense


def test_sparse_rows_give_the_dense_result(spark):
    df, dense = _sparse_table(spark)
    rng = np.random.default_rng(1)
    w = np.concatenate([rng.random((20, dense.shape[1])), dense[:3], np.zeros((2, dense.shape[1]))])
    model = SOM.SomModel(5, 5, w)
    idx, dist = SOM._bmu_and_dist(dense, w)
    got = model.score(df, "f", ["id"]).orderBy("id").collect()
    assert [r["bmu"] for r in got] == idx.tolist() and np.allclose([r["distance"] for r in got], dist, atol=1e-9)
    s, c = SOM.bmu_statistics(df, "f", w)
    want = np.zeros_like(w)
    np.add.at(want, idx, dense)
    assert np.allclose(s, want) and np.array_equal(c, np.bincount(idx, minlength=25))
    lo, hi = SOM.feature_bounds(df, "f")
    assert np.array_equal(lo, dense.min(0)) and np.array_equal(hi, dense.max(0))


def test_sparse_training_equals_dense_training(spark):
    from pyspark.ml.functions import vector_to_array
    df, dense = _sparse_table(spark, dim=40)
    w0 = np.random.default_rng(2).random((12, 40))
    args = dict(m=3, n=4, iterations=3, sigma=1.5, learning_rate=0.4, decay=False, cutoff=2.0, init=w0)
    a = SOM.train_som(df, "f", **args)
    b = SOM.train_som(df.select(vector_to_array("f").alias("f")), "f", **args)
    assert np.allclose(a.weights, b.weights, atol=1e-12)


def test_sparse_edges(spark):
    import pytest
    from pyspark.ml.linalg import Vectors
    df, _ = _sparse_table(spark, n=5, dim=4 + 12)
    model = SOM.SomModel(1, 2, np.zeros((2, 16)))
    assert {r["bmu"] for r in model.score(df, "f", []).collect()} == {0}  # ties go to the lower node
    assert model.score(df.limit(0), "f", ["id"]).collect() == []
    assert SOM.bmu_statistics(df.limit(0), "f", model.weights)[1].sum() == 0
    for bad in ([(1, Vectors.sparse(9, [], []))], [(1, None)]):
        frame = spark.createDataFrame(bad, df.schema)
        with pytest.raises(Exception, match="feature vector"):
            model.score(frame, "f", ["id"]).collect()


def test_the_cost_of_sparse_rows_follows_their_entries():
    """A block is bounded by entries times nodes, not by rows times features."""
    from logloom.operators.vectors import SparseRows
    n, dim = 3000, 1 << 18
    rng = np.random.default_rng(4)
    x = SparseRows(np.arange(0, 3 * n + 1, 3), rng.integers(0, dim, 3 * n), np.ones(3 * n), dim)
    w = np.zeros((4, dim))
    w[1, x.index[:3]] = 1.0
    idx, dist = SOM._sparse_bmu_and_dist(x, w)
    assert idx[0] == 1 and dist[0] == 0.0 and (dist[1:] > 0).all()


def test_minibatches_read_each_row_once_a_round_and_the_error_falls(spark):
    from logloom.operators import sampling as S
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, *map(float, rng.normal(size=3))) for i in range(800)], SCHEMA)
    bands = S.hash_bands(df, 8, "id")
    parts = [bands.read(b) for b in range(8)]
    ids = [sorted(r["id"] for r in p.collect()) for p in parts]
    assert sorted(i for p in ids for i in p) == list(range(800)) and min(map(len, ids)) > 50
    again = S.hash_bands(df.repartition(11), 8, "id")
    assert [sorted(r["id"] for r in again.read(b).collect()) for b in range(8)] == ids
    plan = parts[3]._jdf.queryExecution().executedPlan().toString()
    assert "_band" in plan.split("PartitionFilters")[1][:80]
    w0 = SOM.initial_codebook(df, FEATS, 4, 4, seed=3)
    before = SOM.SomModel(4, 4, w0).quantization_error(df, FEATS)
    model = SOM.train_som(df, FEATS, 4, 4, iterations=16, sigma=1.5, init=w0, bands=8, key="id")
    other = SOM.train_som(df.repartition(13), FEATS, 4, 4, iterations=16, sigma=1.5, init=w0, bands=8, key="id")
    assert model.quantization_error(df, FEATS) < 0.8 * before and np.allclose(model.weights, other.weights, atol=1e-9)


def test_every_task_writes_its_share_of_each_of_few_bands(spark):
    from pyspark.sql import functions as F
    from logloom.operators import sampling as S
    df = spark.range(0, 4000, 1, 8).withColumn("v", F.lit(1.0))
    bands = S.hash_bands(df, 4, "id")
    files = [bands.read(b).select(F.input_file_name().alias("f")).distinct().count() for b in range(4)]
    assert min(files) == 8  # so a step of the training is as many tasks, however well the rows compress
    assert bands.table.count() == 4000
