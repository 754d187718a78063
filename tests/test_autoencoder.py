"""Autoencoder properties (S-08 generated table, A8 literal)."""

import numpy as np
import pytest
from pyspark.sql.functions import lit as F_lit

from logloom.operators import autoencoder as AE
from logloom.sources.generated import uniform_table


def test_loss_falls_on_uniform_table(spark):
    df = uniform_table(spark, 4000, 20, seed=5, num_partitions=4)
    feats = [f"feature_{i}" for i in range(20)]
    model = AE.train_autoencoder(df, feats, [10], epochs=4, batch_size=256, learning_rate=1e-2, seed=2)
    assert len(model.history) == 4
    assert model.history[-1] < model.history[0]


def test_far_row_has_largest_error(spark):
    rows = [(1, 3.0, 2.0), (2, 4.0, 3.0), (3, 5.0, 4.0), (4, 6.0, 5.0), (5, 100.0, 120.0)]
    df = spark.createDataFrame(rows, "id bigint, f1 double, f2 double")
    normal = df.filter("id < 5")
    model = AE.train_autoencoder(normal, ["f1", "f2"], [8], epochs=30, batch_size=4,
                                 learning_rate=5e-2, seed=0, minmax=True)
    errs = {r["id"]: r["reconstruction_error"] for r in model.score(df, ["f1", "f2"], ["id"]).collect()}
    assert max(errs, key=errs.get) == 5


def test_gradients_match_finite_differences():
    model = AE.init_autoencoder([3, 4, 3], seed=0)
    x = np.random.default_rng(1).random((5, 3))
    gw, gb, loss = AE._grads(model, x)
    eps = 1e-6
    w = model.weights[0]
    w[1, 2] += eps
    up = float(((model.forward(x)[-1] - x) ** 2).mean())
    w[1, 2] -= eps
    assert abs((up - loss) / eps - gw[0][1, 2]) < 1e-4


def test_uniform_table_is_layout_independent(spark):
    a = uniform_table(spark, 100, 3, seed=1, num_partitions=1).orderBy("id").collect()
    b = uniform_table(spark, 100, 3, seed=1, num_partitions=7).orderBy("id").collect()
    assert a == b and all(0 <= r["feature_2"] < 1 for r in a)


def _table(spark, n=600, parts=4):
    rng = np.random.default_rng(8)
    base = rng.random((n, 2))
    rows = [(i, float(a), float(b), float(a * b), float(a - b)) for i, (a, b) in enumerate(base)]
    return spark.createDataFrame(rows, "id bigint, a double, b double, c double, d double").repartition(parts)


FEATS = ["a", "b", "c", "d"]


def test_the_model_does_not_depend_on_the_partitions(spark):
    models = [AE.train_autoencoder(_table(spark, parts=p), FEATS, [6, 3, 6], epochs=3, steps=4, learning_rate=1e-2, seed=5) for p in (4, 64)]
    assert np.allclose(models[0].flat(), models[1].flat(), rtol=0, atol=1e-9)
    assert np.allclose(models[0].history, models[1].history, rtol=0, atol=1e-9)
    losses = [m.loss(_table(spark, parts=9), FEATS) for m in models]
    assert abs(losses[0] - losses[1]) < 1e-9 and losses[0] < models[0].history[0]


def test_a_step_is_one_adam_step_on_all_rows(spark):
    df = _table(spark)
    x = np.array([tuple(r) for r in df.select(*FEATS).collect()])
    start = AE.init_autoencoder([4, 3, 4], seed=1)
    start.lo, start.hi = AE.feature_range(df, FEATS)
    gw, gb, loss = AE._grads(start, start.scale(x))
    g = np.concatenate([a.ravel() for pair in zip(gw, gb) for a in pair])
    total, summed, n = AE.gradient_sums(start, df, FEATS)
    assert n == 600 and np.allclose(total / n, g, atol=1e-15) and abs(summed / n - loss) < 1e-12
    model = AE.train_autoencoder(df, FEATS, [3], epochs=2, steps=1, learning_rate=1e-2, seed=1)
    # By hand: the moments go on from the first step to the second.
    flat, m, v = start.flat(), 0.0, 0.0
    for t in (1, 2):
        at = start.with_flat(flat)
        gw, gb, _ = AE._grads(at, at.scale(x))
        g = np.concatenate([a.ravel() for pair in zip(gw, gb) for a in pair])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        flat = flat - 1e-2 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-7)
    assert np.allclose(model.flat(), flat, atol=1e-12)


def test_training_goes_on_where_it_stopped(spark):
    df = _table(spark)
    adam = AE.Adam(1e-2)
    first = AE.train_autoencoder(df, FEATS, [3], epochs=1, steps=1, seed=1, optimizer=adam)
    both = AE.train_autoencoder(df, FEATS, [3], epochs=1, steps=1, seed=1, optimizer=adam, start=first)
    whole = AE.train_autoencoder(df, FEATS, [3], epochs=2, steps=1, seed=1, learning_rate=1e-2)
    assert adam.t == 2 and np.allclose(both.flat(), whole.flat(), atol=1e-12) and np.allclose(both.history, whole.history)


def test_bands_cover_every_row_once_even_when_most_are_equal(spark):
    from pyspark.sql import functions as F
    df = spark.range(300).select(F.col("id").alias("key"), F.when(F.col("id") % 3 > 0, 1.0).otherwise(F.col("id") / 300.0).alias("a"), F.lit(0.5).alias("b"))
    for key in (None, "key"):
        model = AE.train_autoencoder(df, ["a", "b"], [2], epochs=2, steps=5, key=key, seed=3)
        assert len(model.history) == 2 and np.isfinite(model.flat()).all()


def test_store_and_load(spark, tmp_path):
    df = _table(spark, 50)
    model = AE.train_autoencoder(df, FEATS, [6, 3, 6], epochs=1, steps=1, seed=2)
    model.save(spark, str(tmp_path / "ae"))
    back = AE.Autoencoder.load(spark, str(tmp_path / "ae"))
    assert np.array_equal(back.flat(), model.flat()) and back.history == model.history
    assert [w.shape for w in back.weights] == [w.shape for w in model.weights]
    score = lambda m: sorted(map(tuple, m.score(df, FEATS, ["id"]).collect()))
    assert score(back) == score(model)
    plain = AE.init_autoencoder([2, 1, 2])
    plain.save(spark, str(tmp_path / "plain"))
    assert AE.Autoencoder.load(spark, str(tmp_path / "plain")).lo is None
    spark.read.parquet(str(tmp_path / "ae")).withColumn("schema_version", F_lit(9)).write.parquet(str(tmp_path / "newer"))
    with pytest.raises(ValueError, match="schema version"):
        AE.Autoencoder.load(spark, str(tmp_path / "newer"))


def test_no_rows(spark):
    empty = spark.createDataFrame([], "a double, b double")
    with pytest.raises(ValueError):
        AE.train_autoencoder(empty, ["a", "b"], [2], epochs=1)
    start = AE.init_autoencoder([2, 2, 2])
    assert AE.train_autoencoder(empty, ["a", "b"], [2], epochs=1, start=start) is start
