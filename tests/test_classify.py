"""Classifier metrics against Spark's evaluator; model persistence; k-means."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors

from logloom.operators import classify as C


def test_metrics_match_evaluator(spark):
    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0), (2.0, 2.0), (2.0, 2.0), (1.0, 3.0)]
    pred = spark.createDataFrame(rows, "label double, prediction double")
    got = C.classification_metrics(pred).first()
    for name, metric in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall"), ("f1", "f1")]:
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                               metricName=metric)
        assert got[name] == pytest.approx(ev.evaluate(pred), abs=1e-12), name


def test_classifier_fit_save_load(spark, tmp_path):
    rows = [("a.com", 1.0, 2, Vectors.dense([1.0, 0.0]), 10, Vectors.sparse(4, [0], [1.0])),
            ("b.com", 9.0, 3, Vectors.dense([0.0, 1.0]), 900, Vectors.sparse(4, [3], [1.0]))] * 10
    df = spark.createDataFrame(rows, ["domain", *C.CLASSIFIER_FEATURES])
    model = C.train_domain_classifier(df, max_iter=20)
    acc = C.classification_metrics(model.transform(df)).first()["accuracy"]
    assert acc == 1.0
    C.save_model(model.stages[-1], str(tmp_path / "lr"))
    assert C.load_logistic(str(tmp_path / "lr")).numClasses == 2


def test_unseen_labels_stay_and_count_as_errors(spark):
    rows = [("a.com", 1.0, 2, Vectors.dense([1.0, 0.0]), 10, Vectors.sparse(4, [0], [1.0])),
            ("b.com", 9.0, 3, Vectors.dense([0.0, 1.0]), 900, Vectors.sparse(4, [3], [1.0]))]
    columns = ["domain", *C.CLASSIFIER_FEATURES]
    model = C.train_domain_classifier(spark.createDataFrame(rows * 10, columns), max_iter=20)
    test = spark.createDataFrame([*rows, ("new.com", *rows[0][1:])], columns)
    scored = model.transform(test)
    assert scored.count() == 3 and scored.where("domain = 'new.com'").first()["label"] == 2.0
    assert C.classification_metrics(scored).first()["accuracy"] == pytest.approx(2 / 3)


def test_kmeans(spark):
    rows = [(float(i % 2) * 10 + 0.1 * i, 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double")
    _, out = C.kmeans_clusters(df, ["a", "b"], k=2, seed=1)
    assert out.select("cluster").distinct().count() == 2


def _three(spark, n=240):
    import numpy as np
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        c = i % 3
        x = rng.normal(size=2) + [[0, 0], [3, 0], [0, 3]][c]
        rows.append((i, f"d{c}", float(x[0]), 1 + c, Vectors.dense([float(c == 0)]), int(10 * abs(x[1])), Vectors.sparse(5, [c], [1.0])))
    return spark.createDataFrame(rows, ["id", "domain", *C.CLASSIFIER_FEATURES])


def test_metrics_on_the_classifiers_own_held_out_rows(spark):
    df = _three(spark).unionByName(_three(spark, 1).selectExpr("99999 as id", "'rare' as domain", *C.CLASSIFIER_FEATURES))
    done = C.train_and_hold_out(df, "id", max_iter=30, portable=True)
    train, scored = ({r["id"] for r in x.select("id").collect()} for x in (done.train, done.scored))
    assert not train & scored and len(train | scored) == 241 and len(scored) > 30
    got = done.metrics().first()
    for name, metric in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"), ("f1", "f1")]:
        assert got[name] == pytest.approx(MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=metric).evaluate(done.scored), abs=1e-12)
    by = {r["domain"]: r for r in done.by_label().collect()}
    assert sum(r["n"] for r in by.values()) == len(scored) and all(r["recall"] == r["right"] / r["n"] for r in by.values())
    again = C.train_and_hold_out(df.repartition(5), "id", max_iter=1, portable=True)
    assert {r["id"] for r in again.scored.select("id").collect()} == scored


def test_the_fit_is_stationary_by_the_distributed_gradient(spark):
    import numpy as np
    from pyspark.ml.classification import LogisticRegression
    df = _three(spark).selectExpr("cast(substr(domain, 2) as double) as y", "fabstime", "body_bytes_sent / 10.0 as b")
    from logloom.operators.features import assemble
    ready = assemble(df, ["fabstime", "b"])
    reg = 0.05
    fit = LogisticRegression(labelCol="y", family="multinomial", regParam=reg, standardization=False, maxIter=300, tol=1e-12).fit(ready)
    w, b = fit.coefficientMatrix.toArray(), fit.interceptVector.toArray()
    loss, slope, shift = C.softmax_loss(ready, "features", "y", w, b, reg=reg)
    assert np.linalg.norm(slope) < 1e-5 and np.linalg.norm(shift) < 1e-5
    start, first, _ = C.softmax_loss(ready, "features", "y", np.zeros_like(w), np.zeros_like(b), reg=reg)
    assert start == pytest.approx(np.log(3)) and loss < start and np.linalg.norm(first) > 0.1
    step = 1e-6
    moved = w.copy() + 0.3
    _, g, _ = C.softmax_loss(ready, "features", "y", moved, b, reg=reg)
    bumped = moved.copy()
    bumped[1, 0] += step
    up, down = (C.softmax_loss(ready, "features", "y", x, b, reg=reg)[0] for x in (bumped, moved))
    assert (up - down) / step == pytest.approx(g[1, 0], abs=1e-4)


def test_one_lloyd_step(spark):
    rows = [(0.0, 0.0), (2.0, 0.0), (9.0, 9.0), (1.0, 0.0)]
    out = C.lloyd_step(spark.createDataFrame(rows, "a double, b double"), ["a", "b"], [[1.0, 0.0], [9.0, 8.0], [1.0, 0.0], [500.0, 0.0]])
    assert {tuple(r) for r in out.collect()} == {(0, 3, 1.0, 0.0), (1, 1, 9.0, 9.0)}  # a tie goes to the smaller number
