"""Fitted label indexes: stored, reloaded, applied to other rows."""

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array

from logloom.operators import features as FE
from logloom.operators import weblog as W

SCHEMA = "req_method string, v int"


def _index(out, column="req_method"):
    return {r[column]: r[f"{column}_index"] for r in out.collect()}


def test_the_same_labels_have_the_same_index_in_every_table(spark, tmp_path):
    first = spark.createDataFrame([("GET", 1)] * 3 + [("PUT", 2)] * 2 + [("POST", 3)], SCHEMA)
    other = spark.createDataFrame([("PUT", 1)] * 5 + [("GET", 2), ("POST", 7)], SCHEMA)
    FE.LabelIndex.fit(first, "req_method").save(str(tmp_path / "idx"))
    fitted = FE.LabelIndex.load(spark, str(tmp_path / "idx"))
    assert fitted.column == "req_method" and fitted.size == 3
    assert _index(fitted.transform(first)) == _index(fitted.transform(other)) == {"GET": 0.0, "PUT": 1.0, "POST": 2.0}
    # Each fitted anew they differ: the case that a stored index is for.
    assert _index(FE.LabelIndex.fit(other, "req_method").transform(other))["PUT"] == 0.0
    model = StringIndexer(inputCol="req_method", outputCol="i").fit(first)
    assert {lab: float(i) for i, lab in enumerate(model.labels)} == _index(fitted.transform(first))


def test_unseen_rules(spark):
    fitted = FE.LabelIndex.fit(spark.createDataFrame([("GET", 1), ("PUT", 1), ("GET", 1)], SCHEMA), "req_method")
    new = spark.createDataFrame([("GET", 1), ("HEAD", 2), (None, 3)], SCHEMA)
    assert _index(fitted.transform(new, unseen="keep")) == {"GET": 0.0, "HEAD": 2.0, None: 2.0}
    assert _index(fitted.transform(new, unseen="skip")) == {"GET": 0.0}
    with pytest.raises(Exception, match="unseen label"):
        fitted.transform(new).collect()
    with pytest.raises(ValueError):
        fitted.transform(new, unseen="other")


def test_one_hot_size_follows_the_fit(spark):
    fitted = FE.LabelIndex.fit(spark.createDataFrame([("a", 1), ("b", 1), ("a", 1), ("c", 1)], SCHEMA), "req_method")
    hot = lambda rows, **kw: {r.req_method: list(r.h) for r in fitted.one_hot(spark.createDataFrame(rows, SCHEMA), **kw).select("req_method", vector_to_array("req_method_onehot").alias("h")).collect()}
    assert hot([("b", 1)]) == {"b": [0.0, 1.0]}
    assert hot([("c", 1), ("new", 1)], unseen="keep") == {"c": [0.0, 0.0, 1.0], "new": [0.0, 0.0, 0.0]}
    assert hot([("c", 1)], drop_last=False) == {"c": [0.0, 0.0, 1.0]}


def test_clashing_columns_and_empty_tables(spark):
    fitted = FE.LabelIndex.fit(spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA), "req_method")
    clash = spark.createDataFrame([("a", 1, 9.0, 1, 2, 3)], "req_method string, n int, req_method_index double, label int, label_index int, size int")
    row = fitted.transform(clash).first()
    assert row["req_method_index"] == 0.0 and (row["n"], row["label"], row["label_index"], row["size"]) == (1, 1, 2, 3)
    empty = spark.createDataFrame([], SCHEMA)
    assert fitted.transform(empty).collect() == [] and FE.LabelIndex.fit(empty, "req_method").size == 0


def test_an_extract_reuses_the_indexes_of_another(spark):
    line = '10.0.0.1 - - [01/Jan/2024:10:00:00 +0000] "{m} /a/b?x=1 HTTP/1.1" 200 5 "https://s.example.com/" "ua"'
    log = lambda *methods: spark.createDataFrame([(line.format(m=m),) for m in methods], "value string")
    first, later = log("GET", "GET", "PUT"), log("PUT", "PUT", "GET", "HEAD")
    fitted = [FE.LabelIndex.fit(W.extract_log(first, index=False), c) for c in ("req_method", "domain")]
    out = W.extract_log(later, indexes=fitted)
    assert _index(out) == {"GET": 0.0, "PUT": 1.0, "HEAD": 2.0}
    assert set(W.extract_log(first).columns) == set(out.columns)
    assert {r.req_method_onehot.size for r in out.collect()} == {2}


def test_a_hot_label_is_counted_in_the_tasks(spark):
    from pyspark.sql import functions as F
    rows = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("c"))
    fitted = FE.LabelIndex.fit(rows, "c")
    top = fitted.labels.orderBy("label_index").first()
    assert (top["label"], top["n"], top["label_index"]) == ("hot", 6000, 0) and fitted.size == 501
    assert fitted.transform(rows).count() == 9000
