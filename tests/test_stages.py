"""Pipeline stages (M-11): from raw lines to flags, saved and reloaded."""

import pytest
from pyspark.ml import Pipeline, PipelineModel

from logloom.operators import stages as ST
from logloom.operators import weblog as W

LINE = '10.0.0.{i} - u{i} [0{d}/Jan/2024:1{h}:20:30 +0000] "{m} /shop/p{p}/x?k{p}=v HTTP/1.1" 200 {b} "https://s{p}.example.com/" "ua"'


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(LINE.format(i=i % 50, d=1 + i % 9, h=i % 10, m=["GET", "GET", "PUT"][i % 3], p=i % 7, b=100 + i % 13 if i != 77 else 9_000_000),) for i in range(200)]
    return spark.createDataFrame([*rows, ("no log line",)], "value string")


def _rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_raw_lines_to_som_flags_and_back_from_disk(spark, lines, tmp_path):
    pipeline = Pipeline(stages=[ST.LogParser(), ST.LabelIndexer(inputCol="req_method", oneHotCol="req_method_onehot"), ST.LogVectors(numFeatures=64),
                                ST.SomFlagger(gridRows=2, gridCols=3, iterations=4, bands=2, percentile=0.99)])
    pipeline.write().save(str(tmp_path / "unfitted"))
    model = Pipeline.load(str(tmp_path / "unfitted")).fit(lines)
    out = model.transform(lines)
    assert out.count() == 200
    flagged = out.where("is_anomaly").collect()
    assert any(r["body_bytes_sent"] == 9_000_000 for r in flagged) and len(flagged) <= 3
    model.write().save(str(tmp_path / "fitted"))
    again = PipelineModel.load(str(tmp_path / "fitted"))
    columns = ["remote_addr", "date_time", "bmu", "distance", "is_anomaly"]
    assert _rows(again.transform(lines), *columns) == _rows(out, *columns)
    assert again.stages[1].fitted.size == 2 and again.stages[-1].get("threshold") == model.stages[-1].get("threshold")
    # A later log with a method the fit didn't see still goes through.
    later = spark.createDataFrame([(LINE.format(i=1, d=1, h=1, m="HEAD", p=1, b=5),)], "value string")
    assert again.transform(later).first()["req_method_index"] == 2.0


def test_autoencoder_flags_and_fixed_thresholds(spark, lines, tmp_path):
    stages = [ST.LogParser(), ST.LabelIndexer(inputCol="req_method", oneHotCol="req_method_onehot"),
              ST.LogVectors(inputCols=["fabstime", "body_bytes_sent"], outputCol="x"),
              ST.AutoencoderFlagger(featuresCol="x", hidden=[4], epochs=2, steps=2, percentile=0.9)]
    model = Pipeline(stages=stages).fit(lines)
    model.write().save(str(tmp_path / "ae"))
    again = PipelineModel.load(str(tmp_path / "ae"))
    columns = ["remote_addr", "date_time", "reconstruction_error", "is_anomaly"]
    assert _rows(again.transform(lines), *columns) == _rows(model.transform(lines), *columns)
    assert 0 < model.transform(lines).where("is_anomaly").count() <= 20
    stages[-1] = ST.AutoencoderFlagger(featuresCol="x", hidden=[4], epochs=1, steps=1, threshold=1e9, scoreCol="score", flagCol="odd")
    assert Pipeline(stages=stages).fit(lines).transform(lines).where("odd").count() == 0


def test_transformers_equal_the_library_calls(spark, lines):
    parsed = ST.LogParser().transform(lines)
    assert parsed.columns == W.add_time_columns(W.add_url_columns(W.clean_log(W.parse_access_log(lines)))).columns
    ours = ST.UrlFeatures(n=3, numFeatures=32, items="pairs").transform(parsed)
    want = W.add_path_features(parsed, 3, 32, "pairs")
    assert _rows(ours, "req_uri", "hash_url_features") == _rows(want, "req_uri", "hash_url_features")


def test_params_copy_and_defaults(spark):
    flagger = ST.SomFlagger(gridRows=3)
    assert flagger.get("gridRows") == 3 and flagger.get("gridCols") == 10
    copied = flagger.copy({flagger.getParam("gridCols"): 4})
    assert copied.get("gridCols") == 4 and flagger.get("gridCols") == 10


def test_som_flagger_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for pdf in batches:
            seen.add(len(pdf))
            pdf["features"] = [[float(i % 7), float(i % 5)] for i in pdf["id"]]
            yield pdf

    rows = spark.range(200).mapInPandas(run, "id long, features array<double>")
    model = ST.SomFlagger(gridRows=2, gridCols=2, iterations=2, bands=2, seed=1).fit(rows)
    assert seen.value == 200  # not again for the bands, and again for the threshold
    assert model.transform(rows).count() == 200
