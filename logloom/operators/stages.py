"""The library's steps as pipeline stages (M-11).

Transformers and estimators with params, so one ``Pipeline`` goes from raw
log lines to anomaly flags, and the fitted pipeline is saved and loaded
like any other. Params are stored by Spark's own metadata; fitted tables
(labels, codebooks, weights) are Parquet beside them.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame

from logloom.operators import features as FE
from logloom.operators import weblog as W
from logloom.operators.autoencoder import Autoencoder, train_autoencoder
from logloom.operators.som import SomModel, train_som
from logloom.operators.stats import exact_percentile, flag_above
from logloom.sources.staging import materialize


def _param(name: str, doc: str, convert) -> Param:
    return Param(Params._dummy(), name, doc, convert)


class _Stage(Params):
    """Keyword arguments set params; unset ones have the class's defaults."""

    DEFAULTS: dict = {}

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._setDefault(**self.DEFAULTS)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def get(self, name: str):
        return self.getOrDefault(self.getParam(name))


# ---- tables of fitted models -------------------------------------------------

class _TableWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance._save_data(self.sparkSession, f"{path}/data")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = self.cls()
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        instance._load_data(self.sparkSession, f"{path}/data")
        return instance


class _TableModel(_Stage, Model, MLReadable, MLWritable):
    """A fitted stage whose state is a table (``_save_data``, ``_load_data``)."""

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


# ---- raw lines to columns ------------------------------------------------------

class LogParser(_Stage, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Access-log lines to the cleaned, typed table with URL and time columns
    (P-01 to P-07, F-01 to F-08). Lines that don't parse go."""

    inputCol = _param("inputCol", "column with the raw lines", TypeConverters.toString)
    DEFAULTS = {"inputCol": "value"}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cleaned = W.clean_log(W.parse_access_log(dataset, self.get("inputCol")))
        return W.add_time_columns(W.add_url_columns(cleaned))


class UrlFeatures(_Stage, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Path n-grams and query items, hashed (F-09, M-01, F-11, F-12, M-03)."""

    n = _param("n", "characters in a path n-gram", TypeConverters.toInt)
    numFeatures = _param("numFeatures", "hash buckets", TypeConverters.toInt)
    items = _param("items", "keys or pairs of the query", TypeConverters.toString)
    DEFAULTS = {"n": 9, "numFeatures": 16384, "items": "keys"}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return W.add_path_features(dataset, self.get("n"), self.get("numFeatures"), self.get("items"))


class LogVectors(_Stage, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Extracted log rows to one sparse feature vector (M-07)."""

    numFeatures = _param("numFeatures", "hash buckets", TypeConverters.toInt)
    inputCols = _param("inputCols", "columns to assemble", TypeConverters.toListString)
    outputCol = _param("outputCol", "vector column", TypeConverters.toString)
    DEFAULTS = {"numFeatures": 1000, "inputCols": FE.LOG_VECTOR_INPUTS, "outputCol": "features"}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return FE.log_vectors(dataset, self.get("numFeatures"), self.get("outputCol"), self.get("inputCols"))


# ---- label index -----------------------------------------------------------------

class _LabelParams(_Stage):
    inputCol = _param("inputCol", "column with the labels", TypeConverters.toString)
    outputCol = _param("outputCol", "index column", TypeConverters.toString)
    oneHotCol = _param("oneHotCol", "one-hot column; empty for none", TypeConverters.toString)
    unseen = _param("unseen", "error, keep or skip", TypeConverters.toString)
    DEFAULTS = {"inputCol": "domain", "outputCol": "", "oneHotCol": "", "unseen": "keep"}


class LabelIndexModel(_LabelParams, _TableModel):
    fitted: FE.LabelIndex

    def _transform(self, dataset: DataFrame) -> DataFrame:
        column, out = self.get("inputCol"), self.get("outputCol") or f"{self.get('inputCol')}_index"
        if self.get("oneHotCol"):
            hot = self.fitted.one_hot(dataset, column, self.get("oneHotCol"), self.get("unseen"))
            return hot if out == f"{column}_index" else hot.withColumnRenamed(f"{column}_index", out)
        return self.fitted.transform(dataset, column, out, self.get("unseen"))

    def _save_data(self, spark, path: str) -> None:
        self.fitted.save(path)

    def _load_data(self, spark, path: str) -> None:
        self.fitted = FE.LabelIndex.load(spark, path)


class LabelIndexer(_LabelParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """M-05/M-06: fits a ``LabelIndex`` on one column."""

    def _fit(self, dataset: DataFrame) -> LabelIndexModel:
        model = self._copyValues(LabelIndexModel())
        model.fitted = FE.LabelIndex.fit(dataset, self.get("inputCol"))
        return model


# ---- anomaly models ------------------------------------------------------------------

class _FlagParams(_Stage):
    featuresCol = _param("featuresCol", "vector or array column", TypeConverters.toString)
    scoreCol = _param("scoreCol", "score column", TypeConverters.toString)
    flagCol = _param("flagCol", "flag column", TypeConverters.toString)
    percentile = _param("percentile", "share of training scores at or below the threshold", TypeConverters.toFloat)
    threshold = _param("threshold", "score above which a row is flagged; fitted if unset", TypeConverters.toFloat)
    seed = _param("seed", "seed of the start", TypeConverters.toInt)

    def _flag(self, scored: DataFrame) -> DataFrame:
        return flag_above(scored, self.get("scoreCol"), self.get("threshold"), self.get("flagCol"))

    def _fit_threshold(self, model, dataset: DataFrame):
        """The percentile of the training rows' scores, unless one is set.
        Without scores it stays unset and nothing is flagged."""
        if not self.isSet(self.threshold):
            found = exact_percentile(model._scores(dataset), self.get("scoreCol"), self.get("percentile"))
            model._set(threshold=float("inf") if found is None else found)
        return model


class SomFlagModel(_FlagParams, _TableModel):
    gridRows = _param("gridRows", "rows of the grid", TypeConverters.toInt)
    gridCols = _param("gridCols", "columns of the grid", TypeConverters.toInt)
    DEFAULTS = {"featuresCol": "features", "scoreCol": "distance", "flagCol": "is_anomaly", "percentile": 0.95, "seed": 0,
                "gridRows": 10, "gridCols": 10}
    som: SomModel

    def _scores(self, dataset: DataFrame) -> DataFrame:
        simple = [c for c, kind in dataset.dtypes if "vector" not in kind]
        scored = self.som.score(dataset, self.get("featuresCol"), simple)
        return scored if self.get("scoreCol") == "distance" else scored.withColumnRenamed("distance", self.get("scoreCol"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Rows with bmu, bmu_row, bmu_col, score and flag; vector columns,
        which only the models read, are left out."""
        return self._flag(self._scores(dataset))

    def _save_data(self, spark, path: str) -> None:
        self.som.save(spark, path)

    def _load_data(self, spark, path: str) -> None:
        self.som = SomModel.load(spark, path)


class SomFlagger(_FlagParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """M-12 to M-19 as one estimator: trains a SOM, takes the threshold from
    the training distances, flags rows above it."""

    gridRows, gridCols = SomFlagModel.gridRows, SomFlagModel.gridCols
    iterations = _param("iterations", "passes or mini-batch steps", TypeConverters.toInt)
    sigma = _param("sigma", "radius", TypeConverters.toFloat)
    learningRate = _param("learningRate", "rate", TypeConverters.toFloat)
    bands = _param("bands", "mini-batches; 1 for whole passes", TypeConverters.toInt)
    DEFAULTS = {**SomFlagModel.DEFAULTS, "iterations": 20, "sigma": 1.0, "learningRate": 1.0, "bands": 1}

    def _fit(self, dataset: DataFrame) -> SomFlagModel:
        # The features alone are written once: the training and the threshold
        # read them and don't repeat the stages before (parsing the log).
        dataset = materialize(dataset.select(self.get("featuresCol")), "som-features")
        model = self._copyValues(SomFlagModel())
        model.som = train_som(dataset, self.get("featuresCol"), self.get("gridRows"), self.get("gridCols"), self.get("iterations"),
                              self.get("sigma"), self.get("learningRate"), seed=self.get("seed"), bands=self.get("bands"))
        return self._fit_threshold(model, dataset)


class AutoencoderFlagModel(_FlagParams, _TableModel):
    DEFAULTS = {"featuresCol": "features", "scoreCol": "reconstruction_error", "flagCol": "is_anomaly", "percentile": 0.95, "seed": 0}
    autoencoder: Autoencoder

    def _scores(self, dataset: DataFrame) -> DataFrame:
        simple = [c for c, kind in dataset.dtypes if "vector" not in kind]
        return self.autoencoder.score(dataset, self.get("featuresCol"), simple, self.get("scoreCol"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._flag(self._scores(dataset))

    def _save_data(self, spark, path: str) -> None:
        self.autoencoder.save(spark, path)

    def _load_data(self, spark, path: str) -> None:
        self.autoencoder = Autoencoder.load(spark, path)


class AutoencoderFlagger(_FlagParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """M-20 to M-23 as one estimator."""

    hidden = _param("hidden", "sizes of the hidden layers", TypeConverters.toListInt)
    epochs = _param("epochs", "epochs", TypeConverters.toInt)
    steps = _param("steps", "steps of an epoch", TypeConverters.toInt)
    learningRate = _param("learningRate", "rate of the optimizer", TypeConverters.toFloat)
    DEFAULTS = {**AutoencoderFlagModel.DEFAULTS, "hidden": [64, 32, 16, 32, 64], "epochs": 10, "steps": 4, "learningRate": 1e-3}

    def _fit(self, dataset: DataFrame) -> AutoencoderFlagModel:
        dataset = materialize(dataset.select(self.get("featuresCol")), "autoencoder-features")
        model = self._copyValues(AutoencoderFlagModel())
        model.autoencoder = train_autoencoder(dataset, self.get("featuresCol"), self.get("hidden"), self.get("epochs"),
                                              learning_rate=self.get("learningRate"), seed=self.get("seed"), steps=self.get("steps"))
        return self._fit_threshold(model, dataset)
