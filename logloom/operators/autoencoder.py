"""Dense autoencoders (M-20..M-23) trained and scored on executors.

Training is synchronous data-parallel gradient descent. The rows are dealt
once into disjoint bands by a hash; a step is one Spark job over one band:
every task sums the gradient of its rows at the current weights, one
grouped sum combines the tasks, and a single Adam state on the driver,
kept over all steps and epochs, moves the weights. So the model depends on
the rows, the bands and the seed, not on the number of partitions. Only
vectors of the model's size (checked) reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StructField, StructType)

from logloom.operators.sampling import hash_bands
from logloom.operators.vectors import FEATURES, array_matrix, as_double_array, check_model_size

SCHEMA_VERSION = 1
_CHUNK = 4096  # gradient values in one row of the grouped sum
_ROWS = 512  # rows whose activations are computed together: they stay in the core's cache
DEFAULT_STEPS = 4


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-z))


@dataclass
class Autoencoder:
    weights: list[np.ndarray]           # W_l: (n_in, n_out)
    biases: list[np.ndarray]
    lo: np.ndarray | None = None        # optional min-max input scaling
    hi: np.ndarray | None = None
    history: list[float] = field(default_factory=list)

    # -- maths -----------------------------------------------------------------
    def scale(self, x: np.ndarray) -> np.ndarray:
        if self.lo is None:
            return x
        rng = self.hi - self.lo
        safe = np.where(rng == 0, 1.0, rng)
        return np.where(rng == 0, 0.5, (x - self.lo) / safe)

    def forward(self, x: np.ndarray) -> list[np.ndarray]:
        acts = [x]
        last = len(self.weights) - 1
        for i, (w, b) in enumerate(zip(self.weights, self.biases)):
            z = acts[-1] @ w + b
            acts.append(_sigmoid(z) if i == last else np.maximum(z, 0.0))
        return acts

    def errors(self, raw: np.ndarray) -> np.ndarray:
        """M-22: mean squared reconstruction error per row (scaled space)."""
        out = np.empty(len(raw))
        for a in range(0, len(raw), _ROWS):
            x = self.scale(raw[a:a + _ROWS])
            y = self.forward(x)[-1]
            out[a:a + _ROWS] = ((x - y) ** 2).mean(axis=1)
        return out

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for pair in zip(self.weights, self.biases) for a in pair])

    def with_flat(self, v: np.ndarray) -> "Autoencoder":
        ws, bs, o = [], [], 0
        for w, b in zip(self.weights, self.biases):
            ws.append(v[o:o + w.size].reshape(w.shape)); o += w.size
            bs.append(v[o:o + b.size].copy()); o += b.size
        return Autoencoder(ws, bs, self.lo, self.hi, list(self.history))

    # -- Spark -----------------------------------------------------------------
    def score(self, df: DataFrame, features: str | list[str], keep: list[str],
              output: str = "reconstruction_error") -> DataFrame:
        model = self
        check_model_size(self.flat())
        src = df.select(*keep, as_double_array(df, features).alias(FEATURES))
        schema = StructType([*[f for f in src.schema.fields if f.name in keep],
                             StructField(output, DoubleType())])
        kept = schema.names[:-1]

        def run(batches):
            for batch in batches:
                found = model.errors(array_matrix(batch.column(FEATURES)))
                columns = [*(batch.column(c) for c in kept), pa.array(found, mask=np.isnan(found))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        return src.mapInArrow(run, schema)

    def loss(self, df: DataFrame, features: str | list[str]) -> float:
        """Mean reconstruction error over all rows."""
        return self.score(df, features, []).agg(F.avg("reconstruction_error")).first()[0]

    # -- persistence (K-04) ------------------------------------------------------
    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The model as rows: schema_version, part (weights, biases, lo, hi,
        history), layer, n_in, n_out and the values in row order."""
        rows = []
        for i, (w, b) in enumerate(zip(self.weights, self.biases)):
            rows.append((SCHEMA_VERSION, "weights", i, *w.shape, [float(v) for v in w.ravel()]))
            rows.append((SCHEMA_VERSION, "biases", i, 1, len(b), [float(v) for v in b]))
        for part, values in (("lo", self.lo), ("hi", self.hi), ("history", self.history)):
            if values is not None:
                rows.append((SCHEMA_VERSION, part, -1, 1, len(values), [float(v) for v in values]))
        return spark.createDataFrame(rows, "schema_version int, part string, layer int, n_in int, n_out int, values array<double>")

    def save(self, spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
        """One Parquet table of layers, sizes and scaling."""
        self.to_frame(spark).coalesce(1).write.mode(mode).parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Autoencoder":
        rows = spark.read.parquet(path).orderBy("part", "layer").collect()
        versions = {r["schema_version"] for r in rows}
        if versions != {SCHEMA_VERSION}:
            raise ValueError(f"autoencoder table of schema version {sorted(versions)}, not {SCHEMA_VERSION}")
        part = lambda name: [np.array(r["values"]).reshape(r["n_in"], r["n_out"]) for r in rows if r["part"] == name]
        one = lambda name: next((v.ravel() for v in part(name)), None)
        weights, biases = part("weights"), [b.ravel() for b in part("biases")]
        if len(weights) != len(biases) or any(w.shape[1] != len(b) for w, b in zip(weights, biases)):
            raise ValueError("autoencoder table with layers missing")
        return cls(weights, biases, one("lo"), one("hi"), list(one("history")))


def init_autoencoder(sizes: list[int], seed: int = 0) -> Autoencoder:
    """Glorot-uniform weights, zero biases (the Keras defaults)."""
    rng = np.random.default_rng(seed)
    ws, bs = [], []
    for a, b in zip(sizes[:-1], sizes[1:]):
        lim = np.sqrt(6.0 / (a + b))
        ws.append(rng.uniform(-lim, lim, size=(a, b)))
        bs.append(np.zeros(b))
    return Autoencoder(ws, bs)


def _grads(model: Autoencoder, x: np.ndarray) -> tuple[list, list, float]:
    acts = model.forward(x)
    y = acts[-1]
    n, d = x.shape
    loss = float(((y - x) ** 2).mean())
    delta = 2.0 * (y - x) / (n * d) * y * (1.0 - y)
    gw, gb = [None] * len(model.weights), [None] * len(model.weights)
    for i in range(len(model.weights) - 1, -1, -1):
        gw[i] = acts[i].T @ delta
        gb[i] = delta.sum(axis=0)
        if i:
            delta = (delta @ model.weights[i].T) * (acts[i] > 0)
    return gw, gb, loss


@dataclass
class Adam:
    """The optimizer's state: moments of the gradient and the step number."""

    learning_rate: float = 1e-3
    m: np.ndarray | float = 0.0
    v: np.ndarray | float = 0.0
    t: int = 0
    b1: float = 0.9
    b2: float = 0.999
    eps: float = 1e-7

    def step(self, params: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = self.b1 * self.m + (1 - self.b1) * gradient
        self.v = self.b2 * self.v + (1 - self.b2) * gradient * gradient
        first, second = self.m / (1 - self.b1 ** self.t), self.v / (1 - self.b2 ** self.t)
        return params - self.learning_rate * first / (np.sqrt(second) + self.eps)


def gradient_sums(model: Autoencoder, df: DataFrame, features: str | list[str]) -> tuple[np.ndarray, float, int]:
    """(summed gradient, summed loss, rows) at the model's weights: each task
    sums over its own rows, a grouped sum of chunks combines the tasks. The
    gradient is that of the mean squared error of a row, in the order of
    ``Autoencoder.flat``."""
    size = len(model.flat())
    check_model_size(model.flat())
    schema = StructType([StructField("chunk", IntegerType()), StructField("s", ArrayType(DoubleType()))])

    def run(batches):
        total, loss, seen = np.zeros(size), 0.0, 0
        for batch in batches:
            raw = array_matrix(batch.column(FEATURES))
            for a in range(0, len(raw), _ROWS):
                x = model.scale(raw[a:a + _ROWS])
                gw, gb, mean = _grads(model, x)
                total += len(x) * np.concatenate([g.ravel() for pair in zip(gw, gb) for g in pair])
                loss += len(x) * mean
                seen += len(x)
        if seen:
            whole = np.concatenate([[seen, loss], total])
            parts = [whole[a:a + _CHUNK] for a in range(0, len(whole), _CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.list_(pa.float64()))], schema.names)

    part = df.select(as_double_array(df, features).alias(FEATURES)).mapInArrow(run, schema)
    rows = part.groupBy("chunk").agg(Summarizer.sum(array_to_vector("s")).alias("s")).collect()
    if not rows:
        return np.zeros(size), 0.0, 0
    whole = np.concatenate([r["s"].toArray() for r in sorted(rows, key=lambda r: r["chunk"])])
    return whole[2:], float(whole[1]), int(whole[0])


def feature_range(df: DataFrame, features: str | list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per-feature min and max in one distributed pass (MinMaxScaler's fit)."""
    vec = array_to_vector(as_double_array(df, features))
    row = df.select(Summarizer.metrics("min", "max").summary(vec).alias("s")).first()["s"]
    return row["min"].toArray(), row["max"].toArray()


def train_autoencoder(df: DataFrame, features: str | list[str], hidden: list[int],
                      epochs: int = 10, batch_size: int | None = None, learning_rate: float = 1e-3,
                      seed: int = 0, minmax: bool = True, steps: int | None = None,
                      key: Column | str | None = None, optimizer: Adam | None = None,
                      start: Autoencoder | None = None) -> Autoencoder:
    """M-20/M-21. ``hidden`` is e.g. [64, 32, 16, 32, 64] or [10].

    An epoch has ``steps`` steps (``batch_size`` rows each, if that is given;
    a step is one Spark job, so it should grow with the data). Step and band
    are the same thing: the rows are dealt into bands by a hash of ``key``
    (of the features without one), the epochs take the bands in seeded
    orders, and a step reads its own band. A step's gradient is divided by
    the mean rows of a band, so an epoch's steps add up to the gradient of
    all rows even if many equal rows share a band.

    ``start`` and ``optimizer`` continue an earlier training; ``history``
    holds each epoch's mean loss. Without rows the start model comes back."""
    kept = df.select(as_double_array(df, features).alias(FEATURES),
                     *([] if key is None else [(F.col(key) if isinstance(key, str) else key).alias("_key")]))
    if steps is None:
        steps = DEFAULT_STEPS if batch_size is None else max(1, round(df.count() / batch_size))
    bands = hash_bands(kept, steps, F.xxhash64(FEATURES) if key is None else "_key", seed)
    data = bands.table.select(FEATURES)
    first = data.select(F.size(FEATURES)).first()
    if first is None:
        if start is None:
            raise ValueError("no rows to train on")
        return start
    model = start or init_autoencoder([first[0], *hidden, first[0]], seed)
    if minmax and model.lo is None:
        model.lo, model.hi = feature_range(data, FEATURES)
    adam = optimizer or Adam(learning_rate)
    share = data.count() / steps
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        loss_sum, seen = 0.0, 0
        for band in rng.permutation(steps):
            gradient, loss, n = gradient_sums(model, bands.read(int(band)), FEATURES)
            if n:
                model = model.with_flat(adam.step(model.flat(), gradient / share))
            loss_sum, seen = loss_sum + loss, seen + n
        model.history.append(loss_sum / seen)
    return model


def flag_reconstruction(model: Autoencoder, df: DataFrame, features: str | list[str],
                        keep: list[str], p: float = 0.95, threshold: float | None = None,
                        output: str = "reconstruction_error") -> DataFrame:
    """M-23: fixed threshold, or the p-th percentile of the errors."""
    from logloom.operators.stats import flag_above, flag_percentile
    scored = model.score(df, features, keep, output)
    if threshold is not None:
        return flag_above(scored, output, threshold)
    return flag_percentile(scored, output, p, materialize=True)[0]
