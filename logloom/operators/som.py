"""Self-organizing maps (M-12..M-19), trained and scored on executors.

Batch SOM: each pass ships the codebook to the tasks with the closure
(size checked), every task finds each row's best-matching unit (BMU) with
numpy and emits per-BMU sums and counts for its rows, a grouped sum
combines them (at most nodes x dim rows), and the driver smooths that
small table with the grid kernel. Driver cost is nodes x dim per pass,
never rows; a node that attracts a third of all rows is pre-summed inside
every task before the shuffle.

A column of ML vectors stays sparse: its rows reach numpy as compressed
sparse rows, and the cost of a best match follows the stored entries, not
the dimension. Arrays and column lists are dense rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType,
                               StructField, StructType)

from logloom.sources.tables import spread
from logloom.operators.sampling import hash_bands
from logloom.operators.vectors import (FEATURES, SparseRows, as_double_array, batch_matrix,
                                       check_model_size, is_vector, sparse_rows)

_BLOCK = 1 << 22  # doubles of one distance block (32 MB), whatever the grid and the dimension


def _bmu_and_dist(x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact best-matching units in row blocks; ties go to the lower node.

    Squared distances come from one matrix product per block
    (|x|^2 - 2 x.w + |w|^2); nodes within its rounding error of the least are
    compared again by differences, so the result is that of the plain form."""
    idx = np.empty(len(x), dtype=np.int64)
    dist = np.empty(len(x), dtype=np.float64)
    w2 = (w ** 2).sum(axis=1)
    rows = max(1, _BLOCK // max(1, max(w.shape)))
    for s in range(0, len(x), rows):
        blk = x[s:s + rows]
        x2 = (blk ** 2).sum(axis=1)
        d2 = x2[:, None] + w2[None, :] - 2.0 * (blk @ w.T)
        j = d2.argmin(axis=1)
        slack = 1e-12 * w.shape[1] * (x2 + w2.max(initial=0.0)) + 1e-300
        close = d2 <= (d2[np.arange(len(blk)), j] + slack)[:, None]
        for r in np.flatnonzero(close.sum(axis=1) > 1):
            nodes = np.flatnonzero(close[r])
            j[r] = nodes[((w[nodes] - blk[r]) ** 2).sum(axis=1).argmin()]
        idx[s:s + rows] = j
        dist[s:s + rows] = np.sqrt(((blk - w[j]) ** 2).sum(axis=1))
    return idx, dist


def _sparse_bmu_and_dist(x: SparseRows, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_bmu_and_dist`` of sparse rows. A block's products are its entries
    times the nodes (32 MB); near-ties and rows very close to their unit
    are compared again as dense rows, so the result is that of the plain
    form."""
    idx = np.empty(len(x), dtype=np.int64)
    dist = np.empty(len(x), dtype=np.float64)
    w2 = (w ** 2).sum(axis=1)
    by_feature = np.ascontiguousarray(w.T)
    most = max(1, _BLOCK // max(1, len(w)))
    lo = 0
    while lo < len(x):
        hi = int(np.searchsorted(x.start, x.start[lo] + most, "right")) - 1
        hi = min(max(hi, lo + 1), lo + most, len(x))
        blk = x.rows(lo, hi)
        dot = blk.row_sums(blk.value[:, None] * by_feature[blk.index])
        x2 = blk.row_sums(blk.value ** 2)
        d2 = x2[:, None] + w2[None, :] - 2.0 * dot
        j = d2.argmin(axis=1)
        slack = 1e-12 * w.shape[1] * (x2 + w2.max(initial=0.0)) + 1e-300
        close = d2 <= (d2[np.arange(len(blk)), j] + slack)[:, None]
        for r in np.flatnonzero(close.sum(axis=1) > 1):
            nodes = np.flatnonzero(close[r])
            j[r] = nodes[((w[nodes] - blk.dense([r])) ** 2).sum(axis=1).argmin()]
        # |x - w|^2 over the row's entries, plus the rest of |w|^2.
        own = w[np.repeat(j, np.diff(blk.start)), blk.index]
        gap = blk.row_sums(np.stack([(blk.value - own) ** 2, own ** 2], axis=1))
        exact = gap[:, 0] + np.maximum(w2[j] - gap[:, 1], 0.0)
        for r in np.flatnonzero(exact < 1e-6 * w2[j]):
            exact[r] = ((w[j[r]] - blk.dense([r])) ** 2).sum()
        idx[lo:hi], dist[lo:hi] = j, np.sqrt(exact)
        lo = hi
    return idx, dist


def _vector_struct(col: str) -> Column:
    """A vector column in its struct form, for Arrow."""
    return F.unwrap_udt(F.col(col))


def _sum_by_node(idx: np.ndarray, x: np.ndarray, sums: np.ndarray) -> None:
    order = np.argsort(idx, kind="stable")
    nodes, first = np.unique(idx[order], return_index=True)
    if len(nodes):
        sums[nodes] += np.add.reduceat(x[order], first, axis=0)


def grid_coords(m: int, n: int) -> np.ndarray:
    return np.array([(r, c) for r in range(m) for c in range(n)], dtype=np.float64)


def neighbourhood(m: int, n: int, sigma: float, cutoff: float | None = None) -> np.ndarray:
    """Gaussian kernel h[b, j] = exp(-|g_b - g_j|^2 / (2 sigma^2)); with a
    cutoff, nodes at grid distance >= cutoff get 0."""
    g = grid_coords(m, n)
    d2 = ((g[:, None, :] - g[None, :, :]) ** 2).sum(axis=2)
    h = np.exp(-d2 / (2.0 * sigma * sigma))
    if cutoff is not None:
        h = np.where(np.sqrt(d2) < cutoff, h, 0.0)
    return h


def grid_smooth(values: np.ndarray, m: int, n: int, sigma: float, cutoff: float | None = None) -> np.ndarray:
    """``neighbourhood(m, n, sigma, cutoff).T @ values`` without the nodes x
    nodes kernel: the kernel of two grid rows depends on their distance only,
    so one matrix of the longer side squared serves each row distance."""
    if n < m:
        turned = values.reshape(m, n, -1).transpose(1, 0, 2).reshape(m * n, -1)
        out = grid_smooth(turned, n, m, sigma, cutoff)
        return out.reshape(n, m, -1).transpose(1, 0, 2).reshape(values.shape)
    grid = values.reshape(m, n, -1)
    out = np.zeros_like(grid, dtype=np.float64)
    step = np.arange(n)
    across = (step[:, None] - step[None, :]).astype(np.float64) ** 2
    for d in range(m):
        d2 = across + float(d) * d
        kernel = np.exp(-d2 / (2.0 * sigma * sigma))
        if cutoff is not None:
            kernel = np.where(np.sqrt(d2) < cutoff, kernel, 0.0)
        for r in range(m - d):
            out[r + d] += kernel @ grid[r]
            if d:
                out[r] += kernel @ grid[r + d]
    return out.reshape(values.shape)


@dataclass
class SomModel:
    m: int
    n: int
    weights: np.ndarray  # (m * n, dim)

    @property
    def nodes(self) -> int:
        return self.m * self.n

    # -- scoring (M-15, M-17) ------------------------------------------------
    def score(self, df: DataFrame, features: str | list[str], keep: list[str]) -> DataFrame:
        """Adds ``bmu`` (flat node), ``bmu_row``, ``bmu_col`` and ``distance``
        (Euclidean distance to the BMU) to the ``keep`` columns."""
        w = np.ascontiguousarray(self.weights, dtype=np.float64)
        check_model_size(w)
        n_cols = self.n
        if is_vector(df, features):
            return self._score_sparse(df, features, keep, w)
        src = df.select(*keep, as_double_array(df, features).alias(FEATURES))
        out_schema = StructType([*[f for f in src.schema.fields if f.name in keep],
                                 StructField("bmu", LongType()), StructField("bmu_row", LongType()),
                                 StructField("bmu_col", LongType()), StructField("distance", DoubleType())])

        def run(batches):
            for pdf in batches:
                x = batch_matrix(pdf[FEATURES])
                if len(pdf) == 0:
                    continue
                idx, dist = _bmu_and_dist(x, w)
                out = pdf.drop(columns=[FEATURES])
                out["bmu"] = idx
                out["bmu_row"] = idx // n_cols
                out["bmu_col"] = idx % n_cols
                out["distance"] = dist
                yield out

        return src.mapInPandas(run, out_schema)

    def _score_sparse(self, df: DataFrame, features: str, keep: list[str], w: np.ndarray) -> DataFrame:
        n_cols, dim = self.n, w.shape[1]
        src = df.select(*keep, _vector_struct(features).alias(FEATURES))
        out_schema = StructType([*src.schema.fields[:-1], StructField("bmu", LongType()), StructField("bmu_row", LongType()),
                                 StructField("bmu_col", LongType()), StructField("distance", DoubleType())])

        def run(batches):
            for batch in batches:
                idx, dist = _sparse_bmu_and_dist(sparse_rows(batch.column(FEATURES), dim), w)
                found = [pa.array(idx), pa.array(idx // n_cols), pa.array(idx % n_cols), pa.array(dist)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *found], out_schema.names)

        return src.mapInArrow(run, out_schema)

    def quantization_error(self, df: DataFrame, features: str | list[str]) -> float:
        return self.score(df, features, []).agg(F.avg("distance")).first()[0]

    def winner(self, point: list[float]) -> tuple[int, int]:
        j, _ = _bmu_and_dist(np.asarray([point], dtype=np.float64), self.weights)
        return int(j[0] // self.n), int(j[0] % self.n)

    # -- persistence -----------------------------------------------------------
    def to_frame(self, spark) -> DataFrame:
        """Codebook as rows (node, row, col, weights)."""
        rows = [(int(j), int(j // self.n), int(j % self.n), [float(v) for v in self.weights[j]])
                for j in range(self.nodes)]
        schema = "node bigint, row bigint, col bigint, weights array<double>"
        return spark.createDataFrame(rows, schema)

    def save(self, spark, path: str, mode: str = "errorifexists") -> None:
        self.to_frame(spark).coalesce(1).write.mode(mode).parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "SomModel":
        rows = spark.read.parquet(path).orderBy("node").collect()
        m = max(r["row"] for r in rows) + 1
        n = max(r["col"] for r in rows) + 1
        return cls(m, n, np.array([r["weights"] for r in rows], dtype=np.float64))


def bmu_statistics(df: DataFrame, features: str | list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per-node sum of assigned rows and their count, from one pass: each
    task pre-sums per node; one grouped sum combines the tasks."""
    w = np.ascontiguousarray(weights, dtype=np.float64)
    check_model_size(w)
    k, dim = w.shape
    schema = StructType([StructField("bmu", IntegerType()), StructField("n", LongType()),
                         StructField("s", ArrayType(DoubleType()))])

    def run_sparse(batches):
        sums = np.zeros((k, dim))
        counts = np.zeros(k, dtype=np.int64)
        for batch in batches:
            x = sparse_rows(batch.column(FEATURES), dim)
            idx, _ = _sparse_bmu_and_dist(x, w)
            np.add.at(sums, (np.repeat(idx, np.diff(x.start)), x.index), x.value)
            counts += np.bincount(idx, minlength=k)
        for j in np.flatnonzero(counts):
            yield pa.RecordBatch.from_arrays([pa.array([j], pa.int32()), pa.array([counts[j]], pa.int64()),
                                              pa.array([sums[j]], pa.list_(pa.float64()))], schema.names)

    def run(batches):
        sums = np.zeros((k, dim))
        counts = np.zeros(k, dtype=np.int64)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = batch_matrix(pdf[FEATURES])
            idx, _ = _bmu_and_dist(x, w)
            _sum_by_node(idx, x, sums)
            counts += np.bincount(idx, minlength=k)
        hit = np.nonzero(counts)[0]
        if len(hit):
            yield pd.DataFrame({"bmu": hit.astype(np.int32), "n": counts[hit],
                                "s": [sums[j] for j in hit]})

    if is_vector(df, features):
        part = df.select(_vector_struct(features).alias(FEATURES)).mapInArrow(run_sparse, schema)
    else:
        part = df.select(as_double_array(df, features).alias(FEATURES)).mapInPandas(run, schema)
    agg = part.groupBy("bmu").agg(Summarizer.sum(array_to_vector("s")).alias("s"), F.sum("n").alias("n"))
    s = np.zeros((k, dim))
    c = np.zeros(k)
    for r in agg.toLocalIterator():  # one row a node at most
        s[r["bmu"]] = r["s"].toArray()
        c[r["bmu"]] = r["n"]
    return s, c


def batch_update(weights: np.ndarray, sums: np.ndarray, counts: np.ndarray,
                 kernel: np.ndarray, rate: float = 1.0) -> np.ndarray:
    """M-16: w_j <- w_j + rate * (sum_b h[b,j] S_b / sum_b h[b,j] N_b - w_j);
    a node with no weight mass keeps its weights."""
    return _toward(weights, kernel.T @ sums, kernel.T @ counts, rate)


def _toward(weights: np.ndarray, num: np.ndarray, den: np.ndarray, rate: float) -> np.ndarray:
    target = np.where(den[:, None] > 0, num / np.where(den > 0, den, 1.0)[:, None], weights)
    return weights + rate * (target - weights)


def feature_bounds(df: DataFrame, features: str | list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each feature's min and max from one summarizer: a single aggregate
    whatever the dimension, over the stored entries of sparse vectors."""
    vec = F.col(features) if is_vector(df, features) else array_to_vector(as_double_array(df, features))
    row = df.select(Summarizer.metrics("min", "max").summary(vec).alias("s")).first()["s"]
    if row is None or row["min"] is None or not row["min"].size:
        raise ValueError("no rows to take the feature bounds from")
    return row["min"].toArray(), row["max"].toArray()


def initial_codebook(df: DataFrame, features: str | list[str], m: int, n: int,
                     seed: int = 0) -> np.ndarray:
    """Seeded uniform start inside each feature's [min, max] (one pass)."""
    lo, hi = feature_bounds(df, features)
    rng = np.random.default_rng(seed)
    return lo + rng.random((m * n, len(lo))) * (hi - lo)


def train_som(df: DataFrame, features: str | list[str], m: int = 10, n: int = 10,
              iterations: int = 20, sigma: float = 1.0, learning_rate: float = 1.0,
              decay: bool = True, cutoff: float | None = None, seed: int = 0,
              init: np.ndarray | None = None, persist: bool = True, bands: int = 1,
              key: Column | str | None = None, portable: bool = False) -> SomModel:
    """M-12..M-14 as batch passes. With ``decay`` the rate and radius fall
    linearly over the passes (floored so the kernel stays defined).

    With ``bands`` above 1, training is by mini-batches (O-06): the rows are
    dealt once into that many disjoint bands by a hash of ``key`` (all
    features without one), and step t reads band t modulo ``bands`` only, so
    a step costs its share of the rows and every row is drawn once a round."""
    kept = F.col(features) if is_vector(df, features) else as_double_array(df, features)
    if bands > 1:
        own_key = F.col(key) if isinstance(key, str) else key
        keyed = df.select(kept.alias(FEATURES), (F.xxhash64(kept) if own_key is None else own_key).alias("_key"))
        dealt = hash_bands(keyed, bands, "_key", seed, portable)
        steps = [dealt.read(b).select(FEATURES) for b in range(bands)]
        data, persist = dealt.table.select(FEATURES), False
    else:
        data = spread(df.select(kept.alias(FEATURES)))
        if persist:
            data = data.persist(StorageLevel.MEMORY_AND_DISK)
        steps = [data]
    try:
        w = init.copy() if init is not None else initial_codebook(data, FEATURES, m, n, seed)
        for t in range(iterations):
            frac = 1.0 - t / iterations if decay else 1.0
            sig = max(sigma * frac, 1e-3)
            rate = learning_rate * frac if decay else learning_rate
            s, c = bmu_statistics(steps[t % bands], FEATURES, w)
            w = _toward(w, grid_smooth(s, m, n, sig, cutoff), grid_smooth(c[:, None], m, n, sig, cutoff)[:, 0], rate)
        return SomModel(m, n, w)
    finally:
        if persist:
            data.unpersist()


def som_anomalies(model: SomModel, df: DataFrame, features: str | list[str], keep: list[str],
                  p: float = 0.95, threshold: float | None = None) -> DataFrame:
    """M-18 (percentile threshold) or M-19 (fixed threshold): rows whose
    distance to their BMU is strictly above the threshold."""
    from logloom.operators.stats import flag_above, flag_percentile
    scored = model.score(df, features, keep)
    if threshold is not None:
        return flag_above(scored, "distance", threshold)
    return flag_percentile(scored, "distance", p, materialize=True)[0]
