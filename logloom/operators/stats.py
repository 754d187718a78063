"""Aggregations, profiles, exact percentiles and threshold flags
(A-02..A-09, K-07, M-18, M-19, M-23)."""

from __future__ import annotations

import functools
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.session import ensure_checkpoint_dir


def profile_table(df: DataFrame) -> DataFrame:
    """K-07 in one pass: per column its null count, plus the row and column
    count. One aggregate (partial per task, one tiny final row), unpivoted."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"))
        for i, c in enumerate(cols)
    ])).alias("s")
    return one.select(F.col("_rows").alias("row_count"),
                      F.lit(len(cols)).cast("bigint").alias("column_count"), stacked
                      ).select("s.column_name", "row_count", "column_count", "s.null_count")


def length_stats(values: Column, prefix: str, digits: int | None = 6) -> list[Column]:
    """min, max, avg, sample stddev of a numeric column in one aggregate
    (the job being matched ran four). Float results are rounded to
    ``digits`` so they compare across engines whose summation order
    differs."""
    def r(c):
        return F.round(c, digits) if digits is not None else c
    return [F.min(values).cast("bigint").alias(f"min_{prefix}"),
            F.max(values).cast("bigint").alias(f"max_{prefix}"),
            r(F.avg(values)).alias(f"avg_{prefix}"),
            r(F.stddev_samp(values)).alias(f"stddev_{prefix}")]


_SIGN = np.int64(-1) ^ np.iinfo(np.int64).min  # all bits but the sign


def _order_keys(batches):
    """Doubles -> 64-bit integers in the same order (null and NaN left out).

    A double's bits, read as a sign and a magnitude, order like its value;
    flipping the magnitude of negative numbers makes that the integers' own
    order. -0.0 is 0.0."""
    for batch in batches:
        v = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
        bits = (v[~np.isnan(v)] + 0.0).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.where(bits < 0, bits ^ _SIGN, bits))], ["key"])


def _key_value(key: int) -> float:
    """The double of an order key."""
    bits = np.int64(key)
    return float((bits ^ _SIGN if bits < 0 else bits).view(np.float64))


def _select_ranks(keys: DataFrame, ranks: list[int], bits: int) -> dict[int, int]:
    """The key at each 0-based rank, by radix selection.

    A pass counts the next ``bits`` bits of the keys that share the bits
    found so far with a wanted rank: one grouped count with at most 2**bits
    rows a distinct prefix, and a pushed-down range filter. 64 / bits passes
    end at single keys; no key is collected, whatever the values are."""
    found = {r: (0, r, 64) for r in ranks}  # rank -> prefix (signed), rank inside it, bits left
    while any(left for *_, left in found.values()):
        left = next(iter(found.values()))[2]
        step = min(bits, left)
        rest = left - step
        prefixes = sorted({p for p, *_ in found.values()})
        k = F.col("key")
        digit = F.shiftright(k, rest).alias("p") if rest else k.alias("p")  # the prefix and its next digit
        if left < 64:
            inside = [(k >= F.lit(p << left)) & (k <= F.lit(((p + 1) << left) - 1)) for p in prefixes]
            keys_in = keys.where(functools.reduce(Column.__or__, inside))
        else:
            keys_in = keys
        counts = keys_in.groupBy(digit).agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("p")
        digits, n = counts["p"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
        for rank, (prefix, at, _) in found.items():
            own = (digits >> step == prefix) if left < 64 else np.ones(len(digits), bool)
            upto = np.cumsum(n[own])
            i = int(np.searchsorted(upto, at, "right"))
            found[rank] = int(digits[own][i]), at - int(upto[i - 1] if i else 0), rest
    return {rank: prefix for rank, (prefix, *_) in found.items()}


def _between(a: float, b: float, part: float) -> float:
    """``a`` to ``b`` by a share in [0, 1), without overflow. Between
    -infinity and a larger value it is -infinity, to infinity infinity."""
    if part == 0 or a == b or math.isinf(a):
        return a
    width = b - a
    return a + part * width if math.isfinite(width) or math.isinf(b) else a * (1 - part) + b * part


def exact_percentiles(df: DataFrame, col: str, ps: list[float], bits: int = 16) -> list[float | None]:
    """Exact percentiles with linear interpolation (numpy's default, SQL
    ``percentile_cont``), all from the same passes. Null and NaN are ignored;
    without values every percentile is None.

    The values are written once to the shared folder as 64-bit keys of the
    same order, so a pass reads eight bytes a row at most. Ranks are selected
    by radix (``_select_ranks``): four passes of at most 65,536 counts for
    each distinct prefix, for any distribution, infinities and the widest
    range included. Neither values nor a sorted partition are gathered."""
    from logloom.sources.staging import delete_path
    if any(not 0.0 <= p <= 1.0 for p in ps):
        raise ValueError("p must be in [0, 1]")
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/logloom-pct/{uuid.uuid4().hex}"
    df.select(F.col(col).cast("double").alias("v")).mapInArrow(_order_keys, "key bigint").write.parquet(path)
    try:
        keys = spark.read.schema("key bigint").parquet(path)
        n = keys.count()
        if n == 0:
            return [None] * len(ps)
        at = [p * (n - 1) for p in ps]
        ranks = sorted({k for x in at for k in (math.floor(x), math.ceil(x))})
        value = {r: _key_value(k) for r, k in _select_ranks(keys, ranks, bits).items()}
        return [_between(value[math.floor(x)], value[math.ceil(x)], x - math.floor(x)) for x in at]
    finally:
        delete_path(spark, path)


def exact_percentile(df: DataFrame, col: str, p: float, max_collect: int | None = None,
                     buckets: int = 1 << 16, stage: bool | None = None) -> float | None:
    """One exact percentile (``exact_percentiles``). ``buckets`` is the most
    counts a pass may give for a prefix (a power of two is used). No value is
    collected and the keys are always staged, so ``max_collect`` and
    ``stage`` of earlier versions have no effect."""
    return exact_percentiles(df, col, [p], bits=max(1, min(16, buckets.bit_length() - 1)))[0]


def approx_percentile(df: DataFrame, col: str, p: float, accuracy: int = 10_000) -> float:
    """A-08 at scale when an approximation is acceptable (one pass)."""
    return df.agg(F.percentile_approx(col, p, accuracy)).first()[0]


def flag_above(df: DataFrame, score: str, threshold: float | None, flag: str = "is_anomaly") -> DataFrame:
    """M-19/M-23: flag rows strictly above a threshold (a literal). A NaN
    score isn't above anything; a null score has a null flag. Without a
    threshold (no scores at all) nothing is flagged."""
    limit = float("inf") if threshold is None else float(threshold)
    return df.withColumn(flag, (F.col(score) > F.lit(limit)) & ~F.isnan(F.col(score).cast("double")))


def flag_percentile(df: DataFrame, score: str, p: float = 0.95, flag: str = "is_anomaly",
                    exact: bool = True, materialize: bool = False,
                    max_collect: int | None = None) -> tuple[DataFrame, float | None]:
    """A-08 + M-18: flag rows above the p-th percentile of ``score``.

    With ``materialize`` (for computed scores) the scored rows are written
    once to the shared folder; the percentile's keys and the flagged
    output both read that table, so the scores are computed once.
    ``max_collect`` of earlier versions has no effect. The threshold is None
    when there are no scores."""
    if materialize:
        from logloom.sources.staging import materialize as _mat
        df = _mat(df, "scores")
    t = exact_percentile(df, score, p) if exact else approx_percentile(df, score, p)
    return flag_above(df, score, t, flag), t


# ---- A-05: distinct counts that merge --------------------------------------

def distinct_sketches(df: DataFrame, by: list[str], value: str, lg_k: int = 12) -> DataFrame:
    """A-05 at scale: one HLL sketch of ``value`` for each key of ``by``, with
    its row count. A sketch has 2**lg_k registers at most, however many
    rows it saw (relative standard error about 1.04 / sqrt(2**lg_k)); tasks
    sketch their own rows before the shuffle. The table can be stored and
    later merged over any coarser key (``merge_sketches``): a new day adds
    rows, no old day is read again. Null values aren't counted."""
    v = F.col(value).cast("string")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(v, F.lit(lg_k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Union of sketches over the keys of ``by`` (none: over all of them)."""
    return sketches.groupBy(*(by or [])).agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch"))


def sketch_estimate(sketch: Column | str = "sketch") -> Column:
    """The distinct count that a sketch estimates."""
    return F.hll_sketch_estimate(sketch)


def sketch_error(lg_k: int = 12) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / math.sqrt(1 << lg_k)
