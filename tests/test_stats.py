"""Percentiles, profiles, sampling and splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.operators import sampling as S
from logloom.operators import stats as ST


@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 0.999, 1.0])
def test_exact_percentile_matches_numpy(spark, p):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=3000), np.full(2000, 1.25), rng.exponential(size=1000)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = ST.exact_percentile(df, "v", p, max_collect=50, buckets=16)   # force narrowing passes
    assert got == pytest.approx(float(np.percentile(vals, p * 100)), rel=1e-12, abs=1e-12)


def test_exact_percentile_ignores_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    assert ST.exact_percentile(df, "v", 0.5) == 2.0


def test_profile_table(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rows = {r["column_name"]: r for r in ST.profile_table(df).collect()}
    assert rows["b"]["null_count"] == 1 and rows["a"]["row_count"] == 2
    assert rows["a"]["column_count"] == 2


def test_hash_split_partitions_rows(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    for portable in (False, True):
        train, test = S.hash_split(df, [0.8, 0.2], "k", portable=portable)
        a = {r[0] for r in train.collect()}
        b = {r[0] for r in test.collect()}
        assert not a & b and len(a | b) == 5000
        assert 0.75 < len(a) / 5000 < 0.85
    # same split whatever the partitioning
    again, _ = S.hash_split(df.repartition(7), [0.8, 0.2], "k")
    first, _ = S.hash_split(df, [0.8, 0.2], "k")
    assert {r[0] for r in again.collect()} == {r[0] for r in first.collect()}


def test_hash_sample_fraction(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "k")
    n = S.hash_sample(df, 0.1, "k").count()
    assert 1700 < n < 2300


def test_row_slice_and_first_n(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "k").repartition(5)
    assert [r[0] for r in S.row_slice(df, 10, 3, "k").collect()] == [10, 11, 12]
    assert [r[0] for r in S.first_n(df, 2, "k").collect()] == [0, 1]


def test_flag_above_is_strict(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "s double")
    assert [r[0] for r in ST.flag_above(df, "s", 1.0).select("is_anomaly").orderBy("s").collect()] == [False, True]


def test_row_slice_ties_do_not_depend_on_the_layout(spark):
    df = spark.range(0, 400).select((F.col("id") % 5).alias("k"), F.col("id").alias("v"))
    got = [sorted(tuple(r) for r in S.row_slice(df.repartition(p), 75, 10, "k", shallow=depth).collect()) for p in (1, 3, 8) for depth in (0, 1000)]
    assert all(g == got[0] for g in got) and got[0] == sorted([(0, v) for v in range(375, 400, 5)] + [(1, v) for v in range(1, 26, 5)])


def test_deep_row_slice_uses_distributed_index(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k").repartition(6)
    got = [r[0] for r in S.row_slice(df, 4000, 7, "k", shallow=100).orderBy("k").collect()]
    assert got == list(range(4000, 4007))
    assert [r[0] for r in S.row_slice(df, 4000, 7, "k").collect()] == got
    idx = S.global_row_index(df, ["k"]).collect()
    assert all(r["row_index"] == r["k"] for r in idx)


def test_global_row_index_splits_a_hot_key(spark):
    # A third of the rows share one key (the unique tiebreak lets the range
    # partitioner split it); the index is still 0..n-1 in key order.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                  F.col("id"))
    idx = S.global_row_index(df, ["k"])
    rows = idx.collect()
    assert sorted(r["row_index"] for r in rows) == list(range(3000))
    keys_in_order = [r["k"] for r in sorted(rows, key=lambda r: r["row_index"])]
    assert keys_in_order == sorted(keys_in_order)


def test_percentile_with_infinities_nan_and_no_rows(spark):
    import numpy as np
    finite = [float(x) for x in range(100)]
    for values in ([*finite, float("inf")], [float("-inf"), *finite, float("inf"), float("inf")], [float("inf")] * 3):
        df = spark.createDataFrame([(v,) for v in [*values, float("nan")]], "s double")
        for p in (0.0, 0.3, 0.5, 1.0):
            at = p * (len(values) - 1)
            lo, hi = np.sort(values)[[int(np.floor(at)), int(np.ceil(at))]]
            want = lo if lo == hi else lo + (at - np.floor(at)) * (hi - lo)
            got = ST.exact_percentile(df, "s", p, max_collect=10)
            assert got == want or abs(got - want) < 1e-9, (p, got, want)
    flagged, t = ST.flag_percentile(spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "s double"), "s", 0.5)
    assert t == 1.5 and sorted(r["is_anomaly"] for r in flagged.collect()) == [False, False, True]
    empty, t = ST.flag_percentile(spark.createDataFrame([], "s double"), "s")
    assert t is None and empty.collect() == []


def _plain_percentile(values, p):
    at = p * (len(values) - 1)
    lo, hi = (float(x) for x in np.sort(values)[[int(np.floor(at)), int(np.ceil(at))]])
    return lo, hi, at - np.floor(at)


def test_percentiles_at_a_rank_are_the_value_itself(spark):
    """0..49 and infinity at p = 0.02: rank 1 exactly, so 1.0 isn't flagged."""
    df = spark.createDataFrame([(float(x),) for x in [*range(50), float("inf")]], "s double")
    assert ST.exact_percentile(df, "s", 0.02) == 1.0
    flagged, t = ST.flag_percentile(df, "s", 0.02)
    assert t == 1.0 and flagged.where("s = 1 and is_anomaly").count() == 0


def test_percentiles_of_the_widest_range(spark):
    big = 1.7e308
    values = [-big, big, 0.0, -0.0, 5e-324, -5e-324, 1.0, -1.0, big / 2, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    ps = [k / 40 for k in range(41)]
    for got, p in zip(ST.exact_percentiles(df, "s", ps), ps, strict=True):
        lo, hi, part = _plain_percentile(values, p)
        want = lo if part == 0 or lo == hi or np.isinf(lo) else hi if np.isinf(hi) else lo * (1 - part) + hi * part
        assert got == want or abs(got - want) <= 1e-12 * abs(want) + 1e-300, (p, got, want)


def test_percentiles_of_many_kinds_of_values(spark):
    rng = np.random.default_rng(12)
    for values in (rng.normal(size=500), np.repeat([3.5, -2.0], 200), np.arange(300) * 1e-300, rng.integers(-3, 3, 400).astype(float), np.array([7.0])):
        df = spark.createDataFrame([(float(v),) for v in values], "s double")
        ps = [0.0, 0.1, 0.333, 0.5, 0.95, 0.999, 1.0]
        assert np.allclose(ST.exact_percentiles(df, "s", ps, bits=11), np.percentile(values, np.array(ps) * 100), rtol=1e-12, atol=0)


def test_order_keys_order_like_the_values():
    import pyarrow as pa
    values = np.array([float("-inf"), -1.7e308, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.7e308, float("inf")])
    batch = pa.RecordBatch.from_arrays([pa.array([*values, None, float("nan"), -0.0])], ["v"])
    keys = next(ST._order_keys(iter([batch]))).column(0).to_pylist()
    assert keys[:-1] == sorted(keys[:-1]) and len(set(keys)) == 9 and keys[-1] == keys[4]
    assert [ST._key_value(k) for k in keys[:-1]] == values.tolist()


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("day"), (F.col("id") % 20_000).alias("v"), F.when(F.col("id") < 40_000, "hot").otherwise("other").alias("site"))
    days = ST.distinct_sketches(df, ["day", "site"], "v")
    for by, exact in ((["day"], df.groupBy("day")), (["site"], df.groupBy("site"))):
        want = {r[0]: r[1] for r in exact.agg(F.count_distinct("v")).collect()}
        got = {r[0]: r[1] for r in ST.merge_sketches(days, by).select(by[0], ST.sketch_estimate()).collect()}
        assert all(abs(got[k] - n) <= 4 * ST.sketch_error() * n for k, n in want.items()), (want, got)
    total = ST.merge_sketches(days).select("rows", ST.sketch_estimate().alias("n")).first()
    assert total["rows"] == 60_000 and abs(total["n"] - 20_000) <= 4 * ST.sketch_error() * 20_000
    assert ST.merge_sketches(days.limit(0)).select(ST.sketch_estimate().alias("n")).first()["n"] in (None, 0)
