"""Registered queries over ``events`` and ``lineitem``: profile, literal
arithmetic, percentile and threshold flags, sorts, slices, samples,
splits, assembling and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.operators import features as FE
from logloom.operators import sampling as S
from logloom.operators import stats as ST
from logloom.sources.tables import read_table

FIXED_THRESHOLD = 400.0
FIRST_N = 20
SLICE_START, SLICE_LEN = 1000, 20
SAMPLE_FRACTION = 0.1
TRAIN_FRACTION = 0.8
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_EV_COLS = ["event_id", "ts", "user_id", "event_type", "value"]


def _r6(c):
    return F.round(c, 6)


def q_table_profile(spark, sf_dir):
    return ST.profile_table(read_table(spark, sf_dir, "events"))


def q_add_literal(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id")
    return ev.withColumn("sum", F.col("event_id") + F.lit(1))


def q_percentile_flags(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id", "value")
    flagged, t = ST.flag_percentile(ev, "value", 0.95)
    return flagged.agg(F.lit(t).alias("threshold"),
                       F.count_if("is_anomaly").alias("n_flagged"),
                       F.count(F.lit(1)).alias("n_rows")).select(
        _r6(F.col("threshold")).alias("threshold"), "n_flagged", "n_rows")


def q_fixed_threshold_flags(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id", "value")
    return ST.flag_above(ev, "value", FIXED_THRESHOLD).filter("is_anomaly").select("event_id", "value")


def q_first_n(spark, sf_dir):
    return S.first_n(read_table(spark, sf_dir, "events", *_EV_COLS), FIRST_N, "event_id")


def q_row_slice(spark, sf_dir):
    return S.row_slice(read_table(spark, sf_dir, "events", *_EV_COLS), SLICE_START, SLICE_LEN, "event_id")


def q_bernoulli_sample(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id", "value")
    return S.hash_sample(ev, SAMPLE_FRACTION, "event_id", portable=True)


def q_train_test_split(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id")
    return ev.select("event_id", S.split_label("event_id", TRAIN_FRACTION, portable=True).alias("split"))


def _lines(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", *LINE_FEATURES)


_OUT = ["f0", "f1", "f2", "f3"]


def q_assemble_features(spark, sf_dir):
    df = FE.assemble(_lines(spark, sf_dir), LINE_FEATURES)
    return FE.vector_columns(df.select("l_orderkey", "l_linenumber", "features"), "features", _OUT)


def _scaled(df):
    out = FE.vector_columns(df.select("l_orderkey", "l_linenumber", "scaled_features"),
                            "scaled_features", _OUT)
    return out.select("l_orderkey", "l_linenumber", *[_r6(F.col(c)).alias(c) for c in _OUT])


def q_minmax_scale(spark, sf_dir):
    return _scaled(FE.minmax_scale(_lines(spark, sf_dir), LINE_FEATURES))


def q_std_scale(spark, sf_dir):
    return _scaled(FE.std_scale(_lines(spark, sf_dir), LINE_FEATURES))


def q_zscore_scale(spark, sf_dir):
    df = FE.zscore_scale(_lines(spark, sf_dir), LINE_FEATURES)
    return df.select("l_orderkey", "l_linenumber",
                     *[_r6(F.col(f"{c}_z")).alias(o) for c, o in zip(LINE_FEATURES, _OUT)])


_EV = ", ".join(_EV_COLS)
_U = "CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0"
_EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _scaled_sql(exprs):
    cols = ", ".join(f"round({e}, 6) AS f{i}" for i, e in enumerate(exprs))
    return f"SELECT l_orderkey, l_linenumber, {cols} FROM lineitem"


SQL = {
    "table_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, CAST({len(_EVENT_COLS)} AS BIGINT) AS column_count, "
        f"count(*) - count({c}) AS null_count FROM events" for c in _EVENT_COLS),
    "add_literal": "SELECT event_id, event_id + 1 AS sum FROM events",
    "percentile_flags": """WITH t AS (SELECT quantile_cont(value, 0.95) AS th FROM events)
        SELECT round(th, 6) AS threshold, (SELECT count(*) FROM events WHERE value > th) AS n_flagged,
               (SELECT count(*) FROM events) AS n_rows FROM t""",
    "fixed_threshold_flags": f"SELECT event_id, value FROM events WHERE value > {FIXED_THRESHOLD}",
    "first_n": f"SELECT {_EV} FROM events ORDER BY event_id LIMIT {FIRST_N}",
    "row_slice": f"SELECT {_EV} FROM events ORDER BY event_id LIMIT {SLICE_LEN} OFFSET {SLICE_START}",
    "bernoulli_sample": f"SELECT event_id, value FROM events WHERE {_U} < {SAMPLE_FRACTION}",
    "train_test_split": f"SELECT event_id, CASE WHEN {_U} < {TRAIN_FRACTION} THEN 'train' ELSE 'test' END AS split FROM events",
    "assemble_features": "SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(LINE_FEATURES)) + " FROM lineitem",
    "minmax_scale": _scaled_sql([
        f"CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0.5 ELSE "
        f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END" for c in LINE_FEATURES]),
    "std_scale": _scaled_sql([
        f"CASE WHEN stddev_samp({c}) OVER () = 0 THEN 0.0 ELSE {c} / stddev_samp({c}) OVER () END"
        for c in LINE_FEATURES]),
    "zscore_scale": _scaled_sql([
        f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()" for c in LINE_FEATURES]),
}

QUERIES = {
    "table_profile": q_table_profile,
    "add_literal": q_add_literal,
    "percentile_flags": q_percentile_flags,
    "fixed_threshold_flags": q_fixed_threshold_flags,
    "first_n": q_first_n,
    "row_slice": q_row_slice,
    "bernoulli_sample": q_bernoulli_sample,
    "train_test_split": q_train_test_split,
    "assemble_features": q_assemble_features,
    "minmax_scale": q_minmax_scale,
    "std_scale": q_std_scale,
    "zscore_scale": q_zscore_scale,
}
