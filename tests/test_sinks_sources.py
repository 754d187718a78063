"""Sinks and sources: partitioned round trip with pruning, text, CSV, flags."""

from pyspark.sql import functions as F

from logloom.sources import sinks
from logloom.sources.tables import read_csv, read_parquet_columns


def test_partitioned_parquet_round_trip_prunes(spark, tmp_path):
    df = spark.createDataFrame([("a.com", 1), ("b.com", 2), ("a.com", 3)], "domain string, v int")
    path = str(tmp_path / "known")
    sinks.write_parquet(df, path, partition_by=["domain"])
    back = read_parquet_columns(spark, path, ["domain", "v"]).filter(F.col("domain") == "a.com")
    assert sorted(r["v"] for r in back.collect()) == [1, 3]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(domain" in plan
    # default mode refuses to overwrite
    try:
        sinks.write_parquet(df, path)
        raise AssertionError("overwrite should fail")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e) or "PATH_ALREADY_EXISTS" in str(e)


def test_text_sink(spark, tmp_path):
    df = spark.createDataFrame([("a", 2), ("b", 1)], "word string, count bigint")
    path = str(tmp_path / "wc")
    sinks.write_text(df, path, "%s: %d", ["word", "count"], single_file=True)
    assert sorted(r[0] for r in spark.read.text(path).collect()) == ["a: 2", "b: 1"]


def test_csv_source_explicit_and_inferred(spark, tmp_path):
    p = tmp_path / "f.csv"
    p.write_text("feature1,feature2,feature3\n1,2.5,3\n4,5.5,6\n")
    inferred = read_csv(spark, str(p))
    assert dict(inferred.dtypes)["feature2"] == "double"
    explicit = read_csv(spark, str(p), "feature1 double, feature2 double, feature3 double")
    assert explicit.count() == 2


def test_flags_sink(spark, tmp_path):
    df = spark.createDataFrame([(0, True), (1, False)], "index bigint, is_anomaly boolean")
    sinks.write_flags(df, str(tmp_path / "flags"), "index")
    assert spark.read.parquet(str(tmp_path / "flags")).count() == 2


def test_hot_partition_value_is_split_across_writers(spark, tmp_path):
    """A domain holding most rows is written by several tasks (AQE splits the
    rebalance partition), not by one."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        df = spark.range(0, 60000).select(
            F.when(F.col("id") % 3 != 0, F.lit("hot.example.com"))
             .otherwise(F.concat(F.lit("d"), (F.col("id") % 50).cast("string"))).alias("domain"),
            F.col("id"))
        path = str(tmp_path / "skewed")
        sinks.write_parquet(df, path, partition_by=["domain"])
        hot = [f for f in spark.read.parquet(path).inputFiles() if "domain=hot.example.com" in f]
        assert len(hot) > 1
        assert spark.read.parquet(path).count() == 60000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_fingerprint_follows_the_input_and_scratch_is_dropped(spark, tmp_path):
    import os
    from logloom.sources import staging
    spark.range(5).write.parquet(str(tmp_path / "t"))
    first = staging.fingerprint(spark, f"file:{tmp_path}/t")
    assert first == staging.fingerprint(spark, f"file:{tmp_path}/t")
    spark.range(6).write.mode("append").parquet(str(tmp_path / "t"))
    assert first != staging.fingerprint(spark, f"file:{tmp_path}/t")
    kept = staging.materialize(spark.range(3), "test")
    path = kept.inputFiles()[0].removeprefix("file://").removeprefix("file:")
    assert kept.count() == 3 and os.path.exists(path)
    staging.drop_scratch(spark)
    assert not os.path.exists(path)


def test_two_writers_of_one_staged_table(spark):
    import uuid
    from logloom.sources import staging
    key, ran = uuid.uuid4().hex, []

    def write(path):
        ran.append(path)
        if len(ran) == 1:  # a second writer finishes first
            staging.stage(spark, "race", key, write)
        spark.range(4).write.parquet(path)

    path = staging.stage(spark, "race", key, write)
    assert len(ran) == 2 and spark.read.parquet(path).count() == 4
    assert not staging.path_exists(spark, ran[0]) and not staging.path_exists(spark, f"{path}/{ran[0].rsplit('/')[-1]}")
