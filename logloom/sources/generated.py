"""Literal and generated tables (S-07, S-08) and object-store settings (S-09)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """S-07 with an explicit schema (no type inference from literals)."""
    return spark.createDataFrame(rows, schema)


def uniform_table(spark: SparkSession, n_rows: int, n_features: int, seed: int = 0,
                  prefix: str = "feature_", num_partitions: int | None = None) -> DataFrame:
    """S-08: ``n_rows`` x ``n_features`` uniform [0, 1) values, generated on
    the executors from ``spark.range``. Values depend on (seed, row id,
    feature) only, so they are the same on every cluster layout."""
    ids = spark.range(0, n_rows, numPartitions=num_partitions)
    cols = [(F.pmod(F.xxhash64(F.lit(seed), F.lit(i), F.col("id")), F.lit(1 << 53)).cast("double")
             / F.lit(float(1 << 53))).alias(f"{prefix}{i}") for i in range(n_features)]
    return ids.select("id", *cols)


def object_store_conf(endpoint: str, path_style: bool = True) -> dict[str, str]:
    """S-09: Hadoop S3A settings for an S3-compatible endpoint. Credentials
    are not taken here: supply them through the cluster's credential
    provider or session configuration, never in code."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
