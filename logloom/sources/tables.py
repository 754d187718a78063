"""Readers for the driver's Parquet tables and for log text (S-01..S-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Parquet scan; naming columns here keeps ReadSchema narrow even
    before Catalyst prunes the rest of the plan."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_text(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """Lines as ``value string`` (S-01 glob, S-02 directory, S-03 recursive).

    ``recursive=True`` uses ``recursiveFileLookup``; a ``dir/**`` glob
    misses files two levels down."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.text(path)


def read_parquet_columns(spark: SparkSession, root: str, columns: list[str],
                         base_path: str | None = None) -> DataFrame:
    """S-04/S-05: scan with a column list. Read the partitioned root (or set
    ``basePath``) so the partition column survives; filter it afterwards
    and Catalyst turns the filter into a PartitionFilter."""
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.parquet(root).select(*columns)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """S-06: header CSV. An explicit schema avoids the inference pass over
    the whole input; inference is kept as an option for ad-hoc use."""
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", "true").csv(path)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when the scan yields fewer partitions
    than the cluster has task slots (a small file with one row group).
    CPU-heavy stages (tokenizing, parsing, training) then use every core;
    on large inputs the scan already has enough splits and this is a
    no-op, so no full shuffle of the raw data is added at scale.

    Apply it to scans: asking a plan with shuffles for its partition count
    would run those shuffles under AQE."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
