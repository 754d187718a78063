"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names.

A saved table cuts lineage and outlives any executor. A stage drops the tables it no longer needs; those that a
returned DataFrame still reads stay, as the files of ``DataFrame.checkpoint()`` do."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from logloom.session import ensure_checkpoint_dir
from logloom.sources.staging import delete_path


class Scratch:
    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        out._llm_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            delete_path(self.spark, t._llm_path)


def bounded_batches(spark: SparkSession, rows: int = 2000, size: int = 32 << 20) -> None:
    """Arrow batches for tasks over whole texts: at most ``rows`` rows and ``size`` bytes each."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
