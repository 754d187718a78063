"""Rows that carry blocks of documents through shuffles, packed.

A task takes its documents in blocks and numbers the distinct keys of a block (words, id pairs). A block gives

* one row a bucket with the keys that hash there, to be joined with what the whole corpus knows of them, and
* rows of the bucket ``STREAM`` with its documents, whose keys are numbers.

A hot key is one entry a block, however often it occurs. The rows are one table in the shared folder, bucketed by block,
so its documents are never shuffled: the keys go to their hash buckets and come back to their block with values
(``join_blocks``), where the documents already are."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.scratch import Scratch

BLOCK_BYTES = 16 << 20
MAX_TABLE_BUCKETS = 100_000
STREAM = -1
ROWS = "block long, bucket int, ids array<long>, sizes binary, body binary, numbers binary"
_NAMES = ["block", "bucket", "ids", "sizes", "body", "numbers"]
_TYPES = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]


def new_block() -> int:
    return uuid.uuid4().int >> 65


def row_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)


def save_blocks(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` as a table bucketed by block. Its name leaves the catalog at once; the files stay in the scratch folder."""
    spark = rows.sparkSession
    name = f"blocks_{uuid.uuid4().hex}"
    partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_TABLE_BUCKETS)
    rows.write.bucketBy(partitions, "block").option("path", scratch.path("blocks")).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def keys_by_bucket(rows: DataFrame, partitions: int) -> DataFrame:
    """The rows with keys, all blocks' rows of a bucket in one task, one bucket after the other."""
    return rows.where(F.col("bucket") != STREAM).repartition(partitions, "bucket").sortWithinPartitions("bucket", "block")


def join_blocks(rows: DataFrame, values: DataFrame, give, schema: str) -> DataFrame:
    """``give(documents, values)`` of each block, two Arrow tables of at most one block's rows."""
    documents = rows.where(F.col("bucket") == STREAM)
    return documents.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(give, schema)
