"""Incremental access-log ETL with Structured Streaming.

The parsers are plain DataFrame -> DataFrame functions, so the batch ETL
applies unchanged to a file stream of log lines. Each micro-batch is
split into known and unknown domains and written to Parquet (known
partitioned by domain), one ``batch_id=`` folder per micro-batch. The checkpoint location lives in the
shared folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from logloom.functions.logformat import REGISTERED_DOMAINS
from logloom.operators import weblog as W
from logloom.sources.sinks import write_parquet


def cleaned_log_stream(spark: SparkSession, log_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of cleaned, URL- and time-featured log rows."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(log_dir)
    return W.add_time_columns(W.add_url_columns(W.clean_log(W.parse_access_log(lines))))


def start_extract_stream(spark: SparkSession, log_dir: str, known_path: str, unknown_path: str,
                         checkpoint: str, domains: list[str] = REGISTERED_DOMAINS,
                         available_now: bool = False) -> StreamingQuery:
    """Append each micro-batch to the known/unknown tables."""
    stream = cleaned_log_stream(spark, log_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # One folder per micro-batch, overwritten on replay: a batch that is
        # re-run after a failure replaces its own output instead of adding
        # duplicates.
        # The batch feeds two writes: persisted so the lines are parsed
        # once (lost blocks are recomputed from the batch's source files).
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            known, unknown = W.split_known(batch, domains)
            write_parquet(known, f"{known_path}/batch_id={batch_id}", mode="overwrite", partition_by=["domain"])
            write_parquet(unknown, f"{unknown_path}/batch_id={batch_id}", mode="overwrite")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
