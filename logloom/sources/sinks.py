"""Sinks (K-01..K-05). Every writer takes an explicit save mode; the
default refuses to overwrite, so a rerun never clobbers output silently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster_for_partitions(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Cluster rows by the partition columns before a partitioned write.

    The ``rebalance`` hint shuffles by those columns and lets AQE size the
    result: a partition value holding a third of all rows is split into
    advisory-sized tasks (``spark.sql.adaptive.advisoryPartitionSizeInBytes``)
    instead of landing on one writer, and small values are coalesced. So
    each value gets a few files of a reasonable size."""
    return df.hint("rebalance", *partition_by)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None, repartition: int | None = None,
                  finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """K-01 (partitioned) / K-02 (plain). With ``partition_by`` the rows
    are rebalanced by the partition columns first (see above). ``finish``
    adds row-wise columns after that shuffle, so wide derived columns (path
    n-grams) are computed where they are written and never shuffled."""
    out = df
    if partition_by:
        out = cluster_for_partitions(out, partition_by)
    elif repartition:
        out = out.repartition(repartition)
    if finish:
        out = finish(out)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_text(df: DataFrame, path: str, fmt: str | None = None, columns: list[str] | None = None,
               mode: str = "errorifexists", single_file: bool = False) -> None:
    """K-03: one formatted line per row (e.g. ``"%s: %d"`` over word,
    count). ``single_file`` coalesces to one task: only for small output."""
    cols = columns or df.columns
    line = F.format_string(fmt, *cols) if fmt else F.concat_ws("\t", *[F.col(c).cast("string") for c in cols])
    out = df.select(line.alias("value"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).text(path)


def write_flags(df: DataFrame, path: str, key: str, flag: str = "is_anomaly",
                mode: str = "errorifexists") -> None:
    """K-05: (key, flag) beside the row key, written by the executors."""
    df.select(key, flag).write.mode(mode).parquet(path)
