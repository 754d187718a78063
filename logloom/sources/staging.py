"""Write-once staging of derived tables in the shared checkpoint folder.

Derived inputs (the synthetic web log, the extracted log) are written once
under ``spark.checkpoint.dir`` and read back. That cuts lineage the way a
real pipeline does (text logs and Parquet on shared storage) and survives
lost executors, unlike a local checkpoint."""

from __future__ import annotations

import atexit
import hashlib
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logloom.session import ensure_checkpoint_dir

_SCRATCH: list[str] = []


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop_path(spark, path)
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table this library wrote (shared storage)."""
    fs, hpath = _hadoop_path(spark, path)
    fs.delete(hpath, True)


def _file_states(spark: SparkSession, path: str) -> list[str]:
    """``path:size:mtime`` of every file at or below ``path``, from any store
    that Spark reads."""
    fs, hpath = _hadoop_path(spark, path)
    if not fs.exists(hpath):
        return []
    files, out = fs.listFiles(hpath, True), []
    while files.hasNext():
        st = files.next()
        out.append(f"{st.getPath()}:{st.getLen()}:{st.getModificationTime()}")
    return sorted(out)


def _code_state() -> bytes:
    """Hash of every module of the base library (not of ``llm``)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for folder, _, names in sorted(os.walk(root)):
        if os.path.relpath(folder, root).split(os.sep)[0] != "llm":
            for n in sorted(n for n in names if n.endswith(".py")):
                with open(os.path.join(folder, n), "rb") as fh:
                    h.update(n.encode() + fh.read())
    return h.digest()


def fingerprint(spark: SparkSession, *inputs: str) -> str:
    """Key of a staged table: the files of its inputs (size and modification
    time, by Hadoop's file status) and the library's code, so neither changed
    input nor changed code reuses a stale table."""
    h = hashlib.sha1(_code_state())
    for p in inputs:
        h.update("\n".join([p, *_file_states(spark, p)]).encode())
    return h.hexdigest()[:16]


def staged_dir(spark: SparkSession, name: str, key: str) -> str:
    """``<checkpoint dir>/logloom-stage[/<namespace>]/<name>-<key>``; the
    optional ``logloom.stage.namespace`` setting separates runs (the bench
    uses a fresh one so staging is always measured)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    ns = spark.conf.get("logloom.stage.namespace", "") or ""
    sub = f"/{ns}" if ns else ""
    return f"{root}/logloom-stage{sub}/{name}-{key}"


def stage(spark: SparkSession, name: str, key: str,
          write: Callable[[str], None]) -> str:
    """Run ``write(path)`` unless a completed table (``_SUCCESS``) is there.

    The table is written beside its place and moved there when finished. Of
    two writers the first to finish keeps the place; the other drops its copy
    (same inputs and code, so the same table)."""
    path = staged_dir(spark, name, key)
    if path_exists(spark, f"{path}/_SUCCESS"):
        return path
    own = f"{path}.{uuid.uuid4().hex}"
    write(own)
    fs, target = _hadoop_path(spark, path)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if fs.exists(target) or not fs.rename(jvm_path(own), target):
        # A store may move the folder into an existing one: only a finished
        # table counts as there.
        if not path_exists(spark, f"{path}/_SUCCESS"):
            raise RuntimeError(f"{path} is there without _SUCCESS; remove it")
        delete_path(spark, own)
    return path


def stage_text(spark: SparkSession, lines: DataFrame | Callable[[], DataFrame],
               name: str, key: str) -> DataFrame:
    """``lines`` may be a callable: the plan that computes them is then only
    built when the table is missing (a finished table costs one listing)."""
    def _write(p: str) -> None:
        df = lines() if callable(lines) else lines
        df.write.mode("overwrite").text(p)
    return spark.read.text(stage(spark, name, key, _write))


def stage_parquet(spark: SparkSession, df: DataFrame, name: str, key: str,
                  partition_by: list[str] | None = None,
                  finish: Callable[[DataFrame], DataFrame] | None = None) -> str:
    from logloom.sources.sinks import write_parquet

    def _write(p: str) -> None:
        write_parquet(df, p, mode="overwrite", partition_by=partition_by, finish=finish)
    return stage(spark, name, key, _write)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one intermediate table. It is removed by
    ``drop_scratch`` or, at the latest, when the program ends."""
    path = staged_dir(spark, f"tmp-{name}", uuid.uuid4().hex)
    if not _SCRATCH:
        atexit.register(_drop_at_exit)
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables written so far. DataFrames that still
    read them can't be used afterwards."""
    while _SCRATCH:
        delete_path(spark, _SCRATCH.pop())


def _drop_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        drop_scratch(spark)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a scratch folder under the shared checkpoint
    folder and read it back: later passes scan Parquet (column pruning,
    pushed filters) instead of recomputing an expensive plan."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
