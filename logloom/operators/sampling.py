"""Sorts, limits, slices, samples and splits (O-01..O-08)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window


def first_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """O-02: limit after a key sort (top-k per task, then a merge)."""
    return df.orderBy(*order).limit(n)


def global_row_index(df: DataFrame, order: list[Column | str], index_col: str = "row_index") -> DataFrame:
    """0-based position of every row in ``order``, computed without a
    single-partition window: rows are range-partitioned and sorted, each
    row gets its partition id and an id increasing within the partition,
    the sorted table is written once to the shared folder, the per-partition
    row counts (one row per partition) give each partition's offset, and a
    broadcast of that small table turns local ids into global positions.
    Ties keep an arbitrary but fixed order: a unique row id is the last
    sort key, so the range partitioner can split a key value that holds a
    large share of the rows across many tasks."""
    from logloom.sources.staging import scratch_dir
    spark = df.sparkSession
    path = scratch_dir(spark, "row-index")
    keyed = [*order, "_tb"]
    (df.withColumn("_tb", F.monotonically_increasing_id())
       .repartitionByRange(*keyed).sortWithinPartitions(*keyed).drop("_tb")
       .withColumn("_pid", F.spark_partition_id())
       .withColumn("_mid", F.monotonically_increasing_id())
       .write.mode("overwrite").parquet(path))
    staged = spark.read.parquet(path)
    sizes = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    # One row per partition: a window without keys is fine here.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select("_pid", "_m0", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    out = staged.join(F.broadcast(offs), "_pid")
    return out.select(*[c for c in staged.columns if c not in ("_pid", "_mid")],
                      (F.col("_off") + F.col("_mid") - F.col("_m0")).alias(index_col))


SHALLOW_ROWS = 100_000  # a top-k keeps start + n rows a task, so a deeper slice takes the row index


def row_slice(df: DataFrame, start: int, n: int, *order: str, shallow: int = SHALLOW_ROWS) -> DataFrame:
    """O-03/O-04: rows [start, start + n) of the key order. Equal keys are
    ordered by the other columns, so the slice doesn't depend on the layout.
    A slice that ends within ``shallow`` rows is one top-k under that order;
    a deeper one uses the distributed global row index of the same order."""
    rest = [f.name for f in df.schema.fields if f.name not in order and f.dataType.typeName() not in ("map", "variant")]
    if start + n <= shallow:
        return df.orderBy(*order, *rest).offset(start).limit(n)
    idx = global_row_index(df, [*order, *rest], "_row")
    return idx.filter((F.col("_row") >= start) & (F.col("_row") < start + n)).drop("_row")


def unit_hash(key: Column | str, seed: int = 0, portable: bool = False) -> Column:
    """Deterministic number in [0, 1) per key, independent of partitioning.

    ``portable=False`` uses xxhash64 (fast). ``portable=True`` uses the
    first 32 bits of md5 of the key text, which any SQL engine can
    reproduce."""
    k = F.col(key) if isinstance(key, str) else key
    if portable:
        text = F.concat(k.cast("string"), F.lit(f"#{seed}")) if seed else k.cast("string")
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    return F.pmod(F.xxhash64(k, F.lit(seed)), F.lit(1 << 62)).cast("double") / F.lit(float(1 << 62))


def hash_sample(df: DataFrame, fraction: float, key: str, seed: int = 0,
                portable: bool = False) -> DataFrame:
    """O-05: Bernoulli sample without replacement, reproducible on any
    cluster layout (``df.sample`` depends on partitioning)."""
    return df.filter(unit_hash(key, seed, portable) < F.lit(fraction))


def hash_split(df: DataFrame, weights: list[float], key: str, seed: int = 0,
               portable: bool = False) -> list[DataFrame]:
    """O-07: split by key hash; each row lands in exactly one part no
    matter how the input is partitioned. ``df.randomSplit`` stays the
    option when no key exists."""
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        lo = acc
        acc += w / total
        bounds.append((lo, acc))
    u = unit_hash(key, seed, portable)
    parts = []
    for i, (lo, hi) in enumerate(bounds):
        cond = (u >= F.lit(lo)) & ((u < F.lit(hi)) if i < len(bounds) - 1 else F.lit(True))
        parts.append(df.filter(cond))
    return parts


def split_label(key: str, train: float = 0.8, seed: int = 0, portable: bool = False) -> Column:
    """The split as a column: 'train' or 'test'."""
    return F.when(unit_hash(key, seed, portable) < F.lit(train), F.lit("train")).otherwise(F.lit("test"))


class Bands:
    """O-06 without a random row per step: the rows of a table dealt into
    ``n`` disjoint bands by a hash, in the shared folder with a folder for
    each band. Reading one band reads its share of the rows only."""

    def __init__(self, table: DataFrame, n: int):
        self.table, self.n = table, n

    def read(self, band: int) -> DataFrame:
        if not 0 <= band < self.n:
            raise ValueError(f"band {band} of {self.n}")
        return self.table.where(F.col("_band") == band).drop("_band")


def band_of(key: Column | str, n: int, seed: int = 0, portable: bool = False) -> Column:
    """The band (0 to n - 1) of a row key. It depends on the key's value and
    the seed alone, so any layout gives the same bands; ``portable`` is the
    md5 form that other engines can reproduce."""
    return F.least(F.floor(unit_hash(key, seed, portable) * F.lit(float(n))).cast("int"), F.lit(n - 1))


FEW_BANDS = 16  # bands that each task of a write may have a file of


def hash_bands(df: DataFrame, n: int, key: Column | str | None = None, seed: int = 0,
               portable: bool = False) -> Bands:
    """Deal ``df`` into ``n`` bands, written once. Without a key the band
    comes from all columns, so equal rows share a band; give a unique key
    where a few rows repeat very often.

    Up to ``FEW_BANDS`` bands, every task of a spread scan writes its share
    of each, without a shuffle: a band is read by as many tasks as wrote it,
    however small its encoded rows are. The write of more bands is
    rebalanced, so a large band becomes several files and small ones aren't
    scattered."""
    from logloom.sources.sinks import write_parquet
    from logloom.sources.staging import scratch_dir
    from logloom.sources.tables import spread
    if n < 1:
        raise ValueError("n must be at least 1")
    spark = df.sparkSession
    whole = F.xxhash64(*df.columns)
    banded = df.withColumn("_band", band_of(whole if key is None else key, n, seed, portable))
    path = scratch_dir(spark, "bands")
    if n <= FEW_BANDS:
        spread(banded).write.mode("errorifexists").partitionBy("_band").parquet(path)
    else:
        write_parquet(banded, path, partition_by=["_band"])
    schema = StructType([*banded.schema.fields])
    return Bands(spark.read.schema(schema).parquet(path), n)
