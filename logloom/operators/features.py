"""Feature engineering (M-01..M-11).

Spark ML transformers where they exist (JVM-side, distributed fit), plus
column-expression forms where a query needs plain columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import (HashingTF, MinMaxScaler, NGram, OneHotEncoder,
                                StandardScaler, Tokenizer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def assemble(df: DataFrame, inputs: list[str], output: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """M-07."""
    return VectorAssembler(inputCols=inputs, outputCol=output,
                           handleInvalid=handle_invalid).transform(df)


def vector_columns(df: DataFrame, vec: str, names: list[str]) -> DataFrame:
    """Vector -> one double column per element (for SQL-side checks)."""
    arr = vector_to_array(F.col(vec))
    return df.select(*[c for c in df.columns if c != vec],
                     *[arr[i].alias(n) for i, n in enumerate(names)])


def minmax_scale(df: DataFrame, inputs: list[str], output: str = "scaled_features") -> DataFrame:
    """M-08: per feature (x - min) / (max - min); a constant feature maps
    to 0.5. The fit is one distributed summary pass."""
    pipe = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="_features"),
                            MinMaxScaler(inputCol="_features", outputCol=output)])
    return pipe.fit(df).transform(df).drop("_features")


def std_scale(df: DataFrame, inputs: list[str], output: str = "scaled_features",
              with_mean: bool = False) -> DataFrame:
    """M-09: Spark's StandardScaler (sample std; centring off by default)."""
    pipe = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="_features"),
                            StandardScaler(inputCol="_features", outputCol=output,
                                           withStd=True, withMean=with_mean)])
    return pipe.fit(df).transform(df).drop("_features")


def zscore_scale(df: DataFrame, inputs: list[str], suffix: str = "_z") -> DataFrame:
    """M-10: centred, population std (the scikit-learn convention), from a
    one-row aggregate joined back as literals."""
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(inputs)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(inputs)]).first()
    out = df
    for i, c in enumerate(inputs):
        m, s = stats[f"m{i}"], stats[f"s{i}"]
        z = (F.col(c) - F.lit(m)) / F.lit(s) if s else F.lit(0.0)
        out = out.withColumn(f"{c}{suffix}", z)
    return out


def ngram(df: DataFrame, input_col: str, output_col: str, n: int) -> DataFrame:
    """M-01/M-02 as the ML transformer."""
    return NGram(n=n, inputCol=input_col, outputCol=output_col).transform(df)


def tokenize(df: DataFrame, input_col: str, output_col: str) -> DataFrame:
    """F-19 as the ML transformer."""
    return Tokenizer(inputCol=input_col, outputCol=output_col).transform(df)


def hash_features(df: DataFrame, input_col: str, output_col: str,
                  num_features: int = 16384) -> DataFrame:
    """M-03: feature hashing (no vocabulary, no driver state)."""
    return HashingTF(inputCol=input_col, outputCol=output_col,
                     numFeatures=num_features).transform(df)


def vocabulary(df: DataFrame, input_col: str) -> DataFrame:
    """M-04 vocabulary: every term with its count and its index by count,
    largest first (ties alphabetical). Counted by a partial and a final
    aggregate and ranked by ``index_labels``: no size cap, nothing on the
    driver."""
    terms = df.select(F.explode(input_col).alias("term")).filter(F.col("term").isNotNull())
    return index_labels(terms, "term", "term_index", count_col="n")


def count_vectorize(df: DataFrame, input_col: str, output_col: str) -> tuple[DataFrame, DataFrame]:
    """M-04: (vocabulary, ``df`` with its term counts). ``output_col`` is the
    sparse row: an array of (term_index, n) in index order, empty where the
    row has no terms."""
    words = vocabulary(df, input_col)
    rows = df.withColumn("_row", F.monotonically_increasing_id()).checkpoint(eager=True)
    counts = rows.select("_row", F.explode(input_col).alias("term")).groupBy("_row", "term").agg(F.count(F.lit(1)).alias("_n"))
    sparse = counts.join(words.select("term", "term_index"), "term").groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("term_index", F.col("_n").alias("n")))).alias(output_col))
    out = rows.join(sparse, "_row", "left").drop("_row")
    empty = F.array().cast(out.schema[output_col].dataType)
    return words, out.withColumn(output_col, F.coalesce(output_col, empty))


def index_labels(df: DataFrame, col: str, index_col: str | None = None, count_col: str | None = None) -> DataFrame:
    """M-05 without a driver-side label list: (value, index) ordered by
    frequency desc then value, computed as a distributed rank; with
    ``count_col`` also the frequency.

    The value counts get a global row index in (count desc, value) order
    (``sampling.global_row_index``).
    """
    index_col = index_col or f"{col}_index"
    from logloom.operators.sampling import global_row_index
    from logloom.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    # Checkpointed once: the range partitioner samples its input in one job
    # and the write reads it again; the input itself is scanned once.
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    ranked = global_row_index(counts, [F.col("_n").desc(), F.col(col).asc()], index_col)
    return ranked.select(col, index_col, *([F.col("_n").alias(count_col)] if count_col else []))


UNSEEN_RULES = ("error", "keep", "skip")


@dataclass
class LabelIndex:
    """M-05/M-06 fitted once: the labels of one column with their index, by
    frequency (ties alphabetical), as a table that is saved, loaded and
    joined to any later rows. The same label has the same index in all of
    them, whatever else they hold.

    ``labels`` has label, label_index and n (how often the fit saw it);
    ``size`` is their number. No label list is kept on the driver."""

    column: str
    labels: DataFrame
    size: int

    @classmethod
    def fit(cls, df: DataFrame, column: str) -> "LabelIndex":
        """Distributed counts and rank (``index_labels``); null is no label."""
        known = df.select(F.col(column).cast("string").alias("label")).where("label is not null")
        labels = index_labels(known, "label", "label_index", count_col="n")
        return cls(column, labels, labels.count())  # the ranks are staged: a cheap scan

    def save(self, path: str, mode: str = "errorifexists") -> None:
        """The labels beside the column's name, as one Parquet table."""
        self.labels.withColumn("column", F.lit(self.column)).write.mode(mode).parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LabelIndex":
        table = spark.read.parquet(path)
        first = table.select("column").first()
        if first is None:
            raise ValueError(f"no labels in {path}")
        return cls(first[0], table.select("label", "label_index", "n"), table.count())

    def transform(self, df: DataFrame, column: str | None = None, output: str | None = None,
                  unseen: str = "error") -> DataFrame:
        """``df`` with the index of its column as a double with nominal
        metadata. A value the fit didn't see, or null, is an error, gets the
        index after all labels (``keep``), or its row goes (``skip``).

        The labels are joined, not shipped: AQE broadcasts them when they
        measure small and splits the rows of a hot value otherwise."""
        if unseen not in UNSEEN_RULES:
            raise ValueError(f"unseen must be one of {UNSEEN_RULES}")
        column = column or self.column
        output = output or f"{column}_index"
        ranks = self.labels.select(F.col("label").alias("_label"), F.col("label_index").cast("double").alias("_rank"))
        joined = df.drop(output).join(ranks, F.col(f"`{column}`").cast("string") == F.col("_label"), "inner" if unseen == "skip" else "left")
        if unseen == "error":
            other = F.raise_error(F.concat(F.lit(f"unseen label in {column}: "), F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("null")))).cast("double")
        else:
            other = F.lit(float(self.size))
        meta = {"ml_attr": {"type": "nominal", "num_vals": self.size + int(unseen == "keep"), "name": output}}
        index = F.coalesce("_rank", other) if unseen != "skip" else F.col("_rank")
        return joined.withColumn(output, index.alias(output, metadata=meta)).drop("_label", "_rank")

    def one_hot(self, df: DataFrame, column: str | None = None, output: str | None = None,
                unseen: str = "error", drop_last: bool = True) -> DataFrame:
        """``transform`` plus the one-hot vector (M-06). Its size follows from
        the fitted labels alone, so vectors of different tables agree. The
        last slot is dropped (all zero) unless it is the only one."""
        column = column or self.column
        output = output or f"{column}_onehot"
        drop_last = drop_last and self.size + int(unseen == "keep") > 1
        indexed = self.transform(df, column, f"{column}_index", unseen)
        return OneHotEncoder(inputCol=f"{column}_index", outputCol=output, dropLast=drop_last).fit(indexed).transform(indexed)


LOG_VECTOR_INPUTS = ["req_method_onehot", "status", "body_bytes_sent", "hash_url_features", "fabstime", "day_of_week"]


def log_vectors(df: DataFrame, num_features: int = 1000, output: str = "features",
                inputs: list[str] = LOG_VECTOR_INPUTS) -> DataFrame:
    """M-07 over extracted log rows: two-word runs of the path and the whole
    ``k=v`` items hashed into ``num_features``, assembled with the method's
    one-hot vector, status, bytes and time features into one sparse vector."""
    from logloom.functions import text
    terms = F.concat(text.ngrams(text.path_words("clean_path"), 2), F.col("clean_query_list"))
    hashed = hash_features(df.drop("url_features", "hash_url_features").withColumn("url_features", terms), "url_features", "hash_url_features", num_features)
    return assemble(hashed, inputs, output)


def hashed_entries(df: DataFrame, keep: list[str], hashed: str, bucket: str = "bucket", weight: str = "weight") -> DataFrame:
    """One row for each stored entry of a hashed vector: its bucket and
    weight, read from the vector's own sparse form."""
    entries = F.unwrap_udt(F.col(hashed))
    pairs: Column = F.arrays_zip(entries.getField("indices").alias("i"), entries.getField("values").alias("v"))
    return df.select(*keep, F.explode(pairs).alias("_e")).select(
        *keep, F.col("_e")["i"].cast("bigint").alias(bucket), F.col("_e")["v"].alias(weight))
