"""From raw documents to a training mix, in four stages over the documents table.

1. language ID: documents without a letter, or whose n-grams fit no learned language, go;
2. n-gram Jaccard join on five words, linked from 0.8 (query op6 states its own four words and 0.85): of each group of
   near copies the document with the smallest id stays;
3. benchmark decontamination: documents that contain a benchmark item go;
4. mixing: what is left is taken up to the target weights of its sources.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet in the shared folder and
reads again as the next stage's docs. All stages but the last return the columns of documents. A null id is kept by
every stage that can't name it (it is nobody's copy)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.decontaminate import decontaminate
from logloom.llm.language_id import UNKNOWN, held_out, identify, learn_filters
from logloom.llm.mixing import TARGET_WEIGHTS, mix_sources
from logloom.llm.ngram_join import ngram_jaccard_join
from logloom.llm.scratch import Scratch

#: Least corrected share of a text's n-grams in its language.
LEAST_LANGUAGE_SCORE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a letter and fits a learned language stay; null texts go."""
    filters = learn_filters(docs.where(~held_out()).select("text", "lang"))
    kept = (F.col("_pred.lang_pred") != UNKNOWN) & (F.col("_pred.score") >= LEAST_LANGUAGE_SCORE)
    inner = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("_row"), "text")  # a text goes to Python once
    judged = identify(inner, filters).select("_row", "text", F.struct("lang_pred", "score").alias("_pred"))
    return judged.where(kept).select(*("text" if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is an id with a text. Of linked documents the first by (id, text) stays; of equal ones the first by
    all columns that can be ordered."""
    scratch = Scratch(spark, "near-copies")
    named = docs.where("doc_id is not null")
    text = F.struct(*(F.xxhash64(F.lit(k), F.col("text").isNull(), "text") for k in (1, 2)))
    repeated = named.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(text).alias("t0"), F.max(text).alias("t1")).where("n > 1")
    repeated = scratch.save(repeated.select("doc_id", (F.col("t0") != F.col("t1")).alias("differ")), "repeated")
    several = repeated.where("differ").select("doc_id")
    inner = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")
    keyed = named.select(inner, F.col("doc_id").cast("long").alias("_key"), "text")
    names = None
    if not several.isEmpty():  # ids of several texts: each text has a key of its own, below all ids
        least = named.agg(F.min("doc_id").cast("long")).first()[0]
        names = named.join(several, "doc_id", "left_semi").select("doc_id", "text").distinct().withColumn("_n", F.monotonically_increasing_id())
        names = scratch.save(names.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), (F.lit(least) - 1 - F.col("_n")).alias("_new")), "names")
        keyed = keyed.join(names, (F.col("_doc.doc_id") == F.col("_id")) & F.col("text").eqNullSafe(F.col("_text")), "left").select("_doc", F.coalesce("_new", "_key").alias("_key"), "text")
    found = ngram_jaccard_join(keyed.select(F.col("_key").alias("doc_id"), "text"), width=5, num=80, den=100)
    if names is None:
        copies = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_key")).distinct()
    else:
        ends = found.select(F.col("doc_id").alias("_key"), "component_id").distinct().join(names, F.col("_key") == F.col("_new"), "left")
        ends = scratch.save(ends.select("_key", "component_id", F.struct(F.coalesce("_id", "_key").alias("id"), "_text").alias("_at")), "ends")
        stay = ends.groupBy("component_id").agg(F.min_by("_key", "_at").alias("_stays"))
        copies = ends.join(stay, "component_id").where("_key <> _stays").select("_key")
    kept = keyed.join(scratch.save(copies, "copies"), "_key", "left_anti")
    null_ids = docs.where("doc_id is null")
    if repeated.isEmpty():
        return kept.select("_doc.*").unionByName(null_ids)
    # Only the rows of repeated ids are gathered by key: one of equal rows stays.
    order = F.struct(*(F.col(f"_doc.`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind))
    again = F.col("_doc.doc_id") == F.col("_again")
    ids = repeated.select(F.col("doc_id").alias("_again"))
    one = kept.join(ids, again, "left_semi").groupBy("_key").agg(F.min_by("_doc", order).alias("_doc"))
    return kept.join(ids, again, "left_anti").select("_doc.*").unionByName(one.select("_doc.*")).unionByName(null_ids)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none and stay."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the target weights take, with their whole epochs and the tokens of a part."""
    return mix_sources(docs, TARGET_WEIGHTS)


STAGES = [
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("mixing", mixing_stage),
]

#: Language ID, the join's links and the embedding have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
