"""Registered queries of the llm operators, and their DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import centroids, chat, licenses, mixing, url_rules


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logloom.llm.decontaminate import find_leaks
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logloom.llm.url_rules import RULES, judge_urls
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logloom.llm.warc import pages_to_warc
    _, records = pages_to_warc(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri", "date")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logloom.llm.chat import format_chats
    return format_chats(_table(spark, sf_dir, "conversations"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logloom.llm.licenses import document_path, scan_licenses
    docs = _table(spark, sf_dir, "documents")
    return scan_licenses(docs.select("doc_id", document_path().alias("path"), "text")).drop("text")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logloom.llm.ngram_join import ngram_jaccard_join
    return ngram_jaccard_join(_table(spark, sf_dir, "documents"))


def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logloom.llm.class_lm import score_held_out
    return score_held_out(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logloom.llm.simhash import fingerprint_documents
    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logloom.llm.language_id import identify_held_out
    return identify_held_out(_table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logloom.llm.mixing import TARGET_WEIGHTS, mix_sources
    return mix_sources(_table(spark, sf_dir, "documents"), TARGET_WEIGHTS)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers
    from logloom.llm.alignment import linked_documents, read_models
    models = read_models(tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model"))
    return linked_documents(_table(spark, sf_dir, "documents"), models)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = centroids.integer_vectors(_table(spark, sf_dir, "embeddings"))
    return centroids.cluster_report(centroids.fit_centroids(vectors))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers
    from logloom.llm.byte_bpe import decode, encode, load_ranks
    ranks = load_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    decoded = decode(encode(_table(spark, sf_dir, "documents"), ranks, tokenizers.PATTERN), ranks)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_url_rules": op2_url_rules,
    "op3_warc": op3_warc,
    "op4_chat_format": op4_chat_format,
    "op5_license_scan": op5_license_scan,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_class_lm": op7_class_lm,
    "op8_simhash": op8_simhash,
    "op9_language_id": op9_language_id,
    "op10_mix_sources": op10_mix_sources,
    "op11_token_alignment": op11_token_alignment,
    "op12_centroids": op12_centroids,
    "op13_byte_bpe": op13_byte_bpe,
}

SQL: dict[str, str] = {
    "op4_chat_format": chat.ORACLE_SQL,
    "op5_license_scan": licenses.oracle_sql(),
    "op2_url_rules": url_rules.oracle_sql(),
    "op10_mix_sources": mixing.oracle_sql(),
    "op12_centroids": centroids.oracle_sql(),
}
