import pytest


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    from pyspark.sql import functions as F

    long = " ".join(f"word{i % 5000} the{i % 7}" for i in range(60_000))
    rows = [
        (1, None, "en", "src0"), (2, "", None, "src1"), (3, "  \t\n ", "fr", None), (4, "One", "en", "src0"), (5, "one two three", "de", "src2"),
        (5, "one two three", "de", "src2"), (None, "a text without an id but with some words", None, None), (6, long, "en", "src0"),
        (7, long, "en", "src0"), (8, long.replace("word17 ", "other "), "en", "src1"), (9, "12 34 -- !!", "es", "src4"), (10, "ONE TWO THREE", "de", "src2"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    extra = ["n", "h", "rows", "component", "key", "range", "pos", "score", "lang_pred", "host", "budget", "cells"]
    return docs.select("*", *(F.lit("x").alias(c) for c in extra)), rows


@pytest.fixture(scope="session")
def docs(spark):
    from tests.conftest import SF_SMALL
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").orderBy("doc_id").collect()]
