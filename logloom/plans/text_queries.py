"""Registered queries over ``documents``: word count, top words, token
n-grams."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.functions import text
from logloom.operators import wordcount as WC
from logloom.sources.tables import read_table, spread

TOP_K = 100


def _lines(spark, sf_dir):
    return WC.text_lines(spread(read_table(spark, sf_dir, "documents", "text")))


def q_word_count(spark, sf_dir):
    return WC.word_count(_lines(spark, sf_dir))


def q_top_words(spark, sf_dir):
    return WC.top_words(_lines(spark, sf_dir), TOP_K)


def q_token_ngrams(spark, sf_dir):
    docs = spread(read_table(spark, sf_dir, "documents", "text"))
    # Tokens in their own projection: the n-gram expression refers to the
    # array n+1 times, and a Generate does not share subexpressions.
    toks = docs.select(text.tokens("text").alias("tokens"))
    grams = toks.select(F.explode(text.ngrams("tokens", 2)).alias("ngram"))
    return grams.groupBy("ngram").agg(F.count(F.lit(1)).alias("n"))


_WORDS = ("SELECT unnest(string_split(line, ' ')) AS word FROM "
          "(SELECT unnest(string_split(text, chr(10))) AS line FROM documents)")
_TOKENS = (r"CASE WHEN regexp_replace(lower(text), '\s+$', '') = '' AND lower(text) <> '' "
           r"THEN []::VARCHAR[] ELSE regexp_split_to_array(regexp_replace(lower(text), '\s+$', ''), '\s') END")

SQL = {
    "word_count": f"SELECT word, count(*) AS count FROM ({_WORDS}) GROUP BY word",
    "top_words": f"SELECT word, count(*) AS count FROM ({_WORDS}) GROUP BY word "
                 f"ORDER BY count DESC, word ASC LIMIT {TOP_K}",
    "token_ngrams": f"""SELECT ngram, count(*) AS n FROM (
        SELECT unnest(list_transform(range(1, len(t) - 2 + 2), lambda i: array_to_string(t[i:i + 1], ' '))) AS ngram
        FROM (SELECT {_TOKENS} AS t FROM documents)) GROUP BY ngram""",
}

QUERIES = {
    "word_count": q_word_count,
    "top_words": q_top_words,
    "token_ngrams": q_token_ngrams,
}
