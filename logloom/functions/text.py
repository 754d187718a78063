"""Text and array functions (F-09..F-20, n-grams) as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def characters(c: Column | str) -> Column:
    """F-09: string -> array of characters (no trailing blank)."""
    return F.split(_c(c), "")


def path_words(c: Column | str) -> Column:
    """F-10: strip one leading '/', split on '/'."""
    return F.split(F.regexp_replace(_c(c), "^/", ""), "/")


def words_on_space(c: Column | str) -> Column:
    """F-20: split on a single space; empty tokens are kept."""
    return F.split(_c(c), " ")


def tokens(c: Column | str) -> Column:
    """F-19 lower-case whitespace tokenizer, same output as
    ``ml.feature.Tokenizer``: split on each whitespace character, trailing
    empty tokens removed."""
    low = F.lower(_c(c))
    trimmed = F.regexp_replace(low, r"\s+$", "")
    return (F.when((trimmed == "") & (low != ""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, r"\s")))


def ngrams(arr: Column | str, n: int) -> Column:
    """M-01/M-02 n-grams joined by a space, as ``ml.feature.NGram``: an
    array shorter than ``n`` gives an empty array.

    Built from ``n`` shifted slices zipped together, so the work is linear
    in the array length (a lambda that slices the outer array would
    re-evaluate it for every position)."""
    a = _c(arr)
    if n == 1:
        return a
    m = F.size(a) - F.lit(n - 1)
    length = F.greatest(m, F.lit(0))
    zipped = F.arrays_zip(*[F.slice(a, i + 1, length).alias(f"g{i}") for i in range(n)])
    grams = F.transform(zipped, lambda s: F.concat_ws(" ", *[s[f"g{i}"] for i in range(n)]))
    return F.when(m >= 1, grams).otherwise(F.array().cast("array<string>"))

