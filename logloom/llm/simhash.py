"""Operator 8: SimHash fingerprints, and the fingerprints within a Hamming radius by permuted block tables.

A text's terms are its runs of ``WIDTH`` words (a shorter text is one term). Each distinct term has a 64-bit hash and the
weight ``1 + ln(occurrences)``; every bit of the hash votes plus or minus the weight, and the signs of the 64 sums are
the fingerprint. The likeness of two fingerprints is the share of equal bits.

Search: a fingerprint is cut into ``radius + 2`` blocks. Two fingerprints within ``radius`` differ in at most ``radius``
blocks, so they agree on at least two; there is one table for each pair of blocks, keyed by them (the permuted leading
bits). An equi-join on (table, key) finds all candidates, which the Hamming distance then decides. Documents of one
fingerprint are a class, named by their smallest id: a search finds classes, and a document's class is in its row.

The next document of a row is found without a global sort: ids are cut into ranges at ids of a seeded sample (it decides
balance only), each range is sorted on its own, and the first row of a range is also sent to the range before. Texts are
shuffled once; a task holds a batch and half a million characters of texts, or one longer text and its next.

Defined cases: null text is empty text; a text without words has fingerprint 0; null ids come first; rows of equal id
are ordered by text; a lone row is its own next. Texts are read whole. Other columns are ignored."""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.scratch import Scratch, bounded_batches
from logloom.llm.words import shingle_hashes, word_hashes

WIDTH = 3
BITS = 64
RADIUS = 3
HELD_CHARS = 1 << 19  # characters of the texts whose fingerprints a task computes at once
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20  # of an Arrow batch
RANGES_A_PARTITION = 8
SAMPLED_A_RANGE = 16
NO_ID = -(1 << 63)
PRINTS = ("id long, n_chars long, edited_sha256 string, print long, edited_print long, near_edited double, near_next double")


def fingerprints(col: pa.Array) -> np.ndarray:
    """uint64 fingerprint of each text of a string column."""
    offsets, terms = shingle_hashes(*word_hashes(col), WIDTH)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((terms, row))
    terms, row = terms[order], row[order]
    new = np.ones(len(terms), bool)
    new[1:] = (terms[1:] != terms[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    weights = (1 + np.log(np.diff(np.append(first, len(terms))))).astype(np.float32)
    terms, row = terms[first], row[first]
    votes = np.zeros((len(offsets) - 1, BITS), np.float64)
    step = 1 << 15
    for a in range(0, len(terms), step):
        bits = np.unpackbits(terms[a : a + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        own, start = np.unique(row[a : a + step], return_index=True)
        bits = (2 * bits - 1) * weights[a : a + step, None]
        votes[own] += np.add.reduceat(bits, start, axis=0, dtype=np.float64)
    return np.packbits(votes > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 - np.bitwise_count(a ^ b) / BITS


def edited(text: str, following: str) -> str:
    """The last half of ``text`` (rounded down) replaced by as many first characters of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _print_rows(held: list[tuple[int, str, str]]) -> pa.RecordBatch:
    """``held`` has runs of (id, text, next text); a next text is most often the next row's text."""
    texts, following = [t for _, t, _ in held], [f for *_, f in held]
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    apart = [k for k in range(len(held)) if k + 1 == len(held) or following[k] is not texts[k + 1]]
    own = fingerprints(pa.array(texts + [following[k] for k in apart], pa.large_string()))
    prints, nexts = own[: len(held)], np.append(own[1 : len(held)], own[:1])
    nexts[apart] = own[len(held) :]
    changed_prints = fingerprints(pa.array(changed, pa.large_string()))
    return pa.RecordBatch.from_arrays([
        pa.array([i for i, *_ in held], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed], pa.string()),
        pa.array(prints.view(np.int64), pa.int64()), pa.array(changed_prints.view(np.int64), pa.int64()),
        pa.array(likeness(prints, changed_prints), pa.float64()), pa.array(likeness(prints, nexts), pa.float64())],
        ["id", "n_chars", "edited_sha256", "print", "edited_print", "near_edited", "near_next"])


def _with_next(batches):
    """Rows in order of (range, is_next, id, text): each row that isn't a copy for the range before, with the row
    after it."""
    held: list = []
    size, at, before = 0, None, None
    for batch in batches:
        for number, is_next, i, text in zip(*(batch.column(n).to_pylist() for n in ("range", "is_next", "id", "text")), strict=True):
            if number != at:
                at, before = number, None
            if before is not None:
                held.append((*before, text))
                size += len(before[1]) + len(text)
            before = None if is_next else (i, text)
            if size >= HELD_CHARS:
                yield _print_rows(held)
                held, size = [], 0
    if held:
        yield _print_rows(held)


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """PRINTS of each row of ``docs`` (doc_id, text) and of its edited text; a null id is NO_ID."""
    spark = docs.sparkSession
    bounded_batches(spark, BATCH_ROWS, BATCH_BYTES)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = RANGES_A_PARTITION * partitions
    ids = docs.select("id")
    least = ids.agg(F.min("id")).first()[0]
    drawn = ids.select("id", F.xxhash64("id", F.lit(5)).alias("draw")).distinct().orderBy("draw", "id").limit(SAMPLED_A_RANGE * ranges).select("id").toPandas()["id"]
    drawn = np.sort(drawn.to_numpy(np.int64))
    drawn = drawn[drawn != least] if least is not None else drawn
    bounds = drawn[np.unique(np.arange(1, ranges) * len(drawn) // ranges)] if len(drawn) else drawn

    @F.pandas_udf("int")
    def range_of(i: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, i.to_numpy(np.int64), "right").astype(np.int32))

    @F.pandas_udf("int")
    def range_before(i: pd.Series) -> pd.Series:
        """For the first id of a range the range before; the least id follows the last. Else -1."""
        i = i.to_numpy(np.int64)
        n = np.searchsorted(bounds, i, "right")
        first = (n > 0) & (bounds[np.maximum(n, 1) - 1] == i) if len(bounds) else np.zeros(len(i), bool)
        return pd.Series(np.where(first, n - 1, np.where(i == least, len(bounds), -1)).astype(np.int32))

    placed = docs.select(F.explode(F.filter(F.array(
        F.struct(range_of("id").alias("range"), F.lit(False).alias("is_next")), F.struct(range_before("id").alias("range"), F.lit(True).alias("is_next"))),
        lambda x: x["range"] >= 0)).alias("at"), "id", "text").select("at.range", "at.is_next", "id", "text")
    placed = placed.repartition(partitions, "range").sortWithinPartitions("range", "is_next", "id", "text")
    return placed.mapInArrow(_with_next, PRINTS)


def block_tables(radius: int) -> list[int]:
    """The bit mask of each table: two of ``radius + 2`` blocks."""
    edges = [BITS * k // (radius + 2) for k in range(radius + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [x | y for x, y in combinations(blocks, 2)]


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, print) for each distinct value of the long column ``print`` of either table at most ``radius`` apart."""
    masks = [m - (1 << 64) if m >> 63 else m for m in block_tables(radius)]
    tables = F.explode(F.array(*(F.struct(F.lit(n).alias("table"), F.col("print").bitwiseAND(F.lit(m)).alias("key")) for n, m in enumerate(masks)))).alias("t")
    own = lambda df, name: df.select("print").distinct().select(F.col("print").alias(name), tables).select(name, "t.table", "t.key")
    close = own(queries, "query").join(own(prints, "found"), ["table", "key"]).where(F.bit_count(F.col("query").bitwiseXOR(F.col("found"))) <= radius)
    return close.select("query", F.col("found").alias("print")).distinct()


def fingerprint_documents(docs: DataFrame, radius: int = RADIUS, every: int = 50) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (16 hex digits), near_edited, near_next, class_id
    (the smallest id with the same fingerprint), and for ids divisible by ``every`` (the stated queries) near_documents,
    how many other rows lie within ``radius``, and near_classes, the sorted ids of the other classes among them. A class
    of null ids alone has a null id and is counted, not named."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.save(fingerprint_edits(docs), "prints")
    asked = (F.col("id") != NO_ID) & (F.col("id") % every == 0)
    classes = scratch.save(rows.groupBy("print").agg(F.count("*").alias("n"), F.min(F.when(F.col("id") != NO_ID, F.col("id"))).alias("class_id")), "classes")
    other = F.when(F.col("print") != F.col("query"), F.col("class_id"))
    close = within_radius(rows.where(asked), classes, radius).join(classes, "print").groupBy("query").agg(
        (F.sum("n") - 1).alias("near"), F.array_sort(F.collect_list(other)).alias("others"))
    found = scratch.save(classes.join(close, F.col("print") == F.col("query"), "left").select("print", "class_id", "near", "others"), "near")
    digits = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    return rows.join(found, "print").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", digits("print").alias("fingerprint"),
        digits("edited_print").alias("edited_fingerprint"), "near_edited", "near_next", "class_id", F.when(asked, F.col("near")).alias("near_documents"),
        F.when(asked, F.col("others")).alias("near_classes"))
