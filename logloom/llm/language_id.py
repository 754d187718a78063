"""Operator 9: language identification with language-bitmask n-gram filters.

One Bloom filter per language, stored bit-sliced: slot i holds a bitmask with one bit per language, so the AND of an
n-gram's slots gives all languages whose filter contains it in one lookup. A text's n-grams are looked up, the bits
are counted per language, each count is corrected for that filter's false-positive rate, and the language with the
largest corrected share of the text's n-grams is the answer.

N-grams are three lower-cased characters with a letter in the middle (a non-letter counts as a word edge), so a text
has one n-gram per letter. A language contains an n-gram if its rate in that language's labelled text is at least
``share`` times its highest rate in any language. Counts are taken over all labelled text.

The filters have slices of ``SLOTS`` slots, as many as the language with the most distinct n-grams needs for a
false-positive rate of ``FALSE_POSITIVES``; all slots of an n-gram are in one slice. Filters of at most
``BROADCAST_CELLS`` words go to every task. Larger ones stay a table, and the distinct n-grams of the texts are looked
up in it slice by slice.

Defined cases: null text, or text without a letter, gives ``und`` with score 0, and so does every text when nothing
was learned; null labels and null texts teach nothing; equal counts go to the alphabetically first language. Texts
are read whole, in pieces of bounded size. Input columns named lang_pred or score are replaced; others are kept."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.scratch import Scratch, bounded_batches
from logloom.llm.words import mix64

SLOTS = 1 << 20  # slots of a slice of the bit-sliced filter
HASHES = 3
FALSE_POSITIVES = 0.01  # aimed at in the fullest filter
BROADCAST_CELLS = 1 << 23  # 64 MB in each task
PIECE = 1 << 20  # characters after which a text is cut, as by a word edge
BLOCK = 1 << 17  # characters whose n-grams a task holds at once; PIECE is a multiple
COUNTED = 1 << 18  # n-gram counts that a task holds before it adds them up
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20  # of an Arrow batch of whole texts
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _ngrams(texts: list[str | None]):
    """Yields (row of each text part, offsets, n-gram keys) for parts of about BLOCK characters in all. A part shows its
    neighbours in the piece one character each, so the n-grams don't depend on BLOCK."""
    rows, parts, before, after, size = [], [], [], [], 0

    def flush():
        # Two edge characters between parts keep their n-grams apart.
        codes = np.frombuffer("\n\n".join(["", *parts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letter_table()[codes]
        kept = np.where(letter, codes, 0).astype(np.int64)
        starts = np.cumsum([2, *[len(p) + 2 for p in parts]])
        letter[starts[:-1][before]] = False
        letter[starts[1:][after] - 3] = False
        at = np.flatnonzero(letter)
        keys = (kept[at - 1] << 42) | (kept[at] << 21) | kept[at + 1]
        return np.array(rows), np.searchsorted(at, starts), keys

    for i, text in enumerate(texts):
        text = (text or "").lower()
        for k in range(0, max(1, len(text)), BLOCK):
            shown = k % PIECE > 0, (k + BLOCK) % PIECE > 0 and k + BLOCK < len(text)
            rows.append(i)
            parts.append(text[k - shown[0] : k + BLOCK + shown[1]])
            before.append(shown[0])
            after.append(shown[1])
            size += len(parts[-1])
            if size >= BLOCK:
                yield flush()
                rows, parts, before, after, size = [], [], [], [], 0
    if rows:
        yield flush()


def _slices_for(ngrams: int) -> int:
    """Slices that keep a filter of so many n-grams at FALSE_POSITIVES."""
    return max(1, math.ceil(HASHES * ngrams / -math.log(1 - FALSE_POSITIVES ** (1 / HASHES)) / SLOTS))


def _slice(keys: np.ndarray, slices: int) -> np.ndarray:
    return (mix64(~mix64(keys.astype(np.int64).view(np.uint64))) % np.uint64(slices)).astype(np.int64)


def _slots(keys: np.ndarray) -> list[np.ndarray]:
    """The slots of each n-gram in its slice."""
    h = mix64(keys.astype(np.int64).view(np.uint64))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(i) * step) % np.uint64(SLOTS)).astype(np.int64) for i in range(HASHES)]


def _count(batches):
    """Rows (lang, n-gram, count) of the texts, added up for COUNTED of them at a time."""
    waiting: dict[str, list] = {}
    size = 0

    def added():
        for lang, found in waiting.items():
            keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            counts = np.zeros(len(keys), np.int64)
            np.add.at(counts, at, np.concatenate([c for _, c in found]))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], ["lang", "key", "n"])

    for batch in batches:
        langs = batch.column("lang").to_numpy(zero_copy_only=False)
        texts = batch.column("text").to_pylist()
        for lang in sorted(set(langs)):
            for _, _, keys in _ngrams([t for t, x in zip(texts, langs, strict=True) if x == lang]):
                waiting.setdefault(lang, []).append(np.unique(keys, return_counts=True))
                size += len(waiting[lang][-1][0])
                if size >= COUNTED:
                    yield from added()
                    waiting, size = {}, 0
    yield from added()


@dataclass
class LanguageFilters:
    langs: list[str]
    slices: int
    masks: np.ndarray | None  # words x slots of all slices, one bit per language
    table: DataFrame | None = None  # slice, slot, word, mask, in place of masks that are too large

    def false_positive_rates(self) -> np.ndarray:
        if self.table is None:
            sliced = self.masks.reshape(len(self.masks), self.slices, SLOTS)
            return np.array([np.mean(np.mean((sliced[i // 64] >> np.uint64(i % 64)) & np.uint64(1), axis=1) ** HASHES) for i in range(len(self.langs))])
        full = self.table.groupBy("slice", "word").agg(*(F.sum(F.expr(f"shiftrightunsigned(mask, {b}) & 1L")).alias(f"b{b}") for b in range(64)))
        rows = full.groupBy("word").agg(*((F.sum((F.col(f"b{b}") / SLOTS) ** HASHES) / self.slices).alias(f"b{b}") for b in range(64))).collect()
        of = {r["word"]: r for r in rows}
        return np.array([of[i // 64][f"b{i % 64}"] if i // 64 in of else 0.0 for i in range(len(self.langs))])


def learn_filters(labelled: DataFrame, share: float = 0.25, broadcast_cells: int = BROADCAST_CELLS) -> LanguageFilters:
    """Learn from columns text and lang. The model has SLOTS * slices * ceil(languages / 64) words of 64 bits."""
    bounded_batches(labelled.sparkSession, BATCH_ROWS, BATCH_BYTES)
    labelled = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = labelled.mapInArrow(_count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).persist()
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("ngrams")).toPandas().sort_values("lang")
    langs = totals["lang"].tolist()
    words, slices = max(1, -(-len(langs) // 64)), _slices_for(int(totals["ngrams"].max()) if langs else 0)
    masks, table = None, None
    if langs:
        rates = counts.join(F.broadcast(labelled.sparkSession.createDataFrame([(x, i, float(n)) for i, (x, n) in enumerate(zip(langs, totals["total"], strict=True))], "lang string, i int, total double")), "lang").select("key", "i", (F.col("n") / F.col("total")).alias("rate"))
        top = rates.groupBy("key").agg(F.max("rate").alias("top"), F.collect_list(F.struct("i", "rate")).alias("all"))
        kept = top.select("key", F.expr(f"filter(all, x -> x.rate >= {share} * top).i").alias("i")).select("key", F.explode("i").alias("i"))

        def slots(batches):
            for b in batches:
                k, i = b.column("key").to_numpy(), b.column("i").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(_slice(k, slices), HASHES), pa.int32()), pa.array(np.concatenate(_slots(k)), pa.int32()), pa.array(np.tile(i // 64, HASHES), pa.int32()), pa.array(np.tile(np.int64(1) << (i % 64).astype(np.int64), HASHES), pa.int64())], ["slice", "slot", "word", "bit"])

        table = kept.mapInArrow(slots, "slice int, slot int, word int, bit long").groupBy("slice", "slot", "word").agg(F.bit_or("bit").alias("mask"))
    if words * slices * SLOTS <= broadcast_cells or not langs:
        masks = np.zeros((words, slices * SLOTS), np.uint64)
        if langs:
            cells = table.toPandas()  # at most broadcast_cells rows
            masks[cells["word"].to_numpy(), cells["slice"].to_numpy(np.int64) * SLOTS + cells["slot"].to_numpy()] = cells["mask"].to_numpy(np.int64).view(np.uint64)
        table = None
    else:
        table = Scratch(labelled.sparkSession, "language-filters").save(table, "filters")
    counts.unpersist()
    return LanguageFilters(langs, slices, masks, table)


def languages_of(filters: LanguageFilters, keys: np.ndarray) -> list[np.ndarray]:
    """The language bitmask of each n-gram key, a word of 64 languages at a time."""
    first = _slice(keys, filters.slices) * SLOTS
    slots = [first + s for s in _slots(keys)]
    return [np.bitwise_and.reduce([word[s] for s in slots]) for word in filters.masks]


def identify(docs: DataFrame, filters: LanguageFilters) -> DataFrame:
    """``docs`` with lang_pred and score (the corrected share of n-grams in that language, 0 to 1)."""
    spark = docs.sparkSession
    bounded_batches(spark, BATCH_ROWS, BATCH_BYTES)
    docs = docs.drop("lang_pred", "score")
    if filters.table is not None:
        return _identify_joined(docs, filters)
    model = spark.sparkContext.broadcast(filters)
    rates = filters.false_positive_rates()

    def run(batches):
        langs = np.array([*model.value.langs, UNKNOWN], object)
        for batch in batches:
            n = batch.num_rows
            hits, total = np.zeros((len(rates), n)), np.zeros(n)
            for rows, offsets, keys in _ngrams(batch.column("text").cast(pa.string()).to_pylist()):
                np.add.at(total, rows, np.diff(offsets))
                masks = languages_of(model.value, keys)
                for i in range(len(rates)):
                    sums = np.concatenate([[0], np.cumsum((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1), dtype=np.int64)])
                    np.add.at(hits[i], rows, np.diff(sums[offsets]))
            pred, score = np.full(n, len(rates)), np.zeros(n)
            if len(rates):
                true = np.clip((hits - rates[:, None] * total) / (1 - rates)[:, None], 0, None) / np.maximum(total, 1)
                best = true.argmax(0)
                pred = np.where(total > 0, best, pred)
                score = np.where(total > 0, np.minimum(true.max(0), 1.0), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs[pred].tolist(), pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def _text_ngrams(slices: int):
    """Rows (row, slice, key, times) of the n-grams of each text."""
    def run(batches):
        for batch in batches:
            ids = batch.column("row").to_numpy()
            for rows, offsets, keys in _ngrams(batch.column("text").to_pylist()):
                of = np.repeat(rows, np.diff(offsets))
                order = np.lexsort((keys, of))
                of, keys = of[order], keys[order]
                first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])])) if len(keys) else np.zeros(0, np.int64)
                times = np.diff(np.append(first, len(keys)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[of[first]], pa.int64()), pa.array(_slice(keys[first], slices), pa.int32()), pa.array(keys[first], pa.int64()), pa.array(times, pa.int64())], ["row", "slice", "key", "times"])
    return run


def _look_up(keys: pa.Table, cells: pa.Table) -> pa.Table:
    """The language bitmasks (key, word, mask) of one slice's n-grams."""
    keys = keys.column("key").to_numpy()
    slots = _slots(keys)
    at, words, masks = (cells.column(c).to_numpy() for c in ("slot", "word", "mask"))
    out = [[np.zeros(0, np.int64)] for _ in range(3)]
    for word in np.unique(words) if len(keys) else []:
        full = np.zeros(SLOTS, np.int64)
        full[at[words == word]] = masks[words == word]
        found = np.bitwise_and.reduce([full[s] for s in slots])
        hit = np.flatnonzero(found)
        for o, v in zip(out, (keys[hit], np.full(len(hit), word), found[hit]), strict=True):
            o.append(v)
    key, word, mask = (np.concatenate(o) for o in out)
    return pa.table({"key": pa.array(key, pa.int64()), "word": pa.array(word, pa.int32()), "mask": pa.array(mask, pa.int64())})


def _identify_joined(docs: DataFrame, filters: LanguageFilters) -> DataFrame:
    """``identify`` for filters that stay a table."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "language-id")
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    docs = scratch.save(docs, "docs")  # row ids stay as they are
    grams = docs.select("row", F.col("doc.text").cast("string").alias("text")).mapInArrow(_text_ngrams(filters.slices), "row long, slice int, key long, times long")
    grams = scratch.save(grams, "ngrams")
    looked = grams.select("slice", "key").distinct().groupBy("slice").cogroup(filters.table.groupBy("slice")).applyInArrow(_look_up, "key long, word int, mask long")
    bits = F.explode(F.expr("filter(sequence(0, 63), b -> (shiftrightunsigned(mask, b) & 1L) = 1L)"))
    hits = grams.join(looked, "key").select("row", "times", "word", bits.alias("b")).groupBy("row", (F.col("word") * 64 + F.col("b")).alias("i")).agg(F.sum("times").alias("hits"))
    langs = spark.createDataFrame([(i, x, float(p)) for i, (x, p) in enumerate(zip(filters.langs, filters.false_positive_rates(), strict=True))], "i int, lang string, rate double")
    totals = grams.groupBy("row").agg(F.sum("times").alias("total"))
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("hits") - F.col("rate") * F.col("total")) / (1 - F.col("rate"))) / F.col("total"))
    shares = hits.join(F.broadcast(langs), "i").join(totals, "row").select("row", "i", "lang", share.alias("share"))
    best = shares.groupBy("row").agg(F.max("share").alias("score"), F.max_by("lang", F.struct("share", -F.col("i"))).alias("lang"))
    out = docs.join(totals, "row", "left").join(best, "row", "left")
    pred = F.when(F.col("total").isNull(), UNKNOWN).when(F.col("score") > 0, F.col("lang")).otherwise(filters.langs[0])
    return out.select("doc.*", pred.alias("lang_pred"), F.coalesce("score", F.lit(0.0)).alias("score"))


def held_out(doc_id: str = "doc_id", fold: int = 0):
    """Whether crc32 of the id as text modulo 5 is ``fold``; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == fold, F.lit(True))


def identify_held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learning from those that are not held out."""
    docs = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    filters = learn_filters(docs.where(~F.col("held_out")).select("text", "lang"))
    return identify(docs.select("doc_id", "held_out", "text"), filters).select("doc_id", "held_out", "lang_pred", "score")
