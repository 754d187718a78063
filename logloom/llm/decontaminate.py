"""Operator 1: documents that contain benchmark items, exactly or with few edits.

CGK embedding: a walk over a word sequence writes the word under its cursor at every step and moves on by one random
bit that depends on the step and the word. Two sequences at a small edit distance drift apart at an edit and soon walk
together again, so their outputs differ in few places: edit distance becomes Hamming distance. Bit sampling then
takes a few output places as a signature; equal signatures make a candidate. The walk is repeated with fresh random
bits until ``target_recall`` is reached for items with the most edits allowed; the number of repetitions is measured
on ``TRIALS`` seeded edits of at most ``SAMPLE`` items with their words renamed (so that no two trials walk alike), set
inside running words, as a walk runs past the item's end there. If ``MOST`` repetitions don't reach the target, a warning states the recall. Every candidate is verified by the exact word edit distance between the
whole item and the document around it.

Windows have the size of the items, by size class (``CLASSES``). A document gives a window every ``stride`` words; an
item gives one from each of its words on, so one of its windows starts where a document window does.

The items are a stated query set: they are taken in blocks of bounded size, and each block is held against all rows
in one pass without a shuffle. Memory is one block of signatures and one Arrow batch.

Defined cases: null and empty texts contain nothing; items of fewer than ``CLASSES[-1][0]`` words, null or empty items
match nothing, as such runs occur in clean text; words are compared with A-Z lower-cased; repeated rows and repeated
items each give their own rows; texts are read whole, and columns other than those named are kept."""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.scratch import bounded_batches
from logloom.llm.words import mix64, word_hashes

#: (least words of an item, words of a window, stride of document windows)
CLASSES = ((31, 24, 8), (15, 12, 4), (8, 6, 3), (4, 4, 1))
PLACES = 4  # sampled places of an embedding
SAMPLE = 64  # items of a class on which the repetitions are measured
TRIALS = 400
MOST = 128  # repetitions of a class
FILTER = 1 << 20  # most slots of a signature filter, which has 16 a signature below that; it only spares searches
BLOCK_CHARS = 8 << 20  # characters of items in a block
BATCH_ROWS = 500  # documents whose words and windows a task holds at once
LEAKS = "doc_id long, item_id long, word_start long, distance int, item_words int"


def _steps(window: int) -> int:
    return int(window * 1.7)


def _places(size_class: int, repetition: int) -> np.ndarray:
    rng = np.random.default_rng((size_class, repetition))
    return np.sort(rng.choice(_steps(CLASSES[size_class][1]), PLACES, replace=False))


def signatures(words: np.ndarray, starts: np.ndarray, size_class: int, repetition: int) -> np.ndarray:
    """The sampled CGK embedding of the window at each start; ``words`` are hashes."""
    places = set(_places(size_class, repetition).tolist())
    steps = max(places) + 1
    padded = np.concatenate([words, np.zeros(steps + 1, np.uint64)])
    moves = mix64(padded ^ np.uint64(0x5851F42D4C957F2D * (repetition + 1) % (1 << 64)))
    out = np.zeros(len(starts), np.uint64)
    for a in range(0, len(starts), 1 << 15):
        at = starts[a : a + (1 << 15)].astype(np.int64)
        sig = np.zeros(len(at), np.uint64)
        for j in range(steps):
            if j in places:
                sig = sig * np.uint64(0x9E3779B97F4A7C15) + padded[at]
            at += ((moves[at] >> np.uint64(j)) & np.uint64(1)).astype(np.int64)
        out[a : a + (1 << 15)] = sig
    return mix64(out)


def fitting_distance(pattern: dict, length: int, text: list[int]) -> tuple[int, int]:
    """(least edits between the pattern and any run of ``text``, end of that run), bit-parallel. ``pattern`` maps a
    word to the bits of its places."""
    full, high = (1 << length) - 1, 1 << (length - 1)
    up, down, score, best = full, 0, length, (length, 0)
    for end, word in enumerate(text, 1):
        eq = pattern.get(word, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph, mh = (down | ~(xh | up)) & full, up & xh
        score += 1 if ph & high else -1 if mh & high else 0
        ph, mh = (ph << 1) & full, (mh << 1) & full
        up, down = (mh | ~(xv | ph)) & full, ph & xv
        if score < best[0]:
            best = (score, end)
    return best


@dataclass
class ItemBlock:
    """Signatures of one block of items, by (class, repetition): sorted values, item and window offset of each."""

    ids: list
    words: list[np.ndarray]
    max_edits: float
    tables: dict = field(default_factory=dict)
    patterns: dict = field(default_factory=dict)

    def pattern(self, i: int) -> dict:
        if i not in self.patterns:
            bits: dict = {}
            for k, w in enumerate(self.words[i].tolist()):
                bits[w] = bits.get(w, 0) | 1 << k
            self.patterns[i] = bits
        return self.patterns[i]

    def matches(self, words: np.ndarray, offsets: np.ndarray):
        """(row, item index, first word, distance) of each item within ``max_edits`` in each row."""
        candidates = set()
        per_class: dict = {}
        for (size_class, repetition), (values, items, shifts, bits) in self.tables.items():
            if size_class not in per_class:
                _, window, stride = CLASSES[size_class]
                counts = np.maximum((np.diff(offsets) - window) // stride + 1, 0)
                row = np.repeat(np.arange(len(counts)), counts)
                place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                per_class[size_class] = row, offsets[row] + place * stride
            row, starts = per_class[size_class]
            sig = signatures(words, starts, size_class, repetition)
            near = np.flatnonzero(bits[(sig % np.uint64(len(bits))).astype(np.int64)])
            lo, hi = np.searchsorted(values, sig[near], "left"), np.searchsorted(values, sig[near], "right")
            for k, a, b in zip(near.tolist(), lo.tolist(), hi.tolist(), strict=True):
                for x in range(a, b):
                    candidates.add((int(row[k]), int(items[x]), int(starts[k]) - int(shifts[x])))
        # Candidate places of one item that are within its edits of each other are verified together.
        done: dict = {}
        placed = sorted(candidates)
        k = 0
        while k < len(placed):
            r, i, begin = placed[k]
            length = len(self.words[i])
            allowed = int(self.max_edits * length)
            while k < len(placed) and placed[k][:2] == (r, i) and placed[k][2] <= begin + allowed:
                last = placed[k][2]
                k += 1
            if (r, i) in done and done[r, i][1] == 0:
                continue
            a, b = max(int(offsets[r]), begin - 2 * allowed), min(int(offsets[r + 1]), last + length + 2 * allowed)
            distance, end = fitting_distance(self.pattern(i), length, words[a:b].tolist())
            if distance <= allowed and ((r, i) not in done or distance < done[r, i][1]):
                done[r, i] = (max(0, a + end - length - int(offsets[r])), distance)
        return [(r, i, start, distance) for (r, i), (start, distance) in done.items()]


def _edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    out = words.tolist()
    for _ in range(edits):
        kind, k = rng.integers(3), int(rng.integers(len(out)))
        if kind == 0:
            out[k] = int(rng.integers(1, 1 << 62))
        elif kind == 1:
            out.insert(k, int(rng.integers(1, 1 << 62)))
        elif len(out) > 1:
            del out[k]
    return np.array(out, np.uint64)


def repetitions(items: list[np.ndarray], size_class: int, max_edits: float, target_recall: float) -> int:
    """Repetitions that find an item with the most edits allowed with probability ``target_recall``."""
    _, window, stride = CLASSES[size_class]
    rng = np.random.default_rng(11)
    sample = items[:: max(1, len(items) // SAMPLE)][:SAMPLE]
    other = lambda n: rng.integers(1, 1 << 62, n, dtype=np.int64).astype(np.uint64)
    trials = []
    for k in range(TRIALS):
        _, same = np.unique(sample[k % len(sample)], return_inverse=True)
        item = other(len(same))[same]
        trials.append((item, np.concatenate([other(int(rng.integers(stride))), _edited(item, int(max_edits * len(item)), rng), other(_steps(window))])))
    missed, r = len(trials), 0
    found = np.zeros(len(trials), bool)
    while missed > (1 - target_recall) * len(trials) and r < MOST:
        for k, (w, text) in enumerate(trials):
            if not found[k]:
                there = np.arange(0, len(text) - window + 1, stride)
                found[k] = bool(np.isin(signatures(text, there, size_class, r), signatures(w, np.arange(len(w) - window + 1), size_class, r)).any())
        missed, r = int((~found).sum()), r + 1
    if missed > (1 - target_recall) * len(trials):
        warnings.warn(f"items of {CLASSES[size_class][0]} words and more: recall {found.mean():.3f} after {r} repetitions, below {target_recall}", stacklevel=2)
    return max(1, r)


def item_blocks(items: DataFrame, max_edits: float, target_recall: float):
    """Blocks of the query set, each read to the driver when its pass begins."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = math.ceil(chars / BLOCK_CHARS)
    for n in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == n).toArrow()
        column = part.column("text").combine_chunks()
        offsets, words = word_hashes(column) if len(part) else (np.zeros(1, np.int64), np.zeros(0, np.uint64))
        order = sorted(range(len(part)), key=lambda i: str(part.column("item_id")[i]))
        block = ItemBlock([part.column("item_id")[i].as_py() for i in order], [words[offsets[i] : offsets[i + 1]] for i in order], max_edits)
        upper = math.inf
        for c, (least, window, _) in enumerate(CLASSES):
            own = [i for i, w in enumerate(block.words) if least <= len(w) < upper]
            upper = least
            if not own:
                continue
            for r in range(repetitions([block.words[i] for i in own], c, max_edits, target_recall)):
                sig = [signatures(block.words[i], np.arange(len(block.words[i]) - window + 1), c, r) for i in own]
                sizes = [len(s) for s in sig]
                values = np.concatenate(sig)
                by = np.argsort(values, kind="stable")
                bits = np.zeros(min(FILTER, 1 << (16 * len(values)).bit_length()), bool)
                bits[(values % np.uint64(len(bits))).astype(np.int64)] = True
                block.tables[c, r] = values[by], np.repeat(own, sizes)[by], np.concatenate([np.arange(s) for s in sizes])[by], bits
        yield block


def find_leaks(docs: DataFrame, items: DataFrame, max_edits: float = 0.2, target_recall: float = 0.98) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, word_start, distance, item_words.

    ``docs`` has doc_id and text, ``items`` item_id and text. An item is found where its word edit distance to a run of
    the document's words is at most ``max_edits`` times its words; word_start is about where that run begins."""
    spark = docs.sparkSession
    bounded_batches(spark, BATCH_ROWS)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in item_blocks(items, max_edits, target_recall):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in batches:
                offsets, words = word_hashes(batch.column("text"))
                found = shared.value.matches(words, offsets)
                rows = batch.column("doc_id").take(pa.array([r for r, *_ in found], pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    rows, pa.array([shared.value.ids[i] for _, i, _, _ in found], pa.int64()), pa.array([s for _, _, s, _ in found], pa.int64()),
                    pa.array([d for *_, d in found], pa.int32()), pa.array([len(shared.value.words[i]) for _, i, _, _ in found], pa.int32())],
                    ["doc_id", "item_id", "word_start", "distance", "item_words"])

        part = docs.mapInArrow(run, LEAKS)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], LEAKS) if out is None else out


def decontaminate(docs: DataFrame, items: DataFrame, max_edits: float = 0.2, target_recall: float = 0.98) -> DataFrame:
    """``docs`` without the rows in which an item is found; all columns are kept."""
    spark = docs.sparkSession
    bounded_batches(spark, BATCH_ROWS)
    for block in item_blocks(items, max_edits, target_recall):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in batches:
                offsets, words = word_hashes(batch.column("text").cast(pa.string()))
                clean = np.ones(batch.num_rows, bool)
                clean[[r for r, *_ in shared.value.matches(words, offsets)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, T.StructType(docs.schema.fields))
    return docs
