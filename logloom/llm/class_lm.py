"""Operator 7: score texts with a Brown class-based bigram model.

``P(w_i | w_i-1) = P(class_i | class_i-1) * P(w_i | class_i)``. Exchange clustering gives every word of the training text
its class, the one that raises the likelihood of the class bigrams most, in two phases:

1. units are exchanged, all against one shared class matrix, half of them in turn, until a round moves almost none. A
   unit is one of the ``FREQUENT`` most frequent words, or all rarer words with one ending (hashed to ``ENDINGS`` types);
2. each rarer word leaves its unit for the class that it fits best by its own neighbours, counted over the whole text.

Only words that the training text lacks take the class of their ending. Both probabilities are smoothed: transitions by
adding 0.5, words by ``(c + 0.5) / (N_class + 0.5 * (V_class + 1))``, the last 1 for the class's unseen word. The end of a
text is a token and a class of its own, and also what precedes the first word.

Counts cover all training text. The rarer words with class and count are a distributed table; up to ``LOOKUP`` of
the most frequent words (a fixed 4 MB) are looked up in the tasks, and the distinct other words of a text are joined with that
table. Texts are tagged once, one byte a token; transitions are counted, and scores summed, over the tags. The first phase
keeps one row of neighbour counts per unit, whatever the corpus; a round reads these rows where they lie and returns one
class a unit. The second is one aggregation by word and classes of its neighbours.

Defined cases: null text is empty text, which is one end token; a null id is held out; repeated rows each count and each
get a row; without training text every score is that of the smoothing alone; words of equal counts rank by their hash,
and of classes that fit equally well a word keeps its own, else takes the first. ``score_held_out`` reads doc_id and text
alone, so other columns may have any name; ``score`` keeps other columns, whose names must differ from its own. Words are
compared as 64-bit hashes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.scratch import Scratch, bounded_batches
from logloom.llm.words import mix64, word_hashes

FREQUENT = 8192
ENDINGS = 4096
END = FREQUENT + ENDINGS  # the unit of the end token
CLASSES = 64  # and one more for the end; at most 255, as a tag is a byte
LOOKUP = 1 << 18
ROUNDS = 12
CELLS = "cell int, n double"
HELD = 1 << 21  # counts that a task holds before it passes them on


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _counted(found):
    """(key, count) arrays summed over a task, passed on when more than HELD distinct keys are held."""
    keys, counts, more = np.zeros(0, np.int64), np.zeros(0, np.int64), []
    size = 0
    for k in found:
        more.append(np.unique(k, return_counts=True))
        size += len(more[-1][0])
        if size > max(HELD, len(keys)):
            keys, counts = _summed(np.concatenate([keys, *(x for x, _ in more)]), np.concatenate([counts, *(n for _, n in more)]))
            more, size = [], 0
            if len(keys) > HELD:
                yield keys, counts
                keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, counts = _summed(np.concatenate([keys, *(x for x, _ in more)]), np.concatenate([counts, *(n for _, n in more)]))
    if len(keys):
        yield keys, counts


def _ending_unit(endings: np.ndarray) -> np.ndarray:
    return FREQUENT + (mix64(endings.astype(np.uint64)) % np.uint64(ENDINGS)).astype(np.int64)


def _word_counts(batches):
    """Rows (word, n)."""
    words = (word_hashes(batch.column("text"))[1].view(np.int64) for batch in batches)
    for keys, counts in _counted(words):
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["word", "n"])


class WordTable:
    """Position of a word among sorted hashes, by a table of low bits; -1 if absent."""

    SLOTS = 1 << 21

    def __init__(self, words: np.ndarray):
        self.words = words
        self.slots = np.full(self.SLOTS, -1, np.int32)
        low = words.view(np.uint64) & np.uint64(self.SLOTS - 1)
        self.slots[low.astype(np.int64)] = np.arange(len(words))
        self.shared = np.bincount(low.astype(np.int64), minlength=self.SLOTS) > 1

    def find(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(words), -1)
        low = (words.view(np.uint64) & np.uint64(self.SLOTS - 1)).astype(np.int64)
        at = self.slots[low]
        hit = (at >= 0) & (self.words[at] == words)
        out = np.where(hit, at, -1).astype(np.int64)
        again = np.flatnonzero(~hit & self.shared[low])
        at = np.minimum(np.searchsorted(self.words, words[again]), len(self.words) - 1)
        out[again] = np.where(self.words[at] == words[again], at, -1)
        return out


@dataclass
class Lookup:
    """The most frequent words: sorted hashes, counts, units. Unit ``END + 1 + k`` stands for a rarer word of class k."""

    words: np.ndarray
    counts: np.ndarray
    units: np.ndarray
    table: WordTable | None = None

    def of(self, hashes: np.ndarray, endings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the lookup or -1, unit) of each word."""
        if self.table is None:
            self.table = WordTable(self.words)
        at = self.table.find(hashes.view(np.int64))
        own = self.units[at] if len(self.units) else np.full(len(at), -1)
        return at, np.where(at >= 0, own, _ending_unit(endings))


def _lookup(words: np.ndarray, counts: np.ndarray, units: np.ndarray) -> Lookup:
    order = np.argsort(words, kind="stable")
    return Lookup(words[order], counts[order], units[order])


def _bigrams(lookup):
    """Rows (unit, other, n): other follows unit; every text begins after an end and ends with one."""
    def run(batches):
        def pairs():
            for batch in batches:
                offsets, hashes, last = word_hashes(batch.column("text"), suffixes=True)
                _, units = lookup.value.of(hashes, last)
                tokens = _with_ends(units, offsets)
                yield np.concatenate([[END], tokens[:-1]]) * (END + 1) + tokens
        for keys, counts in _counted(pairs()):
            yield pa.RecordBatch.from_arrays([pa.array(keys // (END + 1), pa.int32()), pa.array(keys % (END + 1), pa.int32()), pa.array(counts)], ["unit", "other", "n"])
    return run


def _with_ends(units: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The units of all texts, an end after each."""
    return np.insert(units, offsets[1:], END)


def _phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def best_classes(matrix: np.ndarray, own: np.ndarray, follows: np.ndarray, precedes: np.ndarray, itself: np.ndarray) -> np.ndarray:
    """The class that each unit (or word) of class ``own`` fits best, every one judged alone. Rows of ``follows`` and
    ``precedes`` count its neighbours by class without itself, ``itself`` how often it follows itself; ``matrix`` has the
    class bigrams with it in its own class. The last class is the end's and takes nothing."""
    rows = np.arange(len(own))

    def side(m: np.ndarray, given: np.ndarray, taken: np.ndarray) -> np.ndarray:
        """What the cells of one direction gain in each class, over the unit's own neighbours only."""
        of, j = np.nonzero(given)
        out = np.zeros(given.shape)
        if not len(of):
            return out
        n, at, mine = given[of, j], np.arange(len(of)), own[of]
        cells = m[:, j].T.copy()
        cells[at, mine] -= n
        same = np.flatnonzero(j == mine)
        cells[same] -= taken[of[same]]
        cells[same, mine[same]] -= itself[of[same]]
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        out[of[first]] = np.add.reduceat(_phi(cells + n[:, None]) - _phi(cells), first)
        return out

    gain = side(matrix, follows, precedes) + side(matrix.T, precedes, follows)
    alone, after, before = itself[:, None], follows.sum(1) + itself, precedes.sum(1) + itself
    corner = np.repeat(np.diag(matrix)[None, :], len(own), axis=0)
    corner[rows, own] -= follows[rows, own] + precedes[rows, own] + itself
    gain += _phi(corner + follows + precedes + alone) - _phi(corner + follows) - _phi(corner + precedes) + _phi(corner)
    for total, n in ((matrix.sum(1), after), (matrix.sum(0), before)):
        left = np.repeat(total[None, :], len(own), axis=0)
        left[rows, own] -= n
        gain -= _phi(left + n[:, None]) - _phi(left)
    best = np.argmax(gain[:, :-1], axis=1)
    return np.where(gain[rows, best] > gain[rows, own] + 1e-6, best, own)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """(row of each value, values) of a list column; a null is empty."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten()


def _neighbour_counts(batch: pa.RecordBatch, side: str, units: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts by class without the unit itself, count of itself) of each row's neighbours on one side."""
    many = len_classes(of)
    rows, others = _flat(batch.column(side))
    others, n = others.to_numpy().astype(np.int64), _flat(batch.column(f"n_{side}"))[1].to_numpy().astype(np.float64)
    apart = others != units[rows]
    counts = np.bincount(rows[apart] * many + of[others[apart]], n[apart], len(units) * many).reshape(len(units), many)
    return counts, np.bincount(rows[~apart], n[~apart], len(units))


def len_classes(classes: np.ndarray) -> int:
    return int(classes[END]) + 1


def exchange(neighbours: DataFrame, unit_counts: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(class of each unit, class bigram counts). ``neighbours`` has one row per unit: unit, after, n_after, before,
    n_before."""
    place = np.empty(END, np.int64)
    place[np.argsort(-unit_counts[:END], kind="stable")] = np.arange(END)
    of = np.append(place % classes, classes)

    def matrix_of(of: np.ndarray) -> np.ndarray:
        def cells(batches):
            m = np.zeros((classes + 1, classes + 1))
            for batch in batches:
                units = batch.column("unit").to_numpy().astype(np.int64)
                counts, itself = _neighbour_counts(batch, "after", units, of)
                counts[np.arange(len(units)), of[units]] += itself
                np.add.at(m, of[units], counts)
            yield _cells(m)
        return _matrix(neighbours.select("unit", "after", "n_after").mapInArrow(cells, CELLS), classes + 1)

    matrix = matrix_of(of)
    for turn in range(rounds):
        def moves(batches, of=of, matrix=matrix, turn=turn):
            for batch in batches:
                units = batch.column("unit").to_numpy().astype(np.int64)
                turns = (units != END) & ((mix64(units.astype(np.uint64)) + np.uint64(turn)) % np.uint64(2) == 0)
                batch, units = batch.filter(pa.array(turns)), units[turns]
                for at in range(0, len(units), 256):
                    part, u = batch.slice(at, 256), units[at : at + 256]
                    (follows, itself), (precedes, _) = (_neighbour_counts(part, side, u, of) for side in ("after", "before"))
                    new = best_classes(matrix, of[u], follows, precedes, itself)
                    moved = new != of[u]
                    yield pa.RecordBatch.from_arrays([pa.array(u[moved], pa.int32()), pa.array(new[moved], pa.int32())], ["unit", "to"])
        moved = neighbours.mapInArrow(moves, "unit int, to int").toPandas()  # at most one row a unit
        of = of.copy()
        of[moved["unit"].to_numpy(np.int64)] = moved["to"].to_numpy(np.int64)
        matrix = matrix_of(of)
        if len(moved) < 0.005 * END:
            break
    return of, matrix


def _cells(m: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(m)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(m.ravel()[at], pa.float64())], ["cell", "n"])


def _matrix(cells: DataFrame, many: int) -> np.ndarray:
    got = cells.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # at most many * many rows
    m = np.zeros(many * many)
    m[got["cell"].to_numpy(np.int64)] = got["n"].to_numpy(np.float64)
    return m.reshape(many, many)


def _rarer_words(shared, many: int):
    """Rows (word, ending, code) of every token that is no frequent word; the code is the classes before and after, or
    ``many`` for the word itself."""
    def run(batches):
        for batch in batches:
            lookup, classes = shared.value
            offsets, hashes, last = word_hashes(batch.column("text"), suffixes=True)
            at, units = lookup.of(hashes, last)
            path = classes[_with_ends(units, offsets)]
            place = np.arange(len(hashes)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))  # in path
            before, after = path[place - 1], path[place + 1]  # the last token, an end, precedes the first
            again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (place[1:] == place[:-1] + 1))
            after[again], before[again + 1] = many, many
            rare = np.flatnonzero(at < 0)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)[rare]), pa.array(units[rare], pa.int32()),
                                              pa.array((before * (many + 1) + after)[rare], pa.int32())], ["word", "ending", "code"])
    return run


def _assign(shared, matrix: np.ndarray):
    """Rows (word, class, n) of words with their counts by code."""
    many = len(matrix)

    def run(batches):
        for batch in batches:
            _, classes = shared.value
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                own = classes[part.column("ending").to_numpy()]
                rows, found = _flat(part.column("codes"))
                code, n = found.field("code").to_numpy().astype(np.int64), found.field("n").to_numpy().astype(np.float64)
                before, after = (np.bincount(rows * (many + 1) + c, n, len(own) * (many + 1)).reshape(len(own), many + 1) for c in (code // (many + 1), code % (many + 1)))
                to = best_classes(matrix, own, after[:, :-1], before[:, :-1], after[:, -1])
                yield pa.RecordBatch.from_arrays([part.column("word"), pa.array(to, pa.int32()), pa.array(before.sum(1).astype(np.int64))], ["word", "class", "n"])
    return run


@dataclass
class WordClasses:
    lookup: Lookup
    classes: np.ndarray  # of each unit
    class_mass: np.ndarray  # log10 (N_class + 0.5 (V_class + 1)); 0 for the end's class
    rarer: DataFrame  # word, class, n of all words but the frequent ones
    tokens: int
    types: int
    texts: int


@dataclass
class ClassModel(WordClasses):
    transitions: np.ndarray = None  # log10 P(class | class before)


def _frequent(words: DataFrame, most: int, whole: bool) -> DataFrame:
    """The words of the highest counts. Counts fall into 32 classes an octave; the class with the ``most``-th word is in
    unless ``whole`` asks for at most ``most`` words. So no task sends more than it holds of these."""
    octave = F.floor(F.log2("n") * 32).cast("int")
    sizes = words.groupBy(octave.alias("octave")).count().toPandas().sort_values("octave", ascending=False)
    before = sizes["count"].cumsum() - (0 if whole else sizes["count"])
    taken = sizes["octave"][before <= most if whole else before < most]
    return words.where(octave >= (int(taken.min()) if len(taken) else 1 << 30))


def learn_classes(texts: DataFrame, scratch: Scratch, frequent: int = FREQUENT, lookup: int = LOOKUP, classes: int = CLASSES) -> WordClasses:
    """The classes of all words of the column ``text``. The ``frequent`` (at most FREQUENT) most frequent words are units
    of their own; ``lookup`` words are held by every task. Neither leaves a word out."""
    spark = texts.sparkSession
    bounded_batches(spark)
    frequent = min(frequent, FREQUENT)
    counted = scratch.save(texts.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    top = _frequent(counted, frequent, whole=False).orderBy(F.desc("n"), "word").limit(frequent).toPandas()
    scratch.drop(counted)
    n_texts = texts.count()
    units = np.arange(len(top))
    named = _lookup(top["word"].to_numpy(np.int64), top["n"].to_numpy(np.int64), units)
    shared = spark.sparkContext.broadcast(named)
    pairs = scratch.save(texts.mapInArrow(_bigrams(shared), "unit int, other int, n long").groupBy("unit", "other").agg(F.sum("n").alias("n")), "bigrams")
    after = pairs.groupBy("unit").agg(F.collect_list(F.struct("other", "n")).alias("a"))
    before = pairs.groupBy(F.col("other").alias("unit")).agg(F.collect_list(F.struct(F.col("unit").alias("other"), "n")).alias("b"))
    neighbours = scratch.save(after.join(before, "unit", "full").select(
        "unit", F.col("a.other").alias("after"), F.col("a.n").alias("n_after"), F.col("b.other").alias("before"), F.col("b.n").alias("n_before")), "neighbours")
    sums = pairs.groupBy("unit").agg(F.sum("n").alias("n")).toPandas()
    unit_tokens = np.zeros(END + 1)
    unit_tokens[sums["unit"].to_numpy(np.int64)] = sums["n"].to_numpy(np.float64)
    of, matrix = exchange(neighbours, unit_tokens, classes)
    many = len(matrix)

    # Second phase: each rarer word by its own neighbours.
    placed = spark.sparkContext.broadcast((named, of))
    codes = texts.mapInArrow(_rarer_words(placed, many), "word long, ending int, code int").groupBy("word", "code").agg(F.min("ending").alias("ending"), F.count("*").alias("n"))
    words = codes.groupBy("word").agg(F.min("ending").alias("ending"), F.collect_list(F.struct("code", "n")).alias("codes"))
    rarer = scratch.save(words.mapInArrow(_assign(placed, matrix), "word long, class int, n long"), "words")
    scratch.drop(pairs, neighbours)
    by_class = rarer.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("types")).toPandas()
    tokens, types = (np.bincount(of[units], n, many).astype(np.float64) for n in (top["n"].to_numpy(np.float64), np.ones(len(top))))
    tokens[by_class["class"].to_numpy(np.int64)] += by_class["n"].to_numpy(np.float64)
    types[by_class["class"].to_numpy(np.int64)] += by_class["types"].to_numpy(np.float64)
    mass = np.log10(tokens + 0.5 * (types + 1))
    mass[-1] = 0.0
    more = _frequent(rarer, lookup - len(top), whole=True).toPandas()  # at most lookup rows
    held = _lookup(*(np.concatenate([a, b]).astype(np.int64) for a, b in ((top["word"], more["word"]), (top["n"], more["n"]), (units, END + 1 + more["class"]))))
    return WordClasses(held, np.append(of, np.arange(many)), mass, rarer, int(tokens.sum()) + n_texts, int(types.sum()) + (n_texts > 0), n_texts)


def _bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of a binary column without nulls."""
    _, offsets, data = col.cast(pa.large_binary()).buffers()
    offsets = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    return offsets - offsets[0], np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)


def tag(docs: DataFrame, words: WordClasses, scratch: Scratch) -> DataFrame:
    """``docs`` (text and any other columns) with n_tokens, n_known, log_counts (sum of log10(c + 0.5) over words) and
    path, the class of each token as a byte, instead of the text. Saved in ``scratch``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast((words.lookup, words.classes))
    others = [c for c in docs.columns if c != "text"]
    names = [*others, "n_tokens", "found", "log_counts", "path", "words", "times", "places"]

    def run(batches):
        for batch in batches:
            lookup, classes = shared.value
            offsets, hashes, last = word_hashes(batch.column("text"), suffixes=True)
            at, units = lookup.of(hashes, last)
            path = classes[_with_ends(units, offsets)].astype(np.uint8)
            logs = np.concatenate([[0.0], np.cumsum(np.where(at >= 0, np.log10(lookup.counts[at] + 0.5) if len(lookup.counts) else 0.0, 0.0))])
            seen = np.concatenate([[0], np.cumsum(at >= 0)])
            # The distinct words of each row that the lookup lacks, and their places in the row.
            rest = np.flatnonzero(at < 0)
            rows = np.searchsorted(offsets, rest, "right") - 1
            order = np.lexsort((hashes[rest], rows))
            rest, rows = rest[order], rows[order]
            first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (hashes[rest[1:]] != hashes[rest[:-1]])])) if len(rest) else np.zeros(0, np.int64)
            row_ends = np.arange(batch.num_rows + 1)
            by_word = pa.array(np.searchsorted(rows[first], row_ends), pa.int32())
            starts = offsets + np.arange(len(offsets))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in others), pa.array(np.diff(offsets) + 1, pa.int64()), pa.array(np.diff(seen[offsets]), pa.int64()), pa.array(np.diff(logs[offsets])),
                pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(path)]),
                pa.ListArray.from_arrays(by_word, pa.array(hashes.view(np.int64)[rest[first]])),
                pa.ListArray.from_arrays(by_word, pa.array(np.diff(np.append(first, len(rest))), pa.int32())),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, row_ends), pa.int32()), pa.array(rest - offsets[rows], pa.int32()))], names)

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != "text")
    parts = scratch.save(docs.mapInArrow(run, f"{kept}n_tokens long, found long, log_counts double, path binary, words array<long>, times array<int>, places array<int>")
                         .withColumn("_row", F.monotonically_increasing_id()), "parts")
    known = parts.select("_row", F.posexplode("words").alias("at", "word")).join(words.rarer, "word").groupBy("_row").agg(F.collect_list(F.struct("at", "class", "n")).alias("known"))

    def fill(batches):
        for batch in batches:
            offsets, path = _bytes(batch.column("path"))
            path = path.copy()
            sizes = batch.column("words").value_lengths().to_numpy()
            begin = np.cumsum(sizes) - sizes
            rows, known = _flat(batch.column("known"))
            at = begin[rows] + known.field("at").to_numpy()
            counts, to = np.zeros(sizes.sum()), np.full(sizes.sum(), -1)
            counts[at], to[at] = known.field("n").to_numpy(), known.field("class").to_numpy()
            row_of_word = np.repeat(np.arange(len(sizes)), sizes)
            times = batch.column("times").flatten().to_numpy()
            word = np.repeat(np.arange(len(times)), times)
            place = offsets[row_of_word[word]] + batch.column("places").flatten().to_numpy()
            path[place[to[word] >= 0]] = to[word][to[word] >= 0]
            more = np.bincount(row_of_word, times * (counts > 0), len(sizes)).astype(np.int64)
            logs = np.bincount(row_of_word, times * np.log10(counts + 0.5), len(sizes))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in others), batch.column("n_tokens"), pa.array(batch.column("found").to_numpy() + more + int(words_seen)), pa.array(batch.column("log_counts").to_numpy() + logs),
                pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(path)])], [*others, "n_tokens", "n_known", "log_counts", "path"])

    words_seen = words.texts > 0
    return scratch.save(parts.join(known, "_row", "left").mapInArrow(fill, f"{kept}n_tokens long, n_known long, log_counts double, path binary"), "tagged")


def count_transitions(tagged: DataFrame, words: WordClasses) -> ClassModel:
    """The model with the class bigrams of the training texts' tags."""
    many = len(words.class_mass)

    def cells(batches):
        m = np.zeros(many * many)
        for batch in batches:
            _, path = _bytes(batch.column("path"))
            path = path.astype(np.int64)
            m += np.bincount(np.append(many - 1, path[:-1]) * many + path, minlength=many * many) if len(path) else 0
        yield _cells(m)

    matrix = _matrix(tagged.select("path").mapInArrow(cells, CELLS), many)
    return ClassModel(**vars(words), transitions=np.log10((matrix + 0.5) / (matrix.sum(1, keepdims=True) + 0.5 * many)))


def train(texts: DataFrame, scratch: Scratch, frequent: int = FREQUENT, lookup: int = LOOKUP, classes: int = CLASSES) -> ClassModel:
    """The model of the whole column ``text``."""
    words = learn_classes(texts, scratch, frequent, lookup, classes)
    return count_transitions(tag(texts.select("text"), words, scratch), words)


def score(docs: DataFrame, model: ClassModel, scratch: Scratch) -> DataFrame:
    """``docs`` (text and any other columns) with n_tokens, n_known, train_tokens, base_score and score."""
    return _scores(tag(docs, model, scratch), model)


def _scores(tagged: DataFrame, model: ClassModel) -> DataFrame:
    transitions, mass = model.transitions, model.class_mass
    others = [c for c in tagged.columns if c not in ("n_tokens", "n_known", "log_counts", "path")]
    own = ["n_tokens", "n_known", "log_counts"]

    def run(batches):
        for batch in batches:
            offsets, path = _bytes(batch.column("path"))
            steps = transitions[np.append(len(mass) - 1, path[:-1]), path] - mass[path]
            sums = np.add.reduceat(steps, offsets[:-1]) if len(path) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in [*others, *own]), pa.array(sums)], [*others, *own, "log_path"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in tagged.schema if f.name != "path")
    end_logs, total = (float(np.log10(x)) for x in (model.texts + 0.5, model.tokens + 0.5 * (model.types + 1)))
    return tagged.mapInArrow(run, f"{kept}log_path double").select(
        *(F.col(f"`{c}`") for c in others), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + end_logs - F.col("n_tokens") * total).alias("base_score"), (F.col("log_counts") + F.col("log_path")).alias("score"))


def score_held_out(docs: DataFrame) -> DataFrame:
    """Scores of every document by the model of those whose crc32 of the id modulo 5 is not 1: doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score."""
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(True))
    scratch = Scratch(docs.sparkSession, "class-lm")
    docs = docs.select("doc_id", out.alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = learn_classes(docs.where(~F.col("held_out")).select("text"), scratch)
    tagged = tag(docs, words, scratch)
    return _scores(tagged, count_transitions(tagged.where(~F.col("held_out")), words))
