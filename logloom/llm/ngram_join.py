"""Operator 6: exact Jaccard join of documents on word n-grams, as a blocked sparse matrix product.

The document by n-gram incidence matrix is multiplied with its transpose one column (n-gram) at a time, and the
products of a pair are summed. Only the columns that a pair at the threshold must share are multiplied: a set of
n distinct n-grams keeps its first ``n - ceil(t*n) + 1`` columns in one global column order. Columns are ordered
by hash, with the most frequent of these columns moved to the end, so passages that many documents share stay out
of the product. A pair goes on when its summed overlap can still reach the size-derived bound
``t/(1+t) * (n_a + n_b)``; the pairs that go on are checked on whole sets.

Work per column is bounded, and only rows that nothing joins yet are multiplied. Equal sets are one row of the matrix.
First every row is checked against one pivot, the first row of one of its columns; what these links join is one
component, and from then on only rows of different components meet.

- Columns of at most ``block`` rows are multiplied in full.
- Longer columns (large groups of near copies) are multiplied after a change of basis. The rows of one pivot are a group;
  its consensus M holds the columns that more than half of the group's rows have (as far as tasks count them: one that
  fewer than 9/16 have may be left out, which costs work and no link), and a row becomes its difference
  ``D_x = x ^ M``, of size d_x. As ``x ^ y = D_x ^ D_y``, sizes alone decide most pairs: where d_x + d_y is within the
  allowance ``T = (1-t)/(1+t) * (n_x + n_y)`` a pair is linked for sure, and all those rows are linked with the row
  nearest to M. Any other link needs ``(d_x + d_y - T) / 2`` changes in common. In an order of the changes by frequency
  in the group the first common one stands early in both rows, so only rows meet that share a rare change, and not
  those that share what many rows have. The pairs that meet are decided on their differences alone.
- Rows whose rare changes are still crowded (a family of its own within the group) form groups around the most frequent
  of these changes first, with a consensus of their own, until that joins nothing more.
- Rows of different pivots that share a long column are compared directly.

So no link between components is lost, and no group is expanded into all its pairs.

Defined cases: null or empty text, and text of white space only, gives an empty set (n_shingles 0), linked with
nothing; repeated rows are copies; a null id is a document of its own row whose component is null; an id names one
text. Extra columns are ignored. The order of columns never changes the result, only the work. N-grams are compared as
64-bit hashes."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.components import components
from logloom.llm.scratch import Scratch, bounded_batches
from logloom.llm.words import mix64, shingle_hashes, word_hashes

FREQUENT_ROWS = 24  # rows that make a column frequent: it goes to the end of the order
FREQUENT_COLUMNS = 1 << 16  # columns moved to the end: 512 kB in each task, whatever the input
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20  # of an Arrow batch: two whole sets a row while pairs are checked
LATE_SHARE = 16  # changes of more than this part of a group's rows go to the end of the group's order
COUNTED_CELLS = 1 << 20  # changes that a task counts at once
GROUP_PARTS = 16  # parts that a group's rows are dealt in where they meet what is known of the group
ID_FILTER_BITS = 1 << 20  # fixed-size filter of the ids whose whole sets are needed
COLUMN_FILTER_BITS = 1 << 23  # fixed-size filter of the columns that may have a second row


def _sets(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes (as signed 64-bit) of each row."""
    offsets, hashes = shingle_hashes(*word_hashes(batch.column("text")), width)
    hashes = hashes.view(np.int64)
    return [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _prefix_length(n: int, num: int, den: int) -> int:
    return n + (-num * n // den) + 1 if n else 0


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.zeros(0), kind))


def _describe(width: int, num: int, den: int):
    """Size, 128-bit set key and first columns in plain hash order."""
    def run(batches):
        for batch in batches:
            sets = _sets(batch, width)
            sums = [(int(mix64(s.view(np.uint64)).sum()), int(np.bitwise_xor.reduce(mix64(~s.view(np.uint64))))) if len(s) else (0, 0) for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(np.array([x for x, _ in sums], np.uint64).view(np.int64), pa.int64()),
                pa.array(np.array([x for _, x in sums], np.uint64).view(np.int64), pa.int64()),
                _lists([s[: _prefix_length(len(s), num, den)] for s in sets], pa.int64())],
                ["doc_id", "n", "k1", "k2", "first"])
    return run


def _reorder(width: int, num: int, den: int, frequent: np.ndarray):
    """First columns of the rows that hold a frequent column among their plain first columns."""
    def run(batches):
        for batch in batches:
            ids, out = [], []
            for i, s in enumerate(_sets(batch, width)):
                k = _prefix_length(len(s), num, den)
                if not k or not len(frequent):
                    continue
                late = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
                if late[:k].any():
                    ids.append(i)
                    out.append(np.concatenate([s[~late], s[late]])[:k])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(ids, pa.int64())), _lists(out, pa.int64())],
                                             ["doc_id", "reordered"])
    return run




def _pairs(num: int, den: int):
    """All pairs of a short column whose components differ and whose sizes and positions allow the threshold."""
    def run(batches):
        for batch in batches:
            offsets = batch.column("rows").offsets.to_numpy()
            flat = batch.column("rows").flatten()
            ids, sizes, places, comps = (flat.field(k).to_numpy() for k in ("id", "n", "pos", "comp"))
            out = [[], [], [], []]
            counts = np.diff(offsets)
            for m in np.unique(counts):
                at = offsets[:-1][counts == m]
                left, right = np.triu_indices(m, 1)
                step = max(1, 500_000 // max(1, len(left)))
                for k in range(0, len(at), step):
                    x, y = (at[k : k + step, None] + left).ravel(), (at[k : k + step, None] + right).ravel()
                    na, nb, pa_, pb = sizes[x], sizes[y], places[x], places[y]
                    most = np.minimum(pa_, pb) + np.minimum(na - pa_, nb - pb)
                    ok = (comps[x] != comps[y]) & ((num + den) * most >= num * (na + nb)) & (den * np.minimum(na, nb) >= num * np.maximum(na, nb))
                    a, b = ids[x[ok]], ids[y[ok]]
                    swap = a > b
                    for o, v in zip(out, (np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb[ok], na[ok]), np.where(swap, na[ok], nb[ok])), strict=True):
                        o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o) if o else np.zeros(0), pa.int64()) for o in out], ["a", "b", "na", "nb"])
    return run


def _id_slot(ids: np.ndarray) -> np.ndarray:
    return (mix64(ids.astype(np.int64).view(np.uint64)) % np.uint64(ID_FILTER_BITS)).astype(np.int64)


def _column_filter(columns: DataFrame) -> np.ndarray:
    """Bits of the values h: true for each of them, and for few others while there is room."""
    def slots(batches):
        for batch in batches:
            at = np.unique(_column_slot(batch.column("h").to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(at // 64), pa.array(np.int64(1) << (at % 64))], ["word", "bit"])

    words = columns.mapInArrow(slots, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(COLUMN_FILTER_BITS // 64, np.int64)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return np.unpackbits(bits.view(np.uint8), bitorder="little").view(bool)


def _column_slot(h: np.ndarray) -> np.ndarray:
    return (mix64(h.astype(np.int64).view(np.uint64)) % np.uint64(COLUMN_FILTER_BITS)).astype(np.int64)


def _cells(shared):
    """A row (h, id, n, pos) for each first column that may have a second row."""
    def run(batches):
        for batch in batches:
            lists = batch.column("first")
            offsets, h = lists.offsets.to_numpy(), lists.flatten().to_numpy()
            sizes = np.diff(offsets)
            pos = np.arange(len(h)) - np.repeat(offsets[:-1] - offsets[0], sizes)
            keep = shared.value[_column_slot(h)]
            row = np.repeat(np.arange(batch.num_rows), sizes)[keep]
            ids, n = batch.column("doc_id").to_numpy(), batch.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(h[keep]), pa.array(ids[row]), pa.array(n[row]), pa.array(pos[keep].astype(np.int64))], ["h", "id", "n", "pos"])
    return run


def _whole_sets(width: int, wanted: np.ndarray):
    def run(batches):
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            ids = batch.column("doc_id").to_numpy()
            batch = batch.filter(pa.array(wanted[_id_slot(ids)]))
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s.tobytes() for s in _sets(batch, width)], pa.binary())], ["id", "cells"])
    return run


CHECKED = "a long, b long, linked boolean, na long, nb long, difference array<long>"


def _check(num: int, den: int):
    """Whether each pair reaches the threshold, its sizes and, where ``basis``, the difference of its sets."""
    def run(batches):
        for batch in batches:
            linked, sizes, differences = [], [], []
            for x, y, basis in zip(batch.column("cells_a"), batch.column("cells_b"), batch.column("basis").to_pylist(), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                twice = both[1:] == both[:-1]
                shared = int(twice.sum())
                linked.append(den * shared >= num * (len(x) + len(y) - shared))
                sizes.append((len(x), len(y)))
                once = np.ones(len(both), bool)
                once[1:] &= ~twice
                once[:-1] &= ~twice
                differences.append(both[once] if basis else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_()), pa.array([m for m, _ in sizes], pa.int64()),
                                              pa.array([n for _, n in sizes], pa.int64()), _lists(differences, pa.int64())], ["a", "b", "linked", "na", "nb", "difference"])
    return run


def _checked(docs: DataFrame, pairs: DataFrame, width: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """CHECKED of the pairs (a, b, basis) on their whole sets, saved."""
    pairs = scratch.save(pairs, "pairs")
    slot = F.pandas_udf(lambda s: pd.Series(_id_slot(s.to_numpy())), "long")
    wanted = np.zeros(ID_FILTER_BITS, bool)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    slots = ids.select(slot("id").alias("s")).distinct().toPandas()
    wanted[slots["s"].to_numpy().astype(np.int64)] = True  # at most ID_FILTER_BITS slots
    sets = scratch.save(docs.mapInArrow(_whole_sets(width, wanted), "id long, cells binary").join(ids, "id", "left_semi").dropDuplicates(["id"]), "sets")
    ends = lambda x: sets.select(F.col("id").alias(x), F.col("cells").alias(f"cells_{x}"))
    out = scratch.save(pairs.join(ends("a"), "a").join(ends("b"), "b").select("a", "b", "basis", "cells_a", "cells_b").mapInArrow(_check(num, den), CHECKED), "checked")
    scratch.drop(sets, pairs)
    return out


def _local_often(keys: list[str], share: int):
    """(keys, some, counts): of each COUNTED_CELLS changes in this task, those that more than 1 / share of a group's rows
    there hold, with their counts. So the counts of a change add up to at most 1 / share of the group's rows too few."""
    def counted(groups: dict[tuple, list[np.ndarray]]) -> pa.RecordBatch:
        names, some, counts = [], [], []
        for key, rows in groups.items():
            cells, n = np.unique(np.concatenate(rows), return_counts=True)
            if (often := share * n > len(rows)).any():
                names.append(key)
                some.append(cells[often])
                counts.append(n[often])
        columns = [pa.array([n[k] for n in names], pa.int64()) for k in range(len(keys))]
        return pa.RecordBatch.from_arrays([*columns, _lists(some, pa.int64()), _lists(counts, pa.int64())], [*keys, "some", "counts"])

    def run(batches):
        groups: dict[tuple, list[np.ndarray]] = {}
        held = 0
        for batch in batches:
            lists = batch.column("diff")
            offsets, cells = lists.offsets.to_numpy(), lists.values.to_numpy()
            for key, lo, hi in zip(zip(*(batch.column(k).to_pylist() for k in keys), strict=True), offsets[:-1], offsets[1:], strict=True):
                groups.setdefault(key, []).append(cells[lo:hi])
            held += int(offsets[-1] - offsets[0])
            if held >= COUNTED_CELLS:
                yield counted(groups)
                groups, held = {}, 0
        yield counted(groups)
    return run


def _often(rows: DataFrame, keys: list[str], share: int, count: str) -> DataFrame:
    """(keys, h, count): the changes that more than 1 / share of a group's rows hold, and others, counted by the tasks
    that read them: the rows are neither expanded nor shuffled."""
    kinds = ", ".join(f"{k} long" for k in keys)
    often = rows.select(*keys, "diff").mapInArrow(_local_often(keys, share), f"{kinds}, some array<long>, counts array<long>")
    often = often.select(*keys, F.explode(F.arrays_zip("some", "counts")).alias("x"))
    return often.groupBy(*keys, F.col("x.some").alias("h")).agg(F.sum("x.counts").alias(count))


def _of_group(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` (keys, id, ...) with the row of their group; the rows of a large group are dealt in GROUP_PARTS parts."""
    parts = groups.select("*", F.explode(F.array(*(F.lit(k) for k in range(GROUP_PARTS)))).alias("part"))
    return rows.withColumn("part", F.pmod(F.hash("id"), F.lit(GROUP_PARTS))).join(parts, [*keys, "part"], how).drop("part")


def _rebased(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (keys, id, n, diff) with each difference taken from the consensus of its group instead: what more than
    half of the group's differences are counted to hold is flipped in all of them."""
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("size"))
    often = _often(rows, keys, LATE_SHARE, "c")
    most = often.join(sizes, keys).where(2 * F.col("c") > F.col("size")).groupBy(*keys).agg(F.collect_list("h").alias("most"))
    flipped = F.concat(F.array_except("diff", "most"), F.array_except("most", "diff"))
    return _of_group(rows, most, keys, "left").select(*keys, "id", "n", F.when(F.col("most").isNull(), F.col("diff")).otherwise(flipped).alias("diff"))


def _excess(num: int, den: int):
    """num + den times what a row's changes are above its own half of the allowance."""
    return (num + den) * F.size("diff") - (den - num) * F.col("n")


def _sure_links(rows: DataFrame, keys: list[str], num: int, den: int) -> DataFrame:
    """(a, b): every row that sizes alone link with its group's nearest row to the consensus."""
    rows = rows.select(*keys, "id", _excess(num, den).alias("e"))
    least = rows.groupBy(*keys).agg(F.min(F.struct("e", "id")).alias("least"))
    sure = _of_group(rows, least, keys).where((F.col("e") + F.col("least.e") <= 0) & (F.col("id") != F.col("least.id")))
    return sure.select(F.col("least.id").alias("a"), F.col("id").alias("b"))


def _placed(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(pivot, id, n, d, early): the changes of each row that may be the first common one of a link, by their places.

    The order of a group's changes is by hash, those that more than 1 / LATE_SHARE of its rows have at the end by
    their counts. A row that sizes link with the nearest one (excess e, least excess of the group e0) can only have
    further links with rows of an excess above -e0, so its first common change stands early; any other row has it
    within its allowance."""
    group = rows.groupBy("pivot").agg(F.count("*").alias("size"), F.min(_excess(num, den)).alias("e0"))
    late = _often(rows, ["pivot"], LATE_SHARE, "f").join(group, "pivot").where(LATE_SHARE * F.col("f") > F.col("size"))
    late = late.groupBy("pivot").agg(F.array_sort(F.collect_list(F.struct("f", "h"))).alias("late")).select("pivot", F.col("late.h").alias("late"))
    group = group.join(late, "pivot", "left").withColumn("late", F.coalesce("late", F.array().cast("array<long>")))
    own = _of_group(rows, group, ["pivot"]).withColumn("e", _excess(num, den))
    ordered = F.concat(F.array_sort(F.array_except("diff", "late")), F.array_intersect("late", "diff"))
    near = F.floor(((num + den) * F.size("diff") + (den - num) * F.col("n") + F.col("e0")) / (2 * (num + den)))
    last = F.when(F.col("e") + F.col("e0") <= 0, near).otherwise(F.floor(F.col("n") * (den - num) / num))
    early = F.slice(ordered, 1, F.greatest(F.lit(0), last + 1).cast("int"))
    return own.select("pivot", "id", "n", F.size("diff").alias("d"), early.alias("early"))


def _early_cells(placed: DataFrame, comps: DataFrame) -> DataFrame:
    """(pivot, id, n, d, comp, j, h): one row for each early change, with the component of its row."""
    own = placed.join(comps.select(F.col("node").alias("id"), "component"), "id", "left")
    return own.select("pivot", "id", "n", "d", F.coalesce("component", "id").alias("comp"), F.posexplode("early").alias("j", "h"))


def _in_pivot_groups(cells: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs (pivot, a, b) of one group whose components differ, by a change that may be their first common
    one. The row with fewer changes has it within half of its allowance, the other one within its whole allowance."""
    crossing = cells.groupBy("pivot", "h").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("pivot", "h")
    cells = cells.join(crossing, ["pivot", "h"], "left_semi")
    half, whole = (F.col("j") * k * num <= F.col("n") * (den - num) for k in (2, 1))
    x = cells.where(half).select("pivot", "h", *(F.col(c).alias(f"{c}_x") for c in ("id", "n", "d", "j", "comp")))
    y = cells.where(whole).select("pivot", "h", *(F.col(c).alias(f"{c}_y") for c in ("id", "n", "d", "j", "comp")))
    need = (num + den) * (F.col("d_x") + F.col("d_y")) - (den - num) * (F.col("n_x") + F.col("n_y"))  # twice the common changes, times num + den
    left = F.least(F.col("d_x") - F.col("j_x"), F.col("d_y") - F.col("j_y"))
    smaller = (F.col("d_x") < F.col("d_y")) | ((F.col("d_x") == F.col("d_y")) & (F.col("id_x") < F.col("id_y")))
    met = x.join(y, ["pivot", "h"]).where(smaller & (F.col("comp_x") != F.col("comp_y")) & (2 * (num + den) * left >= need))
    return met.select("pivot", F.col("id_x").alias("a"), F.col("id_y").alias("b")).distinct()


def _linked_in_groups(pairs: DataFrame, rows: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of (pivot, a, b) that reach the threshold, from the rows' differences."""
    side = lambda c: rows.select("pivot", F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("diff").alias(f"diff_{c}"))
    both = pairs.join(side("a"), ["pivot", "a"]).join(side("b"), ["pivot", "b"])
    apart = F.size("diff_a") + F.size("diff_b") - 2 * F.size(F.array_intersect("diff_a", "diff_b"))
    return both.where((num + den) * apart <= (den - num) * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _settled(rows: DataFrame, placed: DataFrame, links: DataFrame, block: int, num: int, den: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links, components, early cells) after the families within the groups are joined: rows of different components that crowd
    (over ``block``) on a rare change form a group around the most frequent one, as long as that joins components."""
    comps = components(links, scratch)
    while True:
        cells = scratch.save(_early_cells(placed, comps), "early")
        early = cells.where(F.col("j") * 2 * num <= F.col("n") * (den - num))
        crowded = early.groupBy("pivot", "h").agg(F.count("*").alias("c"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
        crowded = crowded.where((F.col("c") > block) & (F.col("c0") != F.col("c1"))).select("pivot", "h", "c")
        family = early.select("pivot", "h", "id").join(crowded, ["pivot", "h"]).groupBy("pivot", "id").agg(F.max_by("h", F.struct("c", "h")).alias("family"))
        family = scratch.save(family, "families")
        if family.isEmpty():
            return links, comps, cells
        own = _rebased(scratch.save(rows.join(family, ["pivot", "id"]), "family-rows"), ["pivot", "family"])
        sure = _sure_links(own, ["pivot", "family"], num, den)
        of = lambda c: comps.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}"))
        new = sure.join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")
        new = scratch.save(new, "new-links")
        if new.isEmpty():
            return links, comps, cells
        scratch.drop(cells)
        links = scratch.save(links.unionByName(new), "links")
        comps = components(links, scratch)


def _between_pivot_groups(cells: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs (a, b) that share a long column and differ in pivot and component."""
    groups = cells.groupBy("h", "pivot").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    crossing = groups.alias("x").join(groups.alias("y"), "h").where("x.pivot < y.pivot and not (x.c0 = y.c0 and x.c1 = y.c1 and x.c0 = x.c1)")
    crossing = crossing.select("h", F.col("x.pivot").alias("ga"), F.col("y.pivot").alias("gb"))
    side = lambda x: cells.select("h", F.col("pivot").alias(f"g{x}"), *(F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "pos", "comp")))
    most = F.least("pos_a", "pos_b") + F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    fits = ((num + den) * most >= num * (F.col("n_a") + F.col("n_b"))) & (den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b"))
    met = crossing.join(side("a"), ["h", "ga"]).join(side("b"), ["h", "gb"]).where(fits & (F.col("comp_a") != F.col("comp_b")))
    return met.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def ngram_jaccard_join(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100, block: int = 128) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links).

    ``docs`` has doc_id (long) and text. Two documents link when ``den * intersection >= num * union`` of their
    distinct word n-grams of ``width`` words. ``block`` bounds the rows of a column that is multiplied in full."""
    spark = docs.sparkSession
    bounded_batches(spark, BATCH_ROWS, BATCH_BYTES)
    scratch = Scratch(spark, "ngram-join")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wide = scratch.save(docs.mapInArrow(_describe(width, num, den), "doc_id long, n long, k1 long, k2 long, first array<long>"), "wide")

    # Equal sets are one row of the matrix: its smallest id.
    classes = scratch.save(wide.where("n > 0 and doc_id is not null").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep")), "classes")
    reps = wide.select("doc_id", "n", "first").join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    reps = scratch.save(reps, "reps")
    described = scratch.save(wide.select("doc_id", "n", "k1", "k2"), "described")
    scratch.drop(wide)

    # Frequent columns go to the end of the order.
    often = scratch.save(reps.select(F.explode("first").alias("h")).groupBy("h").count().where("count > 1"), "often")
    frequent = often.where(F.col("count") > min(FREQUENT_ROWS, block // 2)).orderBy(F.desc("count"), "h").limit(FREQUENT_COLUMNS).select("h").toPandas()["h"].to_numpy().astype(np.int64)
    frequent.sort()
    first, shared_columns = reps, often.select("h")
    if len(frequent):
        moved = docs.where("doc_id is not null").mapInArrow(_reorder(width, num, den, frequent), "doc_id long, reordered array<long>")
        moved = scratch.save(moved.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "moved")
        shared_columns = shared_columns.unionByName(moved.select(F.explode("reordered").alias("h")))
        first = reps.join(moved, "doc_id", "left").select("doc_id", "n", F.coalesce("reordered", "first").alias("first"))
    cells = scratch.save(first.mapInArrow(_cells(spark.sparkContext.broadcast(_column_filter(shared_columns))), "h long, id long, n long, pos long"), "cells")
    scratch.drop(reps, often)
    columns = scratch.save(cells.groupBy("h").agg(F.count("*").alias("rows"), F.min(F.struct("id", F.col("n").alias("na"))).alias("least")).where("rows > 1")
                           .select("h", "rows", F.col("least.id").alias("a"), "least.na"), "columns")
    met = scratch.save(cells.join(columns, "h"), "met")
    scratch.drop(cells, columns)

    # One pivot for each row: in short columns the first row that it meets most often, in long ones the first row that
    # most rows meet.
    short, long = met.where(F.col("rows") <= block), met.where(F.col("rows") > block)
    near = short.where("id <> a").groupBy("a", F.col("id").alias("b")).agg(F.count("*").alias("c"), F.max("na").alias("na"), F.max("n").alias("nb"))
    near = near.where(_reaches("c", "na", "nb", num, den) & (den * F.least("na", "nb") >= num * F.greatest("na", "nb")))
    near = near.groupBy("b").agg(F.max_by("a", F.struct("c", -F.col("a"))).alias("a")).select("a", "b", F.lit(False).alias("basis"))
    star = long.where("id <> a").groupBy("a", F.col("id").alias("b")).agg(F.count("*").alias("c"))
    star = star.join(star.groupBy("a").agg(F.count("*").alias("met")), "a")
    star = star.groupBy("b").agg(F.max_by("a", F.struct("met", "c", -F.col("a"))).alias("a")).select("a", "b", F.lit(True).alias("basis"))
    checked = _checked(docs, near.unionByName(star).groupBy("a", "b").agg(F.bool_or("basis").alias("basis")), width, num, den, scratch)
    starred = checked.where(F.size("difference") > 0)
    rows = starred.select(F.col("a").alias("pivot"), F.col("b").alias("id"), F.col("nb").alias("n"), F.col("difference").alias("diff"))
    heads = starred.groupBy(F.col("a").alias("pivot")).agg(F.max("na").alias("n"))
    rows = rows.unionByName(heads.select("pivot", F.col("pivot").alias("id"), "n", F.array().cast("array<long>").alias("diff")))
    starred = scratch.save(rows, "starred")
    rows = scratch.save(_rebased(starred, ["pivot"]).repartition("id"), "groups")  # a large group in many tasks
    scratch.drop(starred)
    pivots = rows.where("id <> pivot").select("id", "pivot")
    links = checked.where("linked").select("a", "b").unionByName(_sure_links(rows, ["pivot"], num, den))
    links = scratch.save(links, "links")
    scratch.drop(checked)
    placed = scratch.save(_placed(rows, num, den), "placed")
    links, joined, early = _settled(rows, placed, links, block, num, den, scratch)

    # Short columns: every pair of different components, products summed, then the size-derived bound. A pair that
    # also shares a long column may be short of products here; it is looked at below.
    known = joined.select(F.col("node").alias("id"), "component").join(pivots, "id", "full")
    labelled = met.join(known, "id", "left").select("h", "id", "n", "pos", "rows", F.coalesce("component", "id").alias("comp"), F.coalesce("pivot", "id").alias("pivot"))
    labelled = scratch.save(labelled, "labelled")
    lists = labelled.where(F.col("rows") <= block).groupBy("h").agg(
        F.collect_list(F.struct("id", "n", "pos", "comp")).alias("rows"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1")
    products = lists.select("rows").mapInArrow(_pairs(num, den), "a long, b long, na long, nb long")
    summed = products.groupBy("a", "b").agg(F.count("*").alias("c"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    pairs = summed.where(_reaches("c", "na", "nb", num, den)).select("a", "b")

    # Long columns: rows of one pivot by their differences from the consensus, rows of different pivots directly.
    within = _linked_in_groups(_in_pivot_groups(early, num, den), rows, num, den)
    links = scratch.save(links.unionByName(within), "links")
    pairs = pairs.unionByName(_between_pivot_groups(labelled.where(F.col("rows") > block), num, den)).distinct()
    more = _checked(docs, pairs.withColumn("basis", F.lit(False)), width, num, den, scratch)
    final = scratch.save(components(links.unionByName(more.where("linked").select("a", "b")), scratch), "final")
    scratch.drop(met, labelled, more, rows, placed, early)

    labels = classes.join(final, classes["rep"] == final["node"], "left").select("k1", "k2", "n", F.coalesce("component", "rep").alias("component_id"))
    return described.select("doc_id", "n", "k1", "k2").join(labels, ["k1", "k2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _reaches(c: str, na: str, nb: str, num: int, den: int):
    """Whether c products among first columns leave the bound in reach. Of two rows, the one whose first columns
    end first has all shared columns up to there among the products, and shares at most what it has left, which is
    ceil(t * n) - 1 columns."""
    left = F.greatest(*(F.expr(f"({num} * {n} + {den - 1}) div {den} - 1") for n in (na, nb)))
    return (num + den) * (F.col(c) + left) >= num * (F.col(na) + F.col(nb))
