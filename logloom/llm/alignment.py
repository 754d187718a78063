"""Operator 11: alignment of two tokenizers' tokens over a corpus, in Arrow tables merged by Spark.

A is a byte-level BPE file (``tokenizers``) on space + text, B a sentence-piece model on the text, which adds that space.
Tokens cover bytes; byte offsets where a token of A and one of B both end cut a document into groups, and every A-B pair
of overlapping tokens is a link.

In a task, for documents of about ``JOINED_BYTES`` at a time:

* the token lists are flattened with the parent index of each token; a segmented cumulative sum of token lengths gives
  byte ends, and (document, end) one integer key;
* a full outer Acero hash join of both sides on that key, sorted by it, has one row for each interval between ends; rows
  with both sides are group ends, and filling each side from its next end names the two tokens that overlap there;
* ``Table.group_by`` counts links by (document, pair), and the block's documents by pair.

Spark sums these partial counts by pair, finds the highest count of each A id, and brings count and mark back to the
blocks by hash buckets of the pairs (see blocks.py): a pair is one entry a block, so no pair or id is hot.

Both tokenizers are applied once to each distinct word of a block: texts are cut before a space that follows a letter,
digit or ASCII sign. No token of A spans such a place (its pattern ends there), nor of B (``check_pieces`` holds the model
to it), so the ids equal those of the whole text.

Defined cases: null and empty texts, and texts whose joined bytes of A or B differ from space + text, have no tokens:
zeros, and an empty digest. A null doc_id stays null, a repeated row is a document of its own, other columns are ignored,
an empty table gives an empty table. Texts are read whole."""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.blocks import BLOCK_BYTES, ROWS, STREAM, join_blocks, keys_by_bucket, new_block, row_batch, save_blocks
from logloom.llm.packing import pack_ints, unpack_ints
from logloom.llm.scratch import Scratch, bounded_batches
from logloom.llm.words import mix64

JOINED_BYTES = 1 << 20
WORDS_AT_ONCE = 1 << 13
BUCKETS_A_PARTITION = 4
MAX_MODEL_BYTES = 64 << 20
LINKED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"
_SPACE = "▁"
_SEPARATORS = (",", "|", ";")  # before an id: of the same side, the first of B, the first of A in a group
_SIGNS = frozenset("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def read_models(a_path: str, b_path: str) -> tuple[str, bytes]:
    """The two vocabulary files, to be shipped to the tasks; their size is checked."""
    with open(a_path, encoding="utf-8") as f:
        a = f.read()
    with open(b_path, "rb") as f:
        b = f.read()
    if len(a) + len(b) > MAX_MODEL_BYTES:
        raise ValueError("the tokenizers are over the size that is shipped to tasks")
    return a, b


def _byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: printable bytes stand for themselves, the others follow
    from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def check_pieces(pieces: list[str]) -> None:
    """Raise if a piece has a space after something else: words could then not be encoded one by one."""
    if any(_SPACE in p.lstrip(_SPACE) for p in pieces):
        raise ValueError("a piece spans words")


class Pair:
    """Both tokenizers of one task."""

    def __init__(self, models: tuple[str, bytes]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # task slots are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(models[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=models[1])
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        added = {t["id"] for t in json.loads(models[0])["added_tokens"]}
        a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a[i] = token.encode() if i in added else bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        check_pieces(pieces)
        b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a_bytes, self.b_bytes = pa.array(a, pa.large_binary()), pa.array(b, pa.large_binary())
        self.a_lengths, self.b_lengths = (pc.binary_length(x).cast(pa.int64()) for x in (self.a_bytes, self.b_bytes))
        self.space_id = self.b.piece_to_id(_SPACE)
        self.first_b = len(a)
        shown = [str(i) for i in (*range(len(a)), *range(len(b)))]
        self.shown = pa.array([sign + i for sign in _SEPARATORS for i in shown], pa.large_binary())

    def words(self, words: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """The ids of both for each word, which has lost the one space before it."""
        kind = pa.list_(pa.int32())
        a, b = [pa.array([], kind)], [pa.array([], kind)]
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at : at + WORDS_AT_ONCE]
            a.append(pa.array([e.ids for e in self.a.encode_batch_fast([" " + w for w in some], add_special_tokens=False)], kind))
            b.append(pa.array([ids or [self.space_id] for ids in self.b.encode(some, num_threads=1)], kind))
        return pa.concat_arrays(a), pa.concat_arrays(b)


class _Words(dict):
    """word -> its number in the block; ``ends`` tells whether a space after it surely starts a new word."""

    def __init__(self):
        self.ends: list[bool] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.ends.append(bool(word) and (word[-1].isalnum() or word[-1] in _SIGNS))
        return n

    def cut(self, text: str) -> np.ndarray:
        """Numbers of the words of a text, each without the space before it."""
        parts = text.split(" ")
        codes = np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))
        ends = np.fromiter(map(self.ends.__getitem__, codes.tolist()), bool, len(codes))
        ends[-1] = True
        if ends.all():
            return codes
        stops = np.flatnonzero(ends) + 1  # parts up to here are one word
        starts = np.append(0, stops[:-1])
        out = codes[starts]
        for k in np.flatnonzero(stops - starts > 1).tolist():
            out[k] = self[" ".join(parts[starts[k] : stops[k]])]
        return out


def _taken(lists: pa.ListArray, codes: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """Token lists of documents from the lists of their words."""
    taken = lists.take(pa.array(codes))
    ends = np.append(0, np.cumsum(pc.list_value_length(taken).to_numpy(zero_copy_only=False).astype(np.int64)))
    return pa.ListArray.from_arrays(pa.array(ends[np.append(0, np.cumsum(sizes))], pa.int32()), pc.list_flatten(taken))


def _same_bytes(tokens: pa.ListArray, table: pa.Array, texts: list[bytes]) -> np.ndarray:
    """Whether each document's joined token bytes are its text."""
    taken = table.take(pc.list_flatten(tokens))
    whole = memoryview(taken.buffers()[2] or b"").cast("B")
    ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, 8 * taken.offset) if len(taken) else np.zeros(1, np.int64)
    at = ends[tokens.offsets.to_numpy(zero_copy_only=False)]
    return np.fromiter((whole[at[k] : at[k + 1]] == t for k, t in enumerate(texts)), bool, len(texts))


def _ends(tokens: pa.ListArray, lengths: pa.Array, side: str) -> pa.Table:
    """key (document << 32 | byte end), token id and position of each token."""
    parent, flat = pc.list_parent_indices(tokens).cast(pa.int64()), pc.list_flatten(tokens)
    total = pc.cumulative_sum(lengths.take(flat))
    before = np.append(0, total.to_numpy(zero_copy_only=False))[tokens.offsets.to_numpy(zero_copy_only=False)[:-1]]
    own = pc.subtract(total, pa.array(before, pa.int64()).take(parent))
    return pa.table({"key": pc.add(pc.shift_left(parent, 32), own), side: flat})


def intervals(a: pa.ListArray, b: pa.ListArray, pair: Pair) -> pa.Table:
    """One row for each stretch between two neighbouring ends of either side, in text order: doc, a and b (the tokens
    that overlap there), a_ends, b_ends (which of them end there) and cut (both do)."""
    left, right = _ends(a, pair.a_lengths, "a"), _ends(b, pair.b_lengths, "b")
    both = left.join(right, "key", join_type="full outer", use_threads=False)
    both = both.take(pc.sort_indices(both["key"])).combine_chunks()
    a_ends, b_ends = both["a"].is_valid(), both["b"].is_valid()
    return pa.table({"doc": pc.shift_right(both["key"], 32), "a": pc.fill_null_backward(both["a"]), "b": pc.fill_null_backward(both["b"]),
                     "a_ends": a_ends, "b_ends": b_ends, "cut": pc.and_(a_ends, b_ends)})


def _group_texts(a: pa.ListArray, b: pa.ListArray, spans: pa.Table, pair: Pair) -> list[memoryview]:
    """``a1,a2|b1;a3|b2,b3`` of each document's groups, as bytes.

    An id is written with the sign before it. Within a group the ids of A stand before those of B, so an id's place is
    its own position plus the other side's ids that come first."""
    cut, first = spans["cut"].to_numpy(zero_copy_only=False), {}
    group = {}  # of each token: how many groups end before its own end
    before = np.cumsum(cut) - cut
    for side in ("a", "b"):
        own = spans[f"{side}_ends"].to_numpy(zero_copy_only=False)
        group[side] = before[own]
        first[side] = np.append(True, group[side][1:] != group[side][:-1])[: len(group[side])]
    n = int(cut.sum())
    counts = {side: np.bincount(g, minlength=n) for side, g in group.items()}
    upto = {side: np.append(0, np.cumsum(c)) for side, c in counts.items()}
    places = {"a": np.arange(len(group["a"])) + upto["b"][group["a"]], "b": np.arange(len(group["b"])) + upto["a"][group["b"] + 1]}
    codes = np.empty(len(group["a"]) + len(group["b"]), np.int64)
    width = len(pair.shown) // len(_SEPARATORS)
    codes[places["a"]] = pc.list_flatten(a).to_numpy(zero_copy_only=False) + width * np.where(first["a"], 2, 0)
    codes[places["b"]] = pair.first_b + pc.list_flatten(b).to_numpy(zero_copy_only=False) + width * np.where(first["b"], 1, 0)
    shown = pair.shown.take(pa.array(codes))
    data = memoryview(shown.buffers()[2] or b"").cast("B")
    ends = np.frombuffer(shown.buffers()[1], np.int64, len(shown) + 1, 8 * shown.offset) if len(shown) else np.zeros(1, np.int64)
    edges = ends[a.offsets.to_numpy(zero_copy_only=False) + b.offsets.to_numpy(zero_copy_only=False)]
    return [data[i + 1 : j] for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]  # without the first sign


class _Block:
    """Documents of one block: cut when they come, encoded and joined at the end."""

    def __init__(self):
        self.words, self.docs, self.size = _Words(), [], 0

    def add(self, doc_id, text: str) -> None:
        self.docs.append((doc_id, text.encode("utf-8", "surrogatepass"), self.words.cut(text) if text else np.zeros(0, np.int64)))
        self.size += len(self.docs[-1][1])

    def parts(self, pair: Pair):
        """(documents, ids of A and B by document, which documents stand) a few at a time."""
        a, b = pair.words(list(self.words))
        at = 0
        while at < len(self.docs):
            size, to = 0, at
            while to < len(self.docs) and (size < JOINED_BYTES or to == at):
                size += len(self.docs[to][1])
                to += 1
            docs = self.docs[at:to]
            sizes = np.array([len(c) for *_, c in docs], np.int64)
            codes = np.concatenate([c for *_, c in docs])
            own_a, own_b = _taken(a, codes, sizes), _taken(b, codes, sizes)
            texts = [b" " + t if t else t for _, t, _ in docs]
            stand = _same_bytes(own_a, pair.a_bytes, texts) & _same_bytes(own_b, pair.b_bytes, texts) & (sizes > 0)
            if not stand.all():
                own_a, own_b = (_only(x, stand) for x in (own_a, own_b))
            yield docs, own_a, own_b, stand
            at = to

    def rows(self, pair: Pair, buckets: int):
        block = new_block()
        heads, held = [], []
        for docs, a, b, stand in self.parts(pair):
            spans = intervals(a, b, pair)
            code = pc.add(pc.shift_left(spans["a"].cast(pa.int64()), 32), spans["b"].cast(pa.int64()))
            counted = pa.table({"doc": spans["doc"], "pair": code}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
            counted = counted.take(pc.sort_indices(counted["doc"]))
            n = len(docs)
            of = spans["doc"].to_numpy()
            links, groups = np.bincount(of, minlength=n), np.bincount(of[spans["cut"].to_numpy(zero_copy_only=False)], minlength=n)
            held.append((counted["pair"].to_numpy(), counted["count_all"].to_numpy(), np.bincount(counted["doc"].to_numpy(), minlength=n)))
            digests = [hashlib.sha256(text).digest() if ok else b"" for text, ok in zip(_group_texts(a, b, spans, pair), stand.tolist(), strict=True)]
            lengths = (pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in (a, b))
            heads.append(([i for i, *_ in docs], np.stack([*lengths, groups, links]), digests))
        pairs, times, sizes = (np.concatenate([h[k] for h in held]) for k in range(3))
        by_pair = pa.table({"pair": pairs}).group_by("pair", use_threads=False).aggregate([([], "count_all")])  # documents of the block
        known, docs_of = by_pair["pair"].to_numpy(), by_pair["count_all"].to_numpy()
        order = np.lexsort((known, -docs_of))
        known, docs_of = known[order], docs_of[order]
        ascending = np.argsort(known)
        numbers = ascending[np.searchsorted(known[ascending], pairs)]
        out = []
        bucket = (mix64(known.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        at = np.lexsort((known, bucket))
        for own in np.split(at, np.flatnonzero(np.diff(bucket[at])) + 1) if len(at) else []:
            out.append((block, int(bucket[own[0]]), None, pack_ints(docs_of[own]), _pack_pairs(known[own]), pack_ints(own)))
        ends = np.cumsum(sizes)
        first = 0
        for ids, counts, digests in heads:
            last = first + len(ids)
            low, high = int(ends[first - 1]) if first else 0, int(ends[last - 1])
            body = [pack_ints(x) for x in (numbers[low:high], times[low:high])]
            head = pack_ints(np.concatenate([counts.ravel(), sizes[first:last]]))
            out.append((block, STREAM, ids, head, len(body[0]).to_bytes(8, "little") + b"".join(body), b"".join(d or bytes(32) for d in digests)))
            first = last
        return out


def _only(lists: pa.ListArray, stand: np.ndarray) -> pa.ListArray:
    """The lists, empty where ``stand`` is false."""
    return pc.fill_null(pc.if_else(pa.array(stand), lists, pa.scalar(None, lists.type)), pa.scalar([], lists.type))


def _pack_pairs(pairs: np.ndarray) -> bytes:
    """Ascending pairs, as differences of A ids and B ids."""
    a, b = pack_ints(np.diff(pairs >> 32, prepend=0)), pack_ints(pairs & 0xFFFFFFFF)
    return len(a).to_bytes(8, "little") + a + b


def _unpack_pairs(data: bytes) -> np.ndarray:
    n = 8 + int.from_bytes(data[:8], "little")
    return (np.cumsum(unpack_ints(data[8:n]).astype(np.int64)) << 32) | unpack_ints(data[n:])


def _blocks(shared, give):
    """``give(block, pair)`` of each block of a task's documents."""
    def run(batches):
        pair, block = Pair(shared.value), _Block()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                block.add(doc_id, text.as_py())
                if block.size >= BLOCK_BYTES:
                    yield from give(block, pair)
                    block = _Block()
        if block.docs:
            yield from give(block, pair)
    return run


def _documents(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def align_documents(docs: DataFrame, models: tuple[str, bytes]) -> DataFrame:
    """ALIGNED: the ids of both tokenizers for each document, and for each group how many ids of either side lie up to
    its end (``a_cuts``, ``b_cuts``)."""
    def give(block: _Block, pair: Pair):
        for own, a, b, _ in block.parts(pair):
            spans = intervals(a, b, pair)
            cut = spans["cut"].to_numpy(zero_copy_only=False)
            of = spans["doc"].to_numpy()[cut]
            upto = [np.cumsum(spans[f"{side}_ends"].to_numpy(zero_copy_only=False))[cut] for side in ("a", "b")]
            places = [n - x.offsets.to_numpy(zero_copy_only=False)[of] for x, n in zip((a, b), upto, strict=True)]
            offsets = pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=len(own)))), pa.int32())
            cuts = [pa.ListArray.from_arrays(offsets, pa.array(p, pa.int32())) for p in places]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, *_ in own], pa.int64()), a, b, *cuts], ["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"])

    shared = docs.sparkSession.sparkContext.broadcast(models)
    return _documents(docs).mapInArrow(_blocks(shared, give), ALIGNED)


def _partial_counts(batches):
    """Packed rows of pairs -> (a, b, n), summed once more within a batch."""
    for batch in batches:
        rows = batch.to_pylist()
        if rows:
            t = pa.table({"pair": np.concatenate([_unpack_pairs(r["body"]) for r in rows]), "n": np.concatenate([unpack_ints(r["sizes"]) for r in rows]).astype(np.int64)})
            t = t.group_by("pair", use_threads=False).aggregate([("n", "sum")])
            p = t["pair"].to_numpy()
            out = pa.table({"a": pa.array(p >> 32, pa.int32()), "b": pa.array(p & 0xFFFFFFFF, pa.int32()), "n": t["n_sum"]})
            yield from out.to_batches()


def pair_counts(partial: DataFrame) -> DataFrame:
    """(a, b, n, best): the sum of partial counts (a, b, n), and whether it is the highest of its A id. An A id has as
    many rows as B has ids at most."""
    counts = partial.groupBy("a", "b").agg(F.sum("n").alias("n"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _look_up(batches):
    """In order of bucket, the corpus's counts before the blocks' rows (block -1): each block's row gets its values."""
    bucket, parts, known = None, [], None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["bucket"] != bucket:
                bucket, parts, known = r["bucket"], [], None
            if r["block"] < 0:
                parts.append((np.frombuffer(r["body"], np.int64), np.frombuffer(r["sizes"], np.int64)))
                continue
            if known is None:
                keys, values = (np.concatenate([p[k] for p in parts]) for k in range(2))
                at = np.argsort(keys)
                known = keys[at], values[at]
            values = known[1][np.searchsorted(known[0], _unpack_pairs(r["body"]))]
            counts = values >> 1
            body = pack_ints(counts & 0xFFFFFFFF), pack_ints(counts >> 32)
            out.append((r["block"], bucket, None, pack_ints(values & 1), len(body[0]).to_bytes(8, "little") + b"".join(body), r["numbers"]))
        if out:
            yield row_batch(out)


def _corpus_rows(batches):
    """(bucket, pair, value) rows -> packed rows of block -1, one for each bucket in a batch."""
    for batch in batches:
        bucket, pairs, values = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("bucket", "pair", "value"))
        at = np.argsort(bucket, kind="stable")
        rows = [(-1, int(bucket[own[0]]), None, values[own].tobytes(), pairs[own].tobytes(), None) for own in np.split(at, np.flatnonzero(np.diff(bucket[at])) + 1) if len(own)]
        if rows:
            yield row_batch(rows)


def _with_bucket(buckets: int):
    def run(batches):
        for batch in batches:
            a, b, n, best = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "n", "best"))
            pairs = (a.astype(np.int64) << 32) | b.astype(np.int64)
            bucket = (mix64(pairs.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(pairs), pa.array(n.astype(np.int64) << 1 | best.astype(np.int64))], ["bucket", "pair", "value"])
    return run


def _report(documents: pa.Table, values: pa.Table) -> pa.Table:
    """LINKED rows of one block's documents, from the counts and marks of its pairs."""
    got = []
    for r in values.to_pylist():
        n = 8 + int.from_bytes(r["body"][:8], "little")
        value = unpack_ints(r["body"][8:n]).astype(np.int64) | (unpack_ints(r["body"][n:]).astype(np.int64) << 32)
        got.append((unpack_ints(r["numbers"]), value, unpack_ints(r["sizes"])))
    counts, best = np.zeros(sum(len(g[0]) for g in got), np.int64), np.zeros(sum(len(g[0]) for g in got), np.int64)
    for own, value, mark in got:
        counts[own], best[own] = value, mark
    schema = pa.schema([(c.split()[0], pa.string() if "string" in c else pa.int64()) for c in LINKED.split(", ")])
    out = [schema.empty_table()]
    for r in documents.to_pylist():
        ids = r["ids"]
        head = unpack_ints(r["sizes"]).astype(np.int64).reshape(5, len(ids))
        n = 8 + int.from_bytes(r["body"][:8], "little")
        number, times = unpack_ints(r["body"][8:n]), unpack_ints(r["body"][n:]).astype(np.int64)
        edges = np.append(0, np.cumsum(head[4]))
        sums = [np.diff(np.append(0, np.cumsum(times * x[number]))[edges]) for x in (best, counts)]
        digests = [r["numbers"][32 * k : 32 * k + 32].hex() if head[0, k] else "" for k in range(len(ids))]
        out.append(pa.table([pa.array(ids, pa.int64()), *(pa.array(x, pa.int64()) for x in (*head[:4], *sums)), pa.array(digests, pa.string())], schema=schema))
    return pa.concat_tables(out)


def linked_documents(docs: DataFrame, models: tuple[str, bytes]) -> DataFrame:
    """LINKED for every row of ``docs`` (doc_id, text): tokens, groups and links, links whose pair is the most frequent of
    its A id, the sum of the pairs' document counts, and the digest of the groups."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "alignment")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS_A_PARTITION * partitions
    shared = spark.sparkContext.broadcast(models)

    def give(block: _Block, pair: Pair):
        yield row_batch(block.rows(pair, buckets))

    rows = save_blocks(_documents(docs).mapInArrow(_blocks(shared, give), ROWS), scratch)
    partial = rows.where(F.col("bucket") != STREAM).select("sizes", "body").mapInArrow(_partial_counts, "a int, b int, n long")
    counts = pair_counts(partial).mapInArrow(_with_bucket(buckets), "bucket int, pair long, value long").mapInArrow(_corpus_rows, ROWS)
    asked = keys_by_bucket(counts.unionByName(rows.withColumn("sizes", F.when(F.col("bucket") == STREAM, F.col("sizes")))), partitions)
    return join_blocks(rows, asked.mapInArrow(_look_up, ROWS), _report, LINKED)
