"""Operator 13: byte-level BPE encoding and decoding by a global shuffle of the distinct words.

A pattern cuts each text into pre-tokens (words, for short). Encoding goes in four steps:

1. explode: a task takes its documents in blocks of ``BLOCK_BYTES`` of text, numbers the distinct words of a block by
   falling frequency and writes, in compressed rows, the words (dealt over hash buckets) and for each document the
   numbers of its words in text order, so a word's position is its place in that sequence;
2. encode once: the words' rows are shuffled by bucket; a bucket holds all occurrences of its words in all blocks, and
   each distinct word is merged once, however often it occurs. A block has a word once at most, so a word that makes up a
   third of all text is one entry a block;
3. join back: each (block, bucket) row returns to its block with the ids of its words;
4. reassemble: a block's documents replace the numbers by the ids, in order of position.

Decoding joins ids with the token-byte table (bounded by the vocabulary) and keeps their order.

Merging follows the rank rule: a word that is a token is that token; else the adjacent pair whose joined bytes have the
least rank is merged, the leftmost first, until no pair is a token.

Defined cases: null and empty texts have no ids; a null doc_id stays null; repeated rows are encoded each; other columns
are ignored, whatever their names; an empty table gives an empty table. Texts of any length are cut into pre-tokens in
pieces that end where a word surely ends (before white space that follows a letter, digit or ASCII sign)."""

from __future__ import annotations

import base64
import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.blocks import BLOCK_BYTES, ROWS, STREAM, join_blocks, keys_by_bucket, new_block, row_batch, save_blocks
from logloom.llm.packing import pack_ints, unpack_ints, unzip, zip_bytes
from logloom.llm.scratch import Scratch, bounded_batches

PIECE_CHARS = 1 << 20
ROW_WORDS = 1 << 18
BUCKETS_A_PARTITION = 4
MAX_VOCABULARY = 1 << 20
_SURE_END = regex.compile(r"[\p{L}\p{N}!-/:-@\[-`{-~](?=\s)")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a file with one base64 token and its rank in each line. Every byte must be a token."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    if len(ranks) > MAX_VOCABULARY or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the vocabulary is over its bound, or some byte is not a token")
    return ranks


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word: the leftmost pair of least rank first. A heap finds it, so a long word takes n log n."""
    if not word:
        return []
    if (whole := ranks.get(word)) is not None:
        return [whole]
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at i; end 0: merged away
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or ranks.get(word[i : end[middle]]) != rank:
            continue  # one of the parts has changed since
        end[i], end[middle] = end[middle], 0
        if end[i] < n:
            before[end[i]] = i
            if (r := ranks.get(word[i : end[end[i]]])) is not None:
                heapq.heappush(heap, (r, i))
        if (j := before[i]) >= 0 and (r := ranks.get(word[j : end[i]])) is not None:
            heapq.heappush(heap, (r, j))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def _pieces(text: str):
    """Parts of a long text that end between two words."""
    at = 0
    while len(text) - at > PIECE_CHARS:
        cut = _SURE_END.search(text, at + PIECE_CHARS)
        if cut is None:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:] if at else text


class _Numbers(dict):
    """word -> its number, in order of first occurrence."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class _Block:
    def __init__(self):
        self.number, self.ids, self.codes, self.size = _Numbers(), [], [], 0

    def add(self, doc_id, text: str, pattern) -> None:
        of = self.number.__getitem__
        parts = [np.fromiter(map(of, found), np.int32, len(found)) for found in map(pattern.findall, _pieces(text))]
        self.ids.append(doc_id)
        self.codes.append(parts[0] if len(parts) == 1 else np.concatenate(parts))
        self.size += len(text)

    def rows(self, buckets: int):
        block = new_block()
        sizes = np.array([len(c) for c in self.codes], np.int64)
        codes = np.concatenate(self.codes)
        order = np.argsort(-np.bincount(codes, minlength=len(self.number)), kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        codes = place[codes]
        words = list(self.number)
        rows = []
        dealt: dict[int, list[tuple[str, int]]] = {}
        for n, at in enumerate(order.tolist()):
            dealt.setdefault(zlib.crc32(words[at].encode("utf-8", "surrogatepass")) % buckets, []).append((words[at], n))
        for bucket, own in dealt.items():
            own.sort()
            raw = [w.encode("utf-8", "surrogatepass") for w, _ in own]
            rows.append((block, bucket, None, pack_ints([len(w) for w in raw]), zip_bytes(b"".join(raw)), pack_ints([n for _, n in own])))
        ends = np.cumsum(sizes)
        first = 0
        while first < len(sizes):
            base = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + ROW_WORDS, "right")))
            rows.append((block, STREAM, self.ids[first:last], pack_ints(sizes[first:last]), pack_ints(codes[base : int(ends[last - 1])]), None))
            first = last
        return rows


def _explode(pattern: str, buckets: int):
    def run(batches):
        compiled, block = regex.compile(pattern), _Block()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                block.add(doc_id, text.as_py(), compiled)
                if block.size >= BLOCK_BYTES:
                    yield row_batch(block.rows(buckets))
                    block = _Block()
        if block.ids:
            yield row_batch(block.rows(buckets))
    return run


def _encode_words(shared):
    """Rows of words, sorted by bucket -> the same rows with ids in place of the words. Each distinct word of a bucket is
    merged once; only one bucket's words are kept at a time."""
    def run(batches):
        ranks, bucket, known = shared.value, None, {}
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["bucket"] != bucket:
                    bucket, known = r["bucket"], {}
                data, ends = unzip(r["body"]), np.cumsum(unpack_ints(r["sizes"])).tolist()
                found, at = [], 0
                for end in ends:
                    word = data[at:end]
                    if (ids := known.get(word)) is None:
                        ids = known[word] = merge_word(word, ranks)
                    found.append(ids)
                    at = end
                rows.append((r["block"], bucket, None, pack_ints([len(x) for x in found]), pack_ints(np.fromiter((i for x in found for i in x), np.int64)), r["numbers"]))
            if rows:
                yield row_batch(rows)
    return run


def _reassemble(documents: pa.Table, words: pa.Table) -> pa.Table:
    """The documents of one block with the ids of its words in place of their numbers."""
    lists = _by_number([tuple(unpack_ints(r[c]) for c in ("numbers", "sizes", "body")) for r in words.to_pylist()])
    out = [pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32()))})]
    for r in documents.to_pylist():
        taken = lists.take(pa.array(unpack_ints(r["body"])))
        ends = taken.offsets.to_numpy(zero_copy_only=False)
        offsets = (ends - ends[0])[np.append(0, np.cumsum(unpack_ints(r["sizes"]).astype(np.int64)))]
        out.append(pa.table({"doc_id": pa.array(r["ids"], pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), taken.flatten())}))
    return pa.concat_tables(out)


def _by_number(got: list[tuple]) -> pa.ListArray:
    """The ids of each word of a block, at the word's number."""
    if not got:
        return pa.array([], pa.list_(pa.int32()))
    numbers, sizes = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
    flat = pa.array(np.concatenate([g[2] for g in got]).astype(np.int32))
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), flat)
    return lists.take(pa.array(np.argsort(numbers)))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text). Rows come in no stated order."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "byte-bpe")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inner = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = save_blocks(inner.mapInArrow(_explode(pattern, BUCKETS_A_PARTITION * partitions), ROWS), scratch)
    shared = spark.sparkContext.broadcast(ranks)
    words = keys_by_bucket(rows, partitions).mapInArrow(_encode_words(shared), ROWS)
    return join_blocks(rows, words, _reassemble, "doc_id long, ids array<int>")


def token_bytes(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """The token-byte table (id, token)."""
    return spark.createDataFrame(sorted((r, bytearray(t)) for t, r in ranks.items()), "id int, token binary")


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", output: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of each id list in the column ``output`` (null for a null list).

    The token-byte table is bounded by ``MAX_VOCABULARY``, so every task joins its ids with the whole of it; an id
    without a token raises."""
    spark = encoded.sparkSession
    bounded_batches(spark)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    shared = spark.sparkContext.broadcast(table)
    known = set(ranks.values())
    whole = len(known) == len(table)

    def run(batches):
        tokens = pa.array(shared.value, pa.large_binary())
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.flatten()
            if not whole and not known.issuperset(flat.to_pylist()):
                raise ValueError("an id has no token")
            taken = tokens.take(flat)
            ends = taken.buffers()[1]
            ends = np.frombuffer(ends, np.int64, len(taken) + 1, 8 * taken.offset) if len(taken) else np.zeros(1, np.int64)
            sizes = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
            offsets = ends[np.append(0, np.cumsum(sizes))]
            data = taken.buffers()[2] if len(taken) else pa.py_buffer(b"")
            joined = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), data])
            if lists.null_count:
                joined = pc.if_else(lists.is_valid(), joined, pa.scalar(None, pa.large_binary()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), joined.cast(pa.binary())], ["row", "decoded"])

    row = F.struct(*(F.col(f"`{c}`") for c in encoded.columns if c != output))
    inner = encoded.select(row.alias("row"), F.col(ids).cast("array<int>").alias("ids"))
    kind = inner.schema["row"].dataType.simpleString()
    return inner.mapInArrow(run, f"row {kind}, decoded binary").select("row.*", F.col("decoded").alias(output))
