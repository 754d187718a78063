import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from logloom.llm import byte_bpe
from logloom.llm.byte_bpe import decode, encode, load_ranks, merge_word
from logloom.llm.packing import pack_ints, unpack_ints
from logloom.llm.queries import op13_byte_bpe

RANKS = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
PLAIN = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def check(docs, rows):
    """rows: (doc_id, text)"""
    found = decode(encode(docs, RANKS, PATTERN), RANKS).collect()
    want = [(i, PLAIN.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in found), key=str) == sorted(want, key=str)


def test_the_table(docs, doc_rows):
    check(docs, [r[:2] for r in doc_rows])


def test_edges(spark, edge_docs):
    docs, rows = edge_docs
    check(docs, [r[:2] for r in rows])
    assert encode(docs.limit(0), RANKS, PATTERN).collect() == []


def test_texts_of_many_kinds(spark):
    signs = "aéа中あก가\U0001f600́'’ \t\n\r 　​\u0085\x1c\x00_-1٣"
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list(signs), n)) for n in rng.integers(1, 60, 300)]
    texts += ["<|endoftext|> it's we'll I'D", "x" * 5000, "ab" * 3000 + " " * 900 + "1234567" * 300, " a", "a ", "  ", "\n\n \n"]
    rows = list(enumerate(texts))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_a_crowded_word_is_one_entry_a_block(spark):
    """A third of all words is one word; blocks are small, so it is in many."""
    rows = [(i, " ".join(["crowd", f"w{i}", f"v{i % 7}"] * 40)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(24)
    blocks = docs.mapInArrow(byte_bpe._explode(PATTERN, 32), byte_bpe.ROWS)
    n = blocks.select("block").distinct().count()
    assert n > 8
    words = [(r.block, r.bucket) for r in blocks.where("bucket >= 0").collect()]
    assert len(words) == len(set(words))  # a row for a block and a bucket
    check(docs, rows)


def test_pieces_of_long_texts_end_between_words(monkeypatch):
    monkeypatch.setattr(byte_bpe, "PIECE_CHARS", 50)
    compiled = regex.compile(PATTERN)
    for text in ("one two, three. " * 40, "x" * 300 + " y" * 90, " \n\t " * 100, "it's 12 a　b c " * 30, ""):
        pieces = list(byte_bpe._pieces(text))
        assert "".join(pieces) == text
        assert [w for p in pieces for w in compiled.findall(p)] == compiled.findall(text)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("ab th", max_size=80)).map(str.encode))
def test_a_word_is_merged_as_the_plain_rule_says(word):
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1 and word not in RANKS:
        ranked = [(RANKS[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in RANKS]
        if not ranked:
            break
        i = min(ranked)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    assert merge_word(word, RANKS) == ([RANKS[word]] if word in RANKS else [RANKS[p] for p in parts])


def test_decode_has_defined_cases(spark):
    rows = [(1, [], "a"), (2, None, "b"), (3, [RANKS[b"a"], RANKS[b"\xff"]], "c")]
    found = decode(spark.createDataFrame(rows, "doc_id long, ids array<int>, decoded string"), RANKS).collect()
    assert {r.doc_id: r.decoded for r in found} == {1: b"", 2: None, 3: b"a\xff"}
    with pytest.raises(Exception, match="out of bounds|no token"):
        decode(spark.createDataFrame([(1, [len(RANKS) + 7])], "doc_id long, ids array<int>"), RANKS).collect()


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 11_000)))
def test_packed_integers_come_back(values):
    assert unpack_ints(pack_ints(np.array(values, np.int64))).tolist() == values


def test_the_query(spark, doc_rows):
    from tests.conftest import SF_SMALL
    want = {}
    for i, t, *_ in doc_rows:
        ids = PLAIN.encode_ordinary(t or "")
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert {r[0]: tuple(r)[1:] for r in op13_byte_bpe(spark, SF_SMALL).collect()} == want
