import hashlib
import itertools
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from logloom.llm import alignment
from logloom.llm.blocks import STREAM
from logloom.llm.alignment import Pair, align_documents, check_pieces, linked_documents, read_models

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MODELS = read_models(A_PATH, B_PATH)


def plain(texts):
    """For each text (a ids, b ids, groups, links), or None where it has no tokens, by the whole text's tokens."""
    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    pair = Pair(MODELS)
    a_bytes, b_bytes = pair.a_bytes.to_pylist(), pair.b_bytes.to_pylist()
    out = []
    for text in texts:
        x, y = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in x) != whole or b"".join(b_bytes[i] for i in y) != whole:
            out.append(None)
            continue
        x_ends, y_ends = (list(itertools.accumulate(len(t[i]) for i in z)) for t, z in ((a_bytes, x), (b_bytes, y)))
        at, links, i, j = 0, [], 0, 0
        groups, first = [], (0, 0)
        while i < len(x):
            links.append((x[i], y[j]))
            at = min(x_ends[i], y_ends[j])
            ends = x_ends[i] == at, y_ends[j] == at
            i, j = i + ends[0], j + ends[1]
            if all(ends):
                groups.append((x[first[0] : i], y[first[1] : j]))
                first = i, j
        out.append((x, y, groups, links))
    return out


def text_of(groups):
    return ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)


def check(docs, rows):
    found = plain([t for _, t in rows])
    counts = Counter(link for f in found if f for link in set(f[3]))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    want = []
    for (i, _), f in zip(rows, found, strict=True):
        if f is None:
            want.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            x, y, groups, links = f
            best = sum(counts[k] == most[k[0]] for k in links)
            want.append((i, len(x), len(y), len(groups), len(links), best, sum(counts[k] for k in links), hashlib.sha256(text_of(groups).encode()).hexdigest()))
    assert sorted(map(tuple, linked_documents(docs, MODELS).collect()), key=str) == sorted(want, key=str)
    aligned = []
    for r in align_documents(docs, MODELS).collect():
        cuts = list(zip([0, *r.a_cuts], r.a_cuts, [0, *r.b_cuts], r.b_cuts, strict=False))
        aligned.append((r.doc_id, r.a_ids, r.b_ids, [(r.a_ids[i:j], r.b_ids[k:n]) for i, j, k, n in cuts]))
    assert sorted(aligned, key=str) == sorted([(i, *(f[:3] if f else ([], [], []))) for (i, _), f in zip(rows, found, strict=True)], key=str)


def test_the_table(docs, doc_rows):
    check(docs, [r[:2] for r in doc_rows])


def test_edges(edge_docs):
    docs, rows = edge_docs
    check(docs, [r[:2] for r in rows])
    assert linked_documents(docs.limit(0), MODELS).collect() == []
    assert align_documents(docs.limit(0), MODELS).collect() == []


def test_texts_of_many_kinds(spark):
    signs = "abéа中あ\U0001f600́'’   \t\n\r 　​\u0085\x1c\x00_-1▁"
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list(signs), n)) for n in rng.integers(1, 60, 400)]
    texts += ["<|endoftext|> <s> </s><unk><0x41>", "a ", " a", "  a  b  ", " ", "▁", "x" * 4000, "one  two  three.\n four ▁five"]
    rows = list(enumerate(texts))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_many_blocks_and_parts(spark, monkeypatch):
    """Counts of all blocks are summed; one pair is in every document."""
    rows = [(i, f"the crowd of {i} and {i * i % 97} unalignable{i % 5} tokenizations") for i in range(300)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(20), rows)
    monkeypatch.setattr(alignment, "JOINED_BYTES", 200)
    block = alignment._Block()
    for i, t in rows:
        block.add(i, t)
    pair = Pair(MODELS)
    rows_of = block.rows(pair, 4)
    assert sum(len(r[2]) for r in rows_of if r[1] == STREAM) == 300


def test_a_piece_over_words_is_refused():
    check_pieces(["▁", "▁▁", "▁a", "b"])
    with pytest.raises(ValueError):
        check_pieces(["a▁b"])
