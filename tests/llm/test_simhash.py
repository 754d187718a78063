import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from logloom.llm import simhash
from logloom.llm.simhash import WIDTH, block_tables, fingerprint_documents, fingerprints, within_radius
from logloom.llm.words import shingle_hashes, word_hashes


def distance(a, b):
    return bin(int(a, 16) ^ int(b, 16)).count("1")


def plain_print(text):
    """Weighted votes bit by bit; only the hash of a term is the library's."""
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\x20\x09-\x0d]+", text)]
    terms = Counter(tuple(words[k : k + WIDTH]) for k in range(max(1, len(words) - WIDTH + 1))) if words else {}
    votes = [0.0] * 64
    for term, n in terms.items():
        h = int(shingle_hashes(*word_hashes(pa.array([" ".join(term)])), WIDTH)[1][0])
        for b in range(64):
            votes[b] += float(np.float32(1 + math.log(n))) * (1 if h >> b & 1 else -1)
    return sum(1 << b for b, v in enumerate(votes) if v > 0)


def test_fingerprints_by_plain_votes(doc_rows):
    texts = ["", " \t", "One", "one TWO", "a b c", "a b a b a b a b", "x " * 500, *(t or "" for _, t, *_ in doc_rows[:40])]
    assert [int(x) for x in fingerprints(pa.array(texts, pa.large_string()))] == [plain_print(t) for t in texts]


def check(spark, docs, rows, every=50):
    """rows: (id, text) in the order of the operator."""
    found = fingerprint_documents(docs, every=every).collect()
    assert len(found) == len(rows)
    texts = [t or "" for _, t in rows]
    prints = [f"{int(x):016x}" for x in fingerprints(pa.array(texts, pa.large_string()))]
    want = []
    for k, (i, _) in enumerate(rows):
        t, nxt = texts[k], texts[(k + 1) % len(rows)]
        half = len(t) // 2
        changed = t[: len(t) - half] + nxt[:half]
        e = f"{int(fingerprints(pa.array([changed], pa.large_string()))[0]):016x}"
        mine = min((j for (j, _), p in zip(rows, prints) if p == prints[k] and j is not None), default=None)
        others = {p for p in prints if p != prints[k] and distance(prints[k], p) <= 3}
        firsts = [min((j for (j, _), q in zip(rows, prints) if q == p and j is not None), default=None) for p in others]
        near = sum(distance(prints[k], p) <= 3 for p in prints) - 1 if i is not None and i % every == 0 else None
        want.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), prints[k], e, 1 - distance(prints[k], e) / 64,
                     1 - distance(prints[k], prints[(k + 1) % len(rows)]) / 64, mine, near,
                     None if near is None else sorted(j for j in firsts if j is not None)))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_the_table(spark, docs, doc_rows):
    check(spark, docs, [(i, t) for i, t, *_ in doc_rows], every=5)


def test_edges(spark, edge_docs):
    docs, rows = edge_docs
    rows = sorted([(i, t) for i, t, *_ in rows], key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    check(spark, docs, rows, every=2)
    check(spark, docs.where("doc_id = 4"), [(4, "One")], every=2)
    assert fingerprint_documents(docs.limit(0)).collect() == []


def test_near_texts_are_likelier_than_others(spark, docs):
    r = fingerprint_documents(docs).agg(F.avg("near_edited").alias("e"), F.avg("near_next").alias("n")).first()
    assert r.e > r.n + 0.1


def test_tables_find_all_within_the_radius(spark):
    rng = random.Random(8)
    prints = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(8):
            x = base
            for b in rng.sample(range(64), rng.randrange(6)):
                x ^= 1 << b
            prints.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = spark.createDataFrame([(x,) for x in signed], "print long")
    for radius in (1, 3):
        found = {tuple(r) for r in within_radius(df, df, radius).select("query", "print").collect()}
        assert found == {(a, b) for a in signed for b in signed if bin((a ^ b) & (1 << 64) - 1).count("1") <= radius}
        assert np.bitwise_or.reduce(np.array(block_tables(radius), np.uint64)) == np.uint64((1 << 64) - 1)


def test_a_task_holds_few_texts(spark, docs, monkeypatch):
    """Long runs of rows are fingerprinted in pieces of half a million characters, from small Arrow batches."""
    held = []
    monkeypatch.setattr(simhash, "_print_rows", lambda rows: held.append(sum(len(t) + len(f) for _, t, f in rows)) or len(rows))
    text = "some words of a text " * 50
    batches = [pa.RecordBatch.from_pydict({"range": [0] * 500, "is_next": [False] * 500, "id": list(range(500 * k, 500 * k + 500)), "text": [text] * 500})
               for k in range(6)]
    assert sum(simhash._with_next(batches)) == 2999
    assert len(held) > 6 and max(held) <= (1 << 19) + 2 * len(text)
    simhash.fingerprint_edits(docs)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 500
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20
