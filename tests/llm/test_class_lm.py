import math
import zlib
from collections import Counter

import numpy as np
import pytest

from logloom.llm.class_lm import CLASSES, END, best_classes, score, score_held_out, train
from logloom.llm.scratch import Scratch
from tests.llm.brute import words


def check(rows, found):
    """Counts and the base score are exact. rows: (doc_id, text)."""
    tokens = [(i, [*words(t), "\n"]) for i, t in rows]
    out = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, ws in tokens if not out(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, ws in tokens:
        want[i, out(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 4)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found) == want
    assert all(r.score < 0 for r in found)


def test_the_table_and_better_than_the_base(spark, docs, doc_rows):
    found = score_held_out(docs).collect()
    check([(i, t) for i, t, *_ in doc_rows], found)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edges(spark, edge_docs):
    docs, rows = edge_docs
    check([(i, t) for i, t, *_ in rows], score_held_out(docs).collect())
    assert score_held_out(docs.limit(0)).collect() == []
    only_held_out = docs.where("doc_id is null")
    assert [(r.held_out, r.n_known, r.train_tokens) for r in score_held_out(only_held_out).collect()] == [(True, 0, 0)]


def test_next_token_probabilities_sum_to_one(spark):
    texts = ["a b a b c", "c a b", "b b a d e f"]
    scratch = Scratch(spark, "test-lm")
    model = train(spark.createDataFrame([(t,) for t in texts], "text string"), scratch)
    assert model.tokens == 17 and model.types == 7
    assert np.allclose((10 ** model.transitions).sum(1), 1)
    # After "a": each known word, one unseen word per class, and the end.
    unseen = {}
    from logloom.llm.class_lm import _ending_unit
    for k in range(100, 30_000):
        ending = int.from_bytes(str(k).encode()[::-1][:3], "big")
        unseen.setdefault(int(model.classes[_ending_unit(np.array([ending]))[0]]), str(k))
        if len(unseen) == CLASSES:
            break
    assert len(unseen) == CLASSES
    continued = ["a", *[f"a {w}" for w in [*"abcdef", *unseen.values()]]]
    got = {r.text: r.score for r in score(spark.createDataFrame([(t, t) for t in continued], "text string, name string").selectExpr("text", "name"), model, scratch)
           .selectExpr("name as text", "score").collect()}
    end_after = lambda w: float(model.transitions[_class(model, w), CLASSES])
    total = 10 ** got["a"] + sum(10 ** (got[t] - end_after(t.split()[-1])) for t in continued[1:])
    start = 10 ** (got["a"] - end_after("a"))
    assert abs(total / start - 1) < 1e-6


def _class(model, word):
    import pyarrow as pa

    from logloom.llm.words import word_hashes
    _, h, last = word_hashes(pa.array([word]), suffixes=True)
    return int(model.classes[model.lookup.of(h, last)[1][0]])


def test_best_class_raises_the_likelihood():
    """Against the likelihood of the class bigrams, computed afresh for every class."""
    rng = np.random.default_rng(3)
    units, classes = 12, 4
    counts = rng.integers(0, 6, (units, units)).astype(float)
    counts[-1, -1] = 0
    of = np.append(rng.integers(0, classes, units - 1), classes)

    def matrix(of):
        m = np.zeros((classes + 1, classes + 1))
        np.add.at(m, (of[:, None], of[None, :]), counts)
        return m

    def likelihood(of):
        m = matrix(of)
        phi = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return phi(m) - phi(m.sum(0)) - phi(m.sum(1))

    who = np.arange(units - 1)
    after, before = counts[:-1].copy(), counts.T[:-1].copy()
    after[who, who] = before[who, who] = 0
    by_class = lambda n: np.stack([np.bincount(of, row, classes + 1) for row in n])
    got = best_classes(matrix(of), of[:-1], by_class(after), by_class(before), np.diag(counts)[:-1])
    for u in who:
        tried = [likelihood(np.where(np.arange(units) == u, k, of)) for k in range(classes)]
        assert math.isclose(tried[got[u]], max(tried), abs_tol=1e-6)
    assert END > CLASSES


def _plain_classes(model, texts):
    """Class of each word of the texts, from the model's table, lookup and, for unseen words, ending."""
    import pyarrow as pa

    from logloom.llm.words import word_hashes
    table = {r["word"]: r["class"] for r in model.rarer.collect()}
    out = {}
    for w in {w for t in texts for w in words(t)}:
        h = int(word_hashes(pa.array([w]))[1].view(np.int64)[0])
        out[w] = table.get(h, _class(model, w))
    return out


@pytest.mark.parametrize("frequent, lookup", [(8192, 1 << 18), (3, 6), (0, 0)])
def test_scores_against_a_plain_version(spark, frequent, lookup):
    """Transitions, masses and scores from plain counts, with words of all three ways: units, looked up, joined."""
    rng = np.random.default_rng(5)
    names = [f"w{i}" for i in range(40)]
    texts = [" ".join(names[min(int(i), 39)] for i in rng.geometric(0.12, n) - 1) for n in rng.integers(0, 60, 50)] + ["w1 w1 w1 w39 w39"]
    asked = [*texts, "", "w0 new1 w1 new1 new2", "new3"]
    scratch = Scratch(spark, "test-lm")
    model = train(spark.createDataFrame([(t,) for t in texts], "text string"), scratch, frequent, lookup)
    of = _plain_classes(model, asked)
    n = Counter(w for t in texts for w in words(t))
    size, types = Counter(), Counter()
    for w, c in n.items():
        size[of[w]] += c
        types[of[w]] += 1
    path = lambda t: [CLASSES, *(of[w] for w in words(t)), CLASSES]
    steps = Counter((a, b) for t in texts for a, b in zip(path(t), path(t)[1:]))
    from_class = Counter()
    for (a, _), c in steps.items():
        from_class[a] += c
    assert model.rarer.count() == max(len(n) - frequent, 0) and model.tokens == sum(n.values()) + len(texts)

    def plain(t):
        moves = sum(math.log10((steps[a, b] + 0.5) / (from_class[a] + 0.5 * (CLASSES + 1))) for a, b in zip(path(t), path(t)[1:]))
        return moves + sum(math.log10((n[w] + 0.5) / (size[of[w]] + 0.5 * (types[of[w]] + 1))) for w in words(t))

    got = {r.name: r.score for r in score(spark.createDataFrame([(t, t) for t in asked], "name string, text string"), model, scratch).collect()}
    assert all(math.isclose(got[t], plain(t), rel_tol=1e-9) for t in asked)


def test_rarer_words_follow_their_own_neighbours(spark):
    """Words of one ending part by what stands around them, and join the frequent word that stands there."""
    texts = ["a p b", "c r d"] * 200 + [f"{t}zzz {e}" for i in range(30) for t, e in ((f"a x{i}", "b"), (f"c y{i}", "d"))] * 2
    model = train(spark.createDataFrame([(t,) for t in texts], "text string"), Scratch(spark, "test-lm"), 6, classes=6)
    of = _plain_classes(model, texts)
    assert {of[f"x{i}zzz"] for i in range(30)} == {of["p"]} and {of[f"y{i}zzz"] for i in range(30)} == {of["r"]} and of["p"] != of["r"]
