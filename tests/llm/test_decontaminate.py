import random

import numpy as np
import pytest

import logloom.llm.decontaminate as decontaminate_module
from logloom.llm.decontaminate import CLASSES, decontaminate, find_leaks, fitting_distance
from tests.llm.brute import edit_distance_to_run, words


def test_fitting_distance_is_exact():
    rng = random.Random(3)
    for _ in range(200):
        item = [rng.randrange(6) for _ in range(rng.randrange(1, 80))]
        text = [rng.randrange(6) for _ in range(rng.randrange(0, 90))]
        bits = {}
        for k, w in enumerate(item):
            bits[w] = bits.get(w, 0) | 1 << k
        assert fitting_distance(bits, len(item), text)[0] == edit_distance_to_run(item, text)


def test_exact_passages_of_the_table_and_nothing_else(spark, docs, doc_rows):
    from tests.conftest import SF_SMALL
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    found = {(r.doc_id, r.item_id): r.distance for r in find_leaks(docs, items).collect()}
    want = {}
    for item, text in items.select("item_id", "text").collect():
        w = words(text)
        for i, t, *_ in doc_rows:
            d = edit_distance_to_run(w, words(t)) if len(w) >= CLASSES[-1][0] else len(w)
            if d <= int(0.2 * len(w)):
                want[i, item] = d
    assert want and found == want


def test_recall_on_edited_passages(spark):
    rng = random.Random(7)
    vocabulary = [f"v{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(4, 70)))) for k in range(60)]
    docs, planted = [], set()
    for i in range(400):
        text = rng.choices(vocabulary, k=rng.randrange(0, 300))
        if i % 2:
            k, item = rng.choice(items)
            w = item.split()
            for _ in range(rng.randrange(int(0.2 * len(w)) + 1)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
            at = rng.randrange(len(text) + 1)
            text[at:at] = w
            planted.add((i, k))
        docs.append((i, " ".join(text)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in find_leaks(docs, items).collect()}
    assert len(found & planted) >= 0.95 * len(planted)
    assert not {i for i, _ in found} - {i for i, _ in planted}
    kept = {r.doc_id for r in decontaminate(docs, items).collect()}
    assert kept == set(range(400)) - {i for i, _ in found}


def test_edges(spark, edge_docs):
    docs, rows = edge_docs
    long = " ".join(rows[7][1].split()[:3000])
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one two three"), (4, long), (4, long), (None, "text without an id but with")], "item_id long, text string")
    found = [tuple(r) for r in find_leaks(docs, items).select("doc_id", "item_id", "distance").collect()]
    assert sorted(found, key=str) == sorted([(6, 4, 0), (6, 4, 0), (7, 4, 0), (7, 4, 0), (8, 4, 1), (8, 4, 1), (None, None, 0)], key=str)
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 10, 2, 3, 4, 5, 5, 9]
    assert find_leaks(docs.limit(0), items).collect() == [] and find_leaks(docs, items.limit(0)).collect() == []
    assert decontaminate(docs, items.limit(0)).count() == len(rows)


def test_class_sizes_leave_no_length_out():
    for least, window, stride in CLASSES:
        assert window + stride - 1 <= least or stride == 1 and window <= least
    assert np.all(np.diff([c[0] for c in CLASSES]) < 0)


def test_repetitions_reach_the_target_inside_running_text():
    """Short items, verbatim or with the most edits, among other words; a target that can't be reached is reported."""
    rng = np.random.default_rng(21)
    words = lambda n: rng.integers(1, 1 << 62, n, dtype=np.int64).astype(np.uint64)
    for n in (4, 8, 15):
        size_class = next(k for k, (least, *_) in enumerate(decontaminate_module.CLASSES) if n >= least)
        _, window, stride = decontaminate_module.CLASSES[size_class]
        times = decontaminate_module.repetitions([words(n) for _ in range(3)], size_class, 0.2, 0.98)
        hits = 0
        for _ in range(300):
            item = words(n)
            text = np.concatenate([words(int(rng.integers(40))), decontaminate_module._edited(item, n // 5, rng), words(40)])
            there, own = np.arange(0, len(text) - window + 1, stride), np.arange(n - window + 1)
            hits += any(np.isin(decontaminate_module.signatures(text, there, size_class, r), decontaminate_module.signatures(item, own, size_class, r)).any() for r in range(times))
        assert hits >= 0.96 * 300, (n, times, hits)
    with pytest.warns(UserWarning, match="recall"):
        decontaminate_module.repetitions([words(8)], 2, 0.9, 0.98)


def test_tasks_hold_a_bounded_number_of_documents(spark):
    from logloom.llm import decontaminate as D
    docs = spark.createDataFrame([(1, "a b c d e f g h i j")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    left = D.decontaminate(docs, items)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == D.BATCH_ROWS <= 500
    assert left.count() == 0
