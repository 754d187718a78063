import random

import pytest
from pyspark.sql import functions as F

from logloom.llm import ngram_join
from logloom.llm.ngram_join import ngram_jaccard_join
from tests.llm.brute import components


def check(spark, rows, **kwargs):
    found = ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), **kwargs).collect()
    want = components(rows)
    assert len(found) == len(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == {(i, n, c) for i, (n, c) in want.items()}
    return found


def test_matches_brute_force_on_the_table(spark, doc_rows):
    check(spark, [(i, t) for i, t, *_ in doc_rows])


@pytest.mark.parametrize("block", [2, 4, 32])
def test_large_near_copy_groups_and_shared_passages(spark, block):
    """Copies with zero to five edits of one text, most of them not linked with each other, plus a long passage that
    unrelated texts share: with a small block all of it runs over long columns."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    passage = " ".join(f"p{k}" for k in range(60))
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(6)):
            k = rng.randrange(len(w))
            kind = rng.randrange(3)
            if kind == 0:
                w[k] = f"x{rng.randrange(10**6)}"
            elif kind == 1:
                w.insert(k, f"x{rng.randrange(30)}")
            else:
                del w[k]
        rows.append((1000 - i, " ".join(w)))
    for i in range(60):
        rows.append((2000 + i, passage + " " + " ".join(f"q{rng.randrange(5000)}" for _ in range(rng.randrange(4, 40)))))
    check(spark, rows, block=block)


def test_random_small_vocabulary(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 14)))) for i in range(300)]
    check(spark, rows, block=4)


def test_edges(spark, edge_docs):
    docs, rows = edge_docs
    found = ngram_jaccard_join(docs).collect()
    want = components([(i, t) for i, t, *_ in rows])
    assert len(found) == len(rows)
    for r in found:
        assert (r.component_id is None) if r.doc_id is None else (r.n_shingles, r.component_id) == want[r.doc_id]
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0
    assert by_id[10].component_id == 5 and by_id[7].component_id == 6


def test_empty_table(spark, docs):
    assert ngram_jaccard_join(docs.limit(0)).collect() == []


def _two_passages(n, m=120):
    """A long first document of two passages, n documents that share the first (no links), m short ones of the second
    (all linked)."""
    rng = random.Random(3)
    first, second = [f"a{k}" for k in range(200)], [f"b{k}" for k in range(120)]
    rows = [(0, " ".join(first + second))]
    rows += [(1 + i, " ".join(first + [f"u{rng.randrange(10**7)}" for _ in range(rng.randrange(55, 90))])) for i in range(n)]
    rows += [(10_000 + i, " ".join(second + [f"t{i}"])) for i in range(m)]
    return rows


def test_a_pivot_longer_than_its_rows(spark):
    check(spark, _two_passages(150), block=16)


def _met_in_groups(spark, rows, block, monkeypatch):
    """Pairs that meet in groups of one pivot, while the join runs."""
    from logloom.llm import ngram_join
    met, plain = [], ngram_join._in_pivot_groups
    with monkeypatch.context() as m:
        m.setattr(ngram_join, "_in_pivot_groups", lambda *a: met.append(plain(*a).cache()) or met[-1])
        ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
    return sum(f.count() for f in met)


def test_pairs_that_meet_grow_with_the_rows(spark, monkeypatch):
    few, many = (_met_in_groups(spark, _two_passages(n, n), 32, monkeypatch) for n in (150, 600))
    assert many <= 6 * few + 600


def _edited(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        k = rng.randrange(len(w))
        kind = rng.randrange(3)
        w[k : k + (kind > 0)] = [f"x{rng.randrange(10**6)}"] if kind < 2 else []
    return w


def test_a_group_of_mostly_unlinked_copies_is_not_multiplied_out(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    rows = [(i, " ".join(_edited(rng, base, rng.randrange(0, 12)))) for i in range(500)]
    check(spark, rows, block=32)
    assert _met_in_groups(spark, rows, 32, monkeypatch) < 500 * 499 // 2 // 20


def test_families_within_a_group(spark):
    """Three versions of one text, far from each other, each with copies of its own; one is the majority."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(160)]
    versions = [base, base[:60] + [f"v{k}" for k in range(50)] + base[60:], base[:90] + [f"z{k}" for k in range(60)]]
    rows = []
    for v, n in zip(versions, (150, 80, 60), strict=True):
        rows += [(len(rows) + i, " ".join(_edited(rng, v, rng.randrange(0, 7)))) for i in range(n)]
    rng.shuffle(rows)
    check(spark, rows, block=16)


def group_of(rows, keys, shared, own, rng):
    """Differences of ``rows`` rows: ``shared`` changes that all have, ``own`` that few have."""
    few = [rng.getrandbits(62) for _ in range(4000)]
    all_ = [rng.getrandbits(62) for _ in range(shared)]
    return [(*keys, k, 500, sorted({*all_, *rng.sample(few, own)})) for k in range(rows)], set(all_)


def test_changes_of_a_group_are_counted_where_they_are(spark, monkeypatch):
    """Rows are not expanded into the changes that all have, tasks hold few of them, and what most rows have is flipped."""
    monkeypatch.setattr(ngram_join, "COUNTED_CELLS", 20_000)
    rows, shared = group_of(6000, (1,), 24, 10, random.Random(6))
    other, theirs = group_of(3, (2,), 5, 1, random.Random(7))
    rows = spark.createDataFrame(rows + other, "pivot long, id long, n long, diff array<long>").repartition(4)
    seen = []
    run = ngram_join._local_often(["pivot"], 16)
    for batch in run(rows.select("pivot", "diff").toArrow().to_batches(max_chunksize=500)):
        seen += [(p, len(x)) for p, x in zip(batch.column("pivot").to_pylist(), batch.column("some"))]
    assert len(seen) >= 8 and sum(m for _, m in seen) < 6000
    plan = ngram_join._rebased(rows, ["pivot"])
    assert "array_intersect" not in plan._jdf.queryExecution().optimizedPlan().toString()
    left = {(r["pivot"], r["id"]): set(r["diff"]) for r in plan.collect()}
    was = {(r["pivot"], r["id"]): set(r["diff"]) for r in rows.collect()}
    assert left == {k: d - (shared if k[0] == 1 else theirs) for k, d in was.items()}


def test_a_large_group_meets_its_row_in_parts(spark):
    rows = spark.range(5000).select(F.lit(1).cast("long").alias("pivot"), "id").unionByName(spark.createDataFrame([(2, 1), (3, 1)], "pivot long, id long"))
    groups = spark.createDataFrame([(1, "a"), (2, "b")], "pivot long, name string")
    inner, left = (ngram_join._of_group(rows, groups, ["pivot"], how) for how in ("inner", "left"))
    assert {tuple(r) for r in inner.groupBy("name").count().collect()} == {("a", 5000), ("b", 1)}
    assert {tuple(r) for r in left.groupBy("pivot", "name").count().collect()} == {(1, "a", 5000), (2, "b", 1), (3, None, 1)}
    assert "part" not in inner.columns


def test_arrow_batches_are_small(spark, docs):
    ngram_jaccard_join(docs)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20
