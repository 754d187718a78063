import random

import duckdb

import corpus_pipeline
from logloom.llm.mixing import oracle_sql
from tests.conftest import SF_SMALL
from tests.llm.brute import components, edit_distance_to_run, shingles, words


def test_run_matches_a_plain_version(spark, doc_rows, tmp_path):
    """Every document of the small table has letters in a learned language, so stage 1 keeps them all; the other
    stages are redone plainly, the last one by its DuckDB SQL."""
    found = corpus_pipeline.run(spark, SF_SMALL).collect()
    kept = [r for r in doc_rows if any(c.isalpha() for c in r[1] or "")]
    comps = components([(i, t) for i, t, *_ in kept])
    kept = [r for r in kept if comps[r[0]][1] == r[0]]
    items = [words(t) for t, in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("text").collect()]
    kept = [r for r in kept if not any(edit_distance_to_run(w, words(r[1])) <= int(0.2 * len(w)) for w in items)]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", kept)
    columns = ["doc_id", "domain", "lang", "source", "n_tokens", "whole_epochs", "part_tokens"]
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({oracle_sql()})").fetchall()
    assert sorted(tuple(r[c] for c in columns) for r in found) == sorted(want)


def test_stages_keep_columns_and_stand_edges(spark, edge_docs, tmp_path):
    docs, rows = edge_docs
    spark.createDataFrame([(1, "word1 the1 word2 the2 word3 the3"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        docs, before = stage(spark, docs, str(tmp_path)), docs
        if name != "mixing":
            assert docs.columns == before.columns
        ids[name] = sorted((r.doc_id for r in docs.select("doc_id").collect() if r.doc_id is not None), key=str)
    assert ids["language_id"] == [10, 4, 5, 5, 6, 7, 8]
    assert ids["ngram_jaccard_join"] == [4, 5, 6]
    assert ids["benchmark_decontamination"] == [4, 5]
    empty = edge_docs[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []


def test_near_copies_link_on_five_words_from_four_fifths(spark):
    """One replaced block in 200 words, below, between and above the limits of the stage and of query op6."""
    rng = random.Random(5)
    rows, k = [], 0
    for block in (4, 12, 14, 15, 16, 17, 18, 19, 24):
        text = [f"w{k}x{i}" for i in range(200)]
        at = rng.randrange(10, 160)
        rows += [(k, " ".join(text)), (k + 1, " ".join([*text[:at], *(f"new{k}x{i}" for i in range(block)), *text[at + block :]]))]
        k += 2
    sets = [shingles(t, 5) for _, t in rows]
    want = [i for i, _ in rows if not any(5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in range(i))]
    kept = {i for i, c in components(rows).items() if c[1] == i}
    assert kept - set(want)  # pairs between the limits
    found = corpus_pipeline.near_copy_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in found.collect()) == want


def test_texts_of_one_id_are_documents_of_their_own(spark):
    """An id with several texts: only equal or linked ones go, and the same rows stay whatever the order of the input."""
    text = lambda k, block=0: " ".join([*(f"new{k}x{i}" for i in range(block)), *(f"w{k}x{i}" for i in range(block, 200))])
    stay = [(1, text(1), "a"), (1, text(2), "a"), (2, text(3), "b"), (7, text(5), "c"), (7, "", "e"), (7, None, "e"), (9, text(6), "d")]
    go = [(1, text(1), "b"), (3, text(1, 5), "a"), (4, text(2, 5), "a"), (2, text(3), "c"), (7, max(text(4), text(4, 5)), "a"), (8, text(5), "a")]
    stay.append((7, min(text(4), text(4, 5)), "z"))
    for rows in (stay + go, (go + stay)[::-1]):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
        found = [tuple(r) for r in corpus_pipeline.near_copy_stage(spark, docs, "").collect()]
        assert sorted(found, key=str) == sorted(stay, key=str)
