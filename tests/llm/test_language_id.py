import numpy as np
import pyarrow as pa

import corpus_pipeline
from logloom.llm import language_id
from logloom.llm.language_id import identify, identify_held_out, languages_of, learn_filters


def test_held_out_accuracy(spark, docs):
    found = {r.doc_id: r for r in identify_held_out(docs).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    judged = [(found[r.doc_id].lang_pred, r.lang) for r in rows if found[r.doc_id].held_out and r.lang is not None]
    assert np.mean([a == b for a, b in judged]) >= 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_filters_return_every_language_of_an_ngram(spark):
    rows = [("abcd abcd", "x"), ("abcd wxyz", "y"), ("wxyz wxyz", "z")]
    filters = learn_filters(spark.createDataFrame(rows, "text string, lang string"))
    key = lambda g: np.array([(ord(g[0]) << 42) | (ord(g[1]) << 21) | ord(g[2])])
    assert filters.langs == ["x", "y", "z"]
    assert languages_of(filters, key("abc"))[0][0] & np.uint64(0b011) == 0b011
    assert languages_of(filters, key("xyz"))[0][0] & np.uint64(0b110) == 0b110


def test_edges(spark, edge_docs):
    docs, rows = edge_docs
    found = identify_held_out(docs).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (1, 2, 3, 9))
    assert by_id[None].held_out and by_id[None].lang_pred != "und"
    assert by_id[6].lang_pred == "en" and by_id[6].score > 0.9
    kept = identify(docs, learn_filters(docs.select("text", "lang")))
    assert set(kept.columns) == set(docs.columns) and kept.count() == len(rows)
    assert {r.lang_pred for r in identify(docs, learn_filters(docs.limit(0))).collect()} == {"und"}
    assert identify_held_out(docs.limit(0)).collect() == []


def test_more_than_one_word_of_languages(spark):
    rows = [(f"{chr(0x4e00 + k)}{chr(0x5e00 + k)} {chr(0x4e00 + k)}{chr(0x5e00 + k)}", f"l{k:03d}") for k in range(70)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    filters = learn_filters(docs)
    assert filters.masks.shape[0] == 2
    assert all(r.lang_pred == r.lang for r in identify(docs, filters).collect())


def test_filters_grow_with_the_ngrams(spark):
    """A script of many letters with 3 million n-grams: texts of learned n-grams score 1, others 0."""
    rng = np.random.default_rng(9)
    text = lambda first, n: "".join(map(chr, rng.integers(first, first + 11_000, n)))
    learned = [(text(0x4E00, 10_000), "zh") for _ in range(300)] + [(text(0xAC00, 10_000), "ko") for _ in range(10)] + [("plain words of a small language", "en")]
    filters = learn_filters(spark.createDataFrame(learned, "text string, lang string").repartition(8))
    assert filters.table is not None and filters.false_positive_rates().max() < 0.011
    rows = [*((t, x, 1.0) for t, x in (learned[0], learned[300], learned[-1])), (text(0x4E00, 10_000), None, 0.0), ("12", "und", 0.0), (None, "und", 0.0)]
    found = identify(spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(rows)], "row long, text string"), filters)
    assert found.columns == ["row", "text", "lang_pred", "score"]
    for r in found.collect():
        _, lang, score = rows[r.row]
        assert abs(r.score - score) < 0.02 and lang in (None, r.lang_pred)


def test_joined_filters_give_the_same_answers(spark, docs):
    rng = np.random.default_rng(2)
    many = spark.createDataFrame([("".join(map(chr, rng.integers(0x4E00, 0x9000, 3000))), "zh") for _ in range(100)], "text string, lang string")
    labelled = docs.select("text", "lang").unionByName(many)
    small, joined = learn_filters(labelled), learn_filters(labelled, broadcast_cells=0)
    assert small.slices > 1 and small.table is None and joined.table is not None
    assert np.allclose(small.false_positive_rates(), joined.false_positive_rates())
    a, b = ({r.doc_id: (r.lang_pred, round(r.score, 9)) for r in identify(docs.select("doc_id", "text"), f).collect()} for f in (small, joined))
    assert a == b


def _plain_ngrams(text):
    """N-grams of a text that is cut after each PIECE characters."""
    for k in range(0, len(text), language_id.PIECE):
        piece = ["\n", *text[k : k + language_id.PIECE].lower(), "\n"]
        codes = [ord(c) if c.isalpha() else 0 for c in piece]
        yield from ((a << 42) | (b << 21) | c for a, b, c in zip(codes, codes[1:], codes[2:]) if b)


def test_a_task_holds_few_ngrams_at_once():
    """Long and many texts: n-grams of at most a few hundred thousand characters at a time, the same as in one go."""
    rng = np.random.default_rng(4)
    word = lambda n: "".join(rng.choice(list("abcdefg hi 1"), n))
    texts = [word(language_id.PIECE + 400_001), None, "", "a", *(word(3000) for _ in range(200)), word(1 << 17), word((1 << 17) + 1), word(language_id.PIECE)]
    found = [[] for _ in texts]
    for rows, offsets, keys in language_id._ngrams(texts):
        assert len(keys) <= 300_000
        for row, a, b in zip(rows, offsets[:-1], offsets[1:], strict=True):
            found[row].append(keys[a:b])
    for text, parts in zip(texts, found, strict=True):
        assert np.concatenate(parts).tolist() == list(_plain_ngrams(text or ""))


def test_counts_are_added_up_over_batches():
    texts = ["abc abd", "abc", "xyz", "12"]
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "x", "y", "y"]), pa.array(texts)], ["lang", "text"])
    rows = [(r["lang"], r["key"], r["n"]) for out in language_id._count([batch] * 5) for r in out.to_pylist()]
    want = {}
    for lang, text in zip(["x", "x", "y", "y"], texts, strict=True):
        for key in _plain_ngrams(text):
            want[lang, key] = want.get((lang, key), 0) + 5
    assert len(rows) == len(want) and {(lang, key): n for lang, key, n in rows} == want


def test_a_text_goes_to_python_once(spark, docs, monkeypatch):
    sent = []
    monkeypatch.setattr(corpus_pipeline, "identify", lambda inner, filters: (sent.append(inner.schema), identify(inner, filters))[1])
    named = docs.select("doc_id", "lang", "text").withColumn("score", docs["lang"])
    kept = corpus_pipeline.language_stage(spark, named, "")
    assert kept.columns == named.columns and sent[0].simpleString().count("text:") == 1
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in named.collect()}
