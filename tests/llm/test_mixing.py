import random
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from logloom.llm.mixing import TARGET_WEIGHTS, leaf_budgets, mix_sources, oracle_sql
from tests.llm.brute import water_fill, words


def plain_budgets(leaves, budget, weights, epochs):
    """{leaf: budget} going down the tree node by node."""
    def cap(prefix):
        return sum(t * epochs for leaf, t in leaves.items() if leaf[: len(prefix)] == prefix)

    out = {(): min(budget, cap(()))}
    for depth, level in enumerate(("domain", "lang", "source")):
        nodes = defaultdict(dict)
        for leaf in leaves:
            nodes[leaf[:depth]][leaf[: depth + 1]] = (weights.get(level, {}).get(leaf[depth], 1), cap(leaf[: depth + 1]))
        out = {k: v for parent, children in nodes.items() if parent in out for k, v in water_fill(out[parent], children).items()}
    return out


def test_budgets_match_plain_water_filling(spark):
    rng = random.Random(6)
    for _ in range(6):
        leaves = {(f"d{rng.randrange(3)}", f"l{rng.randrange(3)}", f"s{rng.randrange(6)}"): rng.choice([1, 7, 100, 10**6]) for _ in range(25)}
        weights = {level: {f"{level[0]}{k}": rng.choice([0, 1, 2, 9]) for k in range(4)} for level in ("domain", "lang", "source")}
        budget = rng.choice([0, 13, 1000, 10**6, 10**9])
        table = spark.createDataFrame([(*k, t) for k, t in leaves.items()], "domain string, lang string, source string, tokens long")
        found = {(r.domain, r.lang, r.source): r.leaf_budget for r in leaf_budgets(table, budget, weights, 3).collect()}
        assert found == plain_budgets(leaves, budget, weights, 3)


def taken(rows):
    out = defaultdict(int)
    for r in rows:
        out[r.domain, r.lang, r.source] += r.whole_epochs * r.n_tokens + r.part_tokens
    return dict(out)


def test_every_leaf_meets_its_budget_and_the_oracle_agrees(spark, docs):
    from tests.conftest import SF_SMALL
    found = mix_sources(docs, TARGET_WEIGHTS).collect()
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    columns = ["doc_id", "domain", "lang", "source", "n_tokens", "whole_epochs", "part_tokens"]
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({oracle_sql()})").fetchall()
    assert sorted(tuple(r[c] for c in columns) for r in found) == sorted(want)
    leaves = defaultdict(int)
    for r in mix_sources(docs, {}, budget_percent=100, max_epochs=1).collect():
        leaves[r.domain, r.lang, r.source] += r.n_tokens
    assert taken(found) == {k: v for k, v in plain_budgets(leaves, sum(leaves.values()) * 50 // 100, TARGET_WEIGHTS, 4).items() if v}


def test_edges(spark, edge_docs):
    docs, rows = edge_docs
    found = mix_sources(docs, {}, budget_percent=100, max_epochs=1).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in found) == sorted((i is None, i or 0, len(words(t))) for i, t, *_ in rows if words(t))
    assert {(r.lang, r.source) for r in found if r.doc_id is None} == {("", "")}
    half = mix_sources(docs, {"source": {"src0": 0}}, budget_percent=100, max_epochs=2).collect()
    assert all(r.source != "src0" for r in half)
    assert mix_sources(docs.limit(0), TARGET_WEIGHTS).collect() == []


def test_one_leaf_with_all_rows(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("en").alias("lang"), F.lit("src0").alias("source"))
    found = mix_sources(docs, {}, budget_percent=150).collect()
    assert taken(found) == {("domain0", "en", "src0"): 22500}
    assert {r.whole_epochs for r in found} == {1} and sum(r.part_tokens for r in found) == 7500
    again = mix_sources(docs.repartition(7), {}, budget_percent=150).collect()
    assert sorted(found) == sorted(again)
