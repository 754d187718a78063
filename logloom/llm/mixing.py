"""Operator 10: mix sources to target weights by hierarchical budgeting (DataFrame functions only).

Sources are the leaves of a domain, language, source tree. A token budget goes down the tree: the children of a node
share its budget by weight, each up to its capacity (the tokens of its leaves times ``max_epochs``). What a short child
can't take goes to its siblings by weight; only what a whole subtree can't take reaches the siblings of its ancestor,
since a node's own budget never exceeds its subtree's capacity. Each leaf then takes its budget from epochs over its
documents: whole epochs first, then a token-prefix of the next one, in the order of an md5 of seed, epoch and id. The
last document of a prefix may be taken in part, so every budget is met to the token.

A leaf may hold any share of all rows: its prefix is found by 4096 hash ranges (sums per range), and only documents in
the one range where the prefix ends are put in order.

Defined cases: a null language or source counts as the name ''; a document without words has no tokens and is never
taken; equal ids are ordered by tokens; a node without a weight has weight 1, a node of weight 0 takes nothing; an
empty table gives an empty result. Weights are non-negative integers, all sums are exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.scratch import Scratch

LEVELS = ("domain", "lang", "source")
WORD = r"[^\x20\x09-\x0D]+"
RANGE_DIGITS = 3  # hex digits of the order's hash: 4096 ranges a leaf


def default_domain() -> Column:
    """Documents carry no domain; theirs is the number that ends the source's name, modulo 3."""
    number = F.expr("try_cast(regexp_extract(cast(source as string), '([0-9]{1,6})$', 1) as int)")
    return F.coalesce(F.concat(F.lit("domain"), (number % 3).cast("string")), F.lit("other"))


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    given = weights.get(level, {})
    out = F.lit(1)
    for name, w in sorted(given.items()):
        out = F.when(F.col(level) == name, F.lit(int(w))).otherwise(out)
    return out.cast("long")


def _share(nodes: DataFrame, parents: list[str], level: str) -> DataFrame:
    """``nodes`` (budget of the parent, weight, cap) with their own whole-token ``share`` of it."""
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = family.orderBy(F.col("cap") / F.col("weight"), level)
    big = lambda c: c.cast("decimal(19,0)")
    nodes = nodes.where("weight > 0").withColumn("budget", F.least("budget", F.sum("cap").over(family)))
    nodes = nodes.withColumn("caps_before", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")) \
        .withColumn("weight_left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    full = big(F.col("cap")) * big(F.col("weight_left")) <= big(F.col("weight")) * big(F.col("budget") - F.col("caps_before"))
    nodes = nodes.withColumn("full", full)
    nodes = nodes.withColumn("rest", F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(family)) \
        .withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(family)) \
        .withColumn("upto", F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    part = F.expr("(cast(upto as decimal(19,0)) * cast(rest as decimal(19,0))) div open - (cast(upto - weight as decimal(19,0)) * cast(rest as decimal(19,0))) div open")
    return nodes.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(part).cast("long"))


def leaf_budgets(leaves: DataFrame, budget: int | Column, weights: dict[str, dict[str, int]], max_epochs: int) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with ``leaf_budget``."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    shares: DataFrame | None = None
    for depth, level in enumerate(LEVELS):
        keys, parents = list(LEVELS[: depth + 1]), list(LEVELS[:depth])
        nodes = leaves.groupBy(*keys).agg(F.sum("cap").alias("cap"))
        if shares is None:
            total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"))
            nodes = nodes.join(F.broadcast(total), F.lit(True)).withColumn("budget", budget if isinstance(budget, Column) else F.lit(budget)).drop("all")
        else:
            nodes = nodes.join(shares.select(*parents, F.col("share").alias("budget")), parents)
        shares = _share(nodes.withColumn("weight", _weight(level, weights)), parents, level)
    return leaves.join(shares.select(*LEVELS, F.col("share").alias("leaf_budget")), list(LEVELS))


def mix_sources(docs: DataFrame, weights: dict[str, dict[str, int]], budget_percent: int = 50, max_epochs: int = 4, seed: int = 17,
                domain: Column | None = None) -> DataFrame:
    """The documents taken, one row per input row that gives tokens: doc_id, domain, lang, source, n_tokens,
    whole_epochs (times taken whole), part_tokens (tokens taken in the last, partial epoch).

    ``docs`` has doc_id, text, lang, source. The budget is ``budget_percent`` of all tokens of ``docs``."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.save(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (default_domain() if domain is None else domain).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens")), "sized")
    sized = sized.where("n_tokens > 0")
    leaves = sized.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    budgets = scratch.save(leaf_budgets(leaves, F.floor(F.col("all") * budget_percent / 100).cast("long"), weights, max_epochs).select(
        *LEVELS, F.expr("leaf_budget div tokens").alias("whole_epochs"), F.expr("leaf_budget % tokens").alias("rest")).where("whole_epochs > 0 or rest > 0"), "budgets")
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), (F.col("whole_epochs") + 1).cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    docs = sized.join(budgets, list(LEVELS)).withColumn("order", order).withColumn("range", F.substring("order", 1, RANGE_DIGITS))
    ranges = docs.where("rest > 0").groupBy(*LEVELS, "range", "rest").agg(F.sum("n_tokens").alias("in_range"))
    before = F.sum("in_range").over(Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("in_range")
    ranges = ranges.withColumn("before", before).where("before < rest").select(*LEVELS, "range", "before", (F.col("before") + F.col("in_range") > F.col("rest")).alias("ends_here"))
    ranges = scratch.save(ranges, "ranges")
    docs = docs.join(ranges, [*LEVELS, "range"], "left")
    columns = ["doc_id", *LEVELS, "n_tokens", "whole_epochs"]
    inside = docs.where("ends_here is null or not ends_here").select(
        *columns, F.when(F.col("ends_here").isNotNull(), F.col("n_tokens")).otherwise(0).alias("part_tokens"))
    upto = F.sum("n_tokens").over(Window.partitionBy(*LEVELS, "range").orderBy("order", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0))
    at_end = docs.where("ends_here").withColumn("start", F.col("before") + upto - F.col("n_tokens")).select(
        *columns, F.greatest(F.lit(0), F.least("n_tokens", F.col("rest") - F.col("start"))).alias("part_tokens"))
    return inside.unionByName(at_end).where("whole_epochs > 0 or part_tokens > 0").select(*columns, F.col("part_tokens").cast("long").alias("part_tokens"))


#: Target weights of the registered query and the pipeline; names that are not listed weigh 1.
TARGET_WEIGHTS = {
    "domain": {"domain0": 2, "domain1": 5, "domain2": 3},
    "lang": {"en": 4, "de": 3, "fr": 2, "es": 2},
    "source": {"src0": 6, "src1": 2},
}


def oracle_sql(weights: dict[str, dict[str, int]] = TARGET_WEIGHTS, budget_percent: int = 50, max_epochs: int = 4, seed: int = 17, docs: str = "documents") -> str:
    """The same result in DuckDB SQL."""
    def weight(level: str) -> str:
        given = " ".join(f"WHEN '{k}' THEN {v}" for k, v in sorted(weights.get(level, {}).items()))
        return f"CASE {level} {given} ELSE 1 END" if given else "1"

    levels, parts = "domain, lang, source", []
    for depth, level in enumerate(LEVELS):
        keys, parents = ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth])
        family = f"PARTITION BY {parents}" if parents else ""
        source = f"JOIN s{depth - 1} USING ({parents})" if parents else ""
        budget = "share" if parents else f"(SELECT CAST(floor(sum(tokens) * {budget_percent} / 100) AS BIGINT) FROM leaves)"
        parts.append(f"""
n{depth} AS (SELECT n.*, {weight(level)} AS weight, least({budget}, sum(cap) OVER ({family.replace(parents, ", ".join("n." + p for p in LEVELS[:depth])) if parents else ""})) AS budget
  FROM (SELECT {keys}, sum(tokens) * {max_epochs} AS cap FROM leaves GROUP BY {keys}) n {source} WHERE {weight(level)} > 0),
o{depth} AS (SELECT *, sum(cap) OVER w - cap AS caps_before, sum(weight) OVER v AS weight_left FROM n{depth}
  WINDOW w AS ({family} ORDER BY cap / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         v AS ({family} ORDER BY cap / weight, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
f{depth} AS (SELECT *, CAST(cap AS HUGEINT) * weight_left <= CAST(weight AS HUGEINT) * (budget - caps_before) AS is_full FROM o{depth}),
r{depth} AS (SELECT *, CAST(budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({family}) AS HUGEINT) AS rest,
    CAST(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({family}) AS HUGEINT) AS open_weight,
    CAST(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({family} ORDER BY cap / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS HUGEINT) AS upto FROM f{depth}),
s{depth} AS (SELECT {keys}, CAST(CASE WHEN is_full THEN cap ELSE upto * rest // open_weight - (upto - weight) * rest // open_weight END AS BIGINT) AS share FROM r{depth})""")
    return f"""WITH sized AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,6}})$', 1) = '' THEN 'other'
         ELSE 'domain' || (CAST(regexp_extract(source, '([0-9]{{1,6}})$', 1) AS INT) % 3) END AS domain,
    len(regexp_extract_all(text, '{WORD}')) AS n_tokens FROM {docs} WHERE len(regexp_extract_all(text, '{WORD}')) > 0),
leaves AS (SELECT {levels}, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM sized GROUP BY {levels}),{",".join(parts)},
b AS (SELECT {levels}, share // tokens AS whole_epochs, share % tokens AS rest FROM leaves JOIN s2 USING ({levels})),
d AS (SELECT sized.*, whole_epochs, rest, sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('{seed}|' || (whole_epochs + 1) || '|' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens AS start
  FROM sized JOIN b USING ({levels}))
SELECT doc_id, {levels}, CAST(n_tokens AS BIGINT) AS n_tokens, whole_epochs, CAST(greatest(0, least(n_tokens, rest - start)) AS BIGINT) AS part_tokens
FROM d WHERE whole_epochs > 0 OR rest > start"""
