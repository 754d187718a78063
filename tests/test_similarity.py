"""Exact similarity join against brute force on a small fixture."""

import itertools
import random

import pytest

from logloom.operators.similarity import similar_pairs


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_similar_pairs_equals_brute_force(spark, k):
    rng = random.Random(k)
    rows = []
    for g in ("g1", "g2"):
        base = ["/en/825", "/en/826", "/fr/1", "/a", "", "ab", "/api/v1/student/1234",
                "/api/v1/student/5637", "/api/v2/student/1256", "/apigator/1256"]
        for s in base:
            rows.append((g, s))
            t = list(s)
            for _ in range(rng.randint(0, 3)):
                if t and rng.random() < 0.5:
                    t.pop(rng.randrange(len(t)))
                else:
                    t.insert(rng.randrange(len(t) + 1), rng.choice("ab/1"))
            rows.append((g, "".join(t)))
    df = spark.createDataFrame(rows, "grp string, path string")
    got = {(r["grp"], r["value_a"], r["value_b"], r["levenshtein_distance"])
           for r in similar_pairs(df, "path", ["grp"], k=k).collect()}
    want = set()
    by_group = {}
    for g, s in rows:
        by_group.setdefault(g, set()).add(s)
    for g, vals in by_group.items():
        for a, b in itertools.permutations(sorted(vals), 2):
            d = _lev(a, b)
            if d <= k:
                want.add((g, a, b, d))
    assert got == want


def test_similar_pairs_without_groups(spark):
    df = spark.createDataFrame([("kitten",), ("sitting",), ("kitten",), ("mitten",)], "u string")
    got = {(r[0], r[1]) for r in similar_pairs(df, "u", k=1).select("value_a", "value_b").collect()}
    assert got == {("kitten", "mitten"), ("mitten", "kitten")}


def test_no_cartesian_product_in_plan(spark):
    df = spark.createDataFrame([("a", "/x"), ("a", "/y")], "grp string, path string")
    plan = similar_pairs(df, "path", ["grp"], k=2)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("q,k", [(1, 1), (2, 2), (3, 1), (3, 3), (2, 0)])
def test_prefix_filter_with_repeated_grams(spark, q, k):
    # Small alphabets repeat grams inside a string (the occurrence
    # numbering matters) and a shared prefix makes one gram very common.
    rng = random.Random(100 * q + k)
    vals = set()
    while len(vals) < 70:
        body = "".join(rng.choice("ab" if len(vals) % 2 else "abc") for _ in range(rng.randint(0, 16)))
        vals.add(("http://" if len(vals) % 3 == 0 else "") + body)
    rows = [("g", v) for v in sorted(vals)]
    df = spark.createDataFrame(rows, "grp string, s string")
    got = {(r["value_a"], r["value_b"], r["levenshtein_distance"])
           for r in similar_pairs(df, "s", ["grp"], k=k, q=q).collect()}
    want = {(a, b, _lev(a, b)) for a, b in itertools.permutations(sorted(vals), 2)
            if _lev(a, b) <= k}
    assert got == want


def test_shared_prefix_does_not_become_an_all_pairs_bucket(spark):
    # 300 URLs of one length behind the same long prefix: a segment of the
    # prefix matches all of them, but the rarest grams sit in the suffixes.
    from logloom.operators.similarity import _prefix_join, with_signatures
    rng = random.Random(7)
    vals = sorted({"https://shop.example.com/item/" + "".join(rng.choice("abcdefghijklmnop") for _ in range(8))
                   for _ in range(300)})
    base = with_signatures(spark.createDataFrame([(0, v) for v in vals], "_g int, _s string"))
    candidates = _prefix_join(base, ["_g"], k=2, q=3).distinct().count()
    all_pairs = len(vals) * (len(vals) - 1) // 2
    assert candidates < all_pairs // 20
    got = {(r["value_a"], r["value_b"]) for r in
           similar_pairs(spark.createDataFrame([(v,) for v in vals], "u string"), "u", k=2).collect()}
    want = {(a, b) for a, b in itertools.permutations(vals, 2) if _lev(a, b) <= 2}
    assert got == want


def _candidates(spark, values, k, q=3):
    """Distinct candidate pairs of both joins."""
    from pyspark.sql import functions as F
    from logloom.operators.similarity import _deletion_join, _prefix_join, with_signatures
    base = with_signatures(spark.createDataFrame([(0, v) for v in sorted(set(values))], "_g int, _s string"))
    long_min = q * (k + 1)
    return _deletion_join(base.filter(F.col("_len") < long_min + k), ["_g"], k, long_min).unionByName(
        _prefix_join(base.filter(F.col("_len") >= long_min), ["_g"], k, q)).distinct()


def _random_strings(kind, n, rng):
    word = lambda letters, lo, hi: "".join(rng.choice(letters) for _ in range(rng.randint(lo, hi)))
    return {"binary": lambda: word("ab", 12, 24), "ids": lambda: f"/product/{rng.randint(0, 10**6):06d}/view",
            "long ids": lambda: f"https://shop.example.com/p/{rng.randint(0, 10**6):06d}", "same": lambda: "a" * rng.randint(9, 40)}[kind], n


@pytest.mark.parametrize("kind,k", [("binary", 2), ("ids", 2), ("same", 3), ("long ids", 1)])
def test_low_entropy_strings_equal_brute_force(spark, kind, k):
    rng = random.Random(11)
    make, n = _random_strings(kind, 260, rng)
    values = sorted({make() for _ in range(n)})
    for v in values[:40]:  # near copies
        at = rng.randrange(len(v))
        values.append(v[:at] + rng.choice("ab1") + v[at + rng.randint(0, 1):])
    values = sorted(set(values))
    df = spark.createDataFrame([(v,) for v in values], "u string")
    got = {(r[0], r[1], r[2]) for r in similar_pairs(df, "u", k=k).select("value_a", "value_b", "levenshtein_distance").collect()}
    assert got == {(a, b, d) for a, b in itertools.permutations(values, 2) if abs(len(a) - len(b)) <= k and (d := _lev(a, b)) <= k}


@pytest.mark.parametrize("kind", ["binary", "ids"])
def test_low_entropy_candidates_are_few(spark, kind):
    """At most 20 candidates a result, and far from all pairs."""
    rng = random.Random(5)
    make, n = _random_strings(kind, 3000, rng)
    values = sorted({make() for _ in range(n)})
    found = similar_pairs(spark.createDataFrame([(v,) for v in values], "u string"), "u", k=2).count() // 2
    candidates = _candidates(spark, values, 2).count()
    assert found <= candidates <= 20 * found and candidates < len(values) ** 2 // 40


def test_bounds_hold_for_random_edits(spark):
    """An edit changes 2 and 4 signature bits at most, and gram prefixes of two
    strings within k edits share a gram at near places."""
    from pyspark.sql import functions as F
    from logloom.operators.similarity import content_signature, gram_prefixes, with_signatures
    rng = random.Random(2)
    pairs = []
    for i in range(300):
        a = "".join(rng.choice("abc/1é") for _ in range(rng.randint(12, 30)))
        b = list(a)
        k = rng.randint(1, 3)
        for _ in range(k):
            at = rng.randrange(len(b))
            b[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "a"])
        pairs.append((i, a, "".join(b), _lev(a, "".join(b))))
    df = spark.createDataFrame(pairs, "i int, a string, b string, d int")
    for n in (1, 2):
        bits = F.bit_count(content_signature(F.col("a"), n).bitwiseXOR(content_signature(F.col("b"), n)))
        assert df.where(bits > 2 * n * F.col("d")).count() == 0
    for k in (1, 2, 3):
        near = [(a, b) for _, a, b, d in pairs if d <= k and min(len(a), len(b)) >= 3 * (k + 1)]
        base = spark.createDataFrame([(0, s) for s in sorted({s for p in near for s in p})], "_g int, _s string")
        base = with_signatures(base)
        own = {}
        for r in gram_prefixes(base, ["_g"], k, 3).collect():
            own.setdefault(r["_s"], []).append((r["_gram"], r["_pos"]))
        assert all(len(g) <= 3 * k + 1 for g in own.values())
        assert all(any(g == h and abs(p - w) <= k for g, p in own[a] for h, w in own[b]) for a, b in near)
