import random

import pytest

from logloom.llm import url_rules
from logloom.llm.url_rules import RULES, judge_urls


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        for c in "?#":
            rest = rest.split(c, 1)[0]
        host, _, tail = rest.partition("/")
        path = rest[len(host):]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else default


def check(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(found) == len(urls)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == plain(r.url, rules), r.url


@pytest.mark.parametrize("seed", [1, 2])
def test_random_urls_and_nested_rules(spark, seed):
    rng = random.Random(seed)
    labels, parts = ["a", "b", "ab", "com", "org", "é", "a-b"], ["", "/", "/x", "/x/", "/xy", "/x/y", "/\x00", "/\U0010ffff"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))
    rules = [(host(), rng.choice(parts), rng.choice(["allow", "block"])) for _ in range(60)]
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice([str.upper, str])(host())}{rng.choice(parts)}{rng.choice(['', '?a=/x', '#/x', 'z'])}" for _ in range(1500)]
    check(spark, urls + urls[:300], rules)


def test_edges(spark):
    urls = [None, "", "no scheme", "http://", "://org/", "http://ORG", "http://org/", "http://x.org/?q", "http://xorg/", "http://org:80/",
            "http://example.org/en/1", "http://b.example.org/en/12", "http://example.org/en/2", "http://a?b://org/", "http://" + "s." * 300 + "com/de/" + "x" * 100_000]
    check(spark, urls + urls, RULES)
    check(spark, urls, [("org", "", "block")])


def test_null_and_empty_rules_fit_nothing(spark):
    pages = spark.createDataFrame([(1, "http://org/", "k"), (None, None, None)], "page_id long, url string, key string")
    rules = spark.createDataFrame([(None, "/", "block"), ("", None, "block")], "host string, path string, verdict string")
    for found in (judge_urls(pages, rules), judge_urls(pages, rules.limit(0))):
        assert set(found.columns) == {"page_id", "url", "key", "host", "path", "rule", "verdict"}
        assert {(r.rule, r.verdict) for r in found.collect()} == {(None, "allow")}
    assert judge_urls(pages.limit(0), rules).collect() == []


def test_many_rules_over_many_ranges(spark):
    """Enough distinct keys for every range, with rules that cover several ranges and a host with a third of all."""
    rng = random.Random(4)
    urls = [f"http://{rng.choice(['hot', f'h{rng.randrange(500)}'])}.net/{rng.randrange(10**6)}" for _ in range(6000)]
    rules = [("net", "/", "allow"), ("hot.net", "/", "block")] + [("hot.net", f"/{k}", "allow") for k in range(1, 90)] + [(f"h{k}.net", "/9", "block") for k in range(300)]
    check(spark, urls, rules)


def test_oracle_names_the_same_columns():
    assert all(c in url_rules.oracle_sql() for c in ("page_id", "host", "path", "rule", "verdict"))


def test_any_input_columns_stand(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "b", "k", "r", "d")], "page_id long, url string, best string, key string, _row string, `a.b` string")
    rules = spark.createDataFrame([("ORG", "/", "block")], "host string, path string, verdict string")
    got = judge_urls(pages, rules).collect()[0]
    assert got.asDict() == {"page_id": 1, "url": "http://a.org/x", "best": "b", "key": "k", "_row": "r", "a.b": "d", "host": "a.org", "path": "/x", "rule": "org/", "verdict": "block"}


def test_a_host_of_many_labels(spark):
    """As many keys as the deepest rule has labels, not one that holds the whole host for each label."""
    check(spark, ["http://" + "s." * 200_000 + "com/de/x", "http://" + "s." * 200_000 + "b.com/", "http://a.b.com/fr/"], [("b.com", "/", "block"), ("com", "/", "allow"), ("com", "/de/", "block")])
