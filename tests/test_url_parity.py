"""F-01..F-04 against Python's urllib on awkward inputs (FIXTURES.md D)."""

import urllib.parse


from logloom.functions import url

URIS = ["/a%20b+c", "/100%zz", "/%", "/a?x=1&y=2", "/a?x=&y=2&z", "/a;p=1?q=a+b", "//host/p?x=1",
        "/a#f?x=1", "/a?x=1#f", "*", "http://h/p?x=%2541", "/%ff%fe", "/%E4%BD%A0?k=%3D&a=b=c",
        "/a?x=1;y=2", "/a?=v", "", "/a?x=1&&y=%26", "/s?u=http://b.com/?z=1", "/a;b/c;d?x",
        "/%2fetc%3Fq=1", "/a%0Ab", "%20/a", "/p?x=a%0Ab", "android-app:x;y", "%09//h/p;q", "ftp:a;b/c;d",
        "/a%0D%0A?k=%0Dv", "%00/x", "HTTP:x;y"]
REFERERS = ["https://a.com/z", "-", "", "android-app://com.x/", "a.com/z", "http://u@h:80/",
            "https://a.com?x", "//c.com/x", " https://d.com/y", "ht\ntp://e.com/", "\x01//f.com"]


def _py(uri):
    dec = urllib.parse.unquote(uri)
    parsed = urllib.parse.urlparse(dec)
    items = [f"{k}={v}" for k, v in urllib.parse.parse_qsl(parsed.query)]
    return dec, parsed.path, items


def test_uri_functions_match_urllib(spark):
    df = spark.createDataFrame([(u,) for u in URIS], "u string")
    got = df.select("u", url.decode_uri("u").alias("d")).select(
        "u", "d", url.url_path("d").alias("p"), url.query_list("d").alias("q")).collect()
    for r in got:
        dec, path, items = _py(r["u"])
        assert r["d"] == dec, r["u"]
        assert r["p"] == path, r["u"]
        assert list(r["q"]) == items, r["u"]


def test_referer_domain_matches_urllib(spark):
    df = spark.createDataFrame([(u,) for u in REFERERS], "u string")
    got = {r["u"]: r["d"] for r in df.select("u", url.referer_domain("u").alias("d")).collect()}
    for ref in REFERERS:
        net = urllib.parse.urlparse(ref).netloc
        assert got[ref] == (net if net not in ("", "-") else "Unknown"), ref


def test_null_referer_is_unknown(spark):
    df = spark.createDataFrame([(None,)], "u string")
    assert df.select(url.referer_domain("u")).first()[0] == "Unknown"


def test_no_python_udf_in_plan(spark):
    df = spark.createDataFrame([(u,) for u in URIS], "u string")
    plan = df.select(url.query_list(url.decode_uri("u")))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
