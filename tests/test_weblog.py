"""Parser, cleaning and split (P-01..P-13, S-01..S-03)."""

from pyspark.sql import functions as F

from logloom.functions.logformat import LOG_FIELDS, LOG_PATTERN
from logloom.operators import weblog as W

GOOD = ('10.1.0.1 - u5 [01/Jan/2024:10:30:00 +0000] "GET /a/b?x=1&y=%41 HTTP/1.1" 200 512 '
        '"https://ref.example.com/p" "ua/1"')
LINES = [
    GOOD,
    GOOD + " 7",                                                     # gzip ratio
    '::1 - - [01/Jan/2024:10:30:00 +0100] "POST /x HTTP/2.0" 404 0 "-" "ua"',
    '10.1.0.1 - u5 [01/Jan/2024:10:30:00 +0000] "GET /a HTTP/1.1" 200 5 "" "ua"',  # blank referer
    '10.1.0.1 - u5 [01/Jan/2024:10:30:00 +0000] "GET /a HTTP/1.1" 200 5 "r" "   "',  # blank agent
    'upstream error id=3',
    '10.1.0.1 - u\x005 [01/Jan/2024:10:30:00 +0000] "GET /a HTTP/1.1" 200 5 "r" "ua"',  # NUL
    '10.1.0.1 - NaN [01/Jan/2024:10:30:00 +0000] "GET /a HTTP/1.1" 200 5 "r" "ua"',  # NaN text
]


def _lines(spark):
    return spark.createDataFrame([(v,) for v in LINES], "value string")


def test_parse_equals_per_group_extract(spark):
    lines = _lines(spark)
    fast = W.parse_access_log(lines, keep_ratio=True).collect()
    slow = lines.select(*[F.regexp_extract("value", LOG_PATTERN, i + 1).alias(n)
                          for i, n in enumerate(LOG_FIELDS)]).collect()
    for f, s in zip(fast, slow):
        for name in ["remote_addr", "remote_usr", "date_time", "req_method", "req_uri",
                     "http_ver", "http_referer", "user_agent"]:
            assert f[name] == s[name]
        assert f["status"] == (int(s["status"]) if s["status"] else None)
        assert f["gzip_ratio"] == (int(s["gzip_ratio"]) if s["gzip_ratio"] else None)
        assert f["date"] == s["date_time"][:11]


def test_clean_drops_blank_nan_and_unparsed(spark):
    cleaned = W.clean_log(W.parse_access_log(_lines(spark))).collect()
    assert len(cleaned) == 4  # GOOD, GOOD+ratio, IPv6 line, NUL user
    assert all(r["http_referer"] for r in cleaned)


def test_rejects(spark):
    rej = [r["value"] for r in W.rejected_lines(_lines(spark)).collect()]
    assert rej == ["upstream error id=3"]


def test_time_and_url_columns(spark):
    df = W.add_time_columns(W.add_url_columns(W.clean_log(W.parse_access_log(_lines(spark)))))
    r = df.filter(F.col("req_method") == "POST").first()
    assert r["domain"] == "Unknown" and r["clean_path"] == "/x"
    assert r["dateunixtimest"] == 1704101400 and r["day_of_week"] == 2
    g = df.filter(F.col("req_uri").startswith("/a/b")).first()
    assert list(g["clean_query_list"]) == ["x=1", "y=A"] and g["fabstime"] == 10.5


def test_parse_plan_has_barrier_and_no_python(spark):
    plan = W.clean_log(W.parse_access_log(_lines(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "BatchEvalPython" not in plan
    # the cleaning predicate must not repeat the parse regex
    assert plan.count("regexp_replace") <= 2


def test_split_known_list_and_registry(spark):
    df = spark.createDataFrame([("a.com",), ("x.org",), ("b.com",)], "domain string")
    k, u = W.split_known(df)
    assert sorted(r[0] for r in k.collect()) == ["a.com", "b.com"]
    reg = spark.createDataFrame([("x.org",)], "d string")
    k2, u2 = W.split_known(df, reg)
    assert [r[0] for r in k2.collect()] == ["x.org"] and u2.count() == 2


def test_blank_domain_filter(spark):
    df = spark.createDataFrame([("",), ("a",)], "domain string")
    assert df.filter(F.col("domain") == "").count() == 1


def test_recursive_text_read(spark, tmp_path):
    from logloom.sources.tables import read_text
    deep = tmp_path / "logs" / "a" / "b"
    deep.mkdir(parents=True)
    (tmp_path / "logs" / "top.log").write_text(GOOD + "\n")
    (deep / "deep.log").write_text(GOOD + "\n")
    assert read_text(spark, str(tmp_path / "logs"), recursive=True).count() == 2


def test_hits_by_domain(spark):
    hits = {r["domain"]: r["hits"] for r in W.hits_by_domain(
        W.clean_log(W.parse_access_log(_lines(spark)))).collect()}
    assert hits == {"ref.example.com": 2, "Unknown": 2}


def test_indexed_columns_match_string_indexer_and_encoder(spark):
    """The last category has no slot: its rows are all zero."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    from pyspark.ml.functions import vector_to_array
    rows = [("GET", "a.com")] * 5 + [("POST", "b.com")] * 3 + [("GET", "c.com")] * 3 + [("PUT", "d.com")]
    df = spark.createDataFrame(rows, "req_method string, domain string")
    columns = ["req_method", "domain"]

    def collect(out):
        return sorted(tuple(map(str, r)) for r in out.select(
            *columns, *(f"{c}_index" for c in columns), *(vector_to_array(f"{c}_onehot").alias(c[0]) for c in columns)).collect())

    want = df
    for c in columns:
        want = StringIndexer(inputCol=c, outputCol=f"{c}_index").fit(want).transform(want)
        want = OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_onehot").fit(want).transform(want)
    got = W.add_indexed_columns(df)
    assert collect(got) == collect(want)
    assert {tuple(r[0]) for r in got.where("req_method = 'PUT'").select(vector_to_array("req_method_onehot")).collect()} == {(0.0, 0.0)}


def test_indexed_columns_with_missing_values(spark):
    from pyspark.ml.functions import vector_to_array
    df = spark.createDataFrame([("GET",), ("GET",), ("PUT",), (None,)], "m string")
    got = {r.m: (r.m_index, tuple(r.v)) for r in W.add_indexed_columns(df, ["m"], unknown=True).select("m", "m_index", vector_to_array("m_onehot").alias("v")).collect()}
    assert got == {"GET": (0.0, (1.0, 0.0)), "PUT": (1.0, (0.0, 1.0)), None: (2.0, (0.0, 0.0))}


def test_nan_text_and_nan_numbers_become_null(spark):
    rows = [(" " * 30 + "NaN", float("nan")), ("nan", 1.0), ("NAN ", 2.0), ("+NaN", 3.0), ("-NaN", 4.0), ("+nan", 5.0), ("-nan", 6.0), ("banana", 7.0), ("  ", 8.0)]
    got = W.blank_to_null(spark.createDataFrame(rows, "t string, d double")).collect()
    assert [r.t for r in got] == [None, None, None, None, None, "+nan", "-nan", "banana", None]
    assert [r.d for r in got] == [None, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]


def test_path_features_with_whole_items(spark):
    df = spark.createDataFrame([("/a", ["k=v"])], "clean_path string, clean_query_list array<string>")
    assert W.add_path_features(df).first()["url_features"] == ["k"]
    assert W.add_path_features(df, items="pairs").first()["url_features"] == ["k=v"]


def test_clean_filter_tests_all_texts_by_one_lambda(spark):
    plan = W.clean_log(W.parse_access_log(_lines(spark)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("trim(") <= 2  # not one copy a column, in the filter and above it


def test_clean_log_equals_blank_to_null_and_drop(spark):
    parsed = W.parse_access_log(_lines(spark))
    want = W.blank_to_null(parsed).na.drop()
    assert W.clean_log(parsed).exceptAll(want).count() == 0 and want.exceptAll(W.clean_log(parsed)).count() == 0


def test_extract_stages_without_persisting_and_keeps_columns(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame, Row
    from logloom.plans.weblog_queries import extracted_tables
    import datetime
    when = datetime.datetime(2024, 1, 1, 10, 30)
    events = [Row(event_id=i, ts=when, user_id=i, event_type="view") for i in range(40)]
    pages = [Row(page_id=i, url=f"http://{h}/some/path/{i}?a=1") for i, h in enumerate(["a.example.com", "b.example.com", "c.org"])]
    spark.createDataFrame(events).write.parquet(str(tmp_path / "events.parquet"))
    spark.createDataFrame(pages).write.parquet(str(tmp_path / "pages.parquet"))
    want = W.extract_log(_fixture_lines(spark, str(tmp_path)))

    def no_persist(self, *level):
        raise AssertionError("the extract is persisted")
    monkeypatch.setattr(DataFrame, "persist", no_persist)
    known, unknown = (spark.read.parquet(p) for p in extracted_tables(spark, str(tmp_path)))
    assert set(known.columns) == set(want.columns) == set(unknown.columns)
    keys = ["remote_addr", "date_time", "clean_path", "domain", "path_ngrams", "url_features", "domain_index"]
    both = known.select(keys).unionByName(unknown.select(keys))
    assert sorted(map(str, both.collect())) == sorted(map(str, want.select(keys).collect()))
    assert both.count() > 20


def _fixture_lines(spark, sf):
    from logloom.plans.weblog_fixture import weblog_text
    return weblog_text(spark, sf)
