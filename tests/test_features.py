"""Feature transformers and the text functions."""

from pyspark.ml.feature import NGram, StringIndexer, Tokenizer
from pyspark.sql import functions as F

from logloom.functions import text, url
from logloom.operators import features as FE


def test_ngrams_match_ml_ngram(spark):
    df = spark.createDataFrame([(list("abcdefghijk"),), (list("abc"),), ([],)], "a array<string>")
    for n in (1, 2, 3, 9):
        ml = NGram(n=n, inputCol="a", outputCol="g").transform(df).select("g").collect()
        ours = df.select(text.ngrams("a", n).alias("g")).collect()
        assert [list(r[0]) for r in ml] == [list(r[0]) for r in ours]


def test_tokens_match_ml_tokenizer(spark):
    rows = [("Hello  World\tFoo ",), ("  ",), ("",), (" lead",), ("ÉCOLE Été\nx",)]
    df = spark.createDataFrame(rows, "t string")
    ml = Tokenizer(inputCol="t", outputCol="w").transform(df).select("w").collect()
    ours = df.select(text.tokens("t").alias("w")).collect()
    assert [list(r[0]) for r in ml] == [list(r[0]) for r in ours]


def test_characters_and_words(spark):
    r = spark.createDataFrame([("/a/b",)], "p string").select(
        text.characters("p").alias("c"), text.path_words("p").alias("w")).first()
    assert list(r["c"]) == ["/", "a", "/", "b"] and list(r["w"]) == ["a", "b"]


def test_index_labels_matches_string_indexer(spark):
    vals = ["x"] * 5 + ["y"] * 3 + ["z"] * 3 + ["w"]
    df = spark.createDataFrame([(v,) for v in vals], "c string").repartition(3)
    ours = {r["c"]: r["c_index"] for r in FE.index_labels(df, "c").collect()}
    model = StringIndexer(inputCol="c", outputCol="i").fit(df)
    assert ours == {lab: i for i, lab in enumerate(model.labels)}


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    mm = FE.minmax_scale(df, ["a", "b"])
    got = sorted(tuple(r["scaled_features"]) for r in mm.collect())
    assert got == [(0.0, 0.5), (1.0, 0.5)]
    z = FE.zscore_scale(df, ["a"]).select("a_z").collect()
    assert sorted(r[0] for r in z) == [-1.0, 1.0]


def test_count_vectorizer(spark):
    df = spark.createDataFrame([(["a=1", "b=2"],), (["a=1"],)], "p array<string>")
    vocabulary, out = FE.count_vectorize(df.unionByName(df.selectExpr("cast(null as array<string>) p")), "p", "v")
    assert {(r.term, r.n, r.term_index) for r in vocabulary.collect()} == {("a=1", 2, 0), ("b=2", 1, 1)}
    assert sorted([[tuple(x) for x in r.v] for r in out.collect()]) == [[], [], [(0, 1)], [(0, 1), (1, 1)]]


def test_flatten_query_words(spark):
    """F-13: parameter items split into words and flattened."""
    df = spark.createDataFrame([(["a=1", "b=2"],)], "q array<string>")
    r = df.select(url.flat_query_words("q").alias("w")).first()
    assert list(r["w"]) == ["a", "1", "b", "2"]



def test_hashed_entries_and_sql_buckets_equal_the_transformer(spark):
    import duckdb
    from logloom.plans.oracle_sql import hash_buckets
    terms = ["", "a", "ab", "abc", "abcd", "abcde", "k=v", "/ p r o d", "é中😀", "x" * 40, "a" * 7]
    df = spark.createDataFrame([(i, [t]) for i, t in enumerate(terms)], "i bigint, t array<string>")
    hashed = FE.hash_features(df, "t", "h", 1000)
    got = {r.i: (r.bucket, r.weight) for r in FE.hashed_entries(hashed, ["i"], "h").collect()}
    want = {r.i: (int(r.h.indices[0]), 1.0) for r in hashed.collect()}
    assert got == want
    db = duckdb.connect()
    db.execute("CREATE TABLE terms (term VARCHAR)")
    db.executemany("INSERT INTO terms VALUES (?)", [[t] for t in terms])
    assert dict(db.execute(f"WITH {hash_buckets('terms', 1000)} SELECT * FROM buckets").fetchall()) == {t: want[i][0] for i, t in enumerate(terms)}
    twice = spark.createDataFrame([(1, ["a", "a", "b"]), (2, [])], "i bigint, t array<string>")
    entries = FE.hashed_entries(FE.hash_features(twice, "t", "h", 1000), ["i"], "h").collect()
    assert sorted(r.weight for r in entries) == [1.0, 2.0] and {r.i for r in entries} == {1}


def test_log_vectors_are_sparse_and_reproducible(spark):
    from pyspark.ml.linalg import SparseVector, Vectors
    row = (Vectors.dense([1.0]), 200, 5, "/a/b/c", ["k=v"], 10.5, 3)
    df = spark.createDataFrame([row], ["req_method_onehot", "status", "body_bytes_sent", "clean_path", "clean_query_list", "fabstime", "day_of_week"])
    v = FE.log_vectors(df, 1000).first()["features"]
    assert v.size == 1005 and isinstance(v, SparseVector) and len(v.indices) == 8
    assert (v[0], v[1], v[2], v[1003], v[1004]) == (1.0, 200.0, 5.0, 10.5, 3.0)
