"""Access-log ETL (P-01..P-13, F-01..F-12 applied to the log).

``parse_access_log`` -> ``clean_log`` -> ``add_url_columns`` ->
``add_time_columns`` -> ``add_path_features`` -> ``add_indexed_columns``;
``extract_log`` chains them into the 28-column extracted table.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions import logtime, text, url
from logloom.functions.logformat import LOG_FIELDS, LOG_PATTERN, REGISTERED_DOMAINS

PARSED_COLUMNS = [
    "remote_addr", "remote_usr", "date_time", "date", "time", "req_method",
    "req_uri", "http_ver", "status", "body_bytes_sent", "http_referer", "user_agent",
]

_SEP = "\u0000"


def _split_fields(value: Column, matched: Column, parts: Column) -> list[Column]:
    """All eleven groups with two regex evaluations per line instead of
    eleven: one ``rlike`` and one whole-line ``regexp_replace`` that writes
    the groups NUL-separated (``parts``). A field that itself holds a NUL
    changes the part count and falls back to ``regexp_extract`` for that
    row, so the result always equals per-group extraction."""
    n = len(LOG_FIELDS)
    return [
        F.when(~matched, F.lit(""))
        .when(F.size(parts) == n, parts[i])
        .otherwise(F.regexp_extract(value, LOG_PATTERN, i + 1))
        .alias(name)
        for i, name in enumerate(LOG_FIELDS)
    ]


def parse_access_log(lines: DataFrame, value_col: str = "value",
                     keep_ratio: bool = False) -> DataFrame:
    """P-01, P-02, P-04, P-05: fields, date/time substrings, int casts.

    Unparsed lines give '' in every field (kept here; ``clean_log`` drops
    them). Casts are ``try_cast`` so '' becomes null under ANSI mode.

    The typed record leaves through one ``inline`` (a Generate node). It
    stops Catalyst from pushing later predicates (``na.drop``, domain
    filters) below the parse, where each reference to a field would be
    replaced by its regex: with the barrier every regex runs once per line.
    """
    n = len(LOG_FIELDS)
    template = _SEP.join(f"${i}" for i in range(1, n + 1))
    v = F.col(value_col)
    stage = lines.select(
        v.alias("_v"),
        v.rlike(LOG_PATTERN).alias("_m"),
        F.split(F.regexp_replace(v, f"(?:{LOG_PATTERN})(?s:.*)", template), _SEP).alias("_p"),
    )
    raw = dict(zip(LOG_FIELDS, _split_fields(F.col("_v"), F.col("_m"), F.col("_p"))))
    typed = [
        raw["remote_addr"], raw["remote_usr"], raw["date_time"],
        F.substring(raw["date_time"], 1, 11).alias("date"),
        F.substring(raw["date_time"], 13, 8).alias("time"),
        raw["req_method"], raw["req_uri"], raw["http_ver"],
        raw["status"].try_cast("int").alias("status"),
        raw["body_bytes_sent"].try_cast("bigint").alias("body_bytes_sent"),
        raw["http_referer"], raw["user_agent"],
    ]
    if keep_ratio:
        typed.append(raw["gzip_ratio"].try_cast("bigint").alias("gzip_ratio"))
    return stage.select(F.inline(F.array(F.struct(*typed))))


def rejected_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """P-03 rejects: lines the access-log pattern does not match."""
    return lines.filter(~F.col(value_col).rlike(LOG_PATTERN))


def accepted_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    return lines.filter(F.col(value_col).rlike(LOG_PATTERN))


# Text a double cast reads as NaN, surrounded by whitespace or control
# characters: any case without a sign, exactly NaN after one. Tested with a pattern rather than
# ``isnan(try_cast(c AS double))``: that cast throws and catches an
# exception for every non-numeric field, which dominates the cost.
_NAN_TEXT = r"^[\x00-\x20]*(?:(?i:nan)|[+-]NaN)[\x00-\x20]*$"


def _to_null(name: str, dtype: str) -> Column:
    c = F.col(name)
    if dtype in ("double", "float"):
        return F.when(~F.isnan(c), c).alias(name)
    if dtype != "string":
        # An integral value is never blank or NaN text.
        return c.alias(name)
    return F.when(~_missing_text(c), c).alias(name)


def _missing_text(c: Column) -> Column:
    maybe_nan = c.contains("a") | c.contains("A")
    return c.isNull() | (F.trim(c) == "") | (maybe_nan & c.rlike(_NAN_TEXT))


def blank_to_null(df: DataFrame) -> DataFrame:
    """P-06: null, blank (spaces only) or NaN text becomes null."""
    return df.select(*[_to_null(n, t) for n, t in df.dtypes])


def clean_log(parsed: DataFrame) -> DataFrame:
    """P-06 + P-07: drop every row with a missing field. An unparsed line
    is all blank, so it goes too.

    A row that stays has no field that ``blank_to_null`` would change, so its
    conditions are the filter alone. The text columns are tested by one
    lambda over their array: a copy of the conditions for each column makes
    one generated method that the JVM doesn't compile."""
    texts = [F.col(n) for n, t in parsed.dtypes if t == "string"]
    present = [_to_null(n, t).isNotNull() for n, t in parsed.dtypes if t != "string"]
    if texts:
        present.append(F.forall(F.array(*texts), lambda c: ~_missing_text(c)))
    out = parsed
    for kept in present:
        out = out.where(kept)
    return out


def add_url_columns(df: DataFrame) -> DataFrame:
    """F-01..F-04: the URI is decoded first, then split; the referer gives
    the domain."""
    dec = url.decode_uri("req_uri")
    return (df.withColumn("dec_req_uri", dec)
              .withColumn("clean_path", url.url_path("dec_req_uri"))
              .withColumn("clean_query_list", url.query_list("dec_req_uri"))
              .withColumn("domain", url.referer_domain("http_referer")))


def add_time_columns(df: DataFrame) -> DataFrame:
    """F-05..F-08."""
    ts = logtime.parse_log_time("date_time")
    return (df.withColumn("fdate_time", ts)
              .withColumn("dateunixtimest", logtime.epoch_seconds("fdate_time"))
              .withColumn("fabstime", logtime.decimal_hour("fdate_time"))
              .withColumn("day_of_week", logtime.day_of_week("fdate_time")))


def add_path_features(df: DataFrame, n: int = 9, num_features: int = 16384, items: str = "keys") -> DataFrame:
    """F-09, M-01, F-11, F-12, M-03: character n-grams of the path plus
    parameter keys (``items="keys"``) or whole ``k=v`` items
    (``items="pairs"``), hashed."""
    if items not in ("keys", "pairs"):
        raise ValueError("items must be 'keys' or 'pairs'")
    params = F.transform("clean_query_list", url.param_key) if items == "keys" else F.col("clean_query_list")
    out = (df.withColumn("path_characters", text.characters("clean_path"))
             .withColumn("path_ngrams", text.ngrams("path_characters", n))
             .withColumn("url_features", F.concat("path_ngrams", params)))
    return HashingTF(inputCol="url_features", outputCol="hash_url_features",
                     numFeatures=num_features).transform(out)


def add_indexed_columns(df: DataFrame, columns=("req_method", "domain"), unknown: bool = False) -> DataFrame:
    """M-05 + M-06: frequency-ordered index (ties alphabetical) and one-hot
    with the last category dropped (its rows are all zero), unless it is the
    only one.

    The index is the distributed rank of ``features.index_labels``, joined
    back on the value: no label list reaches the driver, AQE broadcasts the
    ranks only when they measure small and splits a hot value's rows. With
    ``unknown``, a missing value gets an index and a slot of its own after
    the labels; without it such a row is an error, as in StringIndexer."""
    from logloom.operators.features import index_labels
    for c in columns:
        ranks = index_labels(df.filter(F.col(c).isNotNull()), c, "_idx")
        n_labels = ranks.count()  # the rank table is staged: a cheap scan
        meta = {"ml_attr": {"type": "nominal", "num_vals": n_labels + int(unknown), "name": f"{c}_index"}}
        missing = F.lit(float(n_labels)) if unknown else F.raise_error(F.lit(f"missing value in {c}")).cast("double")
        idx = F.coalesce(F.col("_idx").cast("double"), missing)
        df = df.join(ranks, c, "left").withColumn(f"{c}_index", idx.alias(f"{c}_index", metadata=meta)).drop("_idx")
        several = n_labels + int(unknown) > 1
        df = OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_onehot", dropLast=several).fit(df).transform(df)
    return df


def extract_columns(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """The extracted table's plain columns: parsed fields, URL and time
    columns, without path features and indexes."""
    return add_time_columns(add_url_columns(clean_log(parse_access_log(lines, value_col))))


def extract_log(lines: DataFrame, value_col: str = "value", index: bool = True, indexes: list | None = None,
                unseen: str = "keep") -> DataFrame:
    """The extracted-log table (28 columns with the index columns).

    ``indexes`` are fitted label indexes (``features.LabelIndex``) of an
    earlier extract: the rows get their indexes and one-hot vectors instead
    of ones fitted on these rows, with ``unseen`` as the rule for new
    labels."""
    df = add_path_features(extract_columns(lines, value_col))
    if indexes is not None:
        for fitted in indexes:
            df = fitted.one_hot(df, unseen=unseen)
        return df
    return add_indexed_columns(df) if index else df


def without_domain(df: DataFrame, column: str = "domain") -> DataFrame:
    """P-13: the rows whose domain is empty text, as a plain host column of a
    referer like ``-`` has it (``referer_domain`` names those Unknown)."""
    return df.filter(F.col(column) == "")


def split_known(df: DataFrame, domains: list[str] | DataFrame = REGISTERED_DOMAINS,
                column: str = "domain") -> tuple[DataFrame, DataFrame]:
    """P-09: (known, unknown). A short list is an ``isin`` filter; a
    registry DataFrame becomes left-semi / left-anti joins, which AQE
    broadcasts only when the registry measures under the broadcast limit."""
    if isinstance(domains, DataFrame):
        reg = domains.select(F.col(domains.columns[0]).alias(column)).distinct()
        return df.join(reg, column, "left_semi"), df.join(reg, column, "left_anti")
    cond = F.col(column).isin(*domains)
    return df.filter(cond), df.filter(~cond)


def hits_by_domain(cleaned: DataFrame) -> DataFrame:
    """A-03: requests per referer domain (partial + final aggregate)."""
    return (cleaned.select(url.referer_domain("http_referer").alias("domain"))
                   .groupBy("domain").agg(F.count(F.lit(1)).alias("hits")))
