"""Levenshtein similarity joins (J-01, J-02, F-18).

``similar_pairs`` returns every ordered pair of distinct strings in the
same group whose edit distance is at most ``k``. It is exact and never
compares all pairs in a group; candidates come from equi-joins on
signatures and are verified with ``levenshtein(a, b, k)``.

Long strings (length >= q(k+1)) use prefix filtering on positional
q-grams (Ed-Join, Xiao et al., VLDB 2008). Within k edits every gram that
no edit touches is found in the other string, at a place at most k away
and in the same order. Each string's grams are ordered by their frequency
in the group, rarest first (then by gram and place). All grams before the
first kept one are destroyed in both strings, and at most k edits can
destroy few of them: a string's prefix ends where destroying all its grams
would take k + 1 edits (one edit reaches the grams within q places, so
that is q*k + 1 grams at most and k + 1 where they lie apart). So any such
pair shares a gram of both prefixes, at places and with lengths at most k
apart. Only those rare grams are joined: a prefix that many strings share
(``https://``, ``/api/``) sits at the end of the order and never becomes a
join key. The key holds gram, length band and place band, which splits a
gram that all strings have; one side goes to the two bands that lie within
k of its own value.

A second bound comes from the content: an edit changes the multiset of a
string's characters by two elements at most, and that of its two-character
runs by four. ``content_signature`` folds a multiset into 64 bits, so the
signatures of two strings within k edits differ in at most 2k and 4k bits;
a join compares these numbers before it gives a row.

In strings of few different letters every gram is frequent. Where a key
has more than ``HOT_STRINGS`` strings that are short enough for their
deletion variants to be bounded (``MAX_VARIANTS``), the key is taken out of
the gram join, and the strings that have such a key meet on deletion
variants instead. Both strings of a pair have the key, so none is lost.

Strings shorter than that have too few grams for the bound. Pairs whose
shorter member is short come from deletion neighbourhoods (as in FastSS):
two strings within k edits both reach a common string by deleting at most
k characters each, so such pairs share a variant. Short strings have few
variants, and two strings share one only if they agree on all but k
characters, which is far tighter than sharing one short segment.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _one_deletion(v: Column) -> Column:
    """Every string made by removing one character of ``v``."""
    n = F.length(v)
    return F.when(n > 0, F.transform(
        F.sequence(F.lit(1), n),
        lambda j: F.concat(F.substring(v, 1, j - 1), F.substring(v, j + 1, n)))
    ).otherwise(F.array().cast("array<string>"))


def _deletion_join(base: DataFrame, g: list[str], k: int, below: int | None) -> DataFrame:
    """Unordered candidate pairs (``_s`` < ``_r``) that share a string
    reachable from both by at most k deletions, keeping pairs whose shorter
    string is below ``below`` (all pairs without it).

    Within k edits, deleting the substituted and unmatched characters of
    each side leaves a common string, so every result pair shares a
    variant. The variants of a row are built inside the row (no shuffle);
    for strings shorter than q(k+1)+k there are at most sum C(L, i) of
    them. Strings of length <= k all share the empty variant; every such
    pair is within k, so that key's candidates are all results."""
    cur = base.select(*g, "_s", "_len", "_sig", F.array("_s").alias("_vs"))
    for _ in range(k):
        # One projection per level: the next level reads this column.
        cur = cur.select(*g, "_s", "_len", "_sig", F.array_distinct(F.concat(
            "_vs", F.flatten(F.transform("_vs", _one_deletion)))).alias("_vs"))
    # ``_vs`` always holds the string itself. The outer form keeps Catalyst
    # from inferring ``size(_vs) > 0`` and pushing that filter, with the
    # whole variant expression inlined, below the length filter.
    var = cur.select(*g, "_s", "_len", "_sig", F.explode_outer("_vs").alias("_v"))
    other = var.select(*g, F.col("_s").alias("_r"), F.col("_len").alias("_rlen"), F.col("_sig").alias("_rsig"), "_v")
    kept = _alike(k)
    if below is not None:
        kept &= F.least("_len", "_rlen") < below
    return var.join(other, [*g, "_v"]).filter(kept).select(*g, "_s", "_r")


def content_signature(c: Column, n: int) -> Column:
    """64 bits of the multiset of ``n``-character runs: the j-th copy of a
    run flips one bit. Strings whose multisets differ by d elements have
    signatures that differ in d bits at most."""
    places = F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1)))
    runs = F.array_sort(F.transform(places, lambda i: F.substring(c, i, n)))
    # In the sorted runs the j-th copy stands j places behind the first.
    bits = F.transform(runs, lambda x, i: F.pmod(F.xxhash64(x, i - F.array_position(runs, x)), F.lit(64)))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b.cast("int"))))


def with_signatures(base: DataFrame) -> DataFrame:
    """``_s`` with its length and the signatures of its characters and of its
    two-character runs."""
    s = F.col("_s")
    return base.withColumn("_len", F.length(s)).withColumn("_sig", F.array(content_signature(s, 1), content_signature(s, 2)))


def _alike(k: int) -> Column:
    """Length and content bounds of a pair that is within k edits."""
    apart = lambda i: F.bit_count(F.get("_sig", F.lit(i)).bitwiseXOR(F.get("_rsig", F.lit(i))))
    return (F.col("_s") < F.col("_r")) & (F.abs(F.col("_len") - F.col("_rlen")) <= k) & (apart(0) <= 2 * k) & (apart(1) <= 4 * k)


HOT_STRINGS = 64
MAX_VARIANTS = 2500


def variant_length(k: int) -> int:
    """The longest string with at most ``MAX_VARIANTS`` variants of up to k
    deletions."""
    n = k
    while sum(math.comb(n + 1, i) for i in range(k + 1)) <= MAX_VARIANTS and n < MAX_VARIANTS:
        n += 1
    return n


def _edits_to_destroy(places: Column, q: int) -> Column:
    """Fewest edits that touch every gram at these (sorted) places: an edit
    reaches the grams that start within q places of the first one left."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("upto"))
    step = lambda a, p: F.when(p > a["upto"], F.struct((a["n"] + 1).alias("n"), (p + F.lit(q - 1)).alias("upto"))).otherwise(a)
    return F.aggregate(places, start, step, lambda a: a["n"])


def gram_prefixes(base: DataFrame, g: list[str], k: int, q: int) -> DataFrame:
    """(group, _s, _len, _sig, _gram, _pos): each string's prefix, its rarest
    grams up to the first that k edits can't destroy with all before it."""
    # Never empty for these lengths; the outer form avoids an inferred
    # filter that would evaluate the gram array twice.
    grams = base.select(*g, "_s", "_len", "_sig", F.posexplode_outer(F.transform(
        F.sequence(F.lit(0), F.col("_len") - q),
        lambda i: F.substring(F.col("_s"), i + 1, q))).alias("_pos", "_gram"))
    # Gram frequency in the group: partial + final aggregate, so a gram in
    # every string is summed inside each task; joined back on the gram
    # (AQE broadcasts the counts when small, and splits a hot gram's rows).
    freq = grams.groupBy(*g, "_gram").agg(F.count(F.lit(1)).alias("_f"))
    # The window is partitioned by the string: it holds one string's grams.
    by_str = Window.partitionBy(*g, "_s").orderBy("_f", "_gram", "_pos")
    ranked = grams.join(freq, [*g, "_gram"]).withColumn("_rank", F.row_number().over(by_str)).filter(F.col("_rank") <= q * k + 1)
    # Per string at most q*k + 1 grams are gathered.
    rows = ranked.groupBy(*g, "_s", "_len", "_sig").agg(F.array_sort(F.collect_list(F.struct("_rank", "_gram", "_pos"))).alias("_grams"))
    upto = lambda n: _edits_to_destroy(F.array_sort(F.transform(F.slice("_grams", 1, n), lambda x: x["_pos"])), q)
    enough = F.filter(F.sequence(F.lit(1), F.size("_grams")), lambda n: upto(n) > F.lit(k))
    cut = rows.withColumn("_n", F.coalesce(F.get(enough, F.lit(0)), F.size("_grams")))
    return cut.select(*g, "_s", "_len", "_sig", F.explode(F.slice("_grams", 1, F.col("_n"))).alias("_e")).select(
        *g, "_s", "_len", "_sig", F.col("_e._gram").alias("_gram"), F.col("_e._pos").alias("_pos"))


def _bands(value: str, k: int) -> Column:
    """The bands (2k + 1 wide) of the values within k of ``value``: one or
    two."""
    w = 2 * k + 1
    return F.array_distinct(F.array(F.floor((F.col(value) - k) / w), F.floor((F.col(value) + k) / w)))


def _prefix_join(base: DataFrame, g: list[str], k: int, q: int) -> DataFrame:
    """Unordered candidate pairs (``_s`` < ``_r``) of strings of length >=
    q(k+1): those that share a prefix gram at near places, or, where a key
    has many short strings, a deletion variant."""
    w = 2 * k + 1
    prefix = gram_prefixes(base, g, k, q).checkpoint(eager=True)  # three branches read it
    key = [*g, "_gram", "_lb", "_pb"]
    own = prefix.withColumn("_lb", F.floor(F.col("_len") / w)).withColumn("_pb", F.floor(F.col("_pos") / w))
    near = prefix.withColumn("_lb", F.explode(_bands("_len", k))).withColumn("_pb", F.explode(_bands("_pos", k)))
    hot = own.groupBy(*key).agg(F.count(F.lit(1)).alias("_c")).filter(
        (F.col("_c") > HOT_STRINGS) & ((F.col("_lb") + 1) * w - 1 + k <= variant_length(k))).select(*key).checkpoint(eager=True)
    other = near.select(*g, F.col("_s").alias("_r"), F.col("_len").alias("_rlen"), F.col("_sig").alias("_rsig"), F.col("_pos").alias("_rpos"), "_gram", "_lb", "_pb")
    met = own.join(hot, key, "left_anti").join(other, key).filter(
        _alike(k) & (F.abs(F.col("_pos") - F.col("_rpos")) <= k)).select(*g, "_s", "_r")
    if hot.isEmpty():
        return met
    crowded = near.join(hot, key, "left_semi").select(*g, "_s", "_len", "_sig").distinct()
    return met.unionByName(_deletion_join(crowded, g, k, None))


def similar_pairs(df: DataFrame, value_col: str, group_cols: list[str] | tuple = (),
                  k: int = 2, left: str = "value_a", right: str = "value_b",
                  distance_col: str = "levenshtein_distance", q: int = 3) -> DataFrame:
    if k < 0:
        raise ValueError("k must be >= 0")
    if q < 1:
        raise ValueError("q must be >= 1")
    g = list(group_cols)
    if not g:
        # One group over the whole table; the join keys below still spread
        # the work by gram and variant.
        df = df.withColumn("_g", F.lit(0))
        g = ["_g"]
    # The distinct values feed several branches: checkpoint them once (the
    # shared folder in spark.checkpoint.dir) so the input is read once.
    from logloom.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    base = (df.select(*g, F.col(value_col).alias("_s")).filter(F.col("_s").isNotNull())
              .distinct())
    base = with_signatures(base).checkpoint(eager=True)
    # AQE sizes the distinct output by bytes, which can leave fewer
    # partitions than task slots for the CPU-heavy signature generation.
    # Spread it once and checkpoint that, so each branch reads it without
    # a shuffle of its own.
    slots = df.sparkSession.sparkContext.defaultParallelism
    if base.rdd.getNumPartitions() < slots:
        base = base.repartition(slots).checkpoint(eager=True)

    # A pair within k whose shorter string is below q(k+1) has both
    # lengths below q(k+1)+k: deletion variants of those strings cover it.
    long_min = q * (k + 1)
    cand = (_deletion_join(base.filter(F.col("_len") < long_min + k), g, k, long_min)
            .unionByName(_prefix_join(base.filter(F.col("_len") >= long_min), g, k, q)))

    # Verified where they meet, so only results are shuffled; each unordered
    # pair once (a pair can meet on several signatures), then both orders.
    dist = F.levenshtein("_s", "_r", k)
    found = cand.select(*g, "_s", "_r", dist.alias("_d")).filter(F.col("_d") >= 0).dropDuplicates([*g, "_s", "_r"])
    out = found.select(*g, F.inline(F.array(
        F.struct(F.col("_s").alias("_s"), F.col("_r").alias("_r"), F.col("_d").alias("_d")),
        F.struct(F.col("_r").alias("_s"), F.col("_s").alias("_r"), F.col("_d").alias("_d")))))
    keep = [c for c in g if c != "_g"]
    return out.select(*keep, F.col("_s").alias(left), F.col("_r").alias(right),
                      F.col("_d").cast("bigint").alias(distance_col))
