"""Operator 4: collapse logged snapshots of chats, then render the maximal conversations.

A chat that is logged after every turn appears as conversations of which one is a prefix of the next. Every turn gets a
rolling hash of all turns up to it: the running sums of two 64-bit hashes of (position, role, text). A conversation
whose last hash is the hash of an inner turn of another is a prefix of that other one, and an anti-join drops it. Of
equal conversations the one with the smallest id stays, with the number of its copies.

A conversation may hold any share of all rows, and so may one turn number. Turns get their positions from a distributed
sort (ranges of (conversation, turn, digest), equal rows split by a row number), so no key is one task. They are then
summed in chunks of ``CHUNK`` positions, and one row per chunk carries the sums of the chunks before. The rendered text
is one row per chunk, too, so no task gathers a whole endless conversation; the parts of a conversation, in order, are
its text.

Defined cases: a null conv_id is one conversation with null id; null turns come first; null role and text are empty;
turns with equal numbers are ordered by the md5 digest of the role's digest and the text, and repeated rows are turns of
their own; ``<|im_`` inside a text becomes ``<\\|im_``; an empty table gives an empty result. Other columns are ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.scratch import Scratch
from logloom.operators.sampling import global_row_index

CHUNK = 1024
NO_ID = -(1 << 63)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, digest, c1, c2, row): row counts the turns of all conversations in order; c1 and c2 hash
    the content."""
    turns = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = turns.select("*", F.md5(F.concat(F.md5("role"), "text")).alias("digest"), F.xxhash64(F.lit(1), "role", "text").alias("c1"), F.xxhash64(F.lit(2), "text", "role").alias("c2"))
    return global_row_index(turns, ["conv", "turn", "digest"], "row")


def first_rows(turns: DataFrame) -> DataFrame:
    """(conv, first): the row of each conversation's first turn."""
    return turns.groupBy("conv").agg(F.min("row").alias("first"))


def rolling_hashes(turns: DataFrame, firsts: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, pos, h1, h2) of each turn: h1 and h2 cover all turns up to pos, counted from 1."""
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    wide = "decimal(38,0)"
    placed = turns.select("conv", "row", "c1", "c2").join(firsts, "conv").withColumn("pos", F.col("row") - F.col("first") + 1)
    hashed = scratch.save(placed.select("conv", F.floor((F.col("pos") - 1) / CHUNK).alias("chunk"), "pos", *(F.xxhash64(F.lit(k), "pos", "c1", "c2").alias(f"t{k}") for k in (1, 2))), "hashed")
    sums = hashed.groupBy("conv", "chunk").agg(*(F.sum(F.col(t).cast(wide)).alias(t) for t in ("t1", "t2")))
    sums = sums.select("conv", "chunk", *(F.coalesce(F.sum(t).over(earlier), F.lit(0)).cast(wide).alias(f"{t}_before") for t in ("t1", "t2")))
    upto = Window.partitionBy("conv", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.select("conv", "chunk", "pos", *(F.sum(F.col(t).cast(wide)).over(upto).alias(t) for t in ("t1", "t2"))).join(sums, ["conv", "chunk"])
    return running.select("conv", "pos", *((F.col(f"t{i}") + F.col(f"t{i}_before")).cast(wide).alias(f"h{i}") for i in (1, 2)))


def maximal_conversations(rolled: DataFrame) -> DataFrame:
    """(conv, n_turns, n_copies) of the conversations that are no prefix of a longer one, one of each equal group."""
    last = rolled.groupBy("conv").agg(F.max_by(F.struct("pos", "h1", "h2"), "pos").alias("last")).select("conv", "last.*")
    groups = last.groupBy("pos", "h1", "h2").agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    # A hash is an inner one of some conversation if more turns than last turns have it.
    inner = rolled.groupBy("pos", "h1", "h2").agg(F.count("*").alias("n")).join(
        groups.select("pos", "h1", "h2", "n_copies"), ["pos", "h1", "h2"], "left").where("n > coalesce(n_copies, 0)")
    return groups.join(inner, ["pos", "h1", "h2"], "left_anti").select("conv", F.col("pos").alias("n_turns"), "n_copies")


def render(turns: DataFrame, firsts: DataFrame) -> DataFrame:
    """(conv, part, text) of the conversations in ``firsts``: the turns of each chunk, each with its role between turn
    marks."""
    clean = F.replace(F.col("text"), F.lit("<|im_"), F.lit("<\\|im_"))
    own = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), clean, F.lit("<|im_end|>\n"))
    part = F.floor((F.col("row") - F.col("first")) / CHUNK).cast("int")
    rows = turns.join(firsts, "conv").select("conv", part.alias("part"), F.struct("row", own.alias("own")).alias("turn"))
    return rows.groupBy("conv", "part").agg(F.array_sort(F.collect_list("turn")).alias("turns")).select("conv", "part", F.array_join("turns.own", "").alias("text"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, n_copies, text of each maximal conversation; parts count from 0."""
    scratch = Scratch(conversations.sparkSession, "chat")
    turns = numbered_turns(conversations)
    firsts = scratch.save(first_rows(turns), "firsts")
    rolled = scratch.save(rolling_hashes(turns, firsts, scratch), "rolled")
    kept = scratch.save(maximal_conversations(rolled).join(firsts, "conv"), "kept")
    return render(turns, kept.select("conv", "first")).join(kept, "conv").select(
        F.when(F.col("conv") != NO_ID, F.col("conv")).alias("conv_id"), "part", "n_turns", "n_copies", "text")


ORACLE_SQL = f"""WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(role) || text)) AS pos FROM r),
p AS (SELECT conv_id, pos, count(*) OVER (PARTITION BY conv_id) AS n,
    string_agg(role || chr(1) || text, chr(2)) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS prefix FROM t),
k AS (SELECT min(conv_id) AS conv_id, n AS n_turns, count(*) AS n_copies FROM p WHERE pos = n
    AND NOT EXISTS (SELECT 1 FROM p q WHERE q.pos < q.n AND q.pos = p.pos AND q.prefix = p.prefix) GROUP BY n, prefix)
SELECT t.conv_id, CAST((pos - 1) // {CHUNK} AS INT) AS part, any_value(n_turns) AS n_turns, any_value(n_copies) AS n_copies,
  string_agg('<|im_start|>' || role || chr(10) || replace(text, '<|im_', '<\\|im_') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM t JOIN k USING (conv_id) GROUP BY t.conv_id, (pos - 1) // {CHUNK}"""
