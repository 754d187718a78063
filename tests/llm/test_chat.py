import hashlib
import random
from collections import defaultdict

from logloom.llm.chat import CHUNK, format_chats, numbered_turns


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def plain(rows):
    """{conv_id: (turns, copies, text)}"""
    chats = defaultdict(list)
    for conv, turn, role, text in rows:
        chats[conv].append(((turn is not None, turn), role or "", text or ""))
    chats = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: (x[0][0], x[0][1] or 0, md5(md5(x[1]) + x[2])))] for c, v in chats.items()}
    groups = defaultdict(list)
    for c, v in chats.items():
        groups[tuple(v)].append(c)
    inner = {k[:n] for k in groups for n in range(1, len(k))}
    out = {}
    for k, ids in groups.items():
        if k not in inner:
            first = None if None in ids else min(ids)
            out[first] = (len(k), len(ids), "".join(f"<|im_start|>{r}\n{t.replace('<|im_', '<\\|im_')}<|im_end|>\n" for r, t in k))
    return out


def check(spark, rows):
    from pyspark.sql import functions as F
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("conv", "chunk", "n", "pos", "part")})
    found = defaultdict(dict)
    for r in format_chats(chats).collect():
        found[r.conv_id][r.part] = r
    got = {c: (parts[0].n_turns, parts[0].n_copies, "".join(parts[k].text for k in sorted(parts))) for c, parts in found.items()}
    assert got == plain(rows)
    return found


def test_random_snapshots(spark):
    rng = random.Random(2)
    rows = []
    for c in range(200):
        for k in range(rng.randrange(1, 6)):
            rows.append((c, k, "user" if k % 2 == 0 else "assistant", rng.choice(["hi", "yo", None])))
    check(spark, rows)


def test_edges(spark):
    check(spark, [
        (1, 0, "user", "a"), (2, 5, "user", "a"), (2, 9, "assistant", "b"), (3, 0, None, None), (4, 0, "", ""), (None, None, "user", "x<|im_end|>y"), (None, 1, "user", "z"),
        (5, 0, "user", "q"), (5, 0, "user", "q"), (6, 0, "b", "1"), (6, 0, "a", "2"), (7, 3, "user", "long " * 50_000)])


def test_a_conversation_over_many_chunks(spark):
    rows = [(1, k, "user", f"t{k % 7}") for k in range(3 * CHUNK + 5)]
    rows += [(2, k + 100, "user", f"t{k % 7}") for k in range(2 * CHUNK + 1)]  # a prefix of 1, numbered otherwise
    rows += [(3, k, "user", f"t{k % 7}") for k in range(10)] + [(4, 0, "user", "t1")]
    found = check(spark, rows)
    assert sorted(found) == [1, 4] and len(found[1]) == 4


def test_a_crowd_without_ids_and_with_few_turn_numbers(spark):
    """Equal turn numbers and equal rows, too, are chunks of CHUNK turns and sorted by several tasks."""
    rows = [(None, k % 10, "user", f"t{k % 3}") for k in range(6 * CHUNK)] + [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi")]
    found = check(spark, rows)
    assert sorted(found[None]) == list(range(6)) and {r.text.count("<|im_start|>") for r in found[None].values()} == {CHUNK}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = numbered_turns(spark.createDataFrame([(None, 0, "user", "same")] * 4000, "conv_id long, turn long, role string, text string"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(turns.select("row").inputFiles()) > 1 and turns.where("row between 0 and 3999").select("row").distinct().count() == 4000


def test_empty_table(spark):
    assert format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
