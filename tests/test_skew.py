"""Hot keys: one conversation / one dedup key / one bucket holding most rows."""

import random

from pyspark.sql import functions as F

from corpusloom.operators.chat_records import chat_examples
from corpusloom.operators.sample import first_n_per_key, quota_sample
from corpusloom.sources.fixtures import chat_from_turns
from tests.checks import assert_greedy


def test_hot_conversation_is_trimmed_before_grouping(spark):
    roles = ["system"] + ["user", "assistant"] * 3000
    turns = [(0, i, r, f"t{i}") for i, r in enumerate(roles)] + [(1, 0, "user", "u"), (1, 1, "assistant", "a")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    chats = chat_from_turns(df, 12)
    sizes = {r["source_index"]: r["n"] for r in chats.select("source_index", F.size("messages").alias("n")).collect()}
    assert sizes[0] <= 13 and sizes[1] == 2
    got = sorted((r["source_index"], r["turn_index"], r["target_text"]) for r in chat_examples(chats, 12).collect())
    # system and the last eleven: an answer nobody asked for (t5990), then five pairs
    want = [(0, t, f"t{5992 + 2 * t}") for t in range(5)] + [(1, 0, "a")]
    assert got == sorted(want)


def test_hot_dedup_key(spark):
    rng = random.Random(9)
    rows = [(f"{rng.random():.12f}", "hot" if rng.random() < 0.6 else f"k{rng.randint(0, 300)}") for _ in range(4000)]
    df = spark.createDataFrame(rows, "ord string, key string")
    got = sorted(r["ord"] for r in first_n_per_key(df, 50, "key").collect())
    seen, want = set(), []
    for o, k in sorted(rows):
        if k not in seen:
            seen.add(k)
            want.append(o)
    assert got == want[:50]


def test_hot_bucket(spark):
    rng = random.Random(10)
    rows = [(f"{rng.random():.12f}", f"k{rng.randint(0, 500)}", "mid" if rng.random() < 0.9 else rng.choice(["short", "long"]))
            for _ in range(3000)]
    quotas = {"short": 20, "mid": 40, "long": 10}
    df = spark.createDataFrame(rows, "ord string, key string, bucket string")
    got = {r["ord"] for r in quota_sample(df, "key", "bucket", quotas).collect()}
    assert_greedy(rows, quotas, got)


def test_repeated_source_keys_pick_one_row(spark):
    rows = [(f"{i:04d}", f"k{i}") for i in range(50)] * 3      # every record present three times
    df = spark.createDataFrame(rows, "ord string, key string")
    out = first_n_per_key(df, 10, "key")
    assert sorted(r["ord"] for r in out.collect()) == [f"{i:04d}" for i in range(10)]
    q = quota_sample(df.withColumn("bucket", F.lit("mid")), "key", "bucket", {"mid": 7})
    assert q.count() == 7


def test_repeated_turns_are_kept(spark):
    turns = [(0, 0, "user", "q"), (0, 1, "assistant", "more"), (0, 1, "assistant", "more"), (0, 2, "user", "q"), (0, 3, "assistant", "more")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    for k, want in ((12, ["q", "more", "more", "q", "more"]), (4, ["q", "more", "more", "q", "more"]), (3, ["q", "more", "q", "more"])):
        got = chat_from_turns(df, k).first()["messages"]
        assert [m["content"] for m in got] == want
