import math
import random

from pyspark.sql import functions as F

from corpusloom.operators.sample import (first_per_key, global_index, quota_sample, split_train_eval,
                                         take_first_n, take_first_n_per_group)
from tests.checks import assert_greedy


def test_quota_sample_equals_greedy_scan(spark):
    rng = random.Random(11)
    cases = []
    for c in range(12):
        n = rng.randint(0, 60)
        keys = rng.randint(1, 25)
        rows = [(f"{rng.random():.12f}", f"k{rng.randint(0, keys)}", rng.choice(["short", "mid", "long"]))
                for _ in range(n)]
        quotas = {"short": rng.randint(0, 6), "mid": rng.randint(0, 8), "long": rng.randint(0, 4)}
        cases.append((rows, quotas))
    for rows, quotas in cases:
        df = spark.createDataFrame(rows or [("0", "k", "none")], "ord string, key string, bucket string")
        if not rows:
            df = df.limit(0)
        got = {r["ord"] for r in quota_sample(df, "key", "bucket", quotas).collect()}
        assert_greedy(rows, quotas, got)


def test_first_per_key_and_take_first_n(spark):
    rows = [(f"{i:04d}", f"k{i % 7}") for i in range(100)]
    df = spark.createDataFrame(rows, "ord string, key string")
    f = first_per_key(df, "key")
    assert sorted(r["ord"] for r in f.collect()) == [f"{i:04d}" for i in range(7)]
    t = take_first_n(df, 10)
    assert sorted(r["ord"] for r in t.collect()) == [f"{i:04d}" for i in range(10)]
    assert take_first_n(df, 1000).count() == 100
    g = take_first_n_per_group(df.withColumnRenamed("key", "grp"), "grp", 2)
    assert g.count() == 14


def test_split_ratio_uses_ceil(spark):
    df = spark.createDataFrame([(f"{i:04d}",) for i in range(150)], "ord string")
    s = split_train_eval(df, 0.02)
    assert s.where(F.col("split") == "eval").count() == math.ceil(0.02 * 150)
    assert split_train_eval(df, 0.0).where(F.col("split") == "eval").count() == 0


def test_global_index_is_dense_and_ordered(spark):
    rng = random.Random(5)
    ords = [f"{rng.random():.12f}" for _ in range(300)]
    df = spark.createDataFrame([(o,) for o in ords], "ord string")
    got = sorted((r["idx"], r["ord"]) for r in global_index(df, "ord", partitions=5).collect())
    assert [i for i, _ in got] == list(range(300))
    assert [o for _, o in got] == sorted(ords)


def test_kth_value_through_small_and_equal_blocks(spark, monkeypatch):
    from corpusloom.operators import sample
    monkeypatch.setattr(sample, "SMALL_BLOCK", 3)
    rng = random.Random(6)
    rows = [(rng.choice("ab"), f"{rng.choice(['0000', '00001', 'ffff'])}{rng.randrange(40):02d}") for _ in range(300)] + [("c", "same")] * 20
    df = spark.createDataFrame(rows, "g string, ord string")
    values = {g: sorted(o for x, o in rows if x == g) for g in "abc"}
    for k in (1, 2, 17, 20, 150, 400):
        got = sample.kth_per_group(df, {g: k for g in "abcd"}, "g")
        assert got == {g: v[k - 1] for g, v in values.items() if len(v) >= k}
    everything = sorted(o for _, o in rows)
    assert sample.kth_order_value(df, 5) == everything[4] and sample.kth_order_value(df, 1000) is None
