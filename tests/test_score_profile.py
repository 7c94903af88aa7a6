import math
import random

import pytest

from corpusloom.operators import profile as P
from corpusloom.operators import score as SC
from tests.checks import assert_rank

LIDS = [[0, 10], [1, 11], [2], [], [4, 14]]


NAN, LOW = float("nan"), float("-inf")
# (logprobs, text, number of choices, letter or None)
PREDICTIONS = [
    ({0: -1.0, 1: -0.5}, None, 2, 1), ({10: -0.1, 1: -0.5}, None, 2, 0), ({0: -1.0, 1: -1.0}, None, 2, 0), ({2: -0.1, 1: -3.0}, None, 2, 1),
    ({2: -0.1, 1: -3.0}, None, 3, 2), ({14: -9.0}, "A", 5, 4), ({0: NAN, 11: -4.0}, None, 2, 1), ({0: LOW, 1: -1e30}, "b", 2, 1),
    ({0: -1e30}, None, 2, None), ({7: -0.1}, "a)", 4, 0), ({}, " c x", 4, 2), ({}, "E", 4, None), ({}, "", 4, None), ({}, None, 4, None),
    (None, "D.", 4, 3), (None, None, 4, None), (None, "\nA", 4, 0), (None, "\xa0\t b", 4, 1), (None, "\x85C", 4, 2), (None, "9", 4, None)]


def test_predicted_letters(spark):
    rows = [(i, *p[:3]) for i, p in enumerate(PREDICTIONS)]
    df = spark.createDataFrame(rows, "i int, logprobs map<int,double>, text string, num_choices int")
    got = {r["i"]: r["p"] for r in df.select("i", SC.predict(df, LIDS).alias("p")).collect()}
    for i, p in enumerate(PREDICTIONS):
        assert got[i] == p[3], p


def test_short_letter_table_is_refused(spark):
    df = spark.createDataFrame([({6: -0.1}, None, 7)], "logprobs map<int,double>, text string, num_choices int")
    with pytest.raises(Exception, match="the letter table has 5 letters"):
        df.select(SC.predict(df, LIDS)).collect()


def test_duplicate_metrics_are_refused(spark):
    m = spark.createDataFrame([("m", "hellaswag", 0.5), ("m", "hellaswag", 0.6)], "model string, dataset string, acc double")
    with pytest.raises(Exception, match="duplicate"):
        SC.accuracy_pivot(m, ["m"]).collect()


def test_metrics_overall_row(spark):
    rows = [("m", "t1", 0, 0), ("m", "t1", 1, None), ("m", "t2", 2, 1), ("m", "t2", 0, 0)]
    df = spark.createDataFrame(rows, "model string, task string, answer_idx int, pred_idx int")
    m = {r["dataset"]: r for r in SC.metrics(df).collect()}
    assert m["t1"]["acc"] == 0.5 and m["t1"]["unknown"] == 1 and m["t1"]["acc_known_only"] == 1.0
    assert m["overall_micro"]["n"] == 4 and m["overall_micro"]["acc"] == 0.5


def test_length_summary_floor_rank(spark):
    rng = random.Random(2)
    groups = {f"g{n}": [rng.randint(0, 50) for _ in range(n)] for n in (1, 2, 20, 100, 37)}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v int")
    out = {r["group"]: r for r in P.length_summary(df, "g", ["v"]).collect()}
    for g, vs in groups.items():
        r = out[g]
        assert r["n"] == len(vs) and r["max"] == max(vs)
        for p in (50, 90, 95):
            assert_rank(vs, r[f"p{p}"], p / 100)


def test_nm_sparsity_against_python(spark):
    rng = random.Random(4)
    rows = [("t", i, [rng.choice([0.0, 0.0, 1.5]) for _ in range(rng.randint(0, 11))]) for i in range(50)]
    df = spark.createDataFrame(rows, "tensor string, row_idx long, values array<float>")
    r = P.nm_sparsity(df).first()
    ok = groups = 0
    for _, _, v in rows:
        m = (len(v) // 4) * 4
        for j in range(0, m, 4):
            groups += 1
            ok += sum(1 for x in v[j:j + 4] if x != 0) == 2
    assert r["groups"] == groups and r["ok_groups"] == ok
    assert math.isclose(r["ratio"], ok / groups if groups else 0.0)


def test_sparsity_sample_with_nothing_qualifying(spark):
    df = spark.createDataFrame([("layers.0.q_proj", 0, [0.0] * 8)], "tensor string, row_idx long, values array<float>")
    out = P.nm_sparsity_sample(P.nm_sparsity(df), 8)
    assert out.count() == 0
