import pytest

from corpusloom.operators import mc as M


def built(df):
    return {r["source_index"]: (r["question"], list(r["choices"]), r["answer_idx"]) for r in df.collect()}


def test_hellaswag_rows(spark):
    ends = ["w", " x ", "", "z"]
    rows = [(0, " a ", "b\xa0", "Act", ends, "1"), (1, None, "b", None, ends, " 2"), (2, "a", "", "", ends, "0"),
            (3, "", " ", None, ends, "0"), (4, "a", "b", "c", ends, "4"), (5, "a", "b", "c", ends, "-1"), (6, "a", "b", "c", ends, "x"),
            (7, "a", "b", "c", ends, ""), (8, "a", "b", "c", ends, None), (9, "a", "b", "c", [], "0"), (10, "a", "b", "c", None, "0")]
    got = built(M.hellaswag(spark.createDataFrame(
        rows, "source_index long, ctx_a string, ctx_b string, activity_label string, endings array<string>, label string")))
    choices = ["w", "x", "", "z"]
    assert got == {0: ("Activity: Act\na\nb", choices, 1), 1: ("b", choices, 2), 2: ("a", choices, 0)}


def test_arc_rows(spark):
    t, abcd = ["p", " q ", "r", "s"], ["A", "B", "C", "D"]
    rows = [(0, "q?", t, abcd, "C"), (1, "q?", t, ["1", "2", "3", "4"], "2"), (2, "q?", t, ["1", "2", "3", "4"], "D"), (3, "q?", t, abcd, "4"),
            (4, "q?", t, [" A", "B", "B", "D"], "B"), (5, "q?", t, abcd, " b"), (6, "q?", t, abcd, "10"), (7, "q?", t, abcd, "K"),
            (8, "q?", t, abcd[:3], "A"), (9, " ", t, abcd, "A"), (10, "q?", [], [], "A"), (11, "q?", t, abcd, ""), (12, "q?", t, abcd, None),
            (13, "q?", t, ["None", "B", "C", "D"], None)]
    df = spark.createDataFrame([(i, q, (x, lab), key) for i, q, x, lab, key in rows],
                               "source_index long, question string, choices struct<text:array<string>,label:array<string>>, answerKey string")
    choices = ["p", "q", "r", "s"]
    want = {0: 2, 1: 1, 2: 3, 3: 3, 4: 2, 13: 0}                # a repeated label names its last choice
    assert built(M.arc(df)) == {i: ("q?", choices, k) for i, k in want.items()}


def test_winogrande_rows(spark):
    rows = [(0, " s _ ", "x ", "y", "1"), (1, "s", "x", "y", " 2"), (2, "s", "x", "y", "3"), (3, "s", "x", "y", ""), (4, "s", "x", "y", None),
            (5, "", "x", "y", "1"), (6, "s", "\xa0", "y", "1"), (7, "s", "x", None, "1")]
    got = built(M.winogrande(spark.createDataFrame(rows, "source_index long, sentence string, option1 string, option2 string, answer string")))
    assert got == {0: ("s _", ["x", "y"], 0), 1: ("s", ["x", "y"], 1)}


def test_truthfulqa_rows(spark):
    c = ["a", " b ", "c"]
    rows = [(0, " q ", c, [0, 1, 0]), (1, "q", c, [1, 0, 0]), (2, "q", c, [1, 1, 0]), (3, "q", c, [0, 0, 0]), (4, "q", c, [0, 1]),
            (5, "", c, [1, 0, 0]), (6, "q", [], []), (7, None, c, [1, 0, 0])]
    df = spark.createDataFrame([(i, q, (x, lab)) for i, q, x, lab in rows],
                               "source_index long, question string, mc1_targets struct<choices:array<string>,labels:array<int>>")
    assert built(M.truthfulqa(df)) == {0: ("q", ["a", "b", "c"], 1), 1: ("q", ["a", "b", "c"], 0)}


@pytest.mark.parametrize("n", [0, 1, 3, 50])
def test_subsample_filters_by_threshold(spark, n):
    from corpusloom.operators.sample import take_first_n_per_group
    rows = [(t, f"{k * 7919 % 997:04d}") for t, m in (("a", 30), ("b", 2), (None, 9)) for k in range(m)]
    got = take_first_n_per_group(spark.createDataFrame(rows, "task string, ord string"), "task", n).collect()
    want = [(t, o) for t in ("a", "b", None) for o in sorted(o for x, o in rows if x == t)[:n]]
    assert sorted(map(str, ((r[0], r[1]) for r in got))) == sorted(map(str, want))


def test_sampled_corpus_equals_the_subsample_of_the_corpus(spark):
    from corpusloom.operators.mc import eval_corpus, sampled_corpus, subsample
    from corpusloom.plans.mc_queries import raw_tables

    raws = raw_tables(spark, "/root/testdata/sf0.001")
    for n in (None, 0, 1, 7, 10_000):
        want = subsample(eval_corpus(raws), n, 4).drop("messages", "choices", "meta")
        got = sampled_corpus(raws, n, seed=4).drop("messages", "choices", "meta")
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str), n
