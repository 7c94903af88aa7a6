import random
from collections import Counter

from pyspark.sql import functions as F

from corpusloom.config import DistillConfig
from corpusloom.functions import text as TX
from corpusloom.functions.tokens import count_tokens, token_ids
from corpusloom.operators.distill import clean_teacher_text, is_repetitive

MARKERS = DistillConfig().markers
ALPHABET = list("ab c\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  　 xyz#é") + ["user\n", "<|eot_id|>",
                                                                                            "### Response:", "assistant\n"]


def rand_text(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, n)))


def test_py_ws_matches_python():
    assert set(TX.PY_WS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_strip_words_lines_clean_against_python(spark):
    rng = random.Random(7)
    texts = [rand_text(rng, 40) for _ in range(600)] + ["foo user\n<|eot_id|>", "<|eot_id|>x", "a b c d e f g h",
                                                         "a a a a a a a a", "a a a b b b c c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", TX.strip("t").alias("s"), TX.words("t").alias("w"),
                     clean_teacher_text(F.col("t")).alias("c"), is_repetitive(F.col("t")).alias("r")).collect()
    for r in rows:
        t = texts[r["i"]]
        assert r["s"] == t.strip(), repr(t)
        assert list(r["w"]) == t.split(), repr(t)
        assert t.lstrip().startswith(r["c"].split("\n")[0])                        # nothing before the first cut is lost
        assert not any(m.strip() in r["c"] for m in MARKERS if not m.endswith("\n")) and r["c"] == r["c"].strip()
        assert all(x == x.strip() and x for x in r["c"].splitlines())
        kinds = len(Counter(t.split()))
        assert r["r"] == (len(t.split()) >= 8 and 20 * kinds < 7 * len(t.split())), repr(t)


def test_cleaned_texts(spark):
    cases = {"foo user\n<|eot_id|>": "foo user", " a \n\n  b\t\n": "a\nb", "keep### Response:drop": "keep", "x<|eot_id|>y<|start_header_id|>z": "x",
             "one\x85 two \u2028three": "one\ntwo\nthree", "an assistant\nsaid": "an", "<|eot_id|>": "", "user": "user", "": ""}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r["t"]: r["c"] for r in df.select("t", clean_teacher_text(F.col("t")).alias("c")).collect()}
    assert got == cases


def test_token_counts_and_ids_agree(spark):
    df = spark.createDataFrame([("Hello, world!! 12345 é ok",), ("",), (None,)], "t string")
    r = df.select(count_tokens("t").alias("n"), F.size(token_ids(F.col("t"))).alias("m")).collect()
    # Hello | , | world | !! | 123 | 45 | é | ok
    assert r[0]["n"] == 8 and r[0]["m"] == 8
    assert r[1]["n"] == 0 and r[2]["n"] == 0


def test_edge_rows(spark):
    cases = {
        "seven": "a b c d e f g",                      # < 8 words: never repetitive
        "ratio_at": " ".join(["w1", "w2", "w3", "w4", "w5", "w6", "w7"] + ["w1"] * 13),  # 7/20 = 0.35
        "below": " ".join(["w1", "w2", "w3", "w4", "w5", "w6"] + ["w1"] * 14),          # 6/20 = 0.30
        "marker0": "<|eot_id|>tail",
        "nbsp": "\xa0\x85 x 　",
    }
    df = spark.createDataFrame(list(cases.items()), "k string, t string")
    got = {r["k"]: r for r in df.select("k", is_repetitive(F.col("t")).alias("r"),
                                       clean_teacher_text(F.col("t")).alias("c"), TX.strip("t").alias("s")).collect()}
    assert got["seven"]["r"] is False and got["ratio_at"]["r"] is False and got["below"]["r"] is True
    assert got["marker0"]["c"] == "" and got["nbsp"]["s"] == "x"


def test_row_cap_larger_than_set(spark):
    from corpusloom.sources.jsonl import read_jsonl_first
    df = spark.createDataFrame([(i,) for i in range(5)], "k int")
    assert read_jsonl_first(df, 100, "k").count() == 5
    assert read_jsonl_first(df, 0, "k").count() == 1   # the cap is checked after a row is taken


def test_pretoken_counts_split_at_whitespace(spark):
    rng = random.Random(12)
    pairs = [(rand_text(rng, 30) + rng.choice([" ", "\n", "\t", "\xa0"]), rand_text(rng, 30)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a string, b string")
    bad = df.where(count_tokens(F.concat("a", "b")) != count_tokens("a") + count_tokens("b")).count()
    assert bad == 0
