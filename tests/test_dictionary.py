"""Ids by dictionary encoding against the encoder on whole texts."""

import base64

import tiktoken
from pyspark.sql import functions as F

from corpusloom.operators import dictionary as D
from corpusloom.operators import trainprep as TP
from corpusloom.plans.train_queries import PIECES, VOCABULARY

TEXTS = [None, "", " ", "\n\n", "a", "It's  they'll\n\n\nsee 　x", "tab\t\tend \t", "naïve 日本語 😀👍🏽 x²", "\x1c\x1dctl\x85nel ls",
         "the the the the", "the the the the", "0123456789 12 $#!?! ...", "x" * 3000, "word " * 2000, "́combining é"]


def whole_encoder():
    ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("whole", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_encoder(spark):
    bpe = whole_encoder()
    rows = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(TEXTS)], "k int, t string, ids string").repartition(3)
    for hot in (1, 8, 1 << 30):                     # no piece is hot, some, all
        got = {r["k"]: r for r in D.encode_texts(rows, "t", PIECES, D.rank_file_encoder(VOCABULARY), hot_parts=hot).collect()}
        assert len(got) == len(TEXTS)
        for k, t in enumerate(TEXTS):
            want = None if t is None else bpe.encode_ordinary(t)
            assert got[k]["ids"] == want, (hot, t)
            assert got[k]["sizes"] == (None if t is None else [len(bpe.decode_single_token_bytes(i)) for i in want])


def test_dictionary_holds_each_piece_once(spark):
    words = spark.createDataFrame([("a",)] * 50 + [("b",), (" a",)], "piece string").repartition(4)
    table = D.build_dictionary(words, D.rank_file_encoder(VOCABULARY))
    assert sorted((r["piece"], r["n"]) for r in table.collect()) == [(" a", 1), ("a", 50), ("b", 1)]


def test_no_rows(spark):
    none = spark.createDataFrame([], "k int, t string")
    assert D.encode_texts(none, "t", PIECES, D.rank_file_encoder(VOCABULARY)).collect() == []


def test_tokens_before(spark):
    df = spark.range(1).select(F.array(*map(F.lit, [3, 1, 2])).alias("s"))
    assert [df.select(D.tokens_before("s", F.lit(n))).first()[0] for n in (0, 1, 3, 4, 5, 99)] == [0, 1, 1, 2, 3, 3]


def test_labels_are_the_tokens_after_the_prompt(spark):
    bpe = whole_encoder()
    pairs = [("Ask:\n\n", "Answer é 日"), ("Ask:\n\n", "Answer é 日"), ("p", "refix"), ("", "all of it"), ("long " * 3000, "tail here")]
    tr = spark.createDataFrame([(str(k), p, p + t) for k, (p, t) in enumerate(pairs)], "id string, prompt_text string, full_text string")
    out = {r["id"]: r for r in TP.tokenize_train_ids(tr, PIECES, D.rank_file_encoder(VOCABULARY)).collect()}
    assert len(out) == len(pairs)
    for k, (p, t) in enumerate(pairs):
        ids = bpe.encode_ordinary(p + t)
        starts = [sum(len(bpe.decode_single_token_bytes(i)) for i in ids[:j]) for j in range(len(ids))] if len(ids) < 100 else None
        row = out[str(k)]
        assert row["input_ids"] == ids[-TP.TRAIN.max_seq_len:]
        kept = [x for x in row["labels"] if x != TP.IGNORE]
        if starts:
            assert kept == [i for i, s in zip(ids, starts) if s >= len(p.encode())]
        assert row["labels"][len(row["labels"]) - len(kept):] == kept
