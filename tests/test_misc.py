from pyspark.sql import functions as F

from corpusloom.functions.tokens import tokenizer_udf
from corpusloom.operators.sample import check_disjoint, split_train_eval
from corpusloom.operators.score import model_name
from corpusloom.sources.tables import read_split, with_progress


def test_tokenizer_plugin(spark):
    enc = tokenizer_udf(lambda: (lambda t: [len(w) for w in t.split()]))
    df = spark.createDataFrame([("a bb ccc",), (None,)], "t string")
    got = [r[0] for r in df.select(enc("t")).collect()]
    assert list(got[0]) == [1, 2, 3] and got[1] is None


def test_model_name(spark):
    df = spark.createDataFrame([("/a/b/model-x/",), ("m",), ("/x//",)], "p string")
    assert [r[0] for r in df.select(model_name("p")).collect()] == ["model-x", "m", "x"]


def test_split_is_disjoint(spark):
    df = spark.createDataFrame([(f"{i:04d}", i) for i in range(200)], "ord string, id int")
    s = split_train_eval(df, 0.1)
    assert check_disjoint(s.where("split = 'train'"), s.where("split = 'eval'")) == 0


def test_read_split_and_progress(spark, tmp_path):
    df = spark.createDataFrame([(i, "train" if i % 3 else "test") for i in range(30)], "x int, split string")
    df.write.partitionBy("split").parquet(str(tmp_path / "ds"))
    tr = read_split(spark, str(tmp_path / "ds"), "train")
    obs_df, obs = with_progress(tr, "scan", even=F.col("x") % 2 == 0)
    assert obs_df.count() == 20
    assert obs.get["rows"] == 20 and obs.get["even"] == 10


def test_untrusted_chat_jsonl_matches_dynamic_checks(spark, tmp_path):
    import json

    from corpusloom.functions.chat import normalize_messages
    from corpusloom.sources.jsonl import read_chat_jsonl_untrusted

    recs = [
        {"messages": [{"role": "user", "content": " hi "}, {"role": "assistant", "content": 5},
                      {"role": "assistant", "content": "yo"}, "junk", None, {"role": "user", "content": None},
                      {"role": "tool", "content": "x"}, {"role": "assistant", "content": {"a": 1}},
                      {"role": "assistant", "content": "ok"}], "id": "r0"},
        {"messages": "not a list", "id": "r1"},
        {"other": 1, "id": "r2"},
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": "r3"},
    ]
    p = tmp_path / "chat.jsonl"
    p.write_text("\n".join(json.dumps(r) for r in recs) + "\n\n")
    df = read_chat_jsonl_untrusted(spark, str(p))
    got = {r["id"]: r["m"] for r in df.select("id", normalize_messages("messages").alias("m")).collect()}
    assert got["r1"] is None and got["r2"] is None
    assert [tuple(m) for m in got["r0"]] == [("user", "hi"), ("assistant", "yo"), ("assistant", "ok")]
    assert [tuple(m) for m in got["r3"]] == [("user", "q"), ("assistant", "a")]


def test_letter_token_ids():
    from corpusloom.operators.score import letter_token_ids
    vocab = {"A": 5, " A": 9, "B": 6, "C": 7}
    enc = lambda s: [vocab[s]] if s in vocab else [1, 2]
    assert letter_token_ids(enc, 4) == [[5, 9], [6], [7], []]


def test_left_truncation_and_assistant_labels(spark):
    import random

    from corpusloom.operators.trainprep import assistant_labels, truncate_left
    rng = random.Random(31)
    L = 8
    rows = []
    for i in range(300):
        full = [rng.randint(1, 99) for _ in range(rng.randint(0, 20))]
        prompt_len = rng.randint(0, len(full) + 2)
        rows.append((i, full, prompt_len, len(full)))
    df = spark.createDataFrame(rows, "i int, ids array<int>, prompt_len_raw int, full_len_raw int")
    out = df.select("i", truncate_left("ids", L).alias("t"))
    out = out.join(df, "i").select("i", "t", assistant_labels("t", "prompt_len_raw", "full_len_raw", L).alias("lab"))
    got = {r["i"]: (list(r["t"]), list(r["lab"])) for r in out.collect()}
    for i, full, p, n in rows:
        ids = full[-L:] if len(full) > L else full
        kept = min(max(p - max(n - L, 0), 0), len(ids))
        assert got[i] == (ids, [-100] * kept + ids[kept:]), (full, p)


def test_plugged_tokenizer_reaches_written_tables(spark, tmp_path):
    from corpusloom.config import V2, CalibConfig, TrainConfig
    from corpusloom.functions.tokens import plugged_tokens
    from corpusloom.operators.chat_records import chat_records
    from corpusloom.operators.distill import judge, kd_records
    from corpusloom.plans import jobs
    tokens = plugged_tokens(lambda: (lambda t: [ord(c) for c in t]))        # one id a character
    chats = spark.createDataFrame([(k, [("user", f"ask {k}"), ("assistant", "answer " * 8 + str(k))]) for k in range(6)],
                                  "source_index long, messages array<struct<role:string,content:string>>")
    recs = chat_records(chats, V2, count=tokens.count)
    r = recs.first()
    assert r["target_tokens"] == len(r["target_text"])
    counts = jobs.prepare_training(recs, str(tmp_path / "t"), TrainConfig(min_sup_tokens=1), tokens=tokens)
    assert sum(counts.values()) == 6
    row = spark.read.parquet(str(tmp_path / "t")).first()
    assert "".join(map(chr, row["input_ids"])).startswith("<|begin_of_text|>") and row["full_len_raw"] == len(row["input_ids"])
    jobs.prepare_calibration(recs, str(tmp_path / "c"), CalibConfig(num_samples=4, max_seq_len=9), tokens)
    ids = [x["input_ids"] for x in spark.read.parquet(str(tmp_path / "c")).collect()]
    assert len(ids) == 4 and all("".join(map(chr, i)) == "<|begin_o" for i in ids)
    p = spark.createDataFrame([("a", [("user", "q")], "g", 3)], "id string, prompt_messages array<struct<role:string,content:string>>, gold_target string, prompt_tokens int")
    g = spark.createDataFrame([("a", "twelve chars"), ("a", "zz repeated id")], "id string, text string")
    j = judge(p, g, count=tokens.count)
    assert j.count() == 1 and j.first()["reason"] == "ok"
    assert kd_records(j, count=tokens.count).first()["meta"]["teacher_target_tokens"] == 12


def test_empty_manifest_and_malformed_lines(spark, tmp_path):
    import pytest

    from corpusloom.sources.jsonl import read_jsonl, read_task_files
    none = spark.createDataFrame([], "name string, path string")
    out = read_task_files(spark, none, "id string")
    assert out.columns == ["id", "task"] and out.count() == 0
    (tmp_path / "x.json").write_text('{"id": "a"}\n{broken\n')
    with pytest.raises(Exception):
        read_jsonl(spark, str(tmp_path / "x.json"), "id string").collect()


def test_unset_shared_folder_is_an_error_on_a_cluster(spark, monkeypatch):
    import pytest

    from corpusloom import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Cluster())


def test_command_line_reads_raw_inputs(spark, tmp_path):
    from corpusloom.__main__ import main
    d = str(tmp_path)
    spark.createDataFrame([("a", "b", "act", ["x", "y"], "1")], "ctx_a string, ctx_b string, activity_label string, endings array<string>, label string").write.parquet(d + "/h")
    spark.createDataFrame([("q", (["x", "y"], ["A", "B"]), "B")], "question string, choices struct<text:array<string>,label:array<string>>, answerKey string").write.parquet(d + "/a")
    spark.createDataFrame([("s _", "x", "y", "2")], "sentence string, option1 string, option2 string, answer string").write.parquet(d + "/w")
    spark.createDataFrame([("q", (["x", "y"], [0, 1]))], "question string, mc1_targets struct<choices:array<string>,labels:array<int>>").write.parquet(d + "/t")
    main(["eval-corpus", "--hellaswag", d + "/h", "--arc", d + "/a", "--winogrande", d + "/w", "--truthfulqa", d + "/t", "--out", d + "/out"])
    assert {(r["name"], r["rows"]) for r in spark.read.json(d + "/out/manifest").collect()} == {
        ("hellaswag", 1), ("arc_challenge", 1), ("winogrande", 1), ("truthfulqa_mc", 1)}
    msgs = [("user", "please tell me " * 30), ("assistant", "well, this is it " * 12)]
    spark.createDataFrame([([(r, c + str(k)) for r, c in msgs], "train" if k % 2 else "test") for k in range(12)],
                          "messages array<struct<role:string,content:string>>, split string").write.partitionBy("split").parquet(d + "/chats")
    main(["chat-sets", "--chats", d + "/chats", "--split", "train", "--out", d + "/sets", "--n-sft", "6", "--calib", "2,0,0"])
    assert spark.read.json(d + "/sets/sft_6").count() == 6
