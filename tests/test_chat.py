import random

from pyspark.sql import functions as F

from corpusloom.functions import chat as C
from corpusloom.operators.chat_records import chat_examples
from tests.checks import chat

DDL = "source_index long, messages array<struct<role:string,content:string>>"


def examples(spark, chats, k):
    df = spark.createDataFrame(list(enumerate(chats)), DDL)
    out = {}
    for r in chat_examples(df, k).orderBy("source_index", "turn_index").collect():
        out.setdefault(r["source_index"], []).append(
            ([m["content"] for m in r["prompt_messages"]], r["target_text"], [m["content"] for m in r["messages"]], r["turn_index"]))
    return out


def test_examples_of_written_chats(spark):
    chats = [chat("ua"), chat("sua"), chat("a"), chat("auaa"), chat("sa"), chat("uuata"), [], chat("u"),
             [("user", "  q \x85"), ("assistant", "\xa0"), ("assistant", None), (None, "x"), ("assistant", " r ")]]
    got = examples(spark, chats, 12)
    assert got[0] == [(["u0"], "a1", ["u0", "a1"], 0)]
    assert got[1] == [(["s0", "u1"], "a2", ["s0", "u1", "a2"], 0)]
    assert 2 not in got and 4 not in got and 6 not in got and 7 not in got        # nothing asked before
    assert got[3] == [(["a0", "u1"], "a2", ["a0", "u1", "a2"], 0), (["a0", "u1", "a2"], "a3", ["a0", "u1", "a2", "a3"], 1)]
    assert got[5] == [(["u0", "u1"], "a2", ["u0", "u1", "a2"], 0), (["u0", "u1", "a2"], "a4", ["u0", "u1", "a2", "a4"], 1)]   # tools go
    assert got[8] == [(["q"], "r", ["q", "r"], 0)]                                 # blank texts and unknown roles go


def test_examples_are_prefixes_of_the_kept_window(spark):
    rng = random.Random(3)
    chats = [chat("".join(rng.choice("suatu") for _ in range(rng.randrange(17)))) for _ in range(200)]
    for k in (12, 4, 2):
        got = examples(spark, chats, k)
        for i, c in enumerate(chats):
            known = [m for m in c if m[0] != "tool"]
            system = len(known) > k and known[0][0] == "system"
            for prompt, target, full, turn in got.get(i, []):
                assert full == [*prompt, target] and len(full) <= k and any(x[0] == "u" for x in prompt) and target[0] == "a"
                tail = full[1:] if system and full[0] == known[0][1] else full
                at = [m[1] for m in known].index(tail[0])
                assert [m[1] for m in known[at:at + len(tail)]] == tail            # consecutive turns
                assert at == (max(1, len(known) - k + 1) if system else max(0, len(known) - k))
            assert [x[3] for x in got.get(i, [])] == list(range(len(got.get(i, []))))
            window = known[-(k - 1):] if system else known[-k:]
            asked = next((j for j, m in enumerate(window) if m[0] == "user"), len(window))
            assert len(got.get(i, [])) == sum(m[0] == "assistant" for m in window[asked:])


def test_truncate_keeps_system(spark):
    m = [("system", "s")] + [("user", str(i)) for i in range(20)]
    df = spark.createDataFrame([(m,)], "m array<struct<role:string,content:string>>")
    out = df.select(C.truncate_messages("m", 4).alias("t")).first()["t"]
    assert [x["content"] for x in out] == ["s", "17", "18", "19"]


def test_render_and_last_content(spark):
    m = [("user", "u1"), ("assistant", "a"), ("user", "u2")]
    df = spark.createDataFrame([(m,)], "m array<struct<role:string,content:string>>")
    r = df.select(C.render("m", True).alias("r"), C.last_content("m", "user").alias("lu"),
                  C.last_content(F.array().cast(C.MESSAGE_DDL), "user").alias("none")).first()
    t = C.DEFAULT_TEMPLATE
    body = "".join(f"{t.header_open}{ro}{t.header_close}{c}{t.eot}" for ro, c in m)
    assert r["r"] == t.bos + body + t.generation_prompt
    assert r["lu"] == "u2" and r["none"] == ""


def test_additive_prompt_counts_equal_direct_counts(spark):
    from corpusloom.config import V2
    from corpusloom.functions.tokens import count_tokens
    from corpusloom.operators.chat_records import chat_records
    rng = random.Random(21)
    alphabet = list("ab1 2<>|.!é9") + ["<|eot_id|>", "12", "x y", "\n"]
    chats = []
    for i in range(300):
        msgs = []
        for _ in range(rng.randint(1, 14)):
            content = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 8)))
            msgs.append((rng.choice(["system", "user", "assistant"]), content))
        chats.append((i, msgs))
    df = spark.createDataFrame(chats, "source_index long, messages array<struct<role:string,content:string>>")
    r = chat_records(df, V2)
    bad = r.where((F.col("prompt_tokens") != count_tokens(C.render("prompt_messages", True)))
                  | (F.col("total_tokens") != count_tokens(C.render("messages", False)))).count()
    assert r.count() > 0 and bad == 0
