import hashlib
import random

import regex

from corpusloom.functions.tokens import PRETOKEN
from corpusloom.operators.instruct import PROMPT_NO_INPUT, PROMPT_WITH_INPUT, instruct_records

# Java/RE2 write code points as \x{h}; Python's regex module wants \Uhhhhhhhh
TOK = regex.compile(regex.sub(r"\\x\{([0-9a-f]+)\}", lambda m: "\\U%08x" % int(m.group(1), 16), PRETOKEN))


def ntok(s):
    return len(TOK.findall(s))


def sha1(s):
    return hashlib.sha1(s.encode("utf-8")).hexdigest()


def py_record(i, ins, inp, out):
    ins, inp, out = (ins or "").strip(), (inp or "").strip(), (out or "").strip()
    if not ins or not out:
        return None
    prompt = (PROMPT_WITH_INPUT.format(instruction=ins, input=inp) if inp
              else PROMPT_NO_INPUT.format(instruction=ins))
    return {
        "id": sha1(f"{i}|||{ins}|||{inp}|||{out}"),
        "prompt_text": prompt, "prompt_tokens": ntok(prompt), "target_tokens": ntok(out),
        "total_tokens": ntok(prompt + out), "has_input": bool(inp),
        "dup_key": sha1(prompt + "|||" + out),
    }


def test_instruction_records_against_python(spark):
    rng = random.Random(23)
    pieces = ["", " ", "Hello", "wörld 123", "!!", "\n", "é" * 350, "x1y22z333", "\xa0"]
    rows = [(i, *["".join(rng.choice(pieces) for _ in range(rng.randint(0, 4))) if rng.random() > 0.05 else None
                 for _ in range(3)]) for i in range(300)]
    df = spark.createDataFrame(rows, "source_index long, instruction string, input string, output string")
    got = {r["source_index"]: r.asDict() for r in instruct_records(df).collect()}
    for i, ins, inp, out in rows:
        want = py_record(i, ins, inp, out)
        if want is None:
            assert i not in got
            continue
        g = got[i]
        assert {k: g[k] for k in want} == want, (ins, inp, out)


def test_chat_record_fields(spark):
    from corpusloom.config import V2
    from corpusloom.functions.chat import DEFAULT_TEMPLATE as T
    from corpusloom.operators.chat_records import chat_records

    def render(msgs, gen):
        return T.bos + "".join(f"{T.header_open}{r}{T.header_close}{c}{T.eot}" for r, c in msgs) + (T.generation_prompt if gen else "")

    long = "é" * 620
    m = [("system", "be !! kind"), ("user", long + " 42"), ("assistant", "x y\nz"), ("user", "<| more"), ("assistant", long + "1")]
    rows = {r["turn_index"]: r for r in chat_records(spark.createDataFrame(
        [(8, m)], "source_index long, messages array<struct<role:string,content:string>>"), V2).collect()}
    assert sorted(rows) == [0, 1]
    for turn, end in ((0, 2), (1, 4)):
        r, target, asked = rows[turn], m[end][1], m[end - 1][1]
        assert r["id"] == sha1(f"8|||{turn}|||{asked}|||{target}") and r["dup_key"] == sha1(asked + "|||" + target)
        assert r["num_messages"] == end + 1 and r["target_tokens"] == ntok(target)
        assert r["prompt_tokens"] == ntok(render(m[:end], True)) and r["total_tokens"] == ntok(render(m[:end + 1], False))


def test_keys_hold_the_whole_text_unless_lengths_are_given(spark):
    from dataclasses import replace

    from corpusloom.config import PREFIX_KD_KEYS, PREFIX_KEYS, V1, V2, DistillConfig
    from corpusloom.operators.chat_records import chat_records
    from corpusloom.operators.distill import kd_source
    same = "w " * 400
    rows = [(k, same, "", same + str(k)) for k in range(5)]
    df = spark.createDataFrame(rows, "source_index long, instruction string, input string, output string")
    assert instruct_records(df).select("dup_key").distinct().count() == 5
    assert instruct_records(df, replace(V1, **PREFIX_KEYS)).select("dup_key").distinct().count() == 1
    chats = spark.createDataFrame([(7, [("user", same + str(k)), ("assistant", same + str(k))]) for k in range(5)],
                                  "source_index long, messages array<struct<role:string,content:string>>")
    recs = chat_records(chats, V2)
    assert recs.select("dup_key").distinct().count() == recs.select("id").distinct().count() == recs.select("ord").distinct().count() == 5
    short = replace(V2, **PREFIX_KEYS)
    assert chat_records(chats, short).select("dup_key").distinct().count() == 1
    one_id = recs.drop("id").selectExpr("*", "'same' AS id")
    kd = kd_source(one_id)
    assert kd.select("dup_key").distinct().count() == kd.select("ord").distinct().count() == 5
    assert kd_source(one_id, replace(DistillConfig(), **PREFIX_KD_KEYS)).select("dup_key").distinct().count() == 1


def test_gates_and_buckets_count_each_text_once(spark):
    """Filters read counted lengths; they don't repeat the count for every comparison."""
    from corpusloom.config import V1
    from corpusloom.operators import sft_sets as S
    from corpusloom.operators.instruct import instruct_records
    rows = [(1, "say", "", "a b c d e " * 40), (1, "say", "", "a b c d e " * 40), (2, None, None, None), (3, " ", "", "x"), (None, "say", "it", "w " * 300),
            (4, "say", None, "a b")]
    records = instruct_records(spark.createDataFrame(rows, "source_index long, instruction string, input string, output string"))
    calib = S.calib_candidates(records, V1)
    assert calib.columns == [*records.columns, "bucket"] and S.sft_candidates(records, V1).columns == records.columns
    assert sorted((r["source_index"] or 0, r["bucket"]) for r in calib.collect()) == [(0, "mid"), (1, "mid"), (1, "mid")]
    for df in (calib, S.sft_candidates(records, V1)):
        plan = df.select("source_index", "total_tokens")._jdf.queryExecution().optimizedPlan().toString()
        filters = [x for x in plan.split("+- ") if x.startswith("Filter")]
        assert filters and not any("regexp_extract_all" in x or "trim" in x for x in filters)
        assert plan.count("regexp_extract_all") <= 2                 # prompt and target
