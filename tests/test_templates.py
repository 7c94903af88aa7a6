import random

import pytest
from pyspark.sql import functions as F

from corpusloom.config import V2
from corpusloom.functions import chat as C
from corpusloom.functions.templates import TemplateError, TextTemplate
from corpusloom.operators.chat_records import chat_examples, chat_records
from corpusloom.operators.history import turn_history
from corpusloom.plans.template_queries import FOLDED, MARKED, NUMBERED
from tests.checks import chat

DDL = "source_index long, messages array<struct<role:string,content:string>>"


def rendered(spark, template, chats, gen=False):
    df = spark.createDataFrame(list(enumerate(chats)), DDL)
    return [r[0] for r in df.orderBy("source_index").select(C.render("messages", gen, template)).collect()]


def test_written_renderings(spark):
    chats = [chat("sua"), chat("ua"), chat("s"), [], None, [("user", None)]]
    assert rendered(spark, MARKED, chats) == [
        "<turn system>\ns0\n</turn>\n<turn user>\nu1\n</turn>\n<turn assistant>\na2\n</turn>\n",
        "<turn user>\nu0\n</turn>\n<turn assistant>\na1\n</turn>\n", "<turn system>\ns0\n</turn>\n", "", None, "<turn user>\n\n</turn>\n"]
    assert rendered(spark, MARKED, chats[:1], True)[0].endswith("a2\n</turn>\n<turn assistant>\n")
    assert rendered(spark, FOLDED, chats) == ["<s>[ask]s0\n\nu1[/ask] a2</s>", "<s>[ask]u0[/ask] a1</s>", "<s>", "<s>", None, "<s>[ask][/ask]"]
    assert rendered(spark, NUMBERED, chats) == ["1/2 USER: u1\n2/2 ASSISTANT: a2", "1/2 USER: u0\n2/2 ASSISTANT: a1", "", "", None, "1/1 USER: "]
    assert rendered(spark, NUMBERED, chats[:1], True) == ["1/2 USER: u1\n2/2 ASSISTANT: a2\nASSISTANT:"]


@pytest.mark.parametrize("source, text", [
    ("{{ messages[-1].content }}{{ messages[7].content }}|{{ messages[1:-1] | length }}", "a3|2"),
    ("{% for m in messages %}{{ messages[loop.index0 - 1].role[0:0] if false else messages[loop.index0 - 1].content }} {% endfor %}", None),
    ("{% for m in messages %}{{ messages[loop.index0 - 1].content }} {% endfor %}", "a3 s0 u1 u2 "),
    ("{% for m in messages %}{% if loop.index0 % 2 == 0 and not loop.last %}{{ m.content }}{% elif m.content.startswith('u') %}U{% else %}-{% endif %}{% endfor %}", "s0Uu2-"),
    ("{{ name or 'none' }} {{ name | default('x') }} {{ word ~ word }}", None),
    ("{{ name or 'none' }} {{ name | default('x') }} {{ 'a}}b' }} {{ word + '|' | trim }}", "none x a}}b w|"),
    ("a\n  {% if word == 'w' %}\n  x\n  {% endif %}\nb {%- if 'u' in messages[1].content %} y{% endif %}\n{{ 'z' }}\n", "a\n  x\nb yz"),
    ("{% set n = 1 + 2 %}{{ n }}{{ n > 2 }}{{ messages[9] is defined }}{{ other is none }}", "3TrueFalseTrue"),
    ("{% if not messages %}{{ raise_exception('no chat') }}{% endif %}ok", "ok"),
])
def test_parts_of_the_language(spark, source, text):
    if text is None:
        with pytest.raises(TemplateError):
            rendered(spark, TextTemplate(source, {"word": "w"}), [chat("suua")])
    else:
        assert rendered(spark, TextTemplate(source, {"word": "w"}), [chat("suua")]) == [text]


@pytest.mark.parametrize("source", ["{% for m in messages %}", "{% if x %}a{% else %}", "{% macro f() %}{% endmacro %}", "{{ a b }}", "{% endif %}", "{% for m of x %}{% endfor %}"])
def test_malformed_templates_stop_when_made(source):
    with pytest.raises(TemplateError):
        TextTemplate(source)


def test_raised_text_reaches_the_user(spark):
    with pytest.raises(Exception, match="no chat"):
        rendered(spark, TextTemplate("{% if not messages %}{{ raise_exception('no chat') }}{% endif %}"), [[]])


def test_template_text_gives_the_records_of_the_marker_template(spark):
    t = C.DEFAULT_TEMPLATE
    text = TextTemplate("{{ bos }}{% for m in messages %}{{ open + m.role + close + m.content + eot }}{% endfor %}{% if add_generation_prompt %}{{ open + 'assistant' + close }}{% endif %}",
                        {"bos": t.bos, "open": t.header_open, "close": t.header_close, "eot": t.eot})
    df = spark.createDataFrame(list(enumerate([chat("suaua"), chat("ua"), chat("uuaaa")])), DDL)
    cols = ["id", "turn_index", "prompt_tokens", "total_tokens", "ord"]
    plain, compiled = (chat_records(df, V2, x).select(*cols) for x in (t, text))
    assert sorted(plain.collect()) == sorted(compiled.collect())
    assert "Python" not in compiled._jdf.queryExecution().toString()


# ---------------------------------------------------------------- running history
def turns_of(chats):
    return [(c, k, role, text) for c, ms in chats.items() for k, (role, text) in enumerate(ms)]


def brute(rows, window):
    out = []
    for c in {r[0] for r in rows}:
        own = sorted(r[1:] for r in rows if r[0] == c)
        for k, (turn, role, content) in enumerate(own):
            out.append((c, turn, role, content, tuple(m[1:] for m in own[max(k - window, 0):k]), any(m[1] == "user" for m in own[:k])))
    return sorted(out, key=repr)


def history(spark, rows, window, size):
    df = spark.createDataFrame(rows, "source_index long, turn int, role string, content string").repartition(7)
    got = turn_history(df.withColumn("_range", F.lit(1)).withColumn("history", F.lit("x")), window, size).collect()
    return sorted(((r[0], r[1], r[2], r[3], tuple(map(tuple, r[4])), r[5]) for r in got), key=repr)


def test_history_equals_brute_force_at_any_range(spark):
    rng = random.Random(5)
    chats = {c: chat("".join(rng.choice("suaa") for _ in range(rng.randrange(1, 14)))) for c in range(40)}
    chats[99] = chat("aaa" + "".join(rng.choice("saaaau") for _ in range(150)))       # a third of all turns
    rows = [r for r in turns_of(chats) if rng.random() < 0.8]                            # gaps in the numbers
    rows += rows[:9] + [(3, 4, "user", "same number"), (3, 4, "assistant", "same number")]
    want = brute(rows, 4)
    for size in (1, 3, 50, 4096):
        assert history(spark, rows, 4, size) == want, size


def test_history_of_nothing_and_of_null_conversations(spark):
    assert history(spark, [], 4, 8) == []
    rows = [(None, 0, "user", "a"), (None, 9, "assistant", "b"), (1, 3, "assistant", "c")]
    assert history(spark, rows, 2, 4) == sorted([
        (None, 0, "user", "a", (), False), (None, 9, "assistant", "b", (("user", "a"),), True), (1, 3, "assistant", "c", (), False)], key=repr)


def test_history_gives_the_examples_of_short_chats(spark):
    rng = random.Random(8)
    chats = {c: chat("".join(rng.choice("sua") for _ in range(rng.randrange(1, 12)))) for c in range(60)}
    want = {(r["source_index"], r["target_text"]): [tuple(m) for m in r["prompt_messages"]]
            for r in chat_examples(spark.createDataFrame(list(chats.items()), DDL), 12).collect()}
    got = {(c, text): list(h) for c, _, role, text, h, seen in history(spark, turns_of(chats), 12, 4) if role == "assistant" and seen}
    assert got == want
