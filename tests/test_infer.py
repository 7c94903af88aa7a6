"""Generation and scoring plug-ins: stop strings, token limit, fixed batches, top log-probabilities."""

import random

import pandas as pd
import pytest

from corpusloom.functions.stops import TextEnd, token_starts
from corpusloom.operators import infer


def brute(text, stops, most):
    if most is not None:
        starts = token_starts(text)
        text = text if len(starts) <= most else text[:starts[most]]
    for end in range(1, len(text) + 1):
        done = [s for s in stops if s and text[:end].endswith(s)]
        if done:
            return text[:end - max(map(len, done))]
    return text


@pytest.mark.parametrize("seed", range(4))
def test_cut_equals_brute_force_in_any_chunks(seed):
    rng = random.Random(seed)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b", "ab", " ", "\n", "7", "é", "#"]) for _ in range(rng.randrange(30)))
        stops = ["".join(rng.choice("ab# ") for _ in range(rng.randrange(0, 4))) for _ in range(rng.randrange(4))]
        most = rng.choice([None, 0, 1, 2, 5])
        cuts = sorted(rng.randrange(len(text) + 1) for _ in range(3))
        chunks = [text[i:j] for i, j in zip([0, *cuts], [*cuts, len(text)])]
        want = brute(text, stops, most)
        end = TextEnd(stops, most)
        assert end.cut(text) == want and end.cut(iter(chunks)) == want and end.cut(iter(text)) == want, (text, stops, most)
    assert TextEnd(["x"]).cut(None) is None and TextEnd().cut("") == ""


def test_no_chunk_is_drawn_beyond_the_end():
    def endless(drawn):
        while True:
            drawn.append(1)
            yield "word <|e"
            drawn.append(1)
            yield "ot_id|> "
    drawn = []
    assert TextEnd(["<|eot_id|>"]).cut(endless(drawn)) == "word " and len(drawn) == 2
    assert len(token_starts(TextEnd([], 7).cut(endless([])))) == 7


@pytest.mark.parametrize("sizes", [[1] * 23, [23], [10, 0, 13], []])
def test_micro_batches_cross_arrow_batches(sizes):
    n = sum(sizes)
    rows = pd.DataFrame({"id": range(n), "t": ["x" * (k * 7 % 11) for k in range(n)]})
    parts, at = [], 0
    for s in sizes:
        parts.append(rows.iloc[at:at + s])
        at += s
    got = list(infer.micro_batches(iter(parts), ["id", "t"], 4, window=3, by="t"))
    assert [len(b[0]) for b in got] == [4] * (n // 4) + ([n % 4] if n % 4 else [])
    assert sorted(i for b in got for i in b[0]) == list(range(n))
    first = [len(t) for b in got[:3] for t in b[1]]
    assert first == sorted(first)


def test_generate_reads_its_settings(spark):
    def make():
        return lambda prompts: [None if p is None else iter(p) for p in prompts]
    rows = [("1", "one two ### Response: three"), ("2", "a b c d e f"), ("3", None), ("4", ""), ("2", "### Response:")]
    df = spark.createDataFrame(rows, "id string, prompt_text string").repartition(3)
    got = sorted(((r["id"], r["text"]) for r in infer.generate(df, make, "t", stop=["### Response:"], max_new_tokens=5, batch_size=2).collect()), key=str)
    assert got == sorted([("1", "one two "), ("2", "a b c d e "), ("3", None), ("4", ""), ("2", "")], key=str)


def test_score_keeps_the_highest(spark):
    def make():
        return lambda prompts: [("A", {k: -float(k % 5) for k in range(40)} | {99: float("nan")}) for _ in prompts]
    df = spark.createDataFrame([(str(k), "p") for k in range(9)], "id string, prompt_text string")
    for r in infer.score(df, make, "s", top=3, batch_size=4).collect():
        assert r["logprobs"] == {0: 0.0, 5: 0.0, 10: 0.0}
    assert infer.top_logprobs(None, 3) is None and infer.top_logprobs({1: None, 2: -1.0}, 3) == {2: -1.0}


def test_scoring_goes_on_where_it_stopped(spark, tmp_path):
    """A job that fails after some waves leaves them; the next one scores only the rest."""
    ledger, calls = f"{tmp_path}/ledger", tmp_path / "calls"
    calls.mkdir()

    def model(fail):
        def make():
            def run(prompts):
                import uuid
                if fail and any(p == "boom" for p in prompts):
                    raise RuntimeError("lost")
                (calls / uuid.uuid4().hex).write_text("\n".join(prompts))
                return [(p[-1:], {len(p): -1.0}) for p in prompts]
            return run
        return make
    rows = [(f"q{k}", f"prompt {k}", k) for k in range(60)] + [("q7", "prompt 7", 7), (None, "no id", -1)]
    last = max(rows[:60], key=lambda r: spark.sql(f"select pmod(xxhash64('{r[0]}'), 4)").first()[0])      # in the last wave that has rows
    rows = [(i, "boom" if i == last[0] else p, n) for i, p, n in rows]
    df = spark.createDataFrame(rows, "id string, prompt_text string, n int").repartition(3)
    with pytest.raises(Exception, match="lost"):
        infer.score_resumable(df, model(True), "m", ledger)
    done = {r["id"] for r in infer.scored_so_far(spark, ledger).collect()}
    assert 0 < len(done) < 60
    before = {f.name for f in calls.iterdir()}
    out = infer.score_resumable(df, model(False), "m", ledger).collect()
    again = [p for f in calls.iterdir() if f.name not in before for p in f.read_text().split("\n")]
    prompts = {i: p for i, p, _ in rows}
    assert sorted(again) == sorted(prompts[i] for i in prompts if i is not None and i not in done)
    assert len(out) == len(rows) and all((r["text"] is None) == (r["id"] is None) for r in out)
    assert infer.score_resumable(df, model(True), "m", ledger).count() == len(rows)               # nothing is left to score
    assert infer.scored_so_far(spark, ledger).where("model = 'other'").count() == 0
