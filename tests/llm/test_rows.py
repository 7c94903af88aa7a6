"""Quality rules, scoring, token counts and page text against brute force."""

import collections
import math
import random
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import html_blocks, ngram_lm, quality, tokencount
from tests.llm.helpers import LOWER, SPACES, awkward, frame, text_rows, words

SIGNS = "#*$%&|<>"


def brute_base(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    at = collections.defaultdict(list)
    for s in range(len(w) - 7):
        at[tuple(w[s:s + 8])].append(s)
    covered = {k for starts in at.values() if len(starts) > 1 for s in starts for k in range(s, s + 8)}
    return (len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in SIGNS), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_quality_equals_brute_force(spark):
    rows = awkward(5) + [(1000 + i, t, s) for i, t, s in text_rows(150)] + [
        (900, "a b c d e f g h\n" * 9, None), (901, "## <b> | $5 & 10%\n\n \x0b\n## <b> | $5 & 10%\n", "a"), (None, "x " * 40, "a"),
        (902, " ".join(f"q{k}" for k in range(30)) + " x y", "a")]
    labels = [(1000 + k, 1, 0) for k in range(60)] + [(1060, 1, 1), (1061, 0, 0), (None, 1, None), (1062, None, None), (1000, 1, 0)]
    df = frame(spark, rows)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    buckets = 256
    ratio = quality.fit_ratio(df, lab, buckets=buckets)
    raw, good = [0] * buckets, [0] * buckets
    for i, t, _ in rows:
        for w in words(t):
            b = (xxhash.xxh64_intdigest(w, seed=42) + (1 << 63)) % (1 << 64) - (1 << 63)
            raw[b % buckets] += 1
            good[b % buckets] += i is not None and 1000 <= i < 1060
    want = [math.log((g + .5) / (sum(good) + .5 * buckets)) - math.log((r + .5) / (sum(raw) + .5 * buckets)) for g, r in zip(good, raw)]
    assert ratio == pytest.approx(want)
    out = quality.judge(df.withColumn("score", F.lit("clash")), ratio, threshold=-0.05).collect()
    assert len(out) == len(rows)
    texts = {i: t for i, t, _ in rows}
    for r in out:
        base = brute_base(texts[r["doc_id"]])
        assert (r["_q_n"], r["_q_chars"], r["_q_symbols"], r["_q_dup"], r["_q_repeat"], r["_q_failed"]) == base, r["doc_id"]
        w = words(texts[r["doc_id"]])
        hashes = [(xxhash.xxh64_intdigest(x, seed=42) + (1 << 63)) % (1 << 64) - (1 << 63) for x in w]
        score = sum(want[h % buckets] for h in hashes) / len(w) if w else 0.0
        assert r["_q_score"] == pytest.approx(score, abs=1e-5) and r["_q_kept"] == (not base[-1] and r["_q_score"] >= -0.05)


@pytest.mark.parametrize("ngram", [1, 2, 3])
def test_quality_scores_runs_of_words(spark, ngram):
    """Texts of the same words in another order differ: runs are counted and scored, each once."""
    rows = [(k, "red fox runs far over green hills and " * 4, "a") for k in range(8)] + [
        (20 + k, "and hills green over far runs fox red " * 4, "a") for k in range(8)] + [(40, "one", "a"), (41, None, "a"), (42, "red fox", "a")]
    df, lab = frame(spark, rows), spark.createDataFrame([(k, 1, 0) for k in range(8)], "doc_id long, quality int, toxic int")

    def h(*values):
        x = 42
        for v in values:
            x = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else v.to_bytes(8, "little"), seed=x)
        return x

    def cells(text):
        ones = [h(w) for w in words(text)]
        runs, out = ones, list(ones)
        for n in range(2, ngram + 1):
            runs = [h(a, b) for a, b in zip(runs, ones[n - 1:])]
            out += runs
        return [(x + (1 << 63)) % (1 << 64) - (1 << 63) for x in out]

    raw, good = [0] * 4096, [0] * 4096
    for i, t, _ in rows:
        for x in cells(t):
            raw[x % 4096] += 1
            good[x % 4096] += i < 8
    want = [math.log((g + .5) / (sum(good) + 2048)) - math.log((r + .5) / (sum(raw) + 2048)) for g, r in zip(good, raw)]
    ratio = quality.fit_ratio(df, lab, buckets=4096, ngram=ngram)
    assert ratio == pytest.approx(want)
    got = {r["doc_id"]: r["_q_score"] for r in quality.judge(df, ratio, ngram=ngram).collect()}
    for i, t, _ in rows:
        x = cells(t)
        assert got[i] == pytest.approx(sum(want[c % 4096] for c in x) / len(x) if x else 0.0, abs=1e-5)
    assert (got[0] > got[20] + 0.1) == (ngram > 1)
    if ngram == quality.NGRAM:                                   # what the query and the pipeline take
        assert quality.fit_ratio(df, lab, buckets=4096) == ratio
        assert {r["doc_id"]: r["_q_score"] for r in quality.judge(df, ratio).collect()} == got


@pytest.mark.parametrize("window", [1, 2, 3, 5, 8])
def test_windows_of_any_length(spark, window):
    texts = ["a b c d e f g h i j a b c d e f g h x", "a b a b a b", "a", None, "q r s t u v w q r s t u v w"]
    for r in quality.base_columns(spark.createDataFrame([(t,) for t in texts], "text string"), window=window).collect():
        w = words(r["text"])
        assert len(r["_q_hashes"]) == max(0, len(w) - window + 1)
        assert len(set(r["_q_hashes"])) == len({tuple(w[s:s + window]) for s in range(len(w) - window + 1)})


def test_quality_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    ratio = quality.fit_ratio(frame(spark, awkward()), none, buckets=64)
    assert ratio == [0.0] * 64
    assert quality.judge(frame(spark, []), quality.fit_ratio(frame(spark, []), none, buckets=64)).collect() == []


def brute_lm(rows, order):
    """A dictionary model with the same split, buckets and weights by plain EM."""
    docs = [(i, ["<s>"] * (order - 1) + (t or "").translate(LOWER).encode().split() + ["</s>"]) for i, t, *_ in rows]
    out = {i for i, _ in docs if zlib.crc32(str("" if i is None else i).encode()) % 7 == 2}
    count = collections.Counter()
    for i, w in docs:
        if i not in out:
            count.update(w[order - 1:])
    n, v = sum(count.values()), len(count)
    return docs, out, count, n, v


@pytest.mark.parametrize("order,block", [(1, 1 << 30), (2, 3000), (3, 20_000)])
def test_scores_follow_the_contract(spark, order, block):
    rows = awkward(6) + [(2000 + i, t, s) for i, t, s in text_rows(100)] + [(2000, text_rows(1)[0][1], "again"), (None, "w1 w2 w3", None)]
    docs, out, count, n, v = brute_lm(rows, order)
    got = ngram_lm.score_documents(frame(spark, rows).withColumn("score", F.lit(0)), order=order, block_bytes=block).collect()
    assert len(got) == len(rows)
    by = {i: w[order - 1:] for i, w in docs}
    for r in got:
        w = by[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (r["doc_id"] in out, len(w), sum(count[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w))
        assert r["score"] < 0
    held = [r for r in got if r["held_out"]]
    if order == 2:
        assert sum(r["score"] for r in held) > 1.1 * sum(r["base_score"] for r in held)     # less negative by a tenth or more


def plain_em(events, order, v):
    """Weights by EM over ``(estimates, times)``, one event after the other."""
    w = [1 / (order + 1)] * (order + 1)
    for _ in range(60):
        share, seen = [0.0] * (order + 1), 0
        for p, times in events:
            parts = [x * y for x, y in zip(w, (1 / (v + 1), *p))]
            seen += times
            for k, x in enumerate(parts):
                share[k] += times * x / sum(parts)
        w = [max(x / seen, 1e-6) for x in share]
        w = [x / sum(w) for x in w]
    return w


def plain_scores(docs, out, gone, order, grid):
    """Log10 probabilities of all documents from dictionaries: n-grams of the training
    texts, contexts counted where they predict a token; EM on estimates rounded to the
    quarter octaves of the operator, or unrounded. ``gone`` holds places in ``docs``."""
    def tables(places):
        grams, contexts = collections.Counter(), collections.Counter()
        for at in places:
            w = docs[at][1]
            for j in range(order - 1, len(w)):
                for k in range(1, order + 1):
                    grams[tuple(w[j - k + 1:j + 1])] += 1
                    contexts[tuple(w[j - k + 1:j])] += 1
        return grams, contexts

    def estimates(w, j, grams, contexts):
        seen = [(grams[tuple(w[j - k + 1:j + 1])], contexts[tuple(w[j - k + 1:j])]) for k in range(1, order + 1)]
        return min(int(math.log2(1 + seen[-1][1])), 20), [a / b if b else 0.0 for a, b in seen]

    train = [at for at, (i, _) in enumerate(docs) if i not in out]
    kept, every = tables([at for at in train if at not in gone]), tables(train)
    v = len([g for g in every[0] if len(g) == 1])
    events = collections.Counter()
    for at in train:
        if at in gone:
            w = docs[at][1]
            for j in range(order - 1, len(w)):
                bucket, p = estimates(w, j, *kept)
                if grid:
                    p = [2.0 ** (round(math.log2(x) * 4) / 4) if x else 0.0 for x in p]
                events[bucket, tuple(p)] += 1
    weights = {b: plain_em([(p, n) for (o, p), n in events.items() if o == b], order, v) for b in {b for b, _ in events}}
    overall = plain_em([(p, n) for (_, p), n in events.items()], order, v)
    scores = []
    for _, w in docs:
        total = 0.0
        for j in range(order - 1, len(w)):
            bucket, p = estimates(w, j, *every)
            total += math.log10(sum(x * y for x, y in zip(weights.get(bucket, overall), (1 / (v + 1), *p))))
        scores.append(total)
    return scores


@pytest.mark.parametrize("order,block", [(1, 1 << 30), (2, 3000), (3, 20_000)])
def test_scores_equal_a_dictionary_model(spark, order, block):
    rows = awkward(8) + [(2000 + i, t, s) for i, t, s in text_rows(60)] + [(None, f"w1 w2 only{k} {'w3 ' * k}", None) for k in range(12)]
    rows += [(77, "one id w2 w5", "a"), (77, "one id w5 w2 w9 other text", "a")]
    docs, out, *_ = brute_lm(rows, order)
    numbered = spark.createDataFrame([(k, i, (t or "").translate(LOWER)) for k, (i, t, _) in enumerate(rows)], "k int, doc_id long, t string")
    gone = {r["k"] for r in numbered.where(ngram_lm.deleted_part("doc_id", "t", 30)).collect()}
    assert 0 < len(gone & {k for k, r in enumerate(rows) if r[0] is None}) < 12
    got = ngram_lm.score_documents(frame(spark, rows), order=order, block_bytes=block, deleted_percent=30).collect()
    names = lambda ids, scores: sorted((-1 if i is None else i, s) for i, s in zip(ids, scores))
    ids = [i for i, _ in docs]
    same = names([r["doc_id"] for r in got], [r["score"] for r in got])
    for (i, a), (j, b) in zip(same, names(ids, plain_scores(docs, out, gone, order, grid=True)), strict=True):
        assert i == j and a == pytest.approx(b, rel=1e-6)
    exact = names(ids, plain_scores(docs, out, gone, order, grid=False))        # what rounding the estimates for EM costs
    assert sum(s for _, s in same) == pytest.approx(sum(s for _, s in exact), rel=0.005)
    assert max(abs(a / b - 1) for (_, a), (_, b) in zip(same, exact)) < 0.05


def test_scores_do_not_depend_on_blocks(spark):
    rows = awkward(7) + [(2000 + i, t, s) for i, t, s in text_rows(80)]
    runs = [{r["doc_id"]: r["n_known"] for r in ngram_lm.score_documents(frame(spark, rows), block_bytes=b).collect()} for b in (2000, 1 << 30)]
    assert runs[0] == runs[1]


def test_weights_are_the_likelihood_maximum():
    cells = [(3, [-8, -12], 50), (3, [ngram_lm.FLOOR, -16], 30), (0, [ngram_lm.FLOOR, ngram_lm.FLOOR], 5)]
    w = ngram_lm.fit_weights(cells, 2, 1000)
    assert w.shape == (ngram_lm.MAX_BUCKET + 1, 3) and w.sum(axis=1) == pytest.approx([1] * len(w))
    loglik = lambda a, b: 50 * math.log((1 - a - b) / 1001 + a * 2 ** -2 + b * 2 ** -3) + 30 * math.log((1 - a - b) / 1001 + b * 2 ** -4)
    best = max(loglik(a / 200, b / 200) for a in range(200) for b in range(200 - a))
    assert loglik(w[3][1], w[3][2]) >= best - 0.01


def test_scores_of_empty_and_untrained(spark):
    assert ngram_lm.score_documents(frame(spark, [])).collect() == []
    out = ngram_lm.score_documents(frame(spark, [(1, "a b", "x")]), held_out=F.lit(True)).first()
    assert (out["n_tokens"], out["n_known"], out["train_tokens"]) == (3, 0, 0) and out["score"] < 0


# ---- tokens ---------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def random_texts(n, seed=5):
    rng = random.Random(seed)
    alphabet = list("abstrvlemd' '  \n\t\r19!?.,-éüñ\x1c\x85 中日😀́²½٣") + ["'s", "'re", "'ll", " the", "ing", "<|endoftext|>", "<|endof", "    "]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_token_counts_equal_the_library(vocabulary):
    from tokenizers import Tokenizer
    texts = random_texts(4000) + ["x" * 5000, " " * 3000, "''" * 500, "'ll'll 'll", "don't we'll they'RE 'rest'r 'l 've'"] + [t for _, t, _ in text_rows()]
    want = [len(e.ids) for e in Tokenizer.from_file(vocabulary).encode_batch(texts, add_special_tokens=False)]
    counter = tokencount.TokenCounter(tokencount.load_vocabulary(vocabulary))
    assert counter.count(texts) == want
    assert counter.count([None, "", "a"]) == [0, 0, 1]


def test_splitter_does_not_depend_on_chunks(vocabulary, monkeypatch):
    texts = random_texts(300, 9)
    counter = tokencount.TokenCounter(tokencount.load_vocabulary(vocabulary))
    whole = counter.count(texts)
    for chunk in (1, 2, 7, 64):
        monkeypatch.setattr(tokencount, "CHUNK", chunk)
        assert counter.count(texts) == whole


def test_token_columns(spark, vocabulary):
    rows = [(1, None, "a"), (2, "", "a"), (2, "hello world " * 300, "a"), (None, "é", None)]
    out = tokencount.with_token_counts(frame(spark, rows).withColumn("length", F.lit(1)), vocabulary).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out), key=str)
    assert got == sorted([(1, 0, 0, False), (2, 0, 0, False), (2, 3600, 601, True), (None, 2, 1, False)], key=str)
    assert tokencount.with_token_counts(frame(spark, []), vocabulary).collect() == []


# ---- pages ----------------------------------------------------------------

def main_truth(html):
    import html as h
    import re
    body = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    parts = [re.sub(r"\s+", " ", h.unescape(re.sub(r"</?b>|<br>", " " if "<br>" in p else "", p).replace("<br>", " "))).strip()
             for p in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(p for p in parts if p)


def page_rows():
    import duckdb
    return duckdb.sql("select page_id, url, html from '/root/testdata/sf0.01/pages.parquet' order by page_id").fetchall()


def test_held_out_pages_are_read_whole(spark):
    rows = page_rows()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    model = html_blocks.train([h for _, _, h in rows[:80]])
    out = {r["page_id"]: r for r in html_blocks.extract_pages(df, model=model).collect()}
    bad = [i for i, _, h in rows[80:] if out[i]["text"] != main_truth(h)]
    assert len(bad) <= 1 and all(r["n_chars"] == len(r["text"]) for r in out.values())
    other = ("<body><header><p>Welcome, please enjoy this site.</p></header><main><article><h1>A title</h1><p>Some &amp; text of the\n "
             "page, a sentence.</p><form><label>Mail</label></form><p>It ends here, at last.</p></article></main>"
             "<div class='comments'><p>Great article, thanks a lot!</p></div></body>")
    assert html_blocks.extract(model, [other]) == ["A title\n\nSome & text of the page, a sentence.\n\nIt ends here, at last."]


def test_blocks_of_broken_and_odd_html():
    texts = lambda h: [t for _, t in html_blocks.leaf_blocks(h)]
    assert texts(None) == texts("") == texts("<p> </p>") == []
    assert texts("no tags &lt;at&gt; all") == ["no tags <at> all"]
    assert texts("<p>a<p>b<script>if (a<b) x</script>c<!-- <p>no --><ul><li>d<li>e</ul>f") == ["a", "bc", "d", "e", "f"]
    assert texts("<div>x <b>y</b>z<br>w</div><style>p{}</style><img src='>'>t") == ["x yz w", "t"]
    assert texts("<script>never closed <p>x") == [] and texts("a < b and c > d") == ["a < b and c > d"]
    path = html_blocks.leaf_blocks("<article><p>a</article><div class='Side-Bar x' id=nav>b")[1][0]
    assert path == ("div", "side", "bar", "x", "nav")
    # an element without its end tag does not take the rest of the page along
    for tag in ("button", "select"):
        assert texts(f"<article><p>First<{tag}>Go<p>Second<p>Third</article>") == ["First", "Second", "Third"]
        assert texts(f"<p>a <{tag}>Go</{tag}>b<p>c") == ["a b", "c"] and texts(f"<p>a<{tag}>Go") == ["a"]
        assert texts(f"<p>a<{tag}>Go<p>b</{tag}>c") == ["a", "bc"]
    for tag in ("template", "svg", "object", "math", "noscript"):
        assert texts(f"<p>a <{tag}>x<p>b") == ["a x", "b"]
    for tag in ("object", "math", "noscript", "audio", "video", "canvas"):
        assert texts(f"<p>Let <{tag}><i>x</i></{tag}> be big<p>b") == ["Let x be big", "b"]
    assert texts("<p>a<svg><path/><title>t</title></svg>b<template><p>no</template>c") == ["abc"]
    assert texts("<p>a<textarea>b<p>c</textarea>d") == ["ad"] and texts("<p>a<iframe src='x'/>b") == ["ab"]
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert texts(deep) == ["x"]


def test_pages_null_empty_and_repeated(spark):
    schema = "page_id long, url string, html string, text string"
    df = spark.createDataFrame([(1, "u", None, "clash"), (1, "u", "", "c"), (None, None, "<article><p>Word here.</p></article>", None)], schema)
    model = html_blocks.train([h for _, _, h in page_rows()[:40]], epochs=6)
    out = html_blocks.extract_pages(df, model=model).collect()
    assert sorted(r["n_chars"] for r in out) == [0, 0, 10] and out[0].__fields__ == ["page_id", "url", "text", "n_chars"]
    assert html_blocks.extract_pages(spark.createDataFrame([], schema)).collect() == []
