"""Source divergence and vector codes against brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from corpusloom.llm import divergence, vectorcodes
from tests.llm.helpers import LOWER

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_audit(rows, min_docs, top):
    docs, counts, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = TERM.findall((text or "").translate(LOWER))
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, k in docs[lang].items() if k >= min_docs]
        own = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(own[s][t] for s in sources) for t in kept}

        def prob(c):
            n = sum(c.values())
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}
        p, q = {s: prob(own[s]) for s in sources}, prob(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items[:most])]
    return sorted(out)


def corpus(seed=1, n=160):
    rng = random.Random(seed)
    vocab = ["alpha", "Beta", "GAMMA", "été", "ÉTÉ", "日本", "x1y", "a\x00b", "don't", "ß", "tab\tline\nend"] + [f"w{chr(97 + k)}" for k in range(26)]
    rows = [(rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "é", None]),
             rng.choice([" ", ".", "\x7f", "_"]).join(rng.choices(vocab, [1 / (k + 1) for k in range(len(vocab))], k=rng.randrange(0, 40)))) for _ in range(n)]
    rows += [("en", "quiet", None), ("en", "quiet", ""), ("en", "digits", "123 456"), ("xx", "a", "seldom"), ("xx", "b", "words"), ("yy", "alone", "q")]
    rows += [("en", "s1", "copy copy alpha")] * 12 + [("de", "long", "alpha beta " * 30_000)]
    return rows


@pytest.mark.parametrize("blocks", [3, 200_000])
def test_audit_equals_brute_force(spark, blocks):
    rows = corpus()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "lang string, source string, text string, term string, n int").repartition(5)
    got = sorted(tuple(r) for r in divergence.audit(df, min_docs=10, top=4, block_postings=blocks).collect())
    assert got == brute_audit(rows, 10, 4)
    assert any(r[0] == "xx" and r[4] == 0 for r in got)


def test_audit_of_few_and_no_rows(spark):
    none = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(none).count() == 0
    one = spark.createDataFrame([(None, None, None)], "lang string, source string, text string")
    assert divergence.audit(one).count() == 0


def test_terms_over_piece_borders(monkeypatch):
    text = "Alpha beta,gamma delta_epsilon été " * 20 + "x" * 50 + " end"
    want = collections.Counter(t.encode() for t in TERM.findall(text.translate(LOWER)))
    for piece in (1, 3, 7, 64, 1 << 20):
        monkeypatch.setattr(divergence, "PIECE", piece)
        assert divergence.term_counts(text.encode()) == want


def test_probability_is_exact():
    for count, total, kept in [(0, 0, 1), (5, 7, 3), (10 ** 14, 10 ** 15, 10 ** 9), (123456789012, 987654321098, 54321)]:
        assert divergence.probability(count, np.int64(total + 2 * kept)) == 1 + 10 ** 9 * (count + 2) // (total + 2 * kept)


def brute_codes(rows, parts, entries, rounds):
    kept = [(i, l, v) for i, l, v in rows if v is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    bounds = vectorcodes.part_bounds(len(kept[0][2]), parts)
    whole = [[math.floor(1024 * x) for x in v] for _, _, v in kept]
    books = [[v[a:b] for v in whole[:entries]] for a, b in bounds]

    def assign():
        return [[min((sum((x - y) ** 2 for x, y in zip(v[a:b], e)), k) for k, e in enumerate(book)) for v in whole] for (a, b), book in zip(bounds, books)]
    for _ in range(rounds):
        at = assign()
        for p, (a, b) in enumerate(bounds):
            cells = collections.defaultdict(list)
            for v, (_, k) in zip(whole, at[p]):
                cells[k].append(v[a:b])
            books[p] = [[sum(c) // len(cells[k]) for c in zip(*cells[k])] if k in cells else e for k, e in enumerate(books[p])]
    at = assign()
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    errors = [sum(at[p][n][0] for p in range(parts)) for n in range(len(kept))]
    by_label = collections.Counter()
    for (_, l, _), e in zip(kept, errors):
        by_label[l] += e
    return sorted([(i, l, "".join(f"{at[p][n][1]:02x}" for p in range(parts)), errors[n], by_label[l], sha) for n, (i, l, _) in enumerate(kept)], key=repr)


@pytest.mark.parametrize("size,entries", [(8, 16), (6, 5), (8, 300)])
def test_codes_equal_brute_force(spark, size, entries):
    rng = random.Random(size + entries)
    f32 = lambda x: float(np.float32(x))
    rows = [(k, rng.choice([0, 1, None]), [f32(rng.choice([rng.gauss(0, .2), 0.25, -0.25])) for _ in range(size)]) for k in range(150)]
    rows += [(200 + k, 2, rows[0][2]) for k in range(30)] + [(3, 1, rows[9][2]), (3, 1, rows[9][2]), (None, None, rows[7][2])]
    rows += [(400, 1, None), (401, 1, []), (402, 1, [None] * size), (403, 1, [float("nan")] * size), (404, 1, [float("inf")] + [0.0] * (size - 1)), (405, 1, [0.5] * 3)]
    rows += [(500, 5, [-100.5] * size), (501, 5, [99.75] + [0.0] * (size - 1))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, code string, error int").repartition(4)
    out = vectorcodes.encode(df, entries=entries)
    got = sorted([tuple(r) for r in out.select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256").collect()], key=repr)
    want = brute_codes(rows, 4, entries, 4)
    if entries <= 256:
        assert got == want
    else:
        assert [r[3:] for r in got] == [r[3:] for r in want]


def test_search_meets_ties_and_huge_components():
    rng = np.random.default_rng(3)
    for scale in (3, 1000, 2 ** 27):
        x, book = rng.integers(-scale, scale + 1, (700, 16)), rng.integers(-scale, scale + 1, (200, 16))
        book[50:60], x[:40] = book[10:20], book[30:70]
        d = ((x[:, None].astype(object) - book[None].astype(object)) ** 2).sum(axis=2)
        at, least = vectorcodes.nearest(x, book)
        assert at.tolist() == [int(np.argmin(r)) for r in d] and least.tolist() == d.min(axis=1).tolist()


def test_codes_of_no_rows_and_beyond_the_bound(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vectorcodes.encode(spark.createDataFrame([], schema)).count() == 0
    assert vectorcodes.encode(spark.createDataFrame([(1, None, 1), (2, [float("nan")], 1)], schema)).count() == 0
    far = spark.createDataFrame([(k, [3e38, -3e38, 0.0, float(k)], 1) for k in range(5)], schema)
    assert [r["error"] for r in vectorcodes.encode(far, entries=2).collect()]
