"""Substring dedup, Jaccard join, components and decontamination against brute force."""

import hashlib
import math
import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import decontam, jaccard, substrings
from corpusloom.llm.components import components
from tests.llm.helpers import LOWER, SCHEMA, awkward, frame, text_rows, words


def brute_repeats(rows, length=20):
    seen, out = set(), {}
    for i, text, *_ in sorted(rows):
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            k = tuple(w[s:s + length])
            if k in seen:
                gone[s:s + length] = [True] * length
            seen.add(k)
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_substrings_equal_brute_force(spark, seed):
    rows = awkward(seed) + [(10_000 + i, t, s) for i, t, s in text_rows(120)]
    got = {r[0]: tuple(r[1:]) for r in substrings.remove_repeats(frame(spark, rows)).collect()}
    assert got == brute_repeats(rows)


def test_substrings_nulls_repeats_and_empty(spark):
    long = " ".join(f"x{k}" for k in range(25))
    df = frame(spark, [(None, long, "a"), (5, long, "a"), (5, long, "a"), (7, None, None)])
    got = sorted(((r[0], r[1], r[2]) for r in substrings.remove_repeats(df).collect()), key=str)
    assert got == sorted([(None, 25, 0), (5, 25, 25), (5, 25, 25), (7, 0, 0)], key=str)
    assert substrings.remove_repeats(frame(spark, [])).collect() == []


def test_substrings_tell_rows_of_one_id_apart(spark):
    rng = random.Random(6)
    draw = lambda n: [f"u{rng.randrange(3000)}" for _ in range(n)]
    passage, ends = draw(30), draw(45)
    texts = [draw(40) + passage + draw(20), draw(40) + passage + draw(3), draw(70), passage + draw(12), passage + draw(9),
             draw(11) + ends + draw(30), draw(5) + ends[4:31] + draw(8), ends[9:] + ends[:40] + draw(4), draw(90)]
    rows = [(i, " ".join(t), "a") for k, t in enumerate(texts) for i in ([None, 4] if k % 3 else [None, 4, 9])]
    rows = [(i, t, s) for k, (i, t, s) in enumerate(rows) if k % 4 != 3] + [(None, None, "a"), (None, " ".join(texts[0]), "a")]
    order = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).digest())
    numbered = {k: r for k, r in enumerate(sorted(set(rows), key=order))}
    want = brute_repeats([(k, t, s) for k, (_, t, s) in numbered.items()])
    of = {numbered[k][:2]: v for k, v in want.items()}
    got = sorted((tuple(r) for r in substrings.remove_repeats(frame(spark, rows)).collect()), key=str)
    assert got == sorted(((i, *of[i, t]) for i, t, _ in rows), key=str)


def brute_sets(rows, size):
    out = {}
    for i, text, *_ in rows:
        w = words((text or "").translate(LOWER))
        out[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    return out


def brute_components(rows, size, percent):
    sets = brute_sets(rows, size)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("size,percent,boundary", [(3, 90, None), (5, 80, None), (3, 60, 0), (3, 70, 12), (2, 50, 6), (3, 90, 40)])
def test_jaccard_equals_brute_force(spark, size, percent, boundary, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 5)          # cut lists into blocks
    monkeypatch.setattr(jaccard, "LARGE", 30)         # and use the cell counts
    rows = awkward(size + percent)
    got = {r[0]: (r[1], r[2]) for r in jaccard.component_report(frame(spark, rows), shingle=size, percent=percent, boundary=boundary).collect()}
    assert got == brute_components(rows, size, percent)


def test_jaccard_real_rows(spark):
    rows = text_rows()
    got = {r[0]: (r[1], r[2]) for r in jaccard.component_report(frame(spark, rows), shingle=3, percent=60).collect()}
    assert got == brute_components(rows, 3, 60)


def test_jaccard_nulls_and_empty(spark):
    df = frame(spark, [(None, "a b c d", "x"), (4, "a b c d", "x"), (4, "a b c d", "x"), (None, None, None)])
    got = sorted(((r[0], r[1], r[2]) for r in jaccard.component_report(df).collect()), key=str)
    assert got == sorted([(None, 2, 4), (4, 2, 4), (4, 2, 4), (None, 0, None)], key=str)
    assert jaccard.component_report(frame(spark, [])).collect() == []


def test_representatives_keep_one_of_each_group(spark):
    rows = awkward(9) + [(0, None, "a"), (21, awkward(9)[7][1], "b")]     # a repeated blank and a repeated row
    out = jaccard.representatives(frame(spark, rows).withColumn("component", F.lit(1))).collect()
    comps = brute_components(rows, 5, 80)
    kept = sorted(r["doc_id"] for r in out)
    want = sorted(i for i, (n, c) in comps.items() if n == 0 or c == i)
    assert kept == sorted(want + [0]) and out[0].__fields__[-1] == "component"


def test_representatives_without_ids_or_with_one_id(spark):
    rng = random.Random(12)
    draw = lambda: [f"v{rng.randrange(5000)}" for _ in range(60)]
    five, lone, pair, six, other = draw(), draw(), draw(), draw(), draw()
    near = lambda w: " ".join(w[:-1] + ["last"])
    rows = [(5, " ".join(five), "a"), (None, near(five), "a"), (None, " ".join(lone), "a"), (None, " ".join(lone), "a"),
            (None, " ".join(pair), "a"), (None, near(pair), "a"), (6, " ".join(six), "a"), (6, " ".join(other), "a"), (6, near(six), "a"),
            (7, near(other), "a"), (None, None, "a"), (None, " \t", "a")]
    out = [(r["doc_id"], r["text"]) for r in jaccard.representatives(frame(spark, rows)).collect()]
    assert len(out) == len(set(out)) == 7
    assert {(5, " ".join(five)), (None, " ".join(lone)), (None, None), (None, " \t"), (6, " ".join(other))} <= set(out)
    left = {t for _, t in out}
    assert len(left & {" ".join(pair), near(pair)}) == len(left & {" ".join(six), near(six)}) == 1
    got = sorted(((r[0], r[2]) for r in jaccard.component_report(frame(spark, rows), shingle=5, percent=80).collect()), key=str)
    want = [(5, 5), (None, 5), *[(None, None)] * 6, *[(6, 6)] * 3, (7, 6)]
    assert got == sorted(want, key=str)


def test_boundary_follows_cost():
    assert jaccard.choose_boundary({}, 90) == 0
    x = jaccard.choose_boundary({n: 100 for n in range(1, 60)}, 90)
    assert 10 <= x < 30 and jaccard.subset_count(x + 6, x + 6, 90) > jaccard.SCAN_COST * jaccard.listed(x + 6, 90)


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(k, k + 1) for k in range(200, 260)]
    root = {x: x for e in edges for x in e}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def brute_hits(docs, items, size=5, threshold="0.8"):
    from fractions import Fraction
    flat = lambda t: [w for w in re.sub(r"[\W_]+", " ", (t or "").lower()).split(" ") if w]
    out = set()
    for i, text, *_ in docs:
        w = flat(text)
        for j, it in items:
            v = flat(it)
            if not v:
                continue
            n = min(size, len(v))
            own = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)}
            there = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
            if len(own & there) >= max(1, math.ceil(Fraction(threshold) * len(own))):
                out.add((i, j, len(own), len(own & there)))
    return out


def items_and_docs():
    rng = random.Random(8)
    draw = lambda n: [f"t{rng.randrange(400)}" for _ in range(n)]
    items = [(k, " ".join(draw(n))) for k, n in enumerate([1, 2, 3, 4, 5, 6, 11, 15, 20, 40, 57])] + [(90, None), (91, " .. "), (None, "aa bb cc dd ee ff")]
    docs = [(k, " ".join(draw(rng.randrange(200))), "a") for k in range(12)] + [(100, None, "a"), (101, "", None)]
    for k, (_, t) in enumerate(items):
        if t:
            w = t.split()
            docs.append((200 + k, " ".join(draw(50)) + " " + t.upper().replace(" ", ",  ") + ". " + " ".join(draw(900)), "b"))
            w[len(w) // 2] = "changed"
            docs.append((300 + k, " ".join(w), "b"))
    return items, docs


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_containment_equals_brute_force(spark, threshold):
    """With small tables broadcast, and with every join shuffled."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        items, docs = items_and_docs()
        df = spark.createDataFrame(items, "item_id long, text string")
        hits = decontam.contaminated(frame(spark, docs).withColumn("item_id", F.lit("clash")), df)
        plan = hits._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD") <= 1                                  # one scan of the documents, whatever the item lengths
        got = [(r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in hits.collect()]
        assert len(got) == len(set(got)) and set(got) == brute_hits(docs, items)
        assert len({min(5, len(t.split())) for _, t in items if t and t.split()}) > 1
        flagged = {i for i, *_ in got}
        clean = decontam.clean_documents(frame(spark, docs), df).collect()
        assert sorted(r["doc_id"] for r in clean) == sorted(i for i, *_ in docs if i not in flagged)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_containment_empty_tables(spark):
    items, docs = items_and_docs()
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.flagged_documents(frame(spark, docs), none).collect() == []
    assert decontam.flagged_documents(frame(spark, []), spark.createDataFrame(items, "item_id long, text string")).collect() == []
    assert decontam.clean_documents(frame(spark, docs), none).count() == len(docs)
    assert frame(spark, [], SCHEMA).columns == ["doc_id", "text", "source"]
