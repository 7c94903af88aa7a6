"""Term-level audit of how the sources of a language differ.

Every (language, source) group has smoothed term probabilities in billionths,
``p = 1 + floor(10^9 * (count + 2) / (N + 2 V))`` over the V terms that at least
``min_docs`` documents of the language hold; two distributions differ at a term by
``f = floor((p - q)^2 / (p + q))``. The report compares each pair of groups of a
language (sum of f over all kept terms) and each group with its language (its most
over-represented terms).

* Counting. Texts are split into bytes words and counted per batch (term and
  document counts), then added up; only distinct terms of a batch are shuffled.
* Pairs by Gustavson's row accumulation. Kept terms are dealt into blocks; a block
  holds the term-major index of its terms (posting lists of groups). Each group
  walks its own terms, scatters what each posting adds into one dense accumulator
  with a cell per peer, and emits the accumulator: a row per pair and block, never a
  row per pair of postings.
* Zero baseline. A term that a group lacks still has a probability, so every cell
  starts from ``V * f(zero, zero)``; a posting then adds the difference to the case in
  which one side or both sides lack the term. One-sided differences depend on the
  count alone and are added once per distinct count.

All arithmetic is in integers; the division is done in three steps of a thousand, so
``N + 2 V`` may reach 9 * 10^15.

Defined cases: null text, language and source read as ''; a group without terms has
the zero probability everywhere; a language without kept terms gives pairs of value 0
and no term rows; repeated rows count again; ties rank by item in UTF-8 order;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import scratch_path

# Bytes that end a term (ASCII but letters) and the smoothing.
SCALE, EXTRA = 1_000_000_000, 2
ENDS = bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
TO_TERMS = bytes.maketrans(ENDS + bytes(range(0x41, 0x5B)), b" " * len(ENDS) + bytes(range(0x61, 0x7B)))
PIECE = 1 << 20                # bytes of a text that are split at a time
KEEP = 200_000                 # counted (group, term) pairs held before they are given out
BLOCK_POSTINGS = 200_000       # postings of a block, on average
COUNTS = "lang string, source string, term string, n long, docs long"


def term_counts(raw: bytes) -> Counter:
    """Occurrences of each term of a UTF-8 text."""
    out, rest = Counter(), b""
    for at in range(0, len(raw), PIECE):
        piece = rest + raw[at:at + PIECE].translate(TO_TERMS)
        cut = piece.rfind(b" ") + 1                          # what follows may go on in the next piece
        out.update(piece[:cut].split())
        rest = piece[cut:]
    out.update(rest.split())
    return out


def _count(batches):
    terms: dict = defaultdict(Counter)
    docs: dict = defaultdict(Counter)

    def given():
        for (lang, source), c in terms.items():
            own = docs[lang, source]
            yield pa.record_batch({"lang": pa.array([lang] * len(c), pa.string()), "source": pa.array([source] * len(c), pa.string()),
                                   "term": pa.array(list(c), pa.binary()).cast(pa.string()), "n": pa.array(list(c.values()), pa.int64()),
                                   "docs": pa.array([own[t] for t in c], pa.int64())})
        terms.clear()
        docs.clear()

    held = 0
    for batch in batches:
        lang, source, text = batch.columns
        for k in range(batch.num_rows):
            group, found = (lang[k].as_py(), source[k].as_py()), term_counts(text[k].as_buffer().to_pybytes())
            before = len(terms[group])
            terms[group].update(found)
            docs[group].update(found.keys())
            held += len(terms[group]) - before
            if held > KEEP:
                yield from given()
                held = 0
    yield from given()


def probability_sql(count: str, total: str, kept: str) -> str:
    """``1 + floor(10^9 * (count + 2) / (total + 2 * kept))`` over longs, in three steps of a thousand."""
    whole, rest, out = f"({total} + {EXTRA}L * {kept})", f"({count} + {EXTRA}L)", "1L"
    for scale in (1_000_000, 1_000, 1):
        out = f"{out} + {scale}L * ({rest} * 1000L div {whole})"
        rest = f"({rest} * 1000L % {whole})"
    return f"({out})"


def probability(count, whole) -> np.ndarray:
    rest, out = np.asarray(count, np.int64) + EXTRA, np.int64(0)
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return 1 + out


def _apart(p, q):
    return (p - q) ** 2 // (p + q)


def _accumulate(key, postings: pa.Table, groups: pa.Table) -> pa.Table:
    """The accumulators of one block: per group a the cells of its peers a+1, a+2, ..."""
    lang, block = key[0].as_py(), key[1].as_py()
    order = np.argsort(groups["idx"].to_numpy())
    total, kept = groups["total"].to_numpy()[order], int(groups["kept"][0].as_py())
    size = len(order)
    cells = [np.zeros(size - 1 - a, np.int64) for a in range(size)]
    if kept:
        whole = total + EXTRA * kept
        zero = probability(0, whole)
        term = postings["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        group, count = postings["idx"].to_numpy(), postings["n"].to_numpy()
        by_term = np.lexsort((group, term))                 # term-major index: postings of a term by group
        term, group, count = term[by_term], group[by_term], count[by_term]
        p = probability(count, whole[group])
        ends = np.searchsorted(term, term, side="right")
        rows = np.argsort(group, kind="stable")              # group-major view of the same postings
        row_first = np.searchsorted(group[rows], np.arange(size + 1))
        # distinct (group, count): how often, and the probability
        seen = np.lexsort((count, group))
        fresh = np.flatnonzero(np.concatenate([[True], (np.diff(group[seen]) != 0) | (np.diff(count[seen]) != 0)])) if len(seen) else seen
        often, h_group, h_p = np.diff(np.append(fresh, len(seen))), group[seen][fresh], p[seen][fresh]
        h_first = np.searchsorted(h_group, np.arange(size + 1))
        for a in range(size - 1):
            cell, peers = cells[a], zero[a + 1:]
            base = _apart(zero[a], peers)
            if block == 0:
                cell += kept * base
            for k in range(h_first[a], h_first[a + 1]):      # own terms that the peer lacks
                cell += often[k] * (_apart(h_p[k], peers) - base)
            later = slice(h_first[a + 1], None)              # terms of the peers that this group lacks
            to = h_group[later] - a - 1
            np.add.at(cell, to, often[later] * (_apart(zero[a], h_p[later]) - base[to]))
            own = rows[row_first[a]:row_first[a + 1]]        # terms of both: take both one-sided parts back
            more = ends[own] - own - 1
            first = np.cumsum(more) - more
            other = np.repeat(own + 1 - first, more) + np.arange(more.sum())
            mine, to = np.repeat(p[own], more), group[other] - a - 1
            np.add.at(cell, to, _apart(mine, p[other]) - _apart(mine, peers[to]) - _apart(zero[a], p[other]) + base[to])
    return pa.table({"lang": pa.array([lang] * size, pa.string()), "a": pa.array(range(size), pa.int32()),
                     "cells": pa.array([c.tolist() for c in cells], pa.list_(pa.int64()))})


def _term_tables(docs: DataFrame, lang: str, source: str, text: str, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """``postings (lang, source, term, n, lang_n)`` of kept terms, and every group of the
    table as ``(lang, source, idx, total, kept, lang_total, postings)``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "divergence")
    word = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(word(lang).alias("lang"), word(source).alias("source"), word(text).alias("text"))
    (rows.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
     .write.parquet(f"{path}/counts"))
    counts = spark.read.parquet(f"{path}/counts")
    kept = (counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
            .where(F.col("docs") >= min_docs).drop("docs"))
    counts.drop("docs").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n").write.parquet(f"{path}/kept")
    postings = spark.read.parquet(f"{path}/kept")
    per_group = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"))
    sums = per_group.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("k").alias("postings"))
    terms = postings.groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    groups = (rows.select("lang", "source").distinct()
              .withColumn("idx", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
              .join(per_group.drop("k"), ["lang", "source"], "left").join(sums, "lang", "left").join(terms, "lang", "left")
              .na.fill(0, ["total", "kept", "lang_total", "postings"]))
    groups.write.parquet(f"{path}/groups")
    return postings, spark.read.parquet(f"{path}/groups")


def pair_divergence(postings: DataFrame, groups: DataFrame, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """``(lang, source, item, value)`` of each ordered pair of groups of a language."""
    # a block is worth its accumulators: at least an eighth as many postings as it has cells
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("g"), F.max("postings").alias("k")).select(
        "lang", F.greatest(F.lit(1), F.ceil(F.col("k") / F.greatest(F.lit(block_postings), F.col("g") * F.col("g") / 8))).cast("int").alias("blocks"))
    left = (postings.join(groups.select("lang", "source", "idx"), ["lang", "source"]).join(langs, "lang")
            .select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "term", "idx", "n"))
    right = (groups.join(langs, "lang").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("lang", "block", "idx", "total", "kept").toDF("lang", "block", "idx", "total", "kept"))
    cells = (left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block"))
             .applyInArrow(_accumulate, "lang string, a int, cells array<long>")
             .select("lang", "a", F.posexplode("cells").alias("at", "v")).withColumn("b", F.col("a") + F.col("at") + 1)
             .groupBy("lang", "a", "b").agg(F.sum("v").alias("value")))
    both = cells.select("lang", "value", F.explode(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
    both = both.select("lang", "value", F.col("e.a").alias("a"), F.col("e.b").alias("b"))
    name = groups.select("lang", "idx", "source")
    return (both.join(name.toDF("lang", "a", "source"), ["lang", "a"]).join(name.toDF("lang", "b", "item"), ["lang", "b"])
            .select("lang", "source", "item", "value"))


def term_divergence(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` of the terms that a group has more of than its language."""
    p, q = probability_sql("n", "total", "kept"), probability_sql("lang_n", "lang_total", "kept")
    rows = (postings.join(groups.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"])
            .select("lang", "source", F.col("term").alias("item"), F.expr(p).alias("p"), F.expr(q).alias("q")))
    return rows.where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 10, top: int = 10,
          block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: all pairs (part ``pair``) and the
    ``top`` over-represented terms (part ``term``) of every group."""
    postings, groups = _term_tables(docs, lang, source, text, min_docs)
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_divergence(postings, groups, block_postings).withColumn("rank", F.row_number().over(best))
    terms = term_divergence(postings, groups).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(*cols)
            .unionByName(terms.withColumn("part", F.lit("term")).select(*cols)))
