"""Quality rules with a hashed n-gram log-likelihood ratio, DataFrame functions only.

Runs of 1 to ``ngram`` consecutive words are hashed into ``buckets`` cells: words
and pairs (``NGRAM``) unless told otherwise, single words in tables of fewer than
``PAIR_BUCKETS`` cells, where pairs would share theirs with most words. Two multinomials with
add-``alpha`` smoothing are counted: the raw corpus (every document) and the trusted
target (documents labelled good). The score of a document is the mean over its runs of
log p_target - log p_raw; a document is kept when no base rule fails and the
score is at least ``threshold``. The rule is a fixed comparison, not a draw, so
a document always gets the same verdict.

Only the fitted table of ``buckets`` numbers reaches the driver; its size is a
parameter. The trusted documents are a bounded sample of labelled rows
(``max_trusted`` smallest hashes of the id); corpus counts cover all documents.

Defined cases: a null or blank text has no words, fails the length rule and has
score 0; null ids and repeated rows are judged row by row; an empty table gives
no rows; without any labelled document the target equals the raw corpus and all
scores are 0. Further columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import SPACE_CHARS, read_table, words_of

BUCKETS = 16384
NGRAM = 2
PAIR_BUCKETS = 4096
MAX_TRUSTED = 20_000
THRESHOLD = -0.35
# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"


def longest_run(buckets: int, ngram: int | None = None) -> int:
    """Words in the longest run that a table of ``buckets`` cells is fitted on."""
    return ngram or (NGRAM if buckets >= PAIR_BUCKETS else 1)


def bucket_of(run: Column, buckets: int) -> Column:
    """Cell of a run's hash."""
    return F.pmod(run, F.lit(buckets)).cast("int")


def _with_shifted(a: Column, b: Column, shift: int) -> Column:
    """Hashes of ``a[i], b[i + shift]``; empty when ``b`` is not longer than ``shift``."""
    n = F.greatest(F.size(b) - shift, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(shift + 1), n), lambda x, y: F.xxhash64(x, y))


def with_runs(df: DataFrame, words: str, ngram: int, prefix: str = "_q_run") -> DataFrame:
    """Adds ``<prefix>1`` to ``<prefix><ngram>``: the 64-bit hashes of all runs of so many
    consecutive words by start. A word is hashed once, longer runs from hashes."""
    df = df.withColumn(f"{prefix}1", F.transform(words, lambda w: F.xxhash64(w)))
    for n in range(2, ngram + 1):
        df = df.withColumn(f"{prefix}{n}", _with_shifted(F.col(f"{prefix}{n - 1}"), F.col(f"{prefix}1"), n - 1))
    return df


def _with_windows(df: DataFrame, size: int) -> DataFrame:
    """Adds ``_q_hashes``, the hashes of all windows of ``size`` words, from those of half the
    size; the last step's halves overlap when ``size`` is no power of two."""
    df, have = df.withColumn("_q_hashes", F.col("_q_run1")), 1
    while have < size:
        step = min(have, size - have)
        df = df.withColumn("_q_hashes", _with_shifted(F.col("_q_hashes"), F.col("_q_hashes"), step))
        have += step
    return df


def trusted_ids(labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """At most ``max_trusted`` ids of documents labelled good and not toxic."""
    return (labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull())
            .select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted))


def fit_ratio(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, alpha: float = 0.5,
              max_trusted: int = MAX_TRUSTED, ngram: int | None = None) -> list[float]:
    """Log-likelihood ratio of every bucket (a list of ``buckets`` floats) over the runs of
    1 to ``ngram`` words (:func:`longest_run`); :func:`judge` takes the same ``ngram``."""
    ngram = longest_run(buckets, ngram)
    good = trusted_ids(labels, max_trusted).withColumn("_good", F.lit(1))
    runs = with_runs(docs.select("doc_id", "text").join(F.broadcast(good), "doc_id", "left")   # at most max_trusted ids
                     .select(F.coalesce("_good", F.lit(0)).alias("_good"), words_of(F.col("text")).alias("w")), "w", ngram)
    cells = (runs.select("_good", F.explode(F.concat(*[F.col(f"_q_run{n}") for n in range(1, ngram + 1)])).alias("h"))
             .groupBy(bucket_of(F.col("h"), buckets).alias("b"))
             .agg(F.count(F.lit(1)).alias("raw"), F.sum("_good").alias("target")).collect())
    raw, target = [0] * buckets, [0] * buckets
    for r in cells:
        raw[r["b"]], target[r["b"]] = r["raw"], r["target"]
    n_raw, n_target = sum(raw), sum(target)
    if not n_target:
        return [0.0] * buckets
    import math
    shift = math.log(n_raw + alpha * buckets) - math.log(n_target + alpha * buckets)
    return [math.log(t + alpha) - math.log(r + alpha) + shift for t, r in zip(target, raw)]


def _table(ratio: list[float]) -> Column:
    """The fitted table as one constant array, held by reference in each task."""
    return F.split(F.lit(",".join(repr(round(x, 6)) for x in ratio)), ",").cast("array<double>")


def _covered(hashes: Column, size: int) -> Column:
    """Words covered by windows whose hash occurs twice or more.

    ``hashes`` holds one hash per start. Sorting (hash, start) pairs puts equal
    windows side by side; the flagged starts, back in order, cover ``size`` words
    each less the overlap with the next.
    """
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # one pass over the sorted pairs: a pair is flagged when a neighbour has its hash
    flagged = F.array_sort(F.transform(
        F.filter(F.zip_with(F.zip_with(pairs, F.slice(F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), pairs), 1, F.size(pairs)),
                                       lambda a, b: F.struct(a["h"].alias("h"), a["i"].alias("i"), b["h"].alias("prev"))),
                            F.slice(F.concat(pairs, F.array(F.lit(None).cast("struct<h:bigint,i:int>"))), 2, F.size(pairs)),
                            lambda a, b: F.struct(a["i"].alias("i"), ((a["h"] == a["prev"]) | (a["h"] == b["h"])).alias("two"))),
                 lambda x: x["two"]), lambda x: x["i"]))
    total = F.aggregate(flagged, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
                        lambda acc, s: F.struct((s + size).alias("end"),
                                                (acc["n"] + size - F.greatest(acc["end"] - s, F.lit(0))).alias("n")))
    return total["n"]


def base_columns(df: DataFrame, text: str = "text", window: int = 8, min_words: int = 20,
                 repeat_percent: int = 30, ngram: int = 1) -> DataFrame:
    """Adds the words, their runs (:func:`with_runs`) and the counts of the base rules, prefixed ``_q_``."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.translate(x, SPACE_CHARS, "") != "")
    d = df.withColumns({
        "_q_words": words_of(F.col(text)),
        "_q_lines": lines,
        "_q_chars": F.char_length(F.translate(t, SPACE_CHARS, "")).cast("long"),
        "_q_symbols": (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long")})
    d = _with_windows(with_runs(d, "_q_words", ngram), window)
    d = d.withColumns({"_q_n": F.size("_q_words").cast("long"),
                       "_q_dup": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long")})
    d = d.withColumn("_q_repeat", F.when(F.size(F.array_distinct("_q_hashes")) == F.size("_q_hashes"), F.lit(0))
                     .otherwise(_covered(F.col("_q_hashes"), window)).cast("long"))
    return d.withColumn("_q_failed", (F.col("_q_n") < min_words) | (100 * F.col("_q_repeat") > repeat_percent * F.col("_q_n")))


def judge(df: DataFrame, ratio: list[float], threshold: float = THRESHOLD, text: str = "text",
          ngram: int | None = None) -> DataFrame:
    """``df`` plus the base counts (``_q_*``), ``_q_score`` and ``_q_kept``."""
    table, buckets = _table(ratio), len(ratio)
    ngram = longest_run(buckets, ngram)
    d = base_columns(df, text, ngram=ngram)
    runs = [F.col(f"_q_run{n}") for n in range(1, ngram + 1)]
    sums = [F.aggregate(r, F.lit(0.0).cast("double"), lambda acc, h: acc + F.get(table, bucket_of(h, buckets))) for r in runs]
    total, size = reduce(Column.__add__, sums), reduce(Column.__add__, map(F.size, runs))
    d = d.withColumn("_q_score", F.when(F.col("_q_n") > 0, total / size).otherwise(F.lit(0.0)))
    return d.withColumn("_q_kept", ~F.col("_q_failed") & (F.col("_q_score") >= threshold))


def quality_report(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ratio = fit_ratio(docs, read_table(spark, sf_dir, "labels"), ngram=NGRAM)
    return judge(docs, ratio, ngram=NGRAM).select(
        "doc_id", F.col("_q_n").alias("n_words"), F.col("_q_chars").alias("word_chars"),
        F.col("_q_symbols").alias("n_symbols"), F.col("_q_dup").alias("n_dup_lines"),
        F.col("_q_repeat").alias("n_repeat_words"), F.col("_q_failed").alias("base_failed"),
        F.col("_q_kept").alias("kept"), F.col("_q_score").alias("score"))
