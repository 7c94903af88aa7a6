"""Benchmark decontamination: MinHash containment search, DataFrame functions only.

Question: which documents hold at least ``threshold`` of a test item's distinct
five-word shingles? Test items are short and documents long, so a symmetric
Jaccard signature would miss them. Instead items are partitioned by size (their
number n of distinct shingles) and each item is represented by its k smallest
shingle hashes, with k = n - ceil(threshold * n) + 1 chosen per size. A document
that holds the threshold lacks at most k - 1 shingles, so it holds at least one of
the k minima: the search has no false negatives. Candidates are then verified by
exact comparison of the shingle strings.

Items with fewer than five words have one shingle, the whole item, and are matched at
their own length; a document's shingles of all item lengths are made in one pass and
met with the minima in one join. Only (text hash, shingle hash) takes part in it; the
texts of candidates are fetched by their hash afterwards and verified. The minima and
the candidates are written tables, so Spark broadcasts them only if their measured
size is below its threshold and shuffles otherwise.

Words are lower-cased runs of letters and digits, so case and punctuation do not
hide a passage. Defined cases: null or empty texts and items match nothing; a
null id is kept as null; repeated documents are reported each, repeated items
(same id and text) once; empty tables give no rows; other columns pass through
``contaminated`` and may have any name but the ``_dc_`` prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import hashed_shingles, let
from corpusloom.session import scratch_path

SHINGLE = 5
THRESHOLD = 0.8


def match_words(text: Column) -> Column:
    flat = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.filter(F.split(flat, " "), lambda w: w != "")


def _runs(words: Column, size: Column | int) -> Column:
    """All runs of ``size`` words as strings, by start."""
    def runs(w):
        n = F.size(w) - size + 1
        starts = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, size), " "))
    return let(words, runs)


def _shingle_hashes(shingles: Column) -> Column:
    """The hash that ``hashed_shingles`` gives for the same words."""
    return F.transform(shingles, lambda s: F.xxhash64(F.split(s, " ")))


def item_shingles(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = SHINGLE,
                  threshold: float = THRESHOLD) -> DataFrame:
    """``(item_id, _dc_len, _dc_shingles, _dc_need, _dc_minima)``, one row per item."""
    w = items.select(F.col(item_id).alias("_dc_item"), match_words(F.col(text)).alias("w")).where(F.size("w") > 0).distinct()
    w = w.withColumn("_dc_len", F.least(F.size("w"), F.lit(size)))
    w = w.withColumn("_dc_shingles", F.array_distinct(_runs(F.col("w"), F.col("_dc_len"))))
    n = F.size("_dc_shingles")
    # decimal arithmetic: 0.8 * 15 must be 12, not 12.000000000000002
    need = F.ceil(F.lit(str(threshold)).cast("decimal(6,4)") * n).cast("int")
    w = w.withColumn("_dc_need", F.greatest(need, F.lit(1)))
    hashes = F.array_sort(_shingle_hashes(F.col("_dc_shingles")))
    return w.withColumn("_dc_minima", F.slice(hashes, 1, n - F.col("_dc_need") + 1)).drop("w")


def _text_key(text: str) -> list[Column]:
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return [F.xxhash64(t).alias("_dc_k1"), F.xxhash64(F.lit(1), t).alias("_dc_k2")]


def candidates(docs: DataFrame, minima: DataFrame, lengths: list[int], text: str = "text") -> DataFrame:
    """Distinct ``(_dc_k1, _dc_k2, _dc_spec)``: texts, by hash, that hold a minimum of an
    item (``minima (_dc_h, _dc_spec)``); ``lengths`` are the shingle lengths of the items."""
    def hashes(w):
        return F.array_distinct(F.concat(*[hashed_shingles(w, n) for n in lengths]))
    # explode_outer: a plain explode would add a filter that evaluates the hashes again
    shingles = docs.select(*_text_key(text), F.explode_outer(let(match_words(F.col(f"`{text}`")), hashes)).alias("_dc_h"))
    return shingles.where(F.col("_dc_h").isNotNull()).join(minima, "_dc_h").select("_dc_k1", "_dc_k2", "_dc_spec").distinct()


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row per (document row, item) at or over the threshold: the columns of
    ``docs`` but the text, plus ``item_id, n_shingles, n_found, containment`` (input
    columns of these names are replaced)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "decontamination")
    keep = [c for c in docs.columns if c not in (text, "item_id", "n_shingles", "n_found", "containment")]
    item_shingles(items, item_id, item_text, size, threshold).withColumn("_dc_spec", F.monotonically_increasing_id()).write.parquet(f"{path}/items")
    spec = spark.read.parquet(f"{path}/items")
    lengths = sorted(r[0] for r in spec.select("_dc_len").distinct().collect())     # at most ``size`` different lengths
    spec.select(F.explode("_dc_minima").alias("_dc_h"), "_dc_spec").write.parquet(f"{path}/minima")
    candidates(docs, spark.read.parquet(f"{path}/minima"), lengths or [size], text).write.parquet(f"{path}/candidates")
    found = spark.read.parquet(f"{path}/candidates")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_dc_text"), *_text_key(text))
    pair = (rows.join(found, ["_dc_k1", "_dc_k2"])
            .join(spec.select("_dc_spec", "_dc_item", "_dc_len", "_dc_shingles", "_dc_need"), "_dc_spec"))
    count = F.size(F.array_intersect(_runs(match_words(F.col("_dc_text")), F.col("_dc_len")), F.col("_dc_shingles")))
    return (pair.withColumn("n_found", count).where(F.col("n_found") >= F.col("_dc_need"))
            .select(*[F.col(f"`{c}`") for c in keep], F.col("_dc_item").alias("item_id"), F.size("_dc_shingles").alias("n_shingles"), "n_found")
            .withColumn("containment", F.col("n_found") / F.col("n_shingles")))


def flagged_documents(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """One row per contaminated document id: items found and the highest containment."""
    hits = contaminated(docs.select("doc_id", "text"), items, **kw)
    return (hits.groupBy("doc_id")
            .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("containment").alias("max_containment"))
            .select("doc_id", "item_ids", F.size("item_ids").cast("long").alias("n_items"), "max_containment"))


def clean_documents(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """``docs`` without the rows whose id is contaminated (rows without an id stay
    unless a null id is itself flagged)."""
    bad = flagged_documents(docs, items, **kw).select(F.col("doc_id").alias("_dc_id"))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_dc_id")), "left_anti")
