"""Scoring multiple-choice predictions and the accuracy tables built from them."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import EvalConfig
from corpusloom.functions.text import normalize

EVAL = EvalConfig()
NEG = -1e30


def letter_token_ids(encode, k: int) -> list[list[int]]:
    """Which single tokens stand for each of the first ``k`` letters, with and without
    a space before it; a letter may have none. ``encode`` gives the ids of a string."""
    forms = [(i, lead + string.ascii_uppercase[i]) for i in range(k) for lead in ("", " ")]
    single = [(i, ids[0]) for i, form in forms if len(ids := list(encode(form))) == 1]
    return [sorted({t for j, t in single if j == i}) for i in range(k)]


def choose_letter(logprobs, letter_ids: list[list[int]], k) -> Column:
    """0-based index of the best letter among the first ``k``: highest logprob over
    each letter's candidate token ids, ties to the earliest letter; NaN, -inf and
    absent ids never win. Null when no candidate id has a usable logprob.

    ``letter_ids`` is computed once on the driver (from the tokenizer) and
    shipped as a literal ``array<array<int>>``.
    """
    lp = F.col(logprobs) if isinstance(logprobs, str) else logprobs
    table = F.array(*[F.array(*[F.lit(t) for t in ids]).cast("array<int>") for ids in letter_ids])
    k = F.lit(k) if isinstance(k, int) else k
    short = F.raise_error(F.concat(F.lit(f"the letter table has {len(letter_ids)} letters, a question has "), k.cast("string")))
    cands = F.when(k > len(letter_ids), short.cast("array<array<int>>")).otherwise(F.slice(table, 1, F.greatest(k, F.lit(0))))

    def per_letter(a, i):
        ok = F.filter(a, lambda t: (F.try_element_at(lp, t) > F.lit(NEG)) & ~F.isnan(F.try_element_at(lp, t)))
        return F.transform(ok, lambda t: F.struct(F.try_element_at(lp, t).alias("v"), (-i).alias("n")))

    best = F.array_max(F.flatten(F.transform(cands, per_letter)))
    return -best["n"]


def predict(df: DataFrame, letter_ids: list[list[int]], logprobs: str = "logprobs", text: str = "text",
            k: str = "num_choices") -> Column:
    """Predicted index or null (unknown): no output -> unknown; logprob letter; else
    the first character of the generated text if it is one of the ``k`` letters."""
    lp_pick = choose_letter(logprobs, letter_ids, F.col(k))
    first = F.upper(F.substring(normalize(text), 1, 1))
    fallback = F.when((F.length(first) == 1) & (F.ascii(first) >= 65) & (F.ascii(first) < 65 + F.col(k)),
                      F.ascii(first) - 65)
    no_output = F.col(logprobs).isNull() & F.col(text).isNull()
    return F.when(no_output, F.lit(None).cast("int")).otherwise(F.coalesce(lp_pick, fallback)).cast("int")


def metrics(preds: DataFrame, overall: str | None = EVAL.overall_name) -> DataFrame:
    """Per (model, dataset) accuracy; plus one ``overall`` row per model when asked
    (one GROUPING SETS aggregate, all ratios from integer sums)."""
    p = preds.select("model", F.col("task").alias("dataset"),
                     F.col("pred_idx").isNull().cast("int").alias("u"),
                     (F.col("pred_idx") == F.col("answer_idx")).cast("int").alias("c"))
    sets = [("model", "dataset"), ("model",)] if overall else [("model", "dataset")]
    agg = (p.groupingSets(sets, "model", "dataset")
           .agg(F.grouping("dataset").alias("_g"), F.count("*").alias("n"),
                F.sum(F.coalesce(F.col("c"), F.lit(0))).cast("long").alias("correct"),
                F.sum("u").cast("long").alias("unknown"))
           .withColumn("dataset", F.when(F.col("_g") == 1, F.lit(overall)).otherwise(F.col("dataset"))))
    return agg.select(
        "model", "dataset", F.col("n").cast("long").alias("n"),
        (F.col("correct") / F.greatest(F.col("n"), F.lit(1))).alias("acc"),
        (F.col("correct") / F.greatest(F.col("n") - F.col("unknown"), F.lit(1))).alias("acc_known_only"),
        "unknown", (F.col("unknown") / F.greatest(F.col("n"), F.lit(1))).alias("unknown_rate"))


def order_metrics(m: DataFrame, order=EVAL.dataset_order) -> DataFrame:
    """Display order: datasets in the fixed order (others last), then model."""
    pos = F.array_position(F.array(*[F.lit(d) for d in order]), F.col("dataset"))
    return m.orderBy(F.when(pos > 0, pos).otherwise(F.lit(len(order) + 1)), "dataset", "model")


def model_name(path) -> Column:
    """Basename of a model path (trailing '/' removed)."""
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(F.regexp_replace(p, "/+$", ""), "[^/]*$", 0)


def accuracy_pivot(m: DataFrame, models: list[str], order=EVAL.dataset_order) -> DataFrame:
    """Datasets (fixed order, others dropped) x models -> acc; duplicates raise."""
    order_arr = F.array(*[F.lit(d) for d in order])
    one = m.where(F.col("dataset").isin(*order)).groupBy("dataset", "model").agg(F.first("acc").alias("acc"), F.count("*").alias("k"))
    checked = F.when(F.col("k") > 1, F.raise_error(F.lit("duplicate (model, dataset) rows in metrics")).cast("double")).otherwise(F.col("acc"))
    pv = one.select("dataset", "model", checked.alias("acc")).groupBy("dataset").pivot("model", models).agg(F.first("acc"))
    return pv.withColumn("pos", F.array_position(order_arr, F.col("dataset")).cast("int")).orderBy("pos")


def quant_delta(pre: DataFrame, post: DataFrame) -> DataFrame:
    """Accuracy change per (model, dataset) after quantisation."""
    a = pre.select("model", "dataset", F.col("acc").alias("pre_acc"))
    b = post.select("model", "dataset", F.col("acc").alias("post_acc"))
    return a.join(b, ["model", "dataset"]).withColumn("delta", F.col("post_acc") - F.col("pre_acc"))
