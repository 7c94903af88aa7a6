"""Knowledge-distillation set: prompt selection, teacher-text cleaning and judging,
record assembly and reject counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import DistillConfig
from corpusloom.functions import chat as C
from corpusloom.functions.ids import order_key
from corpusloom.functions.text import clean_lines, normalize, prefix, strip, words
from corpusloom.functions.tokens import count_tokens
from corpusloom.operators.sample import first_n_per_key

KD = DistillConfig()


def kd_source(sft_rows: DataFrame, cfg: DistillConfig = KD, template=C.DEFAULT_TEMPLATE,
              count=count_tokens) -> DataFrame:
    """Rows of an SFT table that can become distillation prompts, with their keys.

    Prompt present, rendered prompt within the token limit, gold target non-blank;
    dedup key = last user message and gold target (hashed before the shuffle: same
    equality, 40 bytes per row). The order value ends in the prompt's own hash, so
    different prompts that share an id are both kept.
    """
    rows = sft_rows.where(F.col("prompt_messages").isNotNull() & (F.size("prompt_messages") > 0))
    rendered = C.render("prompt_messages", True, template)
    gold = normalize("target_text")
    last_user = normalize(C.last_content("prompt_messages", "user"))
    key = F.coalesce(F.col("id"), F.concat(F.lit("row_"), F.col("source_index").cast("string")))
    extra = [c for c in ("source_index", "turn_index") if c in rows.columns]
    x = rows.select(
        key.alias("id"), *extra, "prompt_messages", "messages", gold.alias("gold_target"),
        count(rendered).alias("prompt_tokens"),
        F.sha1(strip(F.concat(prefix(last_user, cfg.prompt_key_chars), F.lit("|||"), prefix(gold, cfg.gold_key_chars)))).alias("dup_key"),
        F.concat(order_key(cfg.seed, "kd", key), F.lit(":"), F.sha1(F.concat(C.messages_sha("prompt_messages"), gold))).alias("ord"),
    )
    return x.where((F.col("prompt_tokens") <= cfg.max_prompt_tokens) & (F.col("gold_target") != ""))


def kd_prompts(sft_rows: DataFrame, cfg: DistillConfig = KD, n: int | None = None, count=count_tokens) -> DataFrame:
    """First ``n`` distinct prompts in seeded order (the quota may stay unfilled)."""
    n = cfg.n_kd if n is None else n
    out = first_n_per_key(kd_source(sft_rows, cfg, count=count), n, "dup_key")
    if out.isEmpty():
        raise RuntimeError("No valid KD prompts collected.")
    return out


def clean_teacher_text(c, markers=KD.markers) -> Column:
    """Strip; cut at the first occurrence of each marker in turn (re-stripping);
    strip every line, drop empty ones."""
    # one fold over the marker list: a single expression node however often the
    # cleaned text is referenced downstream (a nested chain would be inlined)
    cut = F.aggregate(F.array(*[F.lit(m) for m in markers]), strip(c),
                      lambda acc, m: strip(F.call_function("substring_index", acc, m, F.lit(1))))
    return strip(clean_lines(cut))


def repetitive_from_counts(n_words, n_distinct, min_words: int = KD.repetition_min_words,
                           ratio: float = KD.repetition_ratio) -> Column:
    n, d = F.col(n_words), F.col(n_distinct)
    return F.when(n < min_words, F.lit(False)).otherwise(d / n < F.lit(float(ratio)))


def is_repetitive(c, min_words: int = KD.repetition_min_words, ratio: float = KD.repetition_ratio) -> Column:
    """At least ``min_words`` words and distinct/total below ``ratio`` (case-sensitive)."""
    w = words(c)
    n = F.size(w)
    return F.when(n < min_words, F.lit(False)).otherwise(F.size(F.array_distinct(w)) / n < F.lit(float(ratio)))


def reject_reason(text, cfg: DistillConfig = KD, count=count_tokens) -> Column:
    """First failing check of a cleaned teacher text, or 'ok'."""
    t = F.col(text) if isinstance(text, str) else text
    n = count(t)
    return (F.when(t.isNull(), F.lit("missing"))
            .when(t == "", F.lit("empty"))
            .when(t.contains("###"), F.lit("marker"))
            .when(is_repetitive(t, cfg.repetition_min_words, cfg.repetition_ratio), F.lit("repetitive"))
            .when(n < cfg.min_teacher_tokens, F.lit("too_short"))
            .when(n > cfg.max_teacher_tokens, F.lit("too_long"))
            .otherwise(F.lit("ok")))


def judge(prompts: DataFrame, generations: DataFrame, cfg: DistillConfig = KD, count=count_tokens) -> DataFrame:
    """Left join prompts to generations (``id, text``): missing output = rejected.

    An id that was generated more than once counts once, with its least text, so
    prompts never multiply.
    """
    g = generations.groupBy("id").agg(F.min("text").alias("_raw"))
    j = prompts.join(g, "id", "left")
    cleaned = F.when(F.col("_raw").isNotNull(), clean_teacher_text(F.col("_raw"), cfg.markers))
    j = j.withColumn("teacher_target", cleaned)
    return j.withColumn("reason", reject_reason("teacher_target", cfg, count)).drop("_raw")


def kd_records(judged: DataFrame, cfg: DistillConfig = KD, count=count_tokens) -> DataFrame:
    """Accepted rows as written records: the teacher answer appended to the prompt."""
    ok = judged.where(F.col("reason") == "ok")
    return ok.select(
        "id", "prompt_messages",
        F.concat("prompt_messages", F.array(C.message(F.lit("assistant"), F.col("teacher_target")))).alias("messages"),
        "gold_target", "teacher_target",
        F.struct(F.lit(cfg.teacher_model).alias("teacher_model"), "prompt_tokens",
                 count(F.col("teacher_target")).alias("teacher_target_tokens")).alias("meta"))


def kd_rejects(judged: DataFrame) -> DataFrame:
    return judged.groupBy("reason").agg(F.count("*").alias("n"))
