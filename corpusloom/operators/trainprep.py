"""Fine-tuning and calibration inputs: rendered texts, lengths, keep gate,
train/eval split, left/right truncation, assistant-only labels, padded batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import CalibConfig, TrainConfig
from corpusloom.functions import chat as C
from corpusloom.functions.ids import order_key
from corpusloom.functions.text import strip
from corpusloom.functions.tokens import count_tokens, token_ids
from corpusloom.operators.dictionary import encode_texts, tokens_before
from corpusloom.operators.sample import global_index, split_train_eval, take_first_n

TRAIN = TrainConfig()
CALIB = CalibConfig()
IGNORE = -100


def _empty_messages() -> Column:
    return F.array().cast(C.MESSAGE_DDL)


def train_rows(rows: DataFrame, cfg: TrainConfig = TRAIN, template=C.DEFAULT_TEMPLATE,
               count=count_tokens) -> DataFrame:
    """Rendered prompt (with generation prompt) and full chat, raw lengths, target
    length ``max(full - prompt, 0)`` and ``sup_after_trunc = min(target, max_seq_len)``."""
    pm = F.coalesce(F.col("prompt_messages"), _empty_messages())
    mm = F.coalesce(F.col("messages"), _empty_messages())
    x = rows.select("id", C.render(pm, True, template).alias("prompt_text"),
                    C.render(mm, False, template).alias("full_text"))
    x = x.withColumn("prompt_len_raw", count("prompt_text")).withColumn("full_len_raw", count("full_text"))
    tl = F.greatest(F.col("full_len_raw") - F.col("prompt_len_raw"), F.lit(0))
    return (x.withColumn("target_len_raw", tl)
            .withColumn("sup_after_trunc", F.least(F.col("target_len_raw"), F.lit(cfg.max_seq_len))))


def keep_trainable(tr: DataFrame, cfg: TrainConfig = TRAIN) -> DataFrame:
    return tr.where((F.col("prompt_text") != "") & (F.col("full_text") != "")
                    & (F.col("sup_after_trunc") >= cfg.min_sup_tokens))


def train_eval_split(tr: DataFrame, cfg: TrainConfig = TRAIN) -> DataFrame:
    """Seeded hold-out: ``split`` column with ceil(ratio * n) 'eval' rows."""
    x = tr.withColumn("ord", order_key(cfg.seed, "split", "id"))
    return split_train_eval(x, cfg.eval_ratio, "ord")


def truncate_left(ids, max_len: int) -> Column:
    """Keep the last ``max_len`` ids."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.when(F.size(ids) > max_len, F.slice(ids, -max_len, max_len)).otherwise(ids)


def truncate_right(ids, max_len: int) -> Column:
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.slice(ids, 1, max_len)


def assistant_labels(ids, prompt_len, full_len, max_len: int) -> Column:
    """Mask the prompt part that survives left truncation with -100."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    overflow = F.greatest(F.col(full_len) - max_len, F.lit(0))
    kept = F.least(F.greatest(F.col(prompt_len) - overflow, F.lit(0)), F.size(ids))
    return F.transform(ids, lambda x, j: F.when(j < kept, F.lit(IGNORE)).otherwise(x))


def tokenize_train(tr: DataFrame, cfg: TrainConfig = TRAIN, ids_fn=token_ids) -> DataFrame:
    x = tr.withColumn("input_ids", truncate_left(ids_fn(F.col("full_text")), cfg.max_seq_len))
    return x.withColumn("labels", assistant_labels("input_ids", "prompt_len_raw", "full_len_raw", cfg.max_seq_len))


def tokenize_train_ids(tr: DataFrame, pattern: str, make_encoder, cfg: TrainConfig = TRAIN) -> DataFrame:
    """``tokenize_train`` with a vocabulary's ids. The mask comes from byte offsets: a token is
    prompt if it starts before the end of the prompt's text, so the prompt is not encoded again
    and a piece that would be cut otherwise at the prompt's end moves nothing."""
    x = encode_texts(tr, "full_text", pattern, make_encoder)
    x = (x.withColumn("prompt_ids", tokens_before("sizes", F.octet_length("prompt_text"))).withColumn("full_ids", F.size("ids"))
         .withColumn("input_ids", truncate_left("ids", cfg.max_seq_len)))
    return x.withColumn("labels", assistant_labels("input_ids", "prompt_ids", "full_ids", cfg.max_seq_len)).drop("ids", "sizes")


def pad_batches(tok: DataFrame, batch_size: int, cfg: TrainConfig = TRAIN, order: str = "ord") -> DataFrame:
    """Consecutive batches in ``order``; each row padded to its batch's longest row.
    Padded labels are -100 by attention mask (a real pad-equal token keeps its label)."""
    # only (order, length) is numbered and grouped; the arrays are joined to their batch once
    spots = (global_index(tok.select(order, F.size("input_ids").alias("_len")), order)
             .select(order, "_len", F.floor(F.col("idx") / batch_size).alias("batch_id"), "idx"))
    longest = spots.groupBy("batch_id").agg(F.max("_len").alias("_max"))
    x = tok.join(spots.join(longest, "batch_id"), order)
    pad = F.greatest(F.col("_max") - F.col("_len"), F.lit(0))
    return (x.withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), F.col("_len")), F.array_repeat(F.lit(0), pad)))
            .withColumn("input_ids", F.concat("input_ids", F.array_repeat(F.lit(cfg.pad_id), pad)))
            .withColumn("labels", F.concat("labels", F.array_repeat(F.lit(IGNORE), pad)))
            .drop("_len", "_max"))


def calib_text(rows: DataFrame, template=C.DEFAULT_TEMPLATE) -> DataFrame:
    """Rendered chat per row ('' for missing/empty messages); blank texts dropped."""
    m = F.col("messages")
    t = F.when(m.isNotNull() & (F.size(m) > 0), C.render(m, False, template)).otherwise(F.lit(""))
    return rows.select("id", t.alias("text")).where(strip("text") != "")


def calib_select(texts: DataFrame, cfg: CalibConfig = CALIB) -> DataFrame:
    """Seeded shuffle, then the first ``min(n, rows)`` rows."""
    x = texts.withColumn("ord", order_key(cfg.seed, "calib_shuffle", "id"))
    return take_first_n(x, cfg.num_samples, "ord")


def calib_tokens(sel: DataFrame, cfg: CalibConfig = CALIB, ids_fn=token_ids) -> DataFrame:
    return sel.withColumn("input_ids", truncate_right(ids_fn(F.col("text")), cfg.max_seq_len)) \
              .withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))
