"""Instruction (v1) records: fixed prompt template, lengths, uid, dedup key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import V1, SetConfig
from corpusloom.functions.chat import message
from corpusloom.functions.ids import order_key, sha1_join
from corpusloom.functions.text import normalize, prefix
from corpusloom.functions.tokens import count_tokens
from corpusloom.sources.tables import computed_once

# The instruction prompt template (with and without an input).
PROMPT_WITH_INPUT = (
    "Below is an instruction that describes a task, paired with an input "
    "that provides further context. Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{instruction}\n\n"
    "### Input:\n{input}\n\n"
    "### Response:\n"
)
PROMPT_NO_INPUT = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{instruction}\n\n"
    "### Response:\n"
)


def _fill(template: str, **cols):
    """Build ``concat`` of literal pieces and columns from a ``{name}`` template."""
    out, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        out += [F.lit(head), cols[name]]
    out.append(F.lit(rest))
    return F.concat(*out)


def prompt_text(instruction, input_text):
    """Prompt of normalised fields; the input section only when input is non-empty."""
    return (F.when(input_text != "", _fill(PROMPT_WITH_INPUT, instruction=instruction, input=input_text))
            .otherwise(_fill(PROMPT_NO_INPUT, instruction=instruction)))


def instruct_records(rows: DataFrame, cfg: SetConfig = V1, count=count_tokens) -> DataFrame:
    """``(source_index, instruction, input, output)`` -> v1 records (rows with an
    empty instruction or output are dropped)."""
    n = rows.select("source_index", normalize("instruction").alias("instruction"),
                    normalize("input").alias("input_text"), normalize("output").alias("target_text"))
    n = computed_once(n, "instruction", "input_text", "target_text").where((F.col("instruction") != "") & (F.col("target_text") != ""))
    p = prompt_text(F.col("instruction"), F.col("input_text"))
    user = F.when(F.col("input_text") != "",
                  F.concat("instruction", F.lit("\n\nInput:\n"), "input_text")).otherwise(F.col("instruction"))
    x = n.select("*", p.alias("prompt_text"), user.alias("_user"))
    x = x.withColumn("prompt_tokens", count("prompt_text")).withColumn("target_tokens", count("target_text"))
    if count is count_tokens:
        # the prompt ends in a newline and pre-tokens never span whitespace, so the
        # concatenation's count is exactly the sum (saves a pass over the text)
        total = F.col("prompt_tokens") + F.col("target_tokens")
    else:
        total = count(F.concat("prompt_text", "target_text"))
    return x.select(
        sha1_join("source_index", prefix("instruction", cfg.id_chars), prefix("input_text", cfg.id_chars),
                  prefix("target_text", cfg.id_chars)).alias("id"),
        "source_index",
        F.array(message(F.lit("user"), F.col("_user")), message(F.lit("assistant"), F.col("target_text"))).alias("messages"),
        "prompt_text", "target_text",
        "prompt_tokens", "target_tokens", total.cast("int").alias("total_tokens"),
        (F.col("input_text") != "").alias("has_input"),
        F.sha1(F.concat(prefix("prompt_text", cfg.key_chars), F.lit("|||"), prefix("target_text", cfg.key_chars))).alias("dup_key"),
        # the record's own text breaks ties of a repeated source key
        F.concat(order_key(cfg.seed, "scan", "source_index"), F.lit(":"),
                 F.sha1(F.concat("prompt_text", F.lit("|||"), "target_text"))).alias("ord"),
    )


def with_meta(records: DataFrame) -> DataFrame:
    return records.select(
        "id", "messages", "prompt_text", "target_text",
        F.struct(F.col("source_index").cast("long").alias("source_index"), "prompt_tokens", "target_tokens",
                 "total_tokens", "has_input").alias("meta"))
