"""Chat (v2) training records: normalise, truncate, expand turns, measure, key.

Row-multiplying step: every assistant message with a user message somewhere
before it becomes one example whose prompt is all earlier messages. It is a
``posexplode`` over an index array, so the prefix arrays are sliced late and
nothing is regrouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import V2, SetConfig
from corpusloom.functions import chat as C
from corpusloom.functions.ids import order_key, sha1_join, with_sub_order
from corpusloom.functions.text import prefix
from corpusloom.functions.tokens import count_tokens


def chat_examples(chats: DataFrame, max_messages: int = 12, carry: dict | None = None) -> DataFrame:
    """``(source_index, messages)`` -> one row per supervised assistant turn.

    ``carry`` maps names to functions of the conversation array; they are
    evaluated once per conversation (before the explode) and carried along
    with ``_i``, the message index of the example.
    """
    # a projection of its own: the truncation reads the array several times
    base = chats.select("source_index", C.normalize_messages("messages").alias("_m"))
    base = base.select("source_index", C.truncate_messages("_m", max_messages).alias("_m"))
    extra = [fn(F.col("_m")).alias(name) for name, fn in (carry or {}).items()]
    base = base.select("source_index", "_m", *extra)
    ex = base.select("source_index", "_m", *(carry or {}),
                     F.posexplode(C.assistant_turns("_m")).alias("turn_index", "_i"))
    return ex.select(
        "source_index",
        F.col("turn_index").cast("int").alias("turn_index"),
        F.slice("_m", F.lit(1), F.col("_i")).alias("prompt_messages"),
        F.get(F.col("_m"), F.col("_i"))["content"].alias("target_text"),
        F.slice("_m", F.lit(1), F.col("_i") + 1).alias("messages"),
        *([F.col("_i")] + [F.col(c) for c in carry] if carry else []),
    )


def _additive_template(t: C.ChatTemplate) -> bool:
    """True when the pre-token count of a rendered chat is additive over messages:
    pieces begin and end with symbol characters (each boundary merges into one
    symbol run), and the header ends in whitespace (content never merges with it)."""
    def sym(ch):
        return bool(ch) and not ch.isalnum() and not ch.isspace()
    return (sym(t.bos[-1:]) and sym(t.header_open[:1]) and sym(t.eot[-1:]) and sym(t.eot[:1])
            and t.header_close[-1:].isspace())


def chat_records(chats: DataFrame, cfg: SetConfig = V2, template=C.DEFAULT_TEMPLATE,
                 count=count_tokens) -> DataFrame:
    """Examples plus token lengths, uid, dedup key and the seeded scan order."""
    t = template
    marked = isinstance(t, C.ChatTemplate)
    additive = marked and count is count_tokens and _additive_template(t)
    carry = None
    if additive:
        # per-message pre-token counts, once per conversation: header + content + end-of-turn
        carry = {"_pc": lambda m: F.transform(m, lambda x: count(F.concat(
            F.lit(t.header_open), x["role"], F.lit(t.header_close), x["content"], F.lit(t.eot))))}
    ex = chat_examples(chats, cfg.max_messages, carry)
    ex = ex.where((F.size("messages") > 0) & (F.size("prompt_messages") > 0) & (F.col("target_text") != ""))
    last_user = C.last_content("prompt_messages", "user")
    last_msg = C.last_content("prompt_messages")
    if additive:
        # prompt = bos + pieces[0..i) + generation header; each of the i + 1 joins merges
        # two symbol runs into one, so the count is a prefix sum: O(T) per conversation
        pieces = F.aggregate(F.slice("_pc", F.lit(1), F.col("_i")), F.lit(0), lambda a, x: a + x)
        fixed = count(F.lit(t.bos)) + count(F.lit(t.generation_prompt))
        ex = ex.withColumn("prompt_tokens", (fixed + pieces - (F.col("_i") + 1)).cast("int"))
    else:
        ex = ex.withColumn("prompt_tokens", count(C.render("prompt_messages", True, template)))
    if marked and count is count_tokens and template.header_close[-1:].isspace() and template.generation_role == "assistant":
        # render(messages) = render(prompt, with generation header) + target + eot, and
        # the header ends in whitespace, which no pre-token spans: only the tail is recounted
        total = F.col("prompt_tokens") + count(F.concat("target_text", F.lit(template.eot)))
    else:
        total = count(C.render("messages", False, template))
    return ex.select(
        sha1_join("source_index", "turn_index", prefix(last_user, cfg.id_chars), prefix("target_text", cfg.id_chars)).alias("id"),
        "source_index", "turn_index", "messages", "prompt_messages", "target_text",
        "prompt_tokens",
        count("target_text").alias("target_tokens"),
        total.cast("int").alias("total_tokens"),
        F.size("messages").alias("num_messages"),
        F.sha1(F.concat(prefix(last_msg, cfg.key_chars), F.lit("|||"), prefix("target_text", cfg.key_chars))).alias("dup_key"),
        # the messages themselves break ties of a repeated source key
        F.concat(with_sub_order(order_key(cfg.seed, "scan", "source_index"), "turn_index"), F.lit(":"),
                 C.messages_sha("messages")).alias("ord"),
    )


def with_meta(records: DataFrame) -> DataFrame:
    """The written record layout: ``id, messages, prompt_messages, target_text, meta``."""
    return records.select(
        "id", "messages", "prompt_messages", "target_text",
        F.struct(F.col("source_index").cast("long").alias("source_index"), "turn_index", "prompt_tokens",
                 "target_tokens", "total_tokens", "num_messages").alias("meta"))
