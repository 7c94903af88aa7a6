"""Chat arrays ``array<struct<role,content>>``: normalise, truncate, expand, render.

All functions are array higher-order expressions, evaluated row by row inside
the JVM; none of them shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import col_, strip

ROLES = ("system", "user", "assistant")
MESSAGE_DDL = "array<struct<role:string,content:string>>"


@dataclass(frozen=True)
class ChatTemplate:
    """Header/end-of-turn chat format; a user may pass another."""

    # The header/end-of-turn markers of the default chat format.
    bos: str = "<|begin_of_text|>"
    header_open: str = "<|start_header_id|>"
    header_close: str = "<|end_header_id|>\n\n"
    eot: str = "<|eot_id|>"
    generation_role: str = "assistant"

    @property
    def generation_prompt(self) -> str:
        return self.header_open + self.generation_role + self.header_close


DEFAULT_TEMPLATE = ChatTemplate()


def message(role, content) -> Column:
    return F.struct(col_(role).alias("role"), col_(content).alias("content"))


def normalize_messages(m) -> Column:
    """Keep known roles with a non-empty stripped content, in order."""
    kept = F.transform(
        F.filter(col_(m), lambda x: x.isNotNull()),
        lambda x: F.struct(x["role"].alias("role"), strip(x["content"]).alias("content")),
    )
    return F.filter(kept, lambda x: x["role"].isin(*ROLES) & (x["content"] != ""))


def truncate_messages(m, max_messages: int) -> Column:
    """Last ``max_messages``; a leading system message is kept in front."""
    m = col_(m)
    k = max_messages
    return (
        F.when(F.size(m) <= k, m)
        .when(F.get(m, 0)["role"] == "system",
              F.concat(F.slice(m, 1, 1), F.slice(m, -(k - 1), k - 1)) if k > 1 else F.slice(m, 1, 1))
        .otherwise(F.slice(m, -k, k))
    )


def assistant_turns(m) -> Column:
    """0-based indices of assistant messages that have a user message before them."""
    m = col_(m)
    idx = F.when(F.size(m) > 0, F.sequence(F.lit(0), F.size(m) - 1))
    return F.filter(
        idx,
        lambda i: (F.get(m, i)["role"] == "assistant")
        & F.exists(F.slice(m, 1, i), lambda x: x["role"] == "user"),
    )


def render(m, add_generation_prompt: bool, template=DEFAULT_TEMPLATE) -> Column:
    """Render a chat array to one string with the template (a ``ChatTemplate``, or a
    ``templates.TextTemplate`` for any other shape)."""
    if not isinstance(template, ChatTemplate):
        return template.render(m, add_generation_prompt)
    t = template
    body = F.array_join(
        F.transform(col_(m), lambda x: F.concat(
            F.lit(t.header_open), x["role"], F.lit(t.header_close), x["content"], F.lit(t.eot))),
        "",
    )
    tail = t.generation_prompt if add_generation_prompt else ""
    return F.concat(F.lit(t.bos), body, F.lit(tail))


def last_content(m, role: str | None = None) -> Column:
    """Content of the last message (of ``role`` if given), '' when there is none."""
    arr = col_(m) if role is None else F.filter(col_(m), lambda x: x["role"] == role)
    return F.coalesce(F.try_element_at(arr, F.lit(-1))["content"], F.lit(""))


def roles_joined(m) -> Column:
    return F.array_join(F.transform(col_(m), lambda x: x["role"]), ",")


def messages_sha(m) -> Column:
    """Stable digest of a chat array (role \\x1f content, messages joined by \\x1e)."""
    return F.sha1(F.array_join(
        F.transform(col_(m), lambda x: F.concat(x["role"], F.lit("\x1f"), x["content"])), "\x1e"))
