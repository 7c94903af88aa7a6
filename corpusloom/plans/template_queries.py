"""Catalogue: chats in text templates of three shapes, running history of every turn."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import chat as C
from corpusloom.functions.templates import TextTemplate
from corpusloom.functions.tokens import count_tokens
from corpusloom.operators.history import turn_history as history_of
from corpusloom.plans import sqlkit as Q
from corpusloom.plans.chat_queries import sql_chat_records, v2_records
from corpusloom.plans.registry import query
from corpusloom.sources.fixtures import normalized_turns, table

MARKED = TextTemplate("""\
{% for message in messages %}
{{ '<turn ' + message['role'] + '>\\n' + message['content'] | trim + '\\n</turn>' }}
{% endfor %}
{% if add_generation_prompt %}
{{ '<turn assistant>\\n' }}
{%- endif %}
""")

FOLDED = TextTemplate("""\
{%- if messages and messages[0].role == 'system' %}
  {%- set system = messages[0].content %}
  {%- set rest = messages[1:] %}
{%- else %}
  {%- set rest = messages %}
{%- endif %}
{{- bos_token }}
{%- for message in rest %}
  {%- if message.role == 'user' %}
    {{- '[ask]' + (system + '\\n\\n' if loop.first and system is defined else '') + message.content + '[/ask]' }}
  {%- else %}
    {{- ' ' + message.content + eos_token }}
  {%- endif %}
{%- endfor %}
""", {"bos_token": "<s>", "eos_token": "</s>"})

NUMBERED = TextTemplate("""\
{# questions and answers alone, numbered from the first of them #}
{%- for m in messages if m.role in ['user', 'assistant'] -%}
  {{ loop.index }}{{ '/' }}{{ loop.length }} {{ m.role | upper }}: {{ m.content }}{% if not loop.last or add_generation_prompt %}{{ '\\n' }}{% endif %}
{%- endfor -%}
{%- if add_generation_prompt %}{{ 'ASSISTANT:' }}{% endif %}
""")

TEMPLATES = {"marked": MARKED, "folded": FOLDED, "numbered": NUMBERED}


def _sql_marked(m, gen):
    return (f"(array_to_string(list_transform({m}, lambda x: '<turn ' || x.role || '>' || chr(10) || x.content || chr(10) || '</turn>' || chr(10)), '')"
            + (" || '<turn assistant>' || chr(10))" if gen else ")"))


def _sql_folded(m, gen):
    rest = f"(CASE WHEN {m}[1].role = 'system' THEN list_slice({m}, 2, len({m})) ELSE {m} END)"
    system = f"CASE WHEN i = 1 AND {m}[1].role = 'system' THEN {m}[1].content || chr(10) || chr(10) ELSE '' END"
    return (f"('<s>' || array_to_string(list_transform({rest}, lambda x, i: CASE WHEN x.role = 'user' THEN '[ask]' || {system} || x.content || '[/ask]' "
            f"ELSE ' ' || x.content || '</s>' END), ''))")


def _sql_numbered(m, gen):
    kept = f"list_filter({m}, lambda y: y.role <> 'system')"
    lines = f"list_transform({kept}, lambda x, i: i || '/' || len({kept}) || ' ' || upper(x.role) || ': ' || x.content)"
    return f"(array_to_string({lines}, chr(10))" + (" || chr(10) || 'ASSISTANT:')" if gen else ")")


_SQL = {"marked": _sql_marked, "folded": _sql_folded, "numbered": _sql_numbered}


@query("chat_rendered_templates", sql=f"WITH {sql_chat_records()}\nSELECT source_index, turn_index, " + ",\n  ".join(
    f"sha1({_SQL[n]('pm', True)}) AS {n}_prompt_sha, sha1({_SQL[n]('mm', False)}) AS {n}_full_sha, {Q.ntok(_SQL[n]('mm', False))} AS {n}_tokens"
    for n in TEMPLATES) + " FROM rec")
def chat_rendered_templates(spark, sf_dir):
    """Prompt and whole example in three templates, with the token counts records would carry."""
    out = []
    for name, t in TEMPLATES.items():
        out += [F.sha1(C.render("prompt_messages", True, t)).alias(f"{name}_prompt_sha"),
                F.sha1(C.render("messages", False, t)).alias(f"{name}_full_sha"),
                count_tokens(C.render("messages", False, t)).alias(f"{name}_tokens")]
    return v2_records(spark, sf_dir).select("source_index", "turn_index", *out)


HISTORY = 5           # messages before a turn
RANGE = 3             # turns in a range, small enough that test conversations have several


@query("turn_history", sql=f"""WITH nt AS (SELECT conv_id AS source_index, turn, role, {Q.strip('text')} AS content FROM conversations
  WHERE role IN ('system','user','assistant') AND {Q.strip('text')} <> ''),
h AS (SELECT source_index, turn, role, content, coalesce(list(struct_pack(role := role, content := content)) OVER w, []) AS hist,
  coalesce(bool_or(role = 'user') OVER (PARTITION BY source_index ORDER BY turn, role, content ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS has_user
  FROM nt WINDOW w AS (PARTITION BY source_index ORDER BY turn, role, content ROWS BETWEEN {HISTORY} PRECEDING AND 1 PRECEDING))
SELECT source_index, turn, role, sha1(content) AS content_sha, has_user, CAST(len(hist) AS INTEGER) AS num_history, {Q.msha('hist')} AS history_sha FROM h""")
def turn_history(spark, sf_dir):
    rows = history_of(normalized_turns(table(spark, sf_dir, "conversations")), HISTORY, RANGE)
    return rows.select("source_index", "turn", "role", F.sha1("content").alias("content_sha"), "has_user",
                       F.size("history").alias("num_history"), C.messages_sha("history").alias("history_sha"))
