"""Distillation catalogue: prompt selection, cleaning, judging, records, rejects."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.config import V2, DistillConfig
from corpusloom.functions import chat as C
from corpusloom.functions.text import words
from corpusloom.functions.tokens import PRETOKEN
from corpusloom.operators import distill as D
from corpusloom.operators import sft_sets as S
from corpusloom.plans import sqlkit as Q
from corpusloom.plans.chat_queries import sql_chat_records, sql_gate, v2_records
from corpusloom.plans.registry import query
from corpusloom.sources.fixtures import TEACHER_MARKERS, table, teacher_from_documents

# A quota small enough to cut the prompts at every test scale (the default is 15,000).
KD_TEST = DistillConfig(n_kd=100)


def prompts(spark, sf_dir):
    """The quota-cut prompts of the gated records."""
    return D.kd_prompts(S.sft_candidates(v2_records(spark, sf_dir), V2), KD_TEST)


def judged(spark, sf_dir):
    """Every record that can become a prompt, joined to its generation and judged."""
    p = D.kd_source(v2_records(spark, sf_dir), KD_TEST)
    return D.judge(p, teacher_from_documents(p, table(spark, sf_dir, "documents")), KD_TEST)


MARKS = "[" + ", ".join(Q.lit(m) for m in TEACHER_MARKERS) + "]"


def sql_clean(src: str) -> str:
    """Successive CTEs c0..c7 cleaning ``raw`` of ``src``; result column ``tt`` in ``cl``."""
    ctes = [f"c0 AS (SELECT *, {Q.strip('raw')} AS t0 FROM {src})"]
    for j, m in enumerate(KD_TEST.markers, start=1):
        ctes.append(f"c{j} AS (SELECT *, {Q.strip(f'split_part(t{j - 1}, {Q.lit(m)}, 1)')} AS t{j} FROM c{j - 1})")
    last = len(KD_TEST.markers)
    lines = (f"array_to_string(list_filter(list_transform(regexp_split_to_array(t{last}, {Q.LINE_BREAKS}), "
             f"lambda x: {Q.strip('x')}), lambda x: x <> ''), chr(10))")
    ctes.append(f"cl AS (SELECT *, CASE WHEN raw IS NOT NULL THEN {Q.strip(lines)} END AS tt FROM c{last})")
    return ",\n".join(ctes)


def sql_reason(t: str) -> str:
    w = Q.words(t)
    return (f"CASE WHEN {t} IS NULL THEN 'missing' WHEN {t} = '' THEN 'empty' WHEN contains({t}, '###') THEN 'marker' "
            f"WHEN len({w}) >= {KD_TEST.repetition_min_words} AND len(list_distinct({w})) / len({w}) < "
            f"CAST({KD_TEST.repetition_ratio} AS DOUBLE) THEN 'repetitive' "
            f"WHEN {Q.ntok(t)} < {KD_TEST.min_teacher_tokens} THEN 'too_short' "
            f"WHEN {Q.ntok(t)} > {KD_TEST.max_teacher_tokens} THEN 'too_long' ELSE 'ok' END")


SQL_KD = f"""{sql_chat_records()},
ks0 AS (SELECT id, source_index, turn_index, pm, mm, {Q.norm('target')} AS gold,
         {Q.ntok(Q.render('pm', True))} AS prompt_tokens, {sql_gate(V2.sft_gate)} AS gated,
         sha1({Q.strip(Q.norm("coalesce(list_filter(pm, lambda x: x.role = 'user')[-1].content, '')") + " || '|||' || " + Q.norm('target'))}) AS kd_key,
         {Q.okey(KD_TEST.seed, 'kd', 'id')} || ':' || sha1({Q.msha('pm')} || {Q.norm('target')}) AS kord
       FROM rec WHERE len(pm) > 0),
ks AS (SELECT * FROM ks0 WHERE prompt_tokens <= {KD_TEST.max_prompt_tokens} AND gold <> ''),
kp AS (SELECT * FROM ks WHERE gated
       QUALIFY row_number() OVER (PARTITION BY kd_key ORDER BY kord) = 1 ORDER BY kord LIMIT {KD_TEST.n_kd}),
gen AS (SELECT p.id, CASE WHEN p.k % 19 = 0 THEN NULL
          ELSE d.ls[1] || {MARKS}[p.k % 7 + 1] || chr(10) || coalesce(array_to_string(d.ls[2:], chr(10)), '') END AS text
        FROM (SELECT id, source_index + turn_index AS k FROM ks) p
        JOIN (SELECT doc_id AS k, string_split(text, chr(10)) AS ls FROM documents) d ON p.k = d.k),
kj0 AS (SELECT ks.*, gen.text AS raw FROM ks LEFT JOIN gen ON ks.id = gen.id),
{sql_clean('kj0')},
kj AS (SELECT *, {sql_reason('tt')} AS reason FROM cl)"""


@query("kd_prompts", sql=f"WITH {SQL_KD}\nSELECT id, prompt_tokens, kd_key AS dup_key, kord AS ord FROM kp")
def kd_prompts_q(spark, sf_dir):
    return prompts(spark, sf_dir).select("id", "prompt_tokens", "dup_key", "ord")


@query("teacher_clean", sql=f"WITH {SQL_KD}\nSELECT id, tt AS teacher_target FROM kj")
def teacher_clean(spark, sf_dir):
    return judged(spark, sf_dir).select("id", "teacher_target")


@query("teacher_quality", sql=f"WITH {SQL_KD}\nSELECT id, reason, {Q.ntok('tt')} AS n_tokens FROM kj")
def teacher_quality(spark, sf_dir):
    from corpusloom.functions.tokens import count_tokens
    return judged(spark, sf_dir).select("id", "reason", count_tokens("teacher_target").alias("n_tokens"))


def echo_model():
    """A deterministic stand-in: gives each prompt back, in chunks that cut stop strings apart."""
    def chunks(prompt):
        return (prompt[k:k + 7] for k in range(0, len(prompt), 7))
    return lambda prompts: [None if p is None else chunks(p) for p in prompts]


STOPS = "[" + ", ".join(Q.lit(s) for s in KD_TEST.stop) + "]"
SPACES = Q.WS_RUN[1:-2] + "*"
PIECES = f"regexp_extract_all(raw, '(?:{PRETOKEN}){SPACES}')"


@query("kd_generated", sql=f"""WITH {SQL_KD},
b AS (SELECT id, CASE WHEN len(p) <= {KD_TEST.max_new_tokens} THEN raw
             ELSE regexp_extract(raw, '^{SPACES}') || array_to_string(p[1:{KD_TEST.max_new_tokens}], '') END AS t
      FROM (SELECT id, raw, {PIECES} AS p FROM kj0)),
s AS (SELECT id, t, list_min(list_filter(list_transform({STOPS}, lambda x: strpos(t, x)), lambda k: k > 0)) AS k FROM b),
g AS (SELECT id, CASE WHEN k IS NULL THEN t ELSE substr(t, 1, k - 1) END AS text FROM s)
SELECT id, sha1(text) AS text_sha, {Q.ntok('text')} AS n_tokens FROM g""")
def kd_generated(spark, sf_dir):
    """Generation over every prompt, cut at stop strings and at the token limit."""
    from corpusloom.functions.tokens import count_tokens
    from corpusloom.operators.infer import generate
    p = D.kd_source(v2_records(spark, sf_dir), KD_TEST)
    raw = teacher_from_documents(p, table(spark, sf_dir, "documents")).groupBy("id").agg(F.min("text").alias("prompt_text"))
    prompts = p.select("id").join(raw, "id", "left")
    out = generate(prompts, echo_model, "echo", stop=KD_TEST.stop, max_new_tokens=KD_TEST.max_new_tokens)
    return out.select("id", F.sha1("text").alias("text_sha"), count_tokens("text").alias("n_tokens"))


@query("kd_records", sql=f"""WITH {SQL_KD}
SELECT id, CAST(len(pm) + 1 AS INTEGER) AS num_messages, prompt_tokens, {Q.ntok('tt')} AS teacher_target_tokens,
       sha1(gold) AS gold_sha, sha1(tt) AS teacher_sha,
       {Q.msha("list_append(pm, {'role': 'assistant', 'content': tt})")} AS messages_sha
FROM kj WHERE reason = 'ok'""")
def kd_records_q(spark, sf_dir):
    r = D.kd_records(judged(spark, sf_dir), KD_TEST)
    return r.select("id", F.size("messages").alias("num_messages"), F.col("meta")["prompt_tokens"].alias("prompt_tokens"),
                    F.col("meta")["teacher_target_tokens"].alias("teacher_target_tokens"),
                    F.sha1("gold_target").alias("gold_sha"), F.sha1("teacher_target").alias("teacher_sha"),
                    C.messages_sha("messages").alias("messages_sha"))


@query("kd_rejects", sql=f"WITH {SQL_KD}\nSELECT reason, count(*) AS n FROM kj GROUP BY reason")
def kd_rejects_q(spark, sf_dir):
    return D.kd_rejects(judged(spark, sf_dir))


@query("repetitive_text", sql=f"""
SELECT doc_id, CAST(len({Q.words('text')}) AS INTEGER) AS n_words,
       CAST(len(list_distinct({Q.words('text')})) AS INTEGER) AS n_distinct,
       CASE WHEN len({Q.words('text')}) < 8 THEN false
            ELSE len(list_distinct({Q.words('text')})) / len({Q.words('text')}) < CAST(0.35 AS DOUBLE) END AS repetitive
FROM documents""")
def repetitive_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", words("text").alias("w"))
    d = d.select("doc_id", F.size("w").alias("n_words"), F.size(F.array_distinct("w")).alias("n_distinct"))
    return d.withColumn("repetitive", D.repetitive_from_counts("n_words", "n_distinct"))
