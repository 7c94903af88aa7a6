"""Instruction (v1) catalogue plus queries that read both generations."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.config import V1, V2
from corpusloom.operators import sft_sets as S
from corpusloom.operators.instruct import PROMPT_NO_INPUT, PROMPT_WITH_INPUT, instruct_records
from corpusloom.operators.profile import bucket_counts, length_summary
from corpusloom.plans import sqlkit as Q
from corpusloom.plans.chat_queries import (V2_TEST, sql_bucket, sql_chat_records, sql_gate, sql_greedy_calib,
                                           v2_narrow, v2_records)
from corpusloom.plans.registry import query
from corpusloom.sources.fixtures import alpaca_from_documents, table

# Test quotas: sized so every quota fills at sf0.001 .. sf0.1 (library defaults are V1's).
V1_TEST = V1.with_quotas(60, {"short": 10, "mid": 20, "long": 8})


def v1_records(spark, sf_dir, cfg=V1):
    return instruct_records(alpaca_from_documents(table(spark, sf_dir, "documents")), cfg)


def v1_narrow(spark, sf_dir, cfg=V1):
    return S.narrow(v1_records(spark, sf_dir, cfg))


def sql_fill(template: str, **exprs) -> str:
    out, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        out += [Q.lit(head), exprs[name]]
    out.append(Q.lit(rest))
    return "(" + " || ".join(out) + ")"


def sql_alpaca_records(cfg=V1) -> str:
    with_in = sql_fill(PROMPT_WITH_INPUT, instruction="instruction", input="input_text")
    no_in = sql_fill(PROMPT_NO_INPUT, instruction="instruction")
    has = "(doc_id % 3 = 0 AND len(ls) > 2)"
    return f"""
al AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
a0 AS (SELECT doc_id AS source_index, ls[1] AS instruction, CASE WHEN {has} THEN ls[2] ELSE '' END AS input,
        array_to_string(list_slice(ls, CASE WHEN {has} THEN 3 ELSE 2 END, len(ls)), chr(10)) AS output FROM al),
a1 AS (SELECT source_index, {Q.norm('instruction')} AS instruction, {Q.norm('input')} AS input_text,
        {Q.norm('output')} AS target_text FROM a0),
a2 AS (SELECT *, CASE WHEN input_text <> '' THEN {with_in} ELSE {no_in} END AS prompt_text
       FROM a1 WHERE instruction <> '' AND target_text <> ''),
arec AS (SELECT sha1(CAST(source_index AS VARCHAR) || '|||' || instruction || '|||' || input_text || '|||' ||
          target_text) AS id,
        source_index, prompt_text, target_text,
        CASE WHEN input_text <> '' THEN instruction || chr(10) || chr(10) || 'Input:' || chr(10) || input_text
             ELSE instruction END AS user_content,
        {Q.ntok('prompt_text')} AS prompt_tokens, {Q.ntok('target_text')} AS target_tokens,
        {Q.ntok('prompt_text || target_text')} AS total_tokens, input_text <> '' AS has_input,
        sha1(prompt_text || '|||' || target_text) AS dup_key,
        {Q.okey(cfg.seed, 'scan', 'source_index')} || ':' || sha1(prompt_text || '|||' || target_text) AS ord FROM a2)"""


SQL_BOTH = f"WITH RECURSIVE {sql_alpaca_records()}, {sql_chat_records()}"


@query("alpaca_prompt", sql=f"""WITH {sql_alpaca_records()}
SELECT source_index, sha1(prompt_text) AS prompt_sha, has_input FROM arec""")
def alpaca_prompt(spark, sf_dir):
    return v1_records(spark, sf_dir).select("source_index", F.sha1("prompt_text").alias("prompt_sha"), "has_input")


@query("alpaca_records", sql=f"""WITH {sql_alpaca_records()}
SELECT id, source_index, prompt_tokens, target_tokens, total_tokens, has_input, sha1(user_content) AS user_sha,
       sha1(target_text) AS target_sha FROM arec""")
def alpaca_records(spark, sf_dir):
    r = v1_records(spark, sf_dir)
    return r.select("id", "source_index", "prompt_tokens", "target_tokens", "total_tokens", "has_input",
                    F.sha1(F.col("messages")[0]["content"]).alias("user_sha"),
                    F.sha1(F.col("messages")[1]["content"]).alias("target_sha"))


@query("record_ids", sql=f"""{SQL_BOTH}
SELECT 'v1' AS kind, source_index, -1 AS turn_index, id FROM arec
UNION ALL SELECT 'v2', source_index, turn_index, id FROM rec""")
def record_ids(spark, sf_dir):
    a = v1_records(spark, sf_dir).select(F.lit("v1").alias("kind"), "source_index",
                                         F.lit(-1).alias("turn_index"), "id")
    b = v2_records(spark, sf_dir).select(F.lit("v2").alias("kind"), "source_index", "turn_index", "id")
    return a.unionByName(b)


@query("dedup_keys", sql=f"""{SQL_BOTH}
SELECT 'v1' AS kind, source_index, -1 AS turn_index, dup_key FROM arec
UNION ALL SELECT 'v2', source_index, turn_index, dup_key FROM rec""")
def dedup_keys(spark, sf_dir):
    a = v1_records(spark, sf_dir).select(F.lit("v1").alias("kind"), "source_index",
                                         F.lit(-1).alias("turn_index"), "dup_key")
    b = v2_records(spark, sf_dir).select(F.lit("v2").alias("kind"), "source_index", "turn_index", "dup_key")
    return a.unionByName(b)


@query("sft_accept_v1", sql=f"""WITH {sql_alpaca_records()}
SELECT id, source_index, total_tokens, target_tokens, has_input FROM arec WHERE {sql_gate(V1.sft_gate)}""")
def sft_accept_v1(spark, sf_dir):
    return S.sft_candidates(v1_records(spark, sf_dir), V1).select(
        "id", "source_index", "total_tokens", "target_tokens", "has_input")


@query("calib_buckets", sql=f"""{SQL_BOTH}
SELECT 'v1' AS version, source_index, -1 AS turn_index, {sql_bucket(V1)} AS bucket FROM arec
 WHERE {sql_gate(V1.calib_gate)} AND {sql_bucket(V1)} IS NOT NULL
UNION ALL
SELECT 'v2', source_index, turn_index, {sql_bucket(V2)} FROM rec
 WHERE {sql_gate(V2.calib_gate)} AND {sql_bucket(V2)} IS NOT NULL""")
def calib_buckets(spark, sf_dir):
    a = S.calib_candidates(v1_records(spark, sf_dir), V1).select(
        F.lit("v1").alias("version"), "source_index", F.lit(-1).alias("turn_index"), "bucket")
    b = S.calib_candidates(v2_records(spark, sf_dir), V2).select(
        F.lit("v2").alias("version"), "source_index", "turn_index", "bucket")
    return a.unionByName(b)


@query("calib_bucket_counts", sql=f"""{SQL_BOTH}
SELECT version, bucket, count(*) AS n FROM (
 SELECT 'v1' AS version, {sql_bucket(V1)} AS bucket FROM arec WHERE {sql_gate(V1.calib_gate)}
 UNION ALL SELECT 'v2', {sql_bucket(V2)} FROM rec WHERE {sql_gate(V2.calib_gate)}) t
WHERE bucket IS NOT NULL GROUP BY version, bucket""")
def calib_bucket_counts(spark, sf_dir):
    return bucket_counts(calib_buckets(spark, sf_dir), ["version", "bucket"])


@query("seeded_shuffle", sql=f"""WITH {sql_alpaca_records()}
SELECT source_index, ord FROM arec ORDER BY ord""")
def seeded_shuffle(spark, sf_dir):
    return v1_records(spark, sf_dir).select("source_index", "ord").orderBy("ord")


@query("sft_sample_v1", sql=f"""WITH {sql_alpaca_records()},
c AS (SELECT * FROM arec WHERE {sql_gate(V1.sft_gate)}
      QUALIFY row_number() OVER (PARTITION BY dup_key ORDER BY ord) = 1)
SELECT id, source_index, dup_key, total_tokens, target_tokens FROM c ORDER BY ord LIMIT {V1_TEST.n_sft}""")
def sft_sample_v1(spark, sf_dir):
    return S.sft_sample(v1_narrow(spark, sf_dir, V1_TEST), V1_TEST).select(
        "id", "source_index", "dup_key", "total_tokens", "target_tokens")


SQL_CALIB_V1_CAND = f"""cand1 AS (SELECT ord, dup_key AS key, {sql_bucket(V1)} AS bucket, id, total_tokens, target_tokens
  FROM arec WHERE {sql_gate(V1.calib_gate)} AND {sql_bucket(V1)} IS NOT NULL)"""
SQL_CALIB_V2_CAND = f"""cand2 AS (SELECT ord, dup_key AS key, {sql_bucket(V2)} AS bucket, id, total_tokens, target_tokens
  FROM rec WHERE {sql_gate(V2.calib_gate)} AND {sql_bucket(V2)} IS NOT NULL)"""


@query("calib_sample_v1", sql=f"""WITH RECURSIVE {sql_alpaca_records()}, {SQL_CALIB_V1_CAND},
{sql_greedy_calib('cand1', V1_TEST, '1')}
SELECT cand1.id, cand1.bucket, cand1.ord FROM g1 JOIN cand1 ON g1.ord = cand1.ord WHERE g1.take""")
def calib_sample_v1(spark, sf_dir):
    return S.calib_sample(v1_narrow(spark, sf_dir, V1_TEST), V1_TEST).select("id", "bucket", "ord")


def _pct_sql(src: str, name: str) -> str:
    parts = []
    for m in ("total_tokens", "target_tokens"):
        ps = ", ".join(
            f"list_sort(list({m}))[least(count(*) - 1, CAST(floor(count(*) * CAST({p} AS DOUBLE)) AS BIGINT)) + 1] AS p{int(p * 100)}"
            for p in (0.5, 0.9, 0.95))
        parts.append(f"SELECT '{name}' AS \"group\", '{m}' AS metric, count(*) AS n, {ps}, max({m}) AS max FROM {src}")
    return " UNION ALL ".join(parts)


@query("length_summary", sql=f"""{SQL_BOTH}, {SQL_CALIB_V1_CAND}, {SQL_CALIB_V2_CAND},
{sql_greedy_calib('cand1', V1_TEST, '1')},
{sql_greedy_calib('cand2', V2_TEST, '2')},
s1 AS (SELECT * FROM arec WHERE {sql_gate(V1.sft_gate)}
       QUALIFY row_number() OVER (PARTITION BY dup_key ORDER BY ord) = 1 ORDER BY ord LIMIT {V1_TEST.n_sft}),
s2 AS (SELECT * FROM rec WHERE {sql_gate(V2.sft_gate)}
       QUALIFY row_number() OVER (PARTITION BY dup_key ORDER BY ord) = 1 ORDER BY ord LIMIT {V2_TEST.n_sft}),
c1 AS (SELECT cand1.* FROM g1 JOIN cand1 ON g1.ord = cand1.ord WHERE g1.take),
c2 AS (SELECT cand2.* FROM g2 JOIN cand2 ON g2.ord = cand2.ord WHERE g2.take)
{_pct_sql('arec', 'records_v1')} UNION ALL {_pct_sql('rec', 'records_v2')} UNION ALL
{_pct_sql('s1', 'sft_v1')} UNION ALL {_pct_sql('s2', 'sft_v2')} UNION ALL
{_pct_sql('c1', 'calib_v1')} UNION ALL {_pct_sql('c2', 'calib_v2')}""")
def length_summary_q(spark, sf_dir):
    r1 = v1_narrow(spark, sf_dir, V1_TEST)
    r2 = v2_narrow(spark, sf_dir, V2_TEST)
    cols = ["total_tokens", "target_tokens"]
    picked = [S.kept(x, "picked") for x in (S.sft_sample(r1, V1_TEST), S.sft_sample(r2, V2_TEST),
                                            S.calib_sample(r1, V1_TEST), S.calib_sample(r2, V2_TEST))]
    sets = [
        r1.select(F.lit("records_v1").alias("set"), *cols),
        r2.select(F.lit("records_v2").alias("set"), *cols),
        picked[0].select(F.lit("sft_v1").alias("set"), *cols),
        picked[1].select(F.lit("sft_v2").alias("set"), *cols),
        picked[2].select(F.lit("calib_v1").alias("set"), *cols),
        picked[3].select(F.lit("calib_v2").alias("set"), *cols),
    ]
    allsets = sets[0]
    for s in sets[1:]:
        allsets = allsets.unionByName(s)
    return length_summary(allsets, "set", cols)
