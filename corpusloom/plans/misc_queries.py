"""Catalogue: N:M sparsity audit, sinks, streaming, token lengths."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.config import SparsityConfig
from corpusloom.functions import chat as C
from corpusloom.operators import profile as P
from corpusloom.operators.chat_records import with_meta
from corpusloom.plans import sqlkit as Q
from corpusloom.plans.chat_queries import sql_chat_records, v2_records
from corpusloom.plans.instruct_queries import sql_alpaca_records
from corpusloom.plans.mc_queries import SQL_MC, corpus
from corpusloom.plans.registry import query
from corpusloom.session import scratch_path
from corpusloom.sources import jsonl as J
from corpusloom.sources.fixtures import WEIGHT_NAMES, table, table_path, weights_from_embeddings
from corpusloom.streaming.records import DISTINCT_SCHEMA, read_sink, run_to_completion, stream_distinct_records

SP = SparsityConfig()
NAMES = "[" + ", ".join(f"'{n}'" for n in WEIGHT_NAMES) + "]"

SQL_NM = f"""
w AS (SELECT 'layers.' || CAST(label AS VARCHAR) || '.' || {NAMES}[label % 10 + 1] AS tensor,
        list_transform(embedding, lambda x: CASE WHEN abs(CAST(x AS DOUBLE)) < CAST(0.08 AS DOUBLE) THEN 0 ELSE x END) AS v
      FROM embeddings),
wr AS (SELECT tensor, len(v) // {SP.m} AS groups,
         len(list_filter(list_transform(range(len(v) // {SP.m}), lambda i:
           len(list_filter(list_slice(v, i * {SP.m} + 1, i * {SP.m} + {SP.m}), lambda x: x <> 0))),
           lambda c: c = {SP.n})) AS ok FROM w),
audit AS (SELECT tensor, CAST(sum(ok) AS BIGINT) AS ok_groups, CAST(sum(groups) AS BIGINT) AS groups,
            CASE WHEN sum(groups) > 0 THEN sum(ok) / sum(groups) ELSE 0.0 END AS ratio FROM wr GROUP BY tensor)"""


def audit(spark, sf_dir):
    return P.nm_sparsity(weights_from_embeddings(table(spark, sf_dir, "embeddings")), n=SP.n, m=SP.m)


@query("nm_sparsity", sql=f"WITH {SQL_NM}\nSELECT * FROM audit")
def nm_sparsity(spark, sf_dir):
    return audit(spark, sf_dir)


TARGETS = " OR ".join(f"suffix(tensor, '{t}')" for t in SP.targets)
IGNORES = " AND ".join(f"NOT suffix(tensor, '{t}')" for t in SP.ignore)


@query("nm_sparsity_sampled", sql=f"""WITH {SQL_NM},
cand AS (SELECT tensor, ratio, {Q.okey(SP.seed, 'layers', 'tensor')} AS ord FROM audit
         WHERE ({TARGETS}) AND {IGNORES} AND ratio > 0 ORDER BY ord LIMIT {SP.sample_tensors})
SELECT tensor, ratio, (SELECT list_reduce(list_sort(list(ratio)), lambda a, x: a + x) / count(*) FROM cand)
       AS sample_mean FROM cand""")
def nm_sparsity_sampled(spark, sf_dir):
    t = P.target_tensors(audit(spark, sf_dir), SP.targets, SP.ignore)
    return P.nm_sparsity_sample(t, SP.sample_tensors, SP.seed).select("tensor", "ratio", "sample_mean")


@query("jsonl_roundtrip", sql=f"""WITH {sql_chat_records()}
SELECT id, source_index, turn_index, total_tokens, CAST(len(mm) AS INTEGER) AS num_messages, {Q.msha('mm')} AS messages_sha
FROM rec""")
def jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "jsonl-roundtrip")
    J.write_jsonl(with_meta(v2_records(spark, sf_dir)), path)
    back = J.read_jsonl(spark, path, J.CHAT_RECORD_SCHEMA)
    return back.select("id", F.col("meta")["source_index"].alias("source_index"),
                       F.col("meta")["turn_index"].alias("turn_index"), F.col("meta")["total_tokens"].alias("total_tokens"),
                       F.size("messages").alias("num_messages"), C.messages_sha("messages").alias("messages_sha"))


EVAL_SCHEMA = ("id string, messages array<struct<role:string,content:string>>, choices array<string>, "
               "answer_idx int, answer_letter string, num_choices int, "
               "meta struct<source_index:bigint,split:string,raw_label:string,raw_answer_key:string>")


@query("manifest", sql=f"""WITH {SQL_MC}
SELECT task AS name, count(*) AS rows, CAST(sum(answer_idx) AS BIGINT) AS answer_sum FROM mc GROUP BY task""")
def manifest(spark, sf_dir):
    out = scratch_path(spark, "eval-corpus")
    c = corpus(spark, sf_dir).drop("source_index")
    man = J.write_task_files(spark, c, out)
    back = J.read_task_files(spark, man, EVAL_SCHEMA)
    return back.groupBy(F.col("task").alias("name")).agg(F.count("*").alias("rows"),
                                                         F.sum("answer_idx").cast("long").alias("answer_sum"))


@query("stream_alpaca_records", sql=f"""WITH {sql_alpaca_records()}
SELECT id, source_index, prompt_tokens, target_tokens, total_tokens, has_input FROM arec""")
def stream_alpaca_records(spark, sf_dir):
    sink = scratch_path(spark, "stream-sink")
    ckpt = scratch_path(spark, "stream-checkpoint")
    out = run_to_completion(spark, table_path(sf_dir, "documents"), sink, ckpt, file_glob="*")
    return out.select("id", "source_index", "prompt_tokens", "target_tokens", "total_tokens", "has_input")


@query("token_lengths", sql=f"""
SELECT 'documents' AS source, CAST(doc_id AS VARCHAR) AS key, {Q.ntok('text')} AS n_tokens FROM documents
UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), {Q.ntok('html')} FROM pages
UNION ALL SELECT 'conversations', conv_id || ':' || turn, {Q.ntok('text')} FROM conversations""")
def token_lengths(spark, sf_dir):
    from corpusloom.functions.tokens import count_tokens
    d = table(spark, sf_dir, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").cast("string").alias("key"),
                                                 count_tokens("text").alias("n_tokens"))
    p = table(spark, sf_dir, "pages").select(F.lit("pages").alias("source"), F.col("page_id").cast("string").alias("key"),
                                             count_tokens("html").alias("n_tokens"))
    c = table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("source"), F.concat_ws(":", "conv_id", "turn").alias("key"),
        count_tokens("text").alias("n_tokens"))
    return d.unionByName(p).unionByName(c)


@query("stream_distinct_keys", sql=f"""WITH {sql_alpaca_records()}
SELECT DISTINCT dup_key FROM arec""")
def stream_distinct_keys(spark, sf_dir):
    sink = scratch_path(spark, "stream-distinct-sink")
    ckpt = scratch_path(spark, "stream-distinct-checkpoint")
    stream_distinct_records(spark, table_path(sf_dir, "documents"), sink, ckpt, file_glob="*").awaitTermination()
    return read_sink(spark, sink, DISTINCT_SCHEMA).select("dup_key")
