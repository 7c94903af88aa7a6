"""Chat (v2) catalogue: normalise, truncate, expand, render, records, gates, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.config import V2
from corpusloom.functions import chat as C
from corpusloom.operators import sft_sets as S
from corpusloom.operators.chat_records import chat_records
from corpusloom.plans import sqlkit as Q
from corpusloom.plans.registry import query
from corpusloom.sources.fixtures import chat_from_turns, normalized_turns, table

# Test quotas: sized so every quota fills at sf0.001 .. sf0.1 (library defaults are V2's).
V2_TEST = V2.with_quotas(25, {"short": 10, "mid": 15, "long": 2})
TRUNC_K = 4
NO_LIMIT = 1_000_000_000


def v2_records(spark, sf_dir, cfg=V2):
    return chat_records(chat_from_turns(table(spark, sf_dir, "conversations"), cfg.max_messages), cfg)


def v2_narrow(spark, sf_dir, cfg=V2):
    return S.narrow(v2_records(spark, sf_dir, cfg))


# ---------------------------------------------------------------- SQL (oracle side)
def sql_chat_arrays(k: int) -> str:
    return f"""
nt AS (SELECT conv_id AS source_index, turn, role, {Q.strip('text')} AS content FROM conversations),
cm AS (SELECT source_index, list(struct_pack(role := role, content := content) ORDER BY turn) AS m0
       FROM nt WHERE role IN ('system','user','assistant') AND content <> '' GROUP BY source_index),
ct AS (SELECT source_index, CASE WHEN len(m0) <= {k} THEN m0
         WHEN m0[1].role = 'system' THEN list_concat(list_slice(m0, 1, 1), list_slice(m0, len(m0) - {k - 1} + 1, len(m0)))
         ELSE list_slice(m0, len(m0) - {k} + 1, len(m0)) END AS m FROM cm)"""


def sql_chat_records(cfg=V2) -> str:
    return sql_chat_arrays(cfg.max_messages) + f""",
pos AS (SELECT source_index, m, unnest(range(len(m))) AS i FROM ct),
ex0 AS (SELECT * FROM pos WHERE m[i + 1].role = 'assistant'
        AND len(list_filter(list_slice(m, 1, i), lambda x: x.role = 'user')) > 0),
ex AS (SELECT source_index, CAST(row_number() OVER (PARTITION BY source_index ORDER BY i) - 1 AS INTEGER) AS turn_index,
        list_slice(m, 1, i) AS pm, m[i + 1].content AS target, list_slice(m, 1, i + 1) AS mm FROM ex0),
rec AS (SELECT sha1(CAST(source_index AS VARCHAR) || '|||' || CAST(turn_index AS VARCHAR) || '|||' ||
          coalesce(list_filter(pm, lambda x: x.role = 'user')[-1].content, '') || '|||' || target) AS id,
        source_index, turn_index, pm, target, mm,
        {Q.ntok(Q.render('pm', True))} AS prompt_tokens, {Q.ntok('target')} AS target_tokens,
        {Q.ntok(Q.render('mm', False))} AS total_tokens, CAST(len(mm) AS INTEGER) AS num_messages,
        sha1(pm[-1].content || '|||' || target) AS dup_key,
        {Q.sub_ord(Q.okey(cfg.seed, 'scan', 'source_index'), 'turn_index')} || ':' || {Q.msha('mm')} AS ord
        FROM ex)"""


def sql_gate(g) -> str:
    return (f"{Q.between('total_tokens', g.min_total, g.max_total)} AND "
            f"{Q.between('target_tokens', g.min_target, g.max_target)}")


def sql_bucket(cfg) -> str:
    whens = " ".join(f"WHEN total_tokens BETWEEN {b.min_total} AND {b.max_total} THEN '{b.name}'" for b in cfg.buckets)
    return f"CASE {whens} END"


def sql_greedy_calib(cand: str, cfg, tag: str = "") -> str:
    """Literal greedy scan as a recursive CTE over ``cand(ord, key, bucket)``."""
    names = [b.name for b in cfg.buckets]
    qs = {b.name: b.target for b in cfg.buckets}
    cnt = ", ".join(f"c{j}" for j in range(len(names)))
    init = ", ".join("0" for _ in names)
    upd = ", ".join(f"q.c{j} + CAST(q.c AND q.bucket = '{n}' AS INTEGER)" for j, n in enumerate(names))
    cap = " OR ".join(f"(r.bucket = '{n}' AND g.c{j} < {qs[n]})" for j, n in enumerate(names))
    gcols = ", ".join(f"g.c{j}" for j in range(len(names)))
    return f"""
cr{tag} AS MATERIALIZED (SELECT ord, key, bucket, row_number() OVER (ORDER BY ord) AS i FROM {cand}),
g{tag}(i, seen, {cnt}, take, ord) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), {init}, false, CAST(NULL AS VARCHAR)
  UNION ALL
  SELECT q.i, CASE WHEN q.c THEN list_append(q.seen, q.key) ELSE q.seen END, {upd}, q.c, q.ord
  FROM (SELECT g.seen, {gcols}, r.i, r.key, r.bucket, r.ord,
               (NOT list_contains(g.seen, r.key) AND ({cap})) AS c
        FROM g{tag} g JOIN cr{tag} r ON r.i = g.i + 1) q)"""


# ---------------------------------------------------------------- queries
@query("chat_normalized", sql=f"""
SELECT conv_id AS source_index, turn, role, {Q.strip('text')} AS content FROM conversations
WHERE role IN ('system','user','assistant') AND {Q.strip('text')} <> ''""")
def chat_normalized(spark, sf_dir):
    return normalized_turns(table(spark, sf_dir, "conversations"))


@query("chat_normalized_arrays", sql=f"""WITH {sql_chat_arrays(NO_LIMIT)}
SELECT source_index, CAST(len(m0) AS INTEGER) AS num_messages, {Q.roles('m0')} AS roles, {Q.msha('m0')} AS messages_sha
FROM cm""")
def chat_normalized_arrays(spark, sf_dir):
    """``normalize_messages`` on whole raw conversations (one array per conversation)."""
    raw = (table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("source_index"))
           .agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("r")))
    m = C.normalize_messages(F.transform("r", lambda x: C.message(x["role"], x["content"])))
    return (raw.select("source_index", m.alias("m")).where(F.size("m") > 0)
            .select("source_index", F.size("m").alias("num_messages"), C.roles_joined("m").alias("roles"),
                    C.messages_sha("m").alias("messages_sha")))


@query("chat_truncated", sql=f"""WITH {sql_chat_arrays(TRUNC_K)}
SELECT source_index, CAST(len(m) AS INTEGER) AS num_messages, {Q.roles('m')} AS roles, {Q.msha('m')} AS messages_sha
FROM ct""")
def chat_truncated(spark, sf_dir):
    chats = chat_from_turns(table(spark, sf_dir, "conversations"), TRUNC_K)
    m = C.truncate_messages(C.normalize_messages("messages"), TRUNC_K)
    return chats.select("source_index", m.alias("m")).select(
        "source_index", F.size("m").alias("num_messages"), C.roles_joined("m").alias("roles"),
        C.messages_sha("m").alias("messages_sha"))


@query("chat_expanded", sql=f"""WITH {sql_chat_records()}
SELECT source_index, turn_index, CAST(len(pm) AS INTEGER) AS prompt_size, {Q.msha('pm')} AS prompt_sha,
       target AS target_text FROM rec""")
def chat_expanded(spark, sf_dir):
    return v2_records(spark, sf_dir).select(
        "source_index", "turn_index", F.size("prompt_messages").alias("prompt_size"),
        C.messages_sha("prompt_messages").alias("prompt_sha"), "target_text")


@query("chat_rendered", sql=f"""WITH {sql_chat_records()}
SELECT source_index, turn_index, sha1({Q.render('pm', True)}) AS prompt_render_sha,
       sha1({Q.render('mm', False)}) AS full_render_sha FROM rec""")
def chat_rendered(spark, sf_dir):
    r = v2_records(spark, sf_dir)
    return r.select("source_index", "turn_index",
                    F.sha1(C.render("prompt_messages", True)).alias("prompt_render_sha"),
                    F.sha1(C.render("messages", False)).alias("full_render_sha"))


@query("chat_records", sql=f"""WITH {sql_chat_records()}
SELECT id, source_index, turn_index, prompt_tokens, target_tokens, total_tokens, num_messages, dup_key FROM rec""")
def chat_records_q(spark, sf_dir):
    return v2_records(spark, sf_dir).select("id", "source_index", "turn_index", "prompt_tokens", "target_tokens",
                                            "total_tokens", "num_messages", "dup_key")


@query("sft_accept_v2", sql=f"""WITH {sql_chat_records()}
SELECT id, source_index, turn_index, total_tokens, target_tokens FROM rec WHERE {sql_gate(V2.sft_gate)}""")
def sft_accept_v2(spark, sf_dir):
    return S.sft_candidates(v2_records(spark, sf_dir), V2).select(
        "id", "source_index", "turn_index", "total_tokens", "target_tokens")


@query("sft_sample_v2", sql=f"""WITH {sql_chat_records()},
c AS (SELECT * FROM rec WHERE {sql_gate(V2.sft_gate)}
      QUALIFY row_number() OVER (PARTITION BY dup_key ORDER BY ord) = 1)
SELECT id, source_index, turn_index, dup_key, ord FROM c ORDER BY ord LIMIT {V2_TEST.n_sft}""")
def sft_sample_v2(spark, sf_dir):
    return S.sft_sample(v2_narrow(spark, sf_dir, V2_TEST), V2_TEST).select(
        "id", "source_index", "turn_index", "dup_key", "ord")


@query("calib_sample_v2", sql=f"""WITH RECURSIVE {sql_chat_records()},
cand AS (SELECT ord, dup_key AS key, {sql_bucket(V2)} AS bucket, id FROM rec
         WHERE {sql_gate(V2.calib_gate)} AND {sql_bucket(V2)} IS NOT NULL),
{sql_greedy_calib('cand', V2_TEST)}
SELECT cand.id, cand.bucket, cand.ord FROM g JOIN cand ON g.ord = cand.ord WHERE g.take""")
def calib_sample_v2(spark, sf_dir):
    return S.calib_sample(v2_narrow(spark, sf_dir, V2_TEST), V2_TEST).select("id", "bucket", "ord")
