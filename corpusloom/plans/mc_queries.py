"""Multiple-choice catalogue: four builders, prompts, corpus, per-task subsample."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import mc as M
from corpusloom.plans import sqlkit as Q
from corpusloom.plans.registry import query
from corpusloom.sources import fixtures as X

# Test size of the per-task subsample (the reference uses 800 on sets of thousands).
N_SUBSAMPLE = 100


def raw_tables(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents")
    conv = X.table(spark, sf_dir, "conversations")
    return {
        "hellaswag": X.hellaswag_from_documents(docs),
        "arc_challenge": X.arc_from_tables(X.table(spark, sf_dir, "benchmark"), conv),
        "winogrande": X.winogrande_from_conversations(conv),
        "truthfulqa_mc": X.truthfulqa_from_documents(docs),
    }


def corpus(spark, sf_dir, style="chat"):
    return M.eval_corpus(raw_tables(spark, sf_dir), style)


def task_records(spark, sf_dir, task):
    raw = raw_tables(spark, sf_dir)[task]
    return M.mc_record(M.BUILDERS[task](raw), task, "chat")


S = Q.strip
LET = ", ".join(f"'{x}'" for x in M.ARC_FALLBACK_LETTERS)
DIG = ", ".join(f"'{x}'" for x in M.ARC_FALLBACK_DIGITS)

SQL_MC = f"""
hsr AS (SELECT doc_id AS source_index, source AS activity_label, ls[1] AS ctx_a, ls[2] AS ctx_b,
          ls[3:] AS endings,
          CASE WHEN doc_id % 31 = 0 THEN NULL WHEN doc_id % 17 = 0 THEN (CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'x' END)
               ELSE CAST(doc_id % 5 AS VARCHAR) END AS label
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents)),
hs0 AS (SELECT source_index, {Q.norm('activity_label')} AS act, {Q.norm('ctx_a')} AS a, {Q.norm('ctx_b')} AS b,
          endings, label FROM hsr),
hs AS (SELECT source_index,
          {S("array_to_string(list_filter([CASE WHEN act <> '' THEN 'Activity: ' || act ELSE '' END, a, b], lambda x: x <> ''), chr(10))")} AS question,
          list_transform(endings, lambda e: {S('e')}) AS choices, TRY_CAST(label AS INTEGER) AS answer_idx,
          label AS raw_label, CAST(NULL AS VARCHAR) AS raw_answer_key
        FROM hs0 WHERE endings IS NOT NULL AND len(endings) > 0 AND label IS NOT NULL),
hsv AS (SELECT * FROM hs WHERE question <> '' AND answer_idx IS NOT NULL AND answer_idx >= 0 AND answer_idx < len(choices)),
arcsrc AS (SELECT item_id AS k, text FROM benchmark
           UNION ALL SELECT 1000000000 + conv_id * 1000 + turn, text FROM conversations WHERE role = 'user'),
arcw AS (SELECT k, text, list_slice(list_filter(string_split(text, ' '), lambda x: x <> ''), 1, 4) AS w FROM arcsrc),
arcl AS (SELECT k, text, w,
          CASE WHEN k % 9 = 0 THEN ['A','B','B','D'] WHEN k % 2 = 0 THEN ['A','B','C','D'] ELSE ['1','2','3','4'] END AS l0
        FROM arcw),
arcr AS (SELECT k AS source_index, text AS question, w AS texts,
          list_slice(CASE WHEN k % 7 = 0 THEN list_transform(l0, lambda x: ' ' || x) ELSE l0 END, 1,
                     CASE WHEN k % 13 = 0 THEN greatest(len(w) - 1, 0) ELSE len(w) END) AS labels,
          CASE WHEN k % 11 = 0 THEN NULL ELSE ['B','A','D','C','2','4','10','K','C'][k % 9 + 1] END AS answerKey
        FROM arcl),
arc0 AS (SELECT source_index, {Q.norm('question')} AS question, texts,
          list_transform(coalesce(labels, []), lambda x: {S('x')}) AS sl,
          {S("coalesce(answerKey, 'None')")} AS key FROM arcr),
arc1 AS (SELECT *, coalesce(list_position(list_reverse(sl), key), 0) AS pos,
          CASE WHEN key IN ({LET}) THEN ascii(key) - 65 WHEN key IN ({DIG}) THEN TRY_CAST(key AS INTEGER) - 1 END AS fb
        FROM arc0),
arcv AS (SELECT source_index, question, list_transform(texts, lambda t: {S('t')}) AS choices,
          CASE WHEN pos > 0 THEN len(sl) - pos WHEN fb < len(texts) THEN fb END AS answer_idx,
          CAST(NULL AS VARCHAR) AS raw_label, key AS raw_answer_key
        FROM arc1 WHERE question <> '' AND texts IS NOT NULL AND len(texts) > 0 AND key <> ''
          AND len(texts) = len(sl) AND (pos > 0 OR fb < len(texts))),
wgr AS (SELECT conv_id * 1000 + turn AS source_index, text AS sentence,
          list_filter(string_split(text, ' '), lambda x: x <> '') AS ws,
          ['1', '2', '', '3', NULL][(conv_id * 1000 + turn) % 5 + 1] AS answer
        FROM conversations WHERE role = 'user'),
wg0 AS (SELECT source_index, {Q.norm('sentence')} AS s, {Q.norm('ws[1]')} AS o1, {Q.norm('ws[2]')} AS o2,
          {S("coalesce(answer, 'None')")} AS ans FROM wgr),
wgv AS (SELECT source_index, s AS question, [o1, o2] AS choices, CAST(ans AS INTEGER) - 1 AS answer_idx,
          CAST(NULL AS VARCHAR) AS raw_label, CAST(NULL AS VARCHAR) AS raw_answer_key
        FROM wg0 WHERE s <> '' AND o1 <> '' AND o2 <> '' AND ans IN ('1', '2')),
tqr AS (SELECT doc_id, ls[1] AS q, ls[2:] AS ch FROM
          (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
tq0 AS (SELECT doc_id, q, ch, CAST(list_transform(range(len(ch)), lambda j: CASE WHEN j = doc_id % len(ch)
          OR (doc_id % 11 = 0 AND j = (doc_id + 1) % len(ch)) THEN 1 ELSE 0 END) AS INTEGER[]) AS l0 FROM tqr),
tq1 AS (SELECT doc_id AS source_index, q, ch,
          CASE WHEN doc_id % 13 = 0 THEN list_slice(l0, 1, greatest(len(ch) - 1, 0)) ELSE l0 END AS labels FROM tq0),
tqv AS (SELECT source_index, {Q.norm('q')} AS question, list_transform(ch, lambda c: {S('c')}) AS choices,
          list_position(labels, 1) - 1 AS answer_idx, CAST(NULL AS VARCHAR) AS raw_label,
          CAST(NULL AS VARCHAR) AS raw_answer_key
        FROM tq1 WHERE {Q.norm('q')} <> '' AND ch IS NOT NULL AND len(ch) > 0 AND labels IS NOT NULL
          AND len(labels) > 0 AND len(ch) = len(labels) AND len(list_filter(labels, lambda v: v = 1)) = 1),
mcall AS (SELECT 'hellaswag' AS task, * FROM hsv UNION ALL SELECT 'arc_challenge', * FROM arcv
          UNION ALL SELECT 'winogrande', * FROM wgv UNION ALL SELECT 'truthfulqa_mc', * FROM tqv),
mc AS (SELECT task, sha1(task || '|||' || CAST(source_index AS VARCHAR) || '|||' || substring(question, 1, 200)) AS id,
          source_index, question, choices, CAST(answer_idx AS INTEGER) AS answer_idx, chr(CAST(65 + answer_idx AS INTEGER)) AS answer_letter,
          CAST(len(choices) AS INTEGER) AS num_choices, raw_label, raw_answer_key,
          sha1(array_to_string(choices, chr(30))) AS choices_sha,
          array_to_string(list_concat(['Question: ' || {S('question')}],
             list_transform(choices, lambda c, i: chr(CAST(64 + i AS INTEGER)) || '. ' || {S('c')}), ['', 'Answer: ']), chr(10)) AS prompt_text,
          array_to_string(list_concat(['{M.CHAT_LEAD}', '', 'Question: ' || {S('question')}],
             list_transform(choices, lambda c, i: chr(CAST(64 + i AS INTEGER)) || '. ' || {S('c')}),
             ['', '{M.CHAT_INSTRUCTION}', 'Answer:']), chr(10)) AS user_prompt
        FROM mcall)"""

TASK_COLS = "id, source_index, answer_idx, answer_letter, num_choices, choices_sha, raw_label, raw_answer_key"


def _task_query(name, task):
    @query(name, sql=f"WITH {SQL_MC}\nSELECT {TASK_COLS} FROM mc WHERE task = '{task}'")
    def q(spark, sf_dir):
        r = task_records(spark, sf_dir, task)
        return r.select("id", "source_index", "answer_idx", "answer_letter", "num_choices",
                        F.sha1(F.array_join("choices", "\x1e")).alias("choices_sha"),
                        F.col("meta")["raw_label"].alias("raw_label"),
                        F.col("meta")["raw_answer_key"].alias("raw_answer_key"))
    return q


for _n, _t in [("mc_hellaswag", "hellaswag"), ("mc_arc", "arc_challenge"),
               ("mc_winogrande", "winogrande"), ("mc_truthfulqa", "truthfulqa_mc")]:
    _task_query(_n, _t)


@query("mc_prompt_completion", sql=f"WITH {SQL_MC}\nSELECT task, id, sha1(prompt_text) AS prompt_sha FROM mc")
def mc_prompt_completion(spark, sf_dir):
    return corpus(spark, sf_dir, "completion").select("task", "id", F.sha1("prompt_text").alias("prompt_sha"))


@query("mc_prompt_chat", sql=f"WITH {SQL_MC}\nSELECT task, id, sha1(user_prompt) AS user_sha FROM mc")
def mc_prompt_chat(spark, sf_dir):
    return corpus(spark, sf_dir, "chat").select(
        "task", "id", F.sha1(F.col("messages")[0]["content"]).alias("user_sha"))


@query("eval_corpus", sql=f"WITH {SQL_MC}\nSELECT task, id, source_index, answer_idx, num_choices FROM mc")
def eval_corpus_q(spark, sf_dir):
    return corpus(spark, sf_dir).select("task", "id", "source_index", "answer_idx", "num_choices")


@query("mc_subsample", sql=f"""WITH {SQL_MC},
o AS (SELECT task, id, {Q.okey(0, 'subsample', 'task', 'source_index')} AS ord FROM mc)
SELECT task, id, ord FROM o QUALIFY row_number() OVER (PARTITION BY task ORDER BY ord) <= {N_SUBSAMPLE}""")
def mc_subsample(spark, sf_dir):
    return M.sampled_corpus(raw_tables(spark, sf_dir), N_SUBSAMPLE).select("task", "id", "ord")
