"""Scoring catalogue: predictions, metrics, overall rows, pivot, pre/post delta."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import score as SC
from corpusloom.plans import sqlkit as Q
from corpusloom.plans.mc_queries import SQL_MC, corpus
from corpusloom.plans.registry import query
from corpusloom.session import scratch_path
from corpusloom.sources.fixtures import LETTER_IDS, PRED_LEADS, PRED_MODELS, PRED_TASKS, predictions_from_embeddings, table


DATASETS = "[" + ", ".join(f"'{d}'" for d in SC.EVAL.dataset_order) + "]"


def preds(spark, sf_dir, quantize=False):
    p = predictions_from_embeddings(table(spark, sf_dir, "embeddings"), quantize)
    p = p.withColumn("model", SC.model_name("model_path")).drop("model_path")
    return p.withColumn("pred_idx", SC.predict(p, LETTER_IDS))


def sql_preds(quantize: bool, tag: str) -> str:
    lids = "[" + ", ".join("[" + ", ".join(str(t) for t in ids) + "]" + ("::INTEGER[]" if not ids else "")
                           for ids in LETTER_IDS) + "]"
    tasks = "[" + ", ".join(f"'{t}'" for t in PRED_TASKS) + "]"
    leads = "[" + ", ".join(Q.lit(x) for x in PRED_LEADS) + "]"
    q = "floor(CAST(v[(j + 7 * {r}) % len(v) + 1] AS DOUBLE) * 4) / 4" if quantize else \
        "CAST(v[(j + 7 * {r}) % len(v) + 1] AS DOUBLE)"
    parts = []
    for r, name in enumerate(PRED_MODELS):
        parts.append(f"""SELECT regexp_extract(regexp_replace('/models/{name}-merged/{name}/', '/+$', ''), '[^/]*$')
            AS model, {tasks}[vec_id % 4 + 1] AS task, vec_id,
            CAST(label % (2 + vec_id % 4) AS INTEGER) AS answer_idx, CAST(2 + vec_id % 4 AS INTEGER) AS k,
            CASE WHEN vec_id % 23 = 0 THEN NULL ELSE {leads}[vec_id % {len(PRED_LEADS)} + 1] || chr(CAST(65 + (vec_id + {r}) % 6 AS INTEGER)) END AS text,
            CASE WHEN vec_id % 23 = 0 OR vec_id % 7 = 3 THEN NULL ELSE list_slice(list_sort(list_transform(
              list_transform(range(len(v)), lambda j: {q.format(r=r)}), lambda x, i: {{'v': x, 't': i - 1}}), 'DESC'), 1, 20)
            END AS top
          FROM (SELECT vec_id, embedding AS v, label FROM embeddings)""")
    body = " UNION ALL ".join(parts)
    return f"""
pr{tag} AS ({body}),
pc{tag} AS (SELECT *, list_filter(flatten(list_transform(range(k), lambda i: list_transform({lids}[i + 1],
              lambda t: {{'v': list_filter(top, lambda s: s.t = t)[1].v, 'n': -i}}))),
              lambda z: z.v IS NOT NULL AND z.v > -1e30 AND NOT isnan(z.v)) AS scored,
            upper(substring({Q.strip("coalesce(text, '')")}, 1, 1)) AS first FROM pr{tag}),
pp{tag} AS (SELECT model, task, sha1(task || '|||' || CAST(vec_id AS VARCHAR)) AS id, answer_idx, k,
            CASE WHEN top IS NULL AND text IS NULL THEN NULL
                 ELSE CAST(coalesce(-(list_sort(scored, 'DESC')[1].n),
                      CASE WHEN length(first) = 1 AND ascii(first) >= 65 AND ascii(first) < 65 + k
                           THEN ascii(first) - 65 END) AS INTEGER) END AS pred_idx
          FROM pc{tag})"""


def sql_metrics(tag: str, overall: bool) -> str:
    sets = "GROUPING SETS ((model, task), (model))" if overall else "GROUP BY model, task"
    grp = "GROUP BY " + sets if overall else sets
    ds = "CASE WHEN grouping(task) = 1 THEN 'overall_micro' ELSE task END" if overall else "task"
    return f"""
m{tag} AS (SELECT model, {ds} AS dataset, count(*) AS n,
             CAST(sum(CASE WHEN pred_idx = answer_idx THEN 1 ELSE 0 END) AS BIGINT) AS correct,
             CAST(sum(CASE WHEN pred_idx IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unknown
           FROM pp{tag} {grp}),
mm{tag} AS (SELECT model, dataset, n, correct / greatest(n, 1) AS acc, correct / greatest(n - unknown, 1) AS acc_known_only,
             unknown, unknown / greatest(n, 1) AS unknown_rate FROM m{tag})"""


@query("mc_predictions", sql=f"""WITH {sql_preds(False, '')}
SELECT model, task, id, answer_idx, pred_idx, coalesce(pred_idx = answer_idx, false) AS correct FROM pp""")
def mc_predictions(spark, sf_dir):
    p = preds(spark, sf_dir)
    return p.select("model", "task", "id", "answer_idx", "pred_idx",
                    F.coalesce(F.col("pred_idx") == F.col("answer_idx"), F.lit(False)).alias("correct"))


@query("eval_metrics", sql=f"WITH {sql_preds(False, '')}, {sql_metrics('', False)}\nSELECT * FROM mm")
def eval_metrics(spark, sf_dir):
    return SC.metrics(preds(spark, sf_dir), overall=None)


@query("eval_metrics_overall", sql=f"WITH {sql_preds(False, '')}, {sql_metrics('', True)}\nSELECT * FROM mm")
def eval_metrics_overall(spark, sf_dir):
    return SC.order_metrics(SC.metrics(preds(spark, sf_dir)))


@query("eval_metrics_order", sql=f"""WITH {sql_preds(False, '')}, {sql_metrics('', True)}
SELECT model, dataset, row_number() OVER (ORDER BY coalesce(list_position({DATASETS}, dataset), {len(SC.EVAL.dataset_order) + 1}), dataset, model) AS place
FROM mm""")
def eval_metrics_order(spark, sf_dir):
    """The display order as a column: place of each of the few metric rows."""
    ordered = SC.order_metrics(SC.metrics(preds(spark, sf_dir))).select("model", "dataset").coalesce(1)
    return ordered.withColumn("place", F.monotonically_increasing_id() + 1)


@query("accuracy_pivot", sql=f"""WITH {sql_preds(False, '')}, {sql_metrics('', True)}
SELECT dataset, {", ".join(f"max(acc) FILTER (WHERE model = '{m}') AS {m}" for m in PRED_MODELS)},
       CAST(list_position({DATASETS}, dataset) AS INTEGER) AS pos
FROM mm WHERE list_contains({DATASETS}, dataset) GROUP BY dataset""")
def accuracy_pivot(spark, sf_dir):
    return SC.accuracy_pivot(SC.metrics(preds(spark, sf_dir)), PRED_MODELS)


@query("quant_delta", sql=f"""WITH {sql_preds(False, '')}, {sql_metrics('', True)}, {sql_preds(True, 'q')},
{sql_metrics('q', True)}
SELECT a.model, a.dataset, a.acc AS pre_acc, b.acc AS post_acc, b.acc - a.acc AS delta
FROM mm a JOIN mmq b ON a.model = b.model AND a.dataset = b.dataset""")
def quant_delta(spark, sf_dir):
    return SC.quant_delta(SC.metrics(preds(spark, sf_dir)), SC.metrics(preds(spark, sf_dir, quantize=True)))


def length_model():
    """A deterministic stand-in: a letter and 30 log-probabilities from the prompt's length."""
    return lambda prompts: [(chr(65 + len(p) % 5), {t: -float((7 * t + len(p)) % 31) for t in range(30)}) for p in prompts]


LIDS = "[" + ", ".join("[" + ", ".join(map(str, ids)) + "]::INTEGER[]" for ids in LETTER_IDS) + "]"


@query("mc_scored", sql=f"""WITH {SQL_MC},
q AS (SELECT task, id, answer_idx, num_choices, length(prompt_text) AS n FROM mc),
t AS (SELECT *, chr(CAST(65 + n % 5 AS INTEGER)) AS text, list_sort(list_transform(range(30), lambda t: {{'v': -((7 * t + n) % 31), 't': t}}), 'DESC')[1:20] AS top FROM q),
p AS (SELECT *, list_sort(flatten(list_transform(range(num_choices), lambda i: list_transform(
        list_filter(top, lambda x: list_contains({LIDS}[i + 1], x.t)), lambda x: {{'v': x.v, 'i': -i}}))), 'DESC')[1].i AS best FROM t WHERE num_choices <= {len(LETTER_IDS)})
SELECT task, id, answer_idx, text, CAST(coalesce(-best, CASE WHEN ascii(text) < 65 + num_choices THEN ascii(text) - 65 END) AS INTEGER) AS pred_idx FROM p
UNION ALL SELECT task, id, answer_idx, text, NULL FROM t WHERE num_choices > {len(LETTER_IDS)}""")
def mc_scored(spark, sf_dir):
    """Every question of the evaluation corpus with its scored output; questions with more
    choices than the letter table has letters stay unknown."""
    from corpusloom.operators.infer import score_resumable
    questions = corpus(spark, sf_dir, "completion").select("task", "id", "answer_idx", "num_choices", "prompt_text")
    path = scratch_path(spark, "questions")
    questions.write.parquet(path)
    out = score_resumable(spark.read.parquet(path), length_model, "length", scratch_path(spark, "scored"))
    known = F.when(F.col("num_choices") <= len(LETTER_IDS), SC.predict(out, LETTER_IDS, k="num_choices"))
    return out.select("task", "id", "answer_idx", "text", known.cast("int").alias("pred_idx"))
