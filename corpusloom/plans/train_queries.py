"""Training-prep and calibration catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.config import CalibConfig, TrainConfig
from corpusloom.functions.tokens import PRETOKEN
from corpusloom.operators import trainprep as TP
from corpusloom.operators.dictionary import rank_file_encoder
from corpusloom.plans import sqlkit as Q
from corpusloom.plans.chat_queries import sql_chat_records, v2_records
from corpusloom.plans.registry import query

TRAIN = TrainConfig()
# Test batch size (the reference trains with batch 1, where padding is a no-op).
BATCH_TEST = 4
# Calibration texts to select: few enough to cut the texts at every test scale (the default is 1,000).
CALIB_TEST = CalibConfig(num_samples=100)


def train_table(spark, sf_dir):
    return TP.train_rows(v2_records(spark, sf_dir), TRAIN)


def kept(spark, sf_dir):
    return TP.keep_trainable(train_table(spark, sf_dir), TRAIN)


def sql_ids(t: str) -> str:
    return (f"list_transform(regexp_extract_all({t}, '{PRETOKEN}'), "
            f"lambda w: CAST((length(w) % 1000) * 1000000 + ascii(w) % 1000000 AS INTEGER))")


L = TRAIN.max_seq_len
SQL_TRAIN = f"""{sql_chat_records()},
tr AS (SELECT id, {Q.render('pm', True)} AS prompt_text, {Q.render('mm', False)} AS full_text FROM rec),
tr2 AS (SELECT *, {Q.ntok('prompt_text')} AS prompt_len_raw, {Q.ntok('full_text')} AS full_len_raw FROM tr),
tr3 AS (SELECT *, CAST(greatest(full_len_raw - prompt_len_raw, 0) AS INTEGER) AS target_len_raw,
          CAST(least(greatest(full_len_raw - prompt_len_raw, 0), {L}) AS INTEGER) AS sup_after_trunc FROM tr2),
kp AS (SELECT * FROM tr3 WHERE prompt_text <> '' AND full_text <> '' AND sup_after_trunc >= {TRAIN.min_sup_tokens}),
sp AS (SELECT *, {Q.okey(TRAIN.seed, 'split', 'id')} AS ord FROM kp),
sp2 AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY ord) <= ceil(CAST({TRAIN.eval_ratio} AS DOUBLE) * count(*) OVER ())
          THEN 'eval' ELSE 'train' END AS split FROM sp),
tk0 AS (SELECT *, {sql_ids('full_text')} AS ids0 FROM sp2),
tk1 AS (SELECT *, CASE WHEN len(ids0) > {L} THEN list_slice(ids0, len(ids0) - {L} + 1, len(ids0)) ELSE ids0 END AS ids
        FROM tk0),
tk AS (SELECT *, list_transform(ids, lambda x, j: CASE WHEN j - 1 < least(greatest(prompt_len_raw -
          greatest(full_len_raw - {L}, 0), 0), len(ids)) THEN -100 ELSE x END) AS labels FROM tk1)"""


@query("train_lengths", sql=f"""WITH {SQL_TRAIN}
SELECT id, prompt_len_raw, full_len_raw, target_len_raw, sup_after_trunc FROM tr3""")
def train_lengths(spark, sf_dir):
    return train_table(spark, sf_dir).select("id", "prompt_len_raw", "full_len_raw", "target_len_raw",
                                             "sup_after_trunc")


@query("train_keep", sql=f"WITH {SQL_TRAIN}\nSELECT id, sup_after_trunc FROM kp")
def train_keep(spark, sf_dir):
    return kept(spark, sf_dir).select("id", "sup_after_trunc")


@query("train_eval_split", sql=f"WITH {SQL_TRAIN}\nSELECT id, split FROM sp2")
def train_eval_split(spark, sf_dir):
    return TP.train_eval_split(kept(spark, sf_dir), TRAIN).select("id", "split")


@query("train_eval_overlap", sql=f"""WITH {SQL_TRAIN}
SELECT count(*) AS n_eval, CAST(sum(CASE WHEN id IN (SELECT id FROM sp2 WHERE split = 'train') THEN 1 ELSE 0 END) AS BIGINT) AS n_shared
FROM sp2 WHERE split = 'eval'""")
def train_eval_overlap(spark, sf_dir):
    """Hold-out rows whose id is also a training id."""
    s = TP.train_eval_split(kept(spark, sf_dir), TRAIN).select("id", "split")
    ev, tr = s.where("split = 'eval'"), s.where("split = 'train'").select("id").distinct().withColumn("hit", F.lit(1))
    return ev.join(tr, "id", "left").agg(F.count("*").alias("n_eval"), F.sum(F.coalesce("hit", F.lit(0))).cast("long").alias("n_shared"))


@query("train_labels", sql=f"""WITH {SQL_TRAIN}
SELECT id, CAST(len(ids) AS INTEGER) AS n_ids, CAST(len(list_filter(labels, lambda x: x = -100)) AS INTEGER) AS n_masked,
       sha1(array_to_string(labels, ',')) AS labels_sha FROM tk""")
def train_labels(spark, sf_dir):
    t = TP.tokenize_train(kept(spark, sf_dir), TRAIN)
    return t.select("id", F.size("input_ids").alias("n_ids"),
                    F.size(F.filter("labels", lambda x: x == TP.IGNORE)).alias("n_masked"),
                    F.sha1(F.array_join(F.col("labels").cast("array<string>"), ",")).alias("labels_sha"))


# A public vocabulary (base64 token and rank per line) and the pattern that splits text before its merges.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# White space as a class; without look-ahead, the last white space before a word is cut off its run by a mark first.
SQL_WS = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SQL_PIECES = rf"''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SQL_WS}\p{{L}}\p{{N}}]+|[{SQL_WS}]+"
SQL_CUT = rf"regexp_replace(full_text, '([{SQL_WS}])([{SQL_WS}][^{SQL_WS}])', '\1' || chr(57344) || '\2', 'g')"

SQL_IDS = f"""WITH RECURSIVE {SQL_TRAIN},
vocabulary AS (SELECT hex(from_base64(token)) AS token, id FROM read_csv('{VOCABULARY}', delim=' ', header=false, quote='', escape='',
  columns={{'token': 'VARCHAR', 'id': 'INTEGER'}})),
numbered AS (SELECT row_number() OVER () AS row, id, prompt_text, full_text FROM kp),
pieced AS (SELECT row, flatten(list_transform(string_split({SQL_CUT}, chr(57344)), lambda x: regexp_extract_all(x, '{SQL_PIECES}'))) AS pieces FROM numbered),
placed AS (SELECT row, unnest(pieces) AS piece, unnest(range(len(pieces))) AS spot FROM pieced),
merged AS (
  SELECT piece, [hex(encode(piece))[2 * k + 1 : 2 * k + 2] FOR k IN range(strlen(piece))] AS tokens FROM (SELECT DISTINCT piece FROM placed)
  UNION ALL
  SELECT piece, tokens[: best - 1] || [tokens[best] || tokens[best + 1]] || tokens[best + 2 :] FROM (
    SELECT p.piece, any_value(p.tokens) AS tokens, arg_min(p.k, v.id::BIGINT * 1000000 + p.k) AS best
    FROM (SELECT piece, tokens, unnest(range(1, len(tokens))) AS k FROM merged) p
    JOIN vocabulary v ON v.token = p.tokens[p.k] || p.tokens[p.k + 1] GROUP BY p.piece)),
codes AS (SELECT piece, arg_min(tokens, len(tokens)) AS tokens FROM merged GROUP BY piece),
loose AS (SELECT row, spot, unnest(tokens) AS token, unnest(range(len(tokens))) AS k FROM placed JOIN codes USING (piece)),
tokens AS (SELECT row, v.id, spot * 1000000 + k AS spot, sum(len(token) // 2) OVER (PARTITION BY row ORDER BY spot, k) - len(token) // 2 AS start
  FROM loose JOIN vocabulary v USING (token)),
whole AS (SELECT row, list(id ORDER BY spot) AS ids0, list(start ORDER BY spot) AS starts FROM tokens GROUP BY row),
masked AS (SELECT n.id, list_transform(ids0, lambda x, j: CASE WHEN starts[j] < strlen(prompt_text) THEN -100 ELSE x END) AS labels0, ids0
  FROM numbered n JOIN whole USING (row)),
cut AS (SELECT id, list_slice(ids0, greatest(len(ids0) - {L}, 0) + 1, len(ids0)) AS ids, list_slice(labels0, greatest(len(ids0) - {L}, 0) + 1, len(ids0)) AS labels
  FROM masked)"""


@query("train_labels_ids", sql=f"""{SQL_IDS}
SELECT id, CAST(len(ids) AS INTEGER) AS n_ids, CAST(len(list_filter(labels, lambda x: x = -100)) AS INTEGER) AS n_masked,
       sha1(array_to_string(ids, ',')) AS ids_sha, sha1(array_to_string(labels, ',')) AS labels_sha FROM cut""")
def train_labels_ids(spark, sf_dir):
    t = TP.tokenize_train_ids(kept(spark, sf_dir).select("id", "prompt_text", "full_text"), PIECES, rank_file_encoder(VOCABULARY), TRAIN)
    digest = lambda c: F.sha1(F.array_join(F.col(c).cast("array<string>"), ",")).alias(f"{c.removeprefix('input_')}_sha")
    return t.select("id", F.size("input_ids").alias("n_ids"), F.size(F.filter("labels", lambda x: x == TP.IGNORE)).alias("n_masked"),
                    digest("input_ids"), digest("labels"))


@query("train_batches", sql=f"""WITH {SQL_TRAIN},
tb AS (SELECT *, (row_number() OVER (ORDER BY ord) - 1) // {BATCH_TEST} AS batch_id FROM tk WHERE split = 'train'),
tbm AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS mx FROM tb)
SELECT batch_id, count(*) AS n_rows, CAST(max(mx) AS INTEGER) AS max_len, CAST(sum(mx - len(ids)) AS BIGINT) AS n_pad,
       CAST(sum(len(list_filter(labels, lambda x: x <> -100))) AS BIGINT) AS n_label_tokens
FROM tbm GROUP BY batch_id""")
def train_batches(spark, sf_dir):
    t = TP.tokenize_train(TP.train_eval_split(kept(spark, sf_dir), TRAIN).where(F.col("split") == "train"), TRAIN)
    b = TP.pad_batches(t.select("ord", "input_ids", "labels"), BATCH_TEST, TRAIN)
    return b.groupBy("batch_id").agg(
        F.count("*").alias("n_rows"), F.max(F.size("input_ids")).alias("max_len"),
        F.sum(F.size(F.filter("attention_mask", lambda x: x == 0))).cast("long").alias("n_pad"),
        F.sum(F.size(F.filter("labels", lambda x: x != TP.IGNORE))).cast("long").alias("n_label_tokens"))


SQL_CALIB = f"""{sql_chat_records()},
ct0 AS (SELECT id, CASE WHEN mm IS NOT NULL AND len(mm) > 0 THEN {Q.render('mm', False)} ELSE '' END AS text FROM rec),
ctx AS (SELECT * FROM ct0 WHERE {Q.strip('text')} <> ''),
csel AS (SELECT *, {Q.okey(CALIB_TEST.seed, 'calib_shuffle', 'id')} AS ord FROM ctx
         ORDER BY ord LIMIT {CALIB_TEST.num_samples}),
ctok AS (SELECT *, list_slice({sql_ids('text')}, 1, {CALIB_TEST.max_seq_len}) AS ids FROM ctx)"""


@query("calib_text", sql=f"WITH {SQL_CALIB}\nSELECT id, sha1(text) AS text_sha FROM ctx")
def calib_text_q(spark, sf_dir):
    return TP.calib_text(v2_records(spark, sf_dir)).select("id", F.sha1("text").alias("text_sha"))


@query("calib_select", sql=f"WITH {SQL_CALIB}\nSELECT id, ord FROM csel")
def calib_select_q(spark, sf_dir):
    return TP.calib_select(TP.calib_text(v2_records(spark, sf_dir)), CALIB_TEST).select("id", "ord")


@query("calib_tokens", sql=f"""WITH {SQL_CALIB}
SELECT id, CAST(len(ids) AS INTEGER) AS n_ids, sha1(array_to_string(ids, ',')) AS ids_sha FROM ctok""")
def calib_tokens_q(spark, sf_dir):
    t = TP.calib_tokens(TP.calib_text(v2_records(spark, sf_dir)), CALIB_TEST)
    return t.select("id", F.size("input_ids").alias("n_ids"),
                    F.sha1(F.array_join(F.col("input_ids").cast("array<string>"), ",")).alias("ids_sha"))
