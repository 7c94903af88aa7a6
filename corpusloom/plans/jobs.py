"""Job-level entry points: the reference's stages as Spark jobs that write tables.

Each job reads DataFrames, composes the operators and writes its outputs with
an explicit number of files; counts and guards come from aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import V1, V2, DistillConfig, EvalConfig, SetConfig
from corpusloom.operators import distill as D
from corpusloom.operators import mc as M
from corpusloom.operators import score as SC
from corpusloom.operators import sft_sets as S
from corpusloom.operators.chat_records import chat_records
from corpusloom.operators.chat_records import with_meta as chat_meta
from corpusloom.operators.instruct import instruct_records
from corpusloom.operators.instruct import with_meta as instruct_meta
from corpusloom.operators.profile import length_summary
from corpusloom.functions.tokens import DEFAULT_TOKENS, count_tokens
from corpusloom.sources import jsonl as J
from corpusloom.sources.tables import with_progress


def _write_sets(records: DataFrame, cfg: SetConfig, out_dir: str, meta, num_files: int | None):
    observed, progress = with_progress(records, "scan", sft_gate=S.gate(cfg.sft_gate),
                                       calib_gate=S.gate(cfg.calib_gate) & S.bucket_of(cfg).isNotNull())
    nar = S.narrow(observed)   # writing the narrow table fills the counters
    sft = S.kept(S.attach(S.sft_sample(nar, cfg), records), "sft")
    cal = S.kept(S.attach(S.calib_sample(nar, cfg), records), "calib")
    n_sft = S.check_quota(sft, cfg.n_sft, "SFT")
    n_cal = S.check_quota(cal, cfg.n_calib, "calib")
    J.write_jsonl(meta(S.output_order(sft, cfg, "sft_out")), f"{out_dir}/sft_{cfg.n_sft}", num_files)
    J.write_jsonl(meta(S.output_order(cal, cfg, "calib_out")), f"{out_dir}/calib_{cfg.n_calib}", num_files)
    both = (sft.select(F.lit("sft").alias("set"), "total_tokens", "target_tokens")
            .unionByName(cal.select(F.lit("calib").alias("set"), "total_tokens", "target_tokens")))
    buckets = S.calib_candidates(cal, cfg).groupBy("bucket").count()
    counts = {"sft": n_sft, "calib": n_cal, **{f"scanned_{k}": v for k, v in progress.get.items()}}
    # both reports are aggregates of a few rows (sets x metrics, buckets)
    summary = [r.asDict() for r in length_summary(both, "set", ["total_tokens", "target_tokens"]).collect()]
    bucket_rows = {r["bucket"]: r["count"] for r in buckets.collect()}
    return counts, summary, bucket_rows


def build_chat_sets(chats: DataFrame, out_dir: str, cfg: SetConfig = V2, num_files: int | None = None, count=count_tokens):
    """``(source_index, messages)`` -> ``sft_<N>`` and ``calib_<N>`` JSONL; returns
    (counts, length-summary rows, bucket counts). Raises when a quota is not met."""
    return _write_sets(chat_records(chats, cfg, count=count), cfg, out_dir, chat_meta, num_files)


def build_instruction_sets(rows: DataFrame, out_dir: str, cfg: SetConfig = V1, num_files: int | None = None,
                           count=count_tokens):
    """``(source_index, instruction, input, output)`` -> SFT and calibration JSONL."""
    return _write_sets(instruct_records(rows, cfg, count=count), cfg, out_dir, instruct_meta, num_files)


def build_eval_corpus(spark: SparkSession, raws: dict[str, DataFrame], out_dir: str, style: str = "chat",
                      n_per_task: int | None = None, seed: int = 0) -> DataFrame:
    """Four builders -> per-task JSONL + manifest; returns the manifest rows."""
    corpus = M.sampled_corpus(raws, n_per_task, style, seed).drop("ord", "source_index")
    return J.write_task_files(spark, corpus, out_dir)


def build_kd_set(sft_rows: DataFrame, generations: DataFrame, out_path: str, cfg: DistillConfig = D.KD,
                 num_files: int | None = None, count=count_tokens):
    """SFT rows + teacher generations ``(id, text)`` -> KD JSONL; returns reject counts."""
    prompts = D.kd_prompts(sft_rows, cfg, count=count)
    judged = S.kept(D.judge(prompts, generations, cfg, count), "judged")     # read by both outputs
    J.write_jsonl(D.kd_records(judged, cfg, count), out_path, num_files)
    return D.kd_rejects(judged)


def kd_prompt_texts(sft_rows: DataFrame, cfg: DistillConfig = D.KD) -> DataFrame:
    """The rendered prompts handed to a generator (``id, prompt_text``)."""
    from corpusloom.functions.chat import render
    return D.kd_prompts(sft_rows, cfg).select("id", render("prompt_messages", True).alias("prompt_text"))


def evaluate(predictions: DataFrame, letter_ids: list[list[int]], models: list[str],
             cfg: EvalConfig = EvalConfig()):
    """Predictions ``(model, task, answer_idx, num_choices, text, logprobs)`` ->
    (metrics with overall rows in display order, accuracy pivot)."""
    p = predictions.withColumn("pred_idx", SC.predict(predictions, letter_ids))
    m = SC.metrics(p, cfg.overall_name)
    return SC.order_metrics(m, cfg.dataset_order), SC.accuracy_pivot(m, models, cfg.dataset_order)


def prepare_training(sft_rows: DataFrame, out_dir: str, cfg=None, num_files: int | None = None, tokens=DEFAULT_TOKENS) -> dict:
    """SFT records -> tokenized ``train`` / ``eval`` tables (input_ids, labels) with the
    keep gate and seeded hold-out; returns row counts. Texts are rendered, measured
    and kept once; the threshold reads only the order column of that table."""
    from corpusloom.config import TrainConfig
    from corpusloom.operators import trainprep as TP
    cfg = cfg or TrainConfig()
    rows = S.kept(TP.keep_trainable(TP.train_rows(sft_rows, cfg, count=tokens.count), cfg), "train")
    tok = TP.tokenize_train(TP.train_eval_split(rows, cfg), cfg, tokens.ids)
    out = tok.select("id", "split", "input_ids", "labels", "prompt_len_raw", "full_len_raw", "sup_after_trunc")
    (out.repartition(num_files) if num_files else out).write.mode("overwrite").partitionBy("split").parquet(out_dir)
    written = sft_rows.sparkSession.read.parquet(out_dir)
    return {r["split"]: r["n"] for r in written.groupBy("split").agg(F.count("*").alias("n")).collect()}


def prepare_calibration(calib_rows: DataFrame, out_dir: str, cfg=None, tokens=DEFAULT_TOKENS) -> dict:
    """Calibration records -> rendered, shuffled, first-n, right-truncated token rows."""
    from corpusloom.config import CalibConfig
    from corpusloom.operators import trainprep as TP
    from corpusloom.operators.profile import length_summary as ls
    cfg = cfg or CalibConfig()
    tok = TP.calib_tokens(TP.calib_select(TP.calib_text(calib_rows), cfg), cfg, tokens.ids)
    tok.select("id", "input_ids", "attention_mask").write.mode("overwrite").parquet(out_dir)
    tok = calib_rows.sparkSession.read.parquet(out_dir)
    summary = ls(tok.select(F.lit("calib").alias("g"), F.size("input_ids").alias("n_ids")), "g", ["n_ids"]).collect()
    return summary[0].asDict() if summary else {}
