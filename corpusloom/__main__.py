"""Command line: run a stage as a Spark job.

  python -m corpusloom chat-sets  --turns conversations.parquet --out DIR [--n-sft N --calib S,M,L]
  python -m corpusloom chat-sets  --chats DIR [--split train_sft] --out DIR     (rows with a messages array)
  python -m corpusloom instruction-sets --rows rows.parquet --out DIR [...]
  python -m corpusloom eval-corpus --hellaswag P --arc P --winogrande P --truthfulqa P --out DIR
                                   [--style chat|completion --n-per-task N --key COLUMN]
  python -m corpusloom train-prep --records DIR/sft_N --out DIR
  python -m corpusloom calib-prep --records DIR/calib_N --out DIR
  python -m corpusloom kd-set --sft DIR/sft_N --generations gen.parquet --out DIR
  python -m corpusloom evaluate --predictions preds.parquet --letter-ids '[[32],[33]]' --out DIR

``--tokenizer module:factory`` (a callable that returns ``text -> ids``) replaces the default
counter wherever tokens are counted or written. Inputs are parquet; the session comes from the environment (spark-submit
settings apply). Counts and summaries are printed; tables are written.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from corpusloom.config import QUANT_CALIB, V1, V2, EvalConfig
from corpusloom.functions.tokens import load_tokens
from corpusloom.plans import jobs
from corpusloom.session import build_session
from corpusloom.sources.tables import read_split, with_key


def _cfg(base, args):
    if args.n_sft is None and args.calib is None:
        return base
    n = args.n_sft if args.n_sft is not None else base.n_sft
    quotas = ({b.name: b.target for b in base.buckets} if args.calib is None else
              dict(zip([b.name for b in base.buckets], (int(x) for x in args.calib.split(",")))))
    return base.with_quotas(n, quotas)


def main(argv=None):
    ap = argparse.ArgumentParser(prog="corpusloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("chat-sets", "instruction-sets"):
        p = sub.add_parser(name)
        if name == "chat-sets":
            given = p.add_mutually_exclusive_group(required=True)
            given.add_argument("--turns", help="one row per turn: conv_id, turn, role, text")
            given.add_argument("--chats", help="one row per chat: messages array<struct<role,content>>")
            p.add_argument("--split", help="keep one split=<name> folder of --chats")
        else:
            p.add_argument("--rows", required=True)
        p.add_argument("--tokenizer")
        p.add_argument("--out", required=True)
        p.add_argument("--n-sft", type=int)
        p.add_argument("--calib", help="comma-separated bucket quotas, e.g. 300,500,200")
        p.add_argument("--files", type=int)
        p.add_argument("--format", default="parquet", help="input format (parquet, json, ...)")
    for name in ("train-prep", "calib-prep"):
        p = sub.add_parser(name)
        p.add_argument("--records", required=True, help="JSONL written by chat-sets (sft_* or calib_*)")
        p.add_argument("--out", required=True)
        p.add_argument("--tokenizer")
        if name == "calib-prep":
            p.add_argument("--preset", default="prune", choices=["prune", "quant"])
    p = sub.add_parser("kd-set")
    p.add_argument("--sft", required=True, help="SFT JSONL written by chat-sets")
    p.add_argument("--generations", required=True, help="parquet with columns id, text")
    p.add_argument("--out", required=True)
    p.add_argument("--tokenizer")
    p = sub.add_parser("evaluate")
    p.add_argument("--predictions", required=True,
                   help="parquet: model or model_path, task, answer_idx, num_choices, text, logprobs")
    p.add_argument("--letter-ids", required=True, help='JSON list of id lists per letter, e.g. [[32],[33]]')
    p.add_argument("--out", required=True)
    p = sub.add_parser("eval-corpus")
    for task in ("hellaswag", "arc", "winogrande", "truthfulqa"):
        p.add_argument(f"--{task}", required=True, help="parquet of the raw task rows")
    p.add_argument("--key", help="stable key column of the raw tables (default: a hash of the row)")
    p.add_argument("--out", required=True)
    p.add_argument("--style", default="chat", choices=["chat", "completion"])
    p.add_argument("--n-per-task", type=int, default=EvalConfig().n_per_task)
    args = ap.parse_args(argv)

    spark = build_session()
    tokens = load_tokens(getattr(args, "tokenizer", None))
    if args.cmd == "chat-sets":
        from corpusloom.sources.fixtures import chat_from_turns
        cfg = _cfg(V2, args)
        if args.chats:
            chats = with_key(read_split(spark, args.chats, args.split, args.format), "source_index", None)
        else:
            chats = chat_from_turns(spark.read.format(args.format).load(args.turns), cfg.max_messages)
        counts, summary, buckets = jobs.build_chat_sets(chats, args.out, cfg, args.files, tokens.count)
    elif args.cmd == "instruction-sets":
        cfg = _cfg(V1, args)
        rows = spark.read.format(args.format).schema("instruction string, input string, output string") \
            .load(args.rows) if args.format == "json" else spark.read.format(args.format).load(args.rows)
        rows = with_key(rows, "source_index", None)
        counts, summary, buckets = jobs.build_instruction_sets(rows, args.out, cfg, args.files, tokens.count)
    elif args.cmd == "evaluate":
        import json

        from corpusloom.operators.score import model_name
        preds = spark.read.parquet(args.predictions)
        if "model" not in preds.columns:
            preds = preds.withColumn("model", model_name("model_path"))
        models = sorted(r[0] for r in preds.select("model").distinct().collect())   # a handful of names
        metrics, pivot = jobs.evaluate(preds, json.loads(args.letter_ids), models)
        metrics.write.mode("overwrite").parquet(f"{args.out}/metrics")
        pivot.write.mode("overwrite").parquet(f"{args.out}/pivot")
        pivot.show(truncate=False)
        return
    elif args.cmd in ("train-prep", "calib-prep", "kd-set"):
        from corpusloom.sources.jsonl import CHAT_RECORD_SCHEMA, read_jsonl
        src = args.sft if args.cmd == "kd-set" else args.records
        rows = read_jsonl(spark, src, CHAT_RECORD_SCHEMA).select(
            "*", F.col("meta")["source_index"].alias("source_index"), F.col("meta")["turn_index"].alias("turn_index"))
        if args.cmd == "train-prep":
            print(jobs.prepare_training(rows, args.out, tokens=tokens))
        elif args.cmd == "calib-prep":
            print(jobs.prepare_calibration(rows, args.out, QUANT_CALIB if args.preset == "quant" else None, tokens))
        else:
            jobs.build_kd_set(rows, spark.read.parquet(args.generations), args.out, count=tokens.count).show()
        return
    else:
        paths = {"hellaswag": args.hellaswag, "arc_challenge": args.arc, "winogrande": args.winogrande, "truthfulqa_mc": args.truthfulqa}
        raws = {task: with_key(spark.read.parquet(path), "source_index", args.key) for task, path in paths.items()}
        man = jobs.build_eval_corpus(spark, raws, args.out, args.style, args.n_per_task)
        man.show(truncate=False)
        return
    print(counts)
    for row in summary:
        print(row)
    print(buckets)


if __name__ == "__main__":
    main()
