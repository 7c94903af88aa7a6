import json
import os

import pytest

from corpusloom.config import V2
from corpusloom.plans import jobs
from corpusloom.sources.fixtures import chat_from_turns, table

SF = "/root/testdata/sf0.001"


def _lines(d):
    out = []
    for f in sorted(os.listdir(d)):
        if f.endswith(".json"):
            with open(os.path.join(d, f), encoding="utf-8") as fh:
                out += [json.loads(x) for x in fh if x.strip()]
    return out


def test_build_chat_sets_writes_and_guards(spark, tmp_path):
    chats = chat_from_turns(table(spark, SF, "conversations"))
    cfg = V2.with_quotas(10, {"short": 3, "mid": 4, "long": 1})
    counts, summary, buckets = jobs.build_chat_sets(chats, str(tmp_path), cfg, num_files=2)
    assert counts["sft"] == 10 and counts["calib"] == 8
    assert counts["scanned_rows"] >= counts["scanned_sft_gate"] >= 10 and counts["scanned_calib_gate"] >= 8
    rows = _lines(tmp_path / "sft_10")
    assert len(rows) == 10 and all("meta" in r and r["messages"][-1]["role"] == "assistant" for r in rows)
    assert {r["group"] for r in summary} == {"sft", "calib"}
    assert buckets == {"short": 3, "mid": 4, "long": 1}
    with pytest.raises(RuntimeError, match="Not enough SFT"):
        jobs.build_chat_sets(chats, str(tmp_path / "x"), V2)


def test_training_and_calibration_prep_from_written_sets(spark, tmp_path):
    from pyspark.sql import functions as F

    from corpusloom.sources.jsonl import CHAT_RECORD_SCHEMA, read_jsonl
    chats = chat_from_turns(table(spark, SF, "conversations"))
    cfg = V2.with_quotas(12, {"short": 3, "mid": 4, "long": 1})
    jobs.build_chat_sets(chats, str(tmp_path / "sets"), cfg)
    sft = read_jsonl(spark, str(tmp_path / "sets" / "sft_12"), CHAT_RECORD_SCHEMA)
    counts = jobs.prepare_training(sft, str(tmp_path / "train"))
    assert counts.get("eval", 0) == 1 and sum(counts.values()) <= 12
    tr = spark.read.parquet(str(tmp_path / "train"))
    assert tr.where(F.size("input_ids") != F.size("labels")).count() == 0
    cal = read_jsonl(spark, str(tmp_path / "sets" / "calib_8"), CHAT_RECORD_SCHEMA)
    summ = jobs.prepare_calibration(cal, str(tmp_path / "calib"))
    assert summ["n"] == 8 and summ["max"] <= 1024


def test_evaluate_job(spark):
    from corpusloom.operators import score as SC
    from corpusloom.sources.fixtures import LETTER_IDS, PRED_MODELS, predictions_from_embeddings
    p = predictions_from_embeddings(table(spark, SF, "embeddings"))
    p = p.withColumn("model", SC.model_name("model_path"))
    metrics, pivot = jobs.evaluate(p, LETTER_IDS, PRED_MODELS)
    m = metrics.collect()
    assert {r["dataset"] for r in m} >= {"overall_micro"} and len({r["model"] for r in m}) == 3
    pv = pivot.collect()
    assert [r["dataset"] for r in pv][-1] == "overall_micro" and set(PRED_MODELS) <= set(pivot.columns)
