"""Plan-shape checks: dedup limits before the shuffle, no row-at-a-time Python."""

import io
from contextlib import redirect_stdout

from corpusloom.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_dedup_has_partial_window_group_limit(spark):
    p = plan(QUERIES["sft_sample_v1"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_record_builders_stay_in_jvm(spark):
    for q in ("chat_records", "alpaca_records", "eval_corpus", "train_labels", "teacher_quality"):
        p = plan(QUERIES[q](spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, q


def test_scan_prunes_columns(spark):
    p = plan(QUERIES["repetitive_text"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_no_single_partition_window_in_selection(spark):
    for q in ("sft_sample_v2", "mc_subsample", "kd_prompts"):
        p = plan(QUERIES[q](spark, SF))
        assert "SinglePartition" not in p, q


def test_chat_assembly_limits_before_shuffle(spark):
    p = plan(QUERIES["chat_records"](spark, SF))
    assert p.count("WindowGroupLimit") >= 4 and "Partial" in p
