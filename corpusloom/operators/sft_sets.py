"""SFT and calibration set selection over a records table (v1 or v2).

Both consumers read the same narrow candidate rows ``(ord, dup_key, lengths)``:
SFT = gate -> first row per dedup key -> first N by order;
calibration = gate -> length bucket -> bucketed quota sample (shared seen set).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import LengthGate, SetConfig
from corpusloom.functions.ids import order_key
from corpusloom.operators.sample import first_n_per_key, kept, quota_sample
from corpusloom.sources.tables import computed_once


def gate(g: LengthGate, total: str = "total_tokens", target: str = "target_tokens") -> Column:
    """Inclusive length gate on total and target tokens."""
    return (F.col(total).between(g.min_total, g.max_total)
            & F.col(target).between(g.min_target, g.max_target))


def bucket_of(cfg: SetConfig, total: str = "total_tokens") -> Column:
    """First bucket (in declaration order) whose inclusive range holds ``total``."""
    e = None
    for b in cfg.buckets:
        cond = F.col(total).between(b.min_total, b.max_total)
        e = F.when(cond, F.lit(b.name)) if e is None else e.when(cond, F.lit(b.name))
    return e


NARROW = ("id", "source_index", "turn_index", "ord", "dup_key", "prompt_tokens", "target_tokens", "total_tokens",
          "has_input", "num_messages")


def narrow(records: DataFrame) -> DataFrame:
    """The selection columns of a records table, written once as Parquet below the
    shared checkpoint folder.

    Every selection (SFT first-N, each calibration round, the thresholds) reads the
    columns it needs of this table instead of re-tokenising the texts, and losing
    an executor never sends a later round back to the source. Wide rows come back
    by ``ord`` only for the selected rows (:func:`attach`).
    """
    return kept(records.select(*[c for c in NARROW if c in records.columns]), "narrow")


def attach(selected: DataFrame, records: DataFrame) -> DataFrame:
    """Wide rows of the selected ``ord`` values."""
    return records.join(selected.select("ord").distinct(), "ord", "left_semi").dropDuplicates(["ord"])


def measured(records: DataFrame) -> DataFrame:
    """``records`` whose lengths, which gates and buckets compare many times, are counted once."""
    return computed_once(records, "total_tokens", "target_tokens")


def sft_candidates(records: DataFrame, cfg: SetConfig) -> DataFrame:
    return measured(records).where(gate(cfg.sft_gate))


def calib_candidates(records: DataFrame, cfg: SetConfig) -> DataFrame:
    """Rows that pass the calibration gate, with their bucket (no bucket -> dropped)."""
    return (measured(records).where(gate(cfg.calib_gate)).withColumn("bucket", bucket_of(cfg))
            .where(F.col("bucket").isNotNull()))


def sft_sample(records: DataFrame, cfg: SetConfig, n: int | None = None) -> DataFrame:
    """Filtered dedup sample: gate -> first per dedup key -> first ``n`` by scan order."""
    n = cfg.n_sft if n is None else n
    return first_n_per_key(sft_candidates(records, cfg), n, "dup_key")


def calib_sample(records: DataFrame, cfg: SetConfig) -> DataFrame:
    """Bucketed quota sample with one dedup set across buckets."""
    quotas = {b.name: b.target for b in cfg.buckets}
    return quota_sample(calib_candidates(records, cfg), "dup_key", "bucket", quotas)


def output_order(df: DataFrame, cfg: SetConfig, stage: str) -> DataFrame:
    """Seeded re-shuffle of a chosen set before it is written."""
    return df.withColumn("out_ord", order_key(cfg.seed, stage, "id")).orderBy("out_ord")


def check_quota(df: DataFrame, need: int, what: str) -> int:
    """Raise when a selected set is short (one count over the narrow result)."""
    got = df.count()
    if got < need:
        raise RuntimeError(f"Not enough {what} records: got {got}, need {need}.")
    return got
