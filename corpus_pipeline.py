"""The corpus pipeline: quality rules, near-duplicate removal, decontamination,
mixing and sharding, applied to ``documents`` one after another.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.

Defined cases of all stages: null, empty and blank texts fail the quality rules (the
later stages alone would keep them); a null id is the largest id, a null source is a
source; rows that share an id are told apart by their text, and rows that repeat id and
text are near duplicates of each other, so one stays; an empty table gives no rows; extra
columns pass through the first four stages.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontam, jaccard, mixing, quality, resharding
from corpusloom.llm.common import read_table
from corpusloom.llm.queries import MIX_SHARES
from corpusloom.session import scratch_path
from corpusloom.sources.positions import row_positions
from corpusloom.sources.tables import computed_once


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood-ratio threshold."""
    ratio = quality.fit_ratio(docs, read_table(spark, sf_dir, "labels"), ngram=quality.NGRAM)
    judged = quality.judge(docs, ratio, ngram=quality.NGRAM)
    return computed_once(judged, "_q_kept").where("_q_kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group linked at similarity 0.8 of five-word shingles."""
    return jaccard.representatives(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def _mixed(rows: DataFrame, *ties) -> DataFrame:
    return mixing.mix(rows, shares=MIX_SHARES, prefix="_mixed_", ties=ties)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, range-partitioned and sorted into the mixture's order: read in
    file order, every prefix holds the sources at their target weights."""
    body = F.coalesce(F.col("text"), F.lit(""))
    mixed = _mixed(docs, F.octet_length(body), F.crc32(body.cast("binary")))
    return mixed.orderBy("_mixed_slot", "_mixed_pos").select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, with its text's size and CRC. The slots of a
    shard follow the order in which ``docs`` was written, so after mixing every run of
    slots from 0 holds the sources at their target weights. Rows that come from no file
    have no order; they are mixed here."""
    try:
        rows, arrange, order = row_positions(docs, "_mixed_at"), (lambda r: r), ["_mixed_at"]
    except AnalysisException:                                  # no file metadata
        rows, arrange, order = docs, (lambda r: _mixed(r, "_rs_size", "_rs_crc")), ["_mixed_slot", "_mixed_pos"]
    keep = ["_mixed_at"] if "_mixed_at" in rows.columns else ["source"]
    return resharding.ordered_assignments(rows, arrange, order, keep=keep, new_shards=16, old_shards=12)


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard_join", near_duplicates),
          ("benchmark_decontamination", decontamination), ("source_mixing", source_mixing), ("sharding", sharding)]

#: The classifier, the similarity join and the flow are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written below the shared
    checkpoint folder and read again, as between separate jobs."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
