"""Incremental record building from a growing folder of source files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators.instruct import instruct_records
from corpusloom.sources.fixtures import alpaca_from_documents

DOCUMENTS_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
RECORDS_SCHEMA = ("id string, source_index bigint, prompt_text string, target_text string, prompt_tokens int, target_tokens int, "
                  "total_tokens int, has_input boolean, dup_key string, ord string")
DISTINCT_SCHEMA = "id string, source_index bigint, dup_key string, total_tokens int, target_tokens int"


def _only(path: str) -> str:
    """``path`` as a pattern that matches it alone. Of a plain path Spark's file stream
    makes the base of partition folders, which a single file can't be."""
    path = path.rstrip("/")
    at = path.rfind("/") + 1
    return f"{path[:at]}[{path[at]}]{path[at + 1:]}" if path[at:at + 1].isalnum() else path


def document_stream(spark: SparkSession, src: str, file_glob: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Documents of ``src``, a folder that may grow or a single file."""
    r = spark.readStream.schema(DOCUMENTS_SCHEMA).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(_only(src))


def read_sink(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """The rows a stream has appended to ``sink``, none when it met no rows."""
    return spark.read.schema(schema).parquet(sink)


def stream_instruct_records(spark: SparkSession, src_dir: str, sink: str, checkpoint: str,
                            file_glob: str = "*.parquet", available_now: bool = True,
                            max_files_per_trigger: int | None = None):
    """Read new document files as a stream, build instruction records (row-local),
    append them to a parquet sink. The checkpoint folder (shared storage) makes the
    query restartable after a failure without duplicates."""
    docs = document_stream(spark, src_dir, file_glob, max_files_per_trigger)
    recs = instruct_records(alpaca_from_documents(docs)).drop("messages")
    w = (recs.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(sink)


def run_to_completion(spark: SparkSession, src_dir: str, sink: str, checkpoint: str, **kw) -> DataFrame:
    q = stream_instruct_records(spark, src_dir, sink, checkpoint, available_now=True, **kw)
    q.awaitTermination()
    return read_sink(spark, sink, RECORDS_SCHEMA)


def stream_distinct_records(spark: SparkSession, src_dir: str, sink: str, checkpoint: str,
                            file_glob: str = "*.parquet", available_now: bool = True):
    """Streaming counterpart of first-occurrence dedup: instruction records whose
    dedup key has not been seen in any earlier micro-batch. The seen keys are
    operator state (40-byte hashes), kept in the checkpoint folder so a restart
    neither re-emits nor loses keys."""
    docs = document_stream(spark, src_dir, file_glob)
    recs = (instruct_records(alpaca_from_documents(docs))
            .select("id", "source_index", "dup_key", "total_tokens", "target_tokens")
            .dropDuplicates(["dup_key"]))
    w = recs.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(sink)
