"""JSONL sinks/sources, per-task files with a manifest, and a runs table."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_jsonl(df: DataFrame, path: str, num_files: int | None = None, partition_by: str | None = None) -> None:
    """UTF-8 JSON lines; null fields are written (not dropped)."""
    out = df.repartition(num_files) if num_files else df
    w = out.write.mode("overwrite").option("ignoreNullFields", "false")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)


def read_jsonl(spark: SparkSession, path, schema: str | T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """Explicit schema (never inferred). A malformed line stops the read unless
    another mode is asked for: it must not turn into a row of nulls unseen."""
    return spark.read.schema(schema).option("mode", mode).json(path)


def read_jsonl_first(df: DataFrame, n_max: int | None, key: str) -> DataFrame:
    """Row cap by a stable key (file order is not a table concept)."""
    if n_max is None:
        return df
    return df.orderBy(key).limit(max(n_max, 1))


MANIFEST_SCHEMA = "run string, name string, path string, rows long, checksum string"


def _run_name() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


def _task_totals(spark: SparkSession, folder: str) -> DataFrame:
    """``(task, rows, checksum)`` of the written files; the checksum does not depend on the order of lines."""
    if "task" not in spark.read.text(folder).columns:                                    # no rows, no task folders
        return spark.createDataFrame([], "task string, rows long, checksum string")
    written = spark.read.schema("value string, task string").text(folder)
    return written.groupBy("task").agg(F.count("*").alias("rows"), F.sum(F.xxhash64("value").cast("decimal(20,0)")).cast("string").alias("checksum"))


def write_task_files(spark: SparkSession, corpus: DataFrame, out_dir: str) -> DataFrame:
    """One JSONL folder per task (``tasks/run=<run>/task=<name>``) and a manifest; returns
    the manifest rows ``(run, name, path, rows, checksum)``.

    A run writes into a folder of its own, and its manifest is one file added at the very
    end: whatever fails before leaves the run published last as it was, files included,
    and readers see the old run or the new one. Rows and checksums are taken from the
    written files (a record is a line), so the corpus is computed once. Folders of earlier
    runs stay until somebody deletes them.
    """
    run = _run_name()
    folder = f"{out_dir}/tasks/run={run}"
    write_jsonl(corpus, folder, partition_by="task")
    rows = [(run, r["task"], f"{folder}/task={r['task']}", r["rows"], r["checksum"])     # one row per task
            for r in _task_totals(spark, folder).orderBy("task").collect()]
    published = rows or [(run, None, None, 0, None)]                                     # an empty run replaces the last one too
    spark.createDataFrame(published, MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(f"{out_dir}/manifest")
    return read_manifest(spark, out_dir)


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """The manifest of the run published last."""
    every = spark.read.schema(MANIFEST_SCHEMA).json(f"{out_dir}/manifest")
    last = every.agg(F.max("run")).first()[0]
    return every.where((F.col("run") == F.lit(last)) & F.col("name").isNotNull())


def damaged_task_files(spark: SparkSession, manifest: DataFrame) -> list[str]:
    """Tasks of one run whose files no longer hold the rows of the manifest."""
    want = {r["name"]: r for r in manifest.collect()}                                    # one row per task
    if not want:
        return []
    folder = next(iter(want.values()))["path"].rsplit("/task=", 1)[0]
    got = {r["task"]: (r["rows"], r["checksum"]) for r in _task_totals(spark, folder).collect()}
    return sorted(name for name, r in want.items() if got.get(name) != (r["rows"], r["checksum"]))


def read_task_files(spark: SparkSession, manifest: DataFrame, schema: str) -> DataFrame:
    """Read every manifest entry; the task comes from the folder name. Entries of one run
    are one scan. Only the manifest (one row per task) is brought to the driver."""
    entries = [(r["name"], r["path"]) for r in manifest.select("name", "path").collect()]
    if not entries:
        return spark.createDataFrame([], schema).withColumn("task", F.lit("").cast("string"))
    roots: dict[str, list[str]] = {}
    parts = []
    for name, path in entries:
        root, _, folder = path.rpartition("/")
        if folder == f"task={name}":
            roots.setdefault(root, []).append(path)
        else:
            parts.append(read_jsonl(spark, path, schema).withColumn("task", F.lit(name)))
    for root, paths in roots.items():
        reader = spark.read.schema(f"{schema}, task string").option("mode", "FAILFAST").option("basePath", root)
        parts.append(reader.json(paths))
    return reduce(DataFrame.unionByName, parts)


def record_run(spark: SparkSession, runs_path: str, stage: str, params: dict, counts: dict) -> DataFrame:
    """Append one run row (stage, params JSON, counts JSON, ISO timestamp) to a runs table, as one file."""
    stamp = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    row = [(stage, json.dumps(params, sort_keys=True), json.dumps(counts, sort_keys=True), stamp)]
    df = spark.createDataFrame(row, "stage string, params string, counts string, ts string")
    df.coalesce(1).write.mode("append").parquet(runs_path)
    return spark.read.parquet(runs_path)


def read_chat_jsonl_untrusted(spark: SparkSession, path) -> DataFrame:
    """Chat JSONL whose field types are not guaranteed: ``(source_index, id, messages)``.

    Each line is parsed into a VARIANT so JSON types can be tested the way a
    dynamic reader would: a non-list ``messages`` gives null (the row expands
    to nothing), elements that are not objects, have an unknown role or a
    non-string ``content`` are dropped. Blank lines are skipped. The source key
    is a hash of the line (stable, no row positions).
    """
    raw = spark.read.text(path).where(F.trim(F.col("value")) != "")
    v = F.try_parse_json(F.col("value"))
    arr = F.try_variant_get(v, "$.messages", "array<variant>")

    def keep(x):
        c = F.try_variant_get(x, "$.content", "variant")
        role = F.try_variant_get(x, "$.role", "string")
        return (F.schema_of_variant(c) == "STRING") & role.isin("system", "user", "assistant")

    msgs = F.transform(F.filter(arr, keep), lambda x: F.struct(
        F.try_variant_get(x, "$.role", "string").alias("role"),
        F.try_variant_get(x, "$.content", "string").alias("content")))
    return raw.select(F.xxhash64("value").alias("source_index"),
                      F.try_variant_get(v, "$.id", "string").alias("id"), msgs.alias("messages"))


# The written chat (v2) record layout.
CHAT_RECORD_SCHEMA = ("id string, messages array<struct<role:string,content:string>>, "
                      "prompt_messages array<struct<role:string,content:string>>, target_text string, "
                      "meta struct<source_index:bigint,turn_index:int,prompt_tokens:int,target_tokens:int,"
                      "total_tokens:int,num_messages:int>")
