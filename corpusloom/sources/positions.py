"""Positions of rows in files: the order that a reader of the files one by one sees.

Files count in the order of their folders and names (``part-9`` before ``part-10``),
rows in the order they stand in a file. Parquet rows carry their number in the file
(``_metadata.row_index``); lines carry the split they were read in, and splits are
numbered by prefix sums of their row counts, so a file gives the same positions
whether it is read in 1 or 64 splits. Only one narrow row per file or split is
gathered, as many as the driver lists to plan the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import strip
from corpusloom.session import scratch_path


def _file_order(path: str) -> list[Column]:
    name = F.substring_index(path, "/", -1)
    folder = F.substring(F.col(path), F.lit(1), F.length(path) - F.length(name))
    return [folder, F.length(name), name]


def _prefix_sums(counts: DataFrame, order: list[Column]) -> DataFrame:
    """``counts (..., _ps_n)`` with ``_ps_before``, the rows of all files or splits before."""
    return counts.withColumn("_ps_before", F.sum("_ps_n").over(Window.orderBy(*order)) - F.col("_ps_n"))


def row_positions(df: DataFrame, name: str = "position") -> DataFrame:
    """``df``, a straight read of Parquet files, with the position of every row from 0.
    The rows are not shuffled."""
    own = [F.col(f"`{c}`") for c in df.columns if c != name]
    placed = df.select(*own, F.col("_metadata.file_path").alias("_ps_file"), F.col("_metadata.row_index").alias("_ps_row"))
    files = placed.groupBy("_ps_file").agg((F.max("_ps_row") + 1).alias("_ps_n"))
    path = scratch_path(df.sparkSession, "file-rows")
    _prefix_sums(files, _file_order("_ps_file")).write.parquet(path)
    starts = df.sparkSession.read.parquet(path).select("_ps_file", "_ps_before")
    return (placed.join(F.broadcast(starts), "_ps_file")             # a row per file: the scan's own listing is larger
            .select(*own, (F.col("_ps_before") + F.col("_ps_row")).alias(name)))


def lines(spark: SparkSession, path) -> DataFrame:
    """``(line, _ps_file, _ps_split, _ps_at)`` of text files; ``_ps_at`` grows along a split."""
    return spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("_ps_file"), F.col("_metadata.file_block_start").alias("_ps_split"),
        F.monotonically_increasing_id().alias("_ps_at"))


def _filled(rows: DataFrame) -> DataFrame:
    return rows.where(strip("line") != "")


def _split_starts(rows: DataFrame) -> DataFrame:
    """One row per split that has any of ``rows``: its number of rows and those before."""
    counts = rows.groupBy("_ps_file", "_ps_split").agg(F.count(F.lit(1)).alias("_ps_n"))
    path = scratch_path(rows.sparkSession, "split-rows")
    _prefix_sums(counts, [*_file_order("_ps_file"), F.col("_ps_split")]).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _ranked(rows: DataFrame, starts: DataFrame, name: str) -> DataFrame:
    """Numbers ``rows`` within their split (one split's rows are one task's read) and on from its start."""
    own = Window.partitionBy("_ps_file", "_ps_split").orderBy("_ps_at")
    return (rows.join(F.broadcast(starts.drop("_ps_n")), ["_ps_file", "_ps_split"])      # a row per split of the scan
            .withColumn(name, F.col("_ps_before") + F.row_number().over(own) - 1)
            .select("line", F.col(name).cast("long").alias(name)))


def line_positions(spark: SparkSession, path, name: str = "position") -> DataFrame:
    """``(line, position)`` of the lines that are not blank, counted from 0."""
    rows = _filled(lines(spark, path))
    return _ranked(rows, _split_starts(rows), name)


def first_lines(spark: SparkSession, path, n_max: int | None, name: str = "position") -> DataFrame:
    """``(line, position)`` of the first ``n_max`` lines that are not blank.

    Reading stops once the cap is reached, and it is looked at after every line: a cap of
    0 or less still takes the very first line, if it is not blank. Beyond the counts, only
    splits that hold one of the first rows are read."""
    if n_max is None:
        return line_positions(spark, path, name)
    every = lines(spark, path)
    rows = every if n_max <= 0 else _filled(every)
    most = max(n_max, 1)
    starts = _split_starts(rows).where(F.col("_ps_before") < most)
    return _filled(_ranked(rows, starts, name).where(F.col(name) < most))


def read_jsonl_positions(spark: SparkSession, path, schema: str | T.StructType, n_max: int | None = None, name: str = "position") -> DataFrame:
    """The fields of ``schema`` of JSON lines in file order, with their position; a
    malformed line stops the read."""
    parsed = F.from_json("line", schema, {"mode": "FAILFAST"})
    return first_lines(spark, path, n_max, name).select(parsed.alias("_ps_row"), name).select("_ps_row.*", name)


def with_default_id(rows: DataFrame, id_col: str = "id", name: str = "position", lead: str = "row_") -> DataFrame:
    """A missing or null id is named after the row's position: ``row_<n>``."""
    return rows.withColumn(id_col, F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit(lead), F.col(name).cast("string"))))


def positional_zip(left: DataFrame, right: DataFrame, name: str = "position") -> DataFrame:
    """Rows of two tables at equal positions side by side, as far as the shorter one goes;
    clashing names of ``right`` are an error. One join on the position."""
    clash = (set(left.columns) & set(right.columns)) - {name}
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    return left.join(right, name)
