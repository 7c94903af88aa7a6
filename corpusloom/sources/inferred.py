"""JSON lines whose fields drift: the schema is read off the data, then the read is typed.

One aggregate (``schema_of_variant_agg``, combined map-side) merges the types of all
lines; only the merged type reaches the driver. Its size is that of the schema.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# a field name (with its colon, so that no name is taken for a type) or a type to widen
_PART = re.compile(r"((?:`(?:[^`]|``)*`|\w+)\s*:)|(OBJECT<>)|(OBJECT<)|(VARIANT|VOID)|(DECIMAL\(\d+,\s*\d+\)|FLOAT)")


def widened(merged: str) -> str:
    """The type to read with: types that clash (and fields that are always null or an empty
    object) are read as their JSON text, numbers with a fraction as doubles."""
    def part(m):
        name, empty, record, clash, number = m.groups()
        return name or (record and "STRUCT<") or (number and "DOUBLE") or "STRING"
    return _PART.sub(part, merged)


def infer_schema(spark: SparkSession, path) -> T.StructType:
    """The record that holds every field of every line; blank lines and lines that are
    no JSON do not count. No record at all, or lines that are no objects, are an error."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    merged = lines.agg(F.schema_of_variant_agg(F.try_parse_json("value"))).first()[0]
    ddl = widened(merged or "")
    if not ddl.startswith("STRUCT<"):
        raise ValueError(f"no schema of records in {path}: the lines are {merged}")
    return T.DataType.fromDDL(ddl)


def read_jsonl_inferred(spark: SparkSession, path, mode: str = "FAILFAST") -> DataFrame:
    """Typed read with the inferred schema. A field missing from a line is null; a field whose
    type differs between lines is text (strings as they are, other values as the line writes them); a
    malformed line stops the read unless another mode is asked for."""
    return spark.read.schema(infer_schema(spark, path)).option("mode", mode).json(path)
