"""Table scans with explicit schemas, split selection and progress counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_split(spark: SparkSession, path: str, split: str | None = None, fmt: str = "parquet",
               schema: str | None = None, split_col: str = "split") -> DataFrame:
    """Read a dataset stored with a ``split=<name>`` partition folder and keep one
    split; the filter on the partition column prunes folders at planning time."""
    r = spark.read.format(fmt)
    if schema:
        r = r.schema(schema)
    df = r.load(path)
    return df if split is None else df.where(F.col(split_col) == split)


def with_key(df: DataFrame, name: str, column: str | None) -> DataFrame:
    """``df`` with a stable key ``name``: as it is when present, else ``column``, else a
    hash of the whole row (a distributed table has no row positions). Rows with
    equal keys stay apart by their texts wherever records are ordered."""
    if name in df.columns and not column:
        return df
    key = F.col(column) if column else F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    return df.withColumn(name, key.cast("long"))


def computed_once(df: DataFrame, *names: str) -> DataFrame:
    """``df`` whose columns ``names`` are computed once a row. A filter on a computed column
    moves below its computation, which is then repeated for every comparison; no filter
    moves below a generator."""
    once = F.inline(F.array(F.struct(*[F.col(f"`{n}`") for n in names])))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in names], once).select(*[F.col(f"`{c}`") for c in df.columns])


def with_progress(df: DataFrame, name: str, **conds) -> tuple[DataFrame, Observation]:
    """Attach row counters (total and one per named boolean condition) that are
    filled as a side effect of the next action; no per-row logging, no extra job."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(c).alias(k) for k, c in conds.items()]
    return df.observe(obs, *metrics), obs
