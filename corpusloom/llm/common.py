"""Small expressions shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words, and the word pattern.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"


def words_of(text: Column) -> Column:
    """Array of the words of ``text``; empty for a null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value`` once. A column used inside a lambda
    may be inlined by the optimizer and then evaluated for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def hashed_shingles(words: Column, size: int) -> Column:
    """64-bit hashes of all runs of ``size`` consecutive words, by start position
    (empty when there are fewer words). One rolling slice per position, JVM-side."""
    def runs(w):
        n = F.size(w) - F.lit(size - 1)
        starts = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, size)))
    return let(words, runs)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, whatever the locale and the other letters."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
