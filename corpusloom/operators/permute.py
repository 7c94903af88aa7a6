"""Seeded permutation of dense positions, computed per row: no sort and no shuffle.

A Feistel network permutes the smallest power of two that holds all ``n`` positions; a
value of ``n`` or more goes through it again until it falls inside (a cycle walk), which
is a permutation of ``0..n-1``. A prefix of the shuffled order is then one filter over
the source, and its rows are exactly as many as asked for.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.positions import row_positions

ROUNDS = 6                     # even: the two halves end with the widths they began with
MULTIPLIER = 1640531527        # below 2^31, so that products of 31-bit numbers stay in 64 bits
MODULUS = 2147483647
WALK = 128                     # more than half of the domain is inside: chances of 2^-128 to walk on


def round_keys(seed: int) -> list[int]:
    digest = [hashlib.sha256(f"{seed}:permute:{r}".encode()).digest() for r in range(ROUNDS)]
    return [int.from_bytes(d[:4], "big") >> 1 for d in digest]


def widths(n: int) -> tuple[int, int]:
    """Bits of the left and the right half."""
    bits = max(2, (n - 1).bit_length())
    return bits - bits // 2, bits // 2


def _shift(name: str, x: Column, bits: Column) -> Column:
    return F.call_function(name, x, bits)


def _network(x: Column, n: int, seed: int) -> Column:
    left, right = widths(n)
    steps = [F.struct(F.lit(key).cast("long").alias("key"), F.lit(left if r % 2 == 0 else right).alias("l"), F.lit(right if r % 2 == 0 else left).alias("r"))
             for r, key in enumerate(round_keys(seed))]

    def step(x, s):
        mask = lambda bits: _shift("shiftleft", F.lit(1).cast("long"), bits) - 1
        low = x.bitwiseAND(mask(s["r"]))
        mixed = (low.bitwiseXOR(s["key"]) * F.lit(MULTIPLIER).cast("long")) % F.lit(MODULUS).cast("long")
        high = _shift("shiftright", x, s["r"]).bitwiseXOR(mixed).bitwiseAND(mask(s["l"]))
        return _shift("shiftleft", low, s["l"]).bitwiseOR(high)

    return F.aggregate(F.array(*steps), x, step)


def place_of(position, n: int, seed: int) -> Column:
    """The place of a position (0..n-1) in the shuffled order of ``n`` rows."""
    if n >= 1 << 62:
        raise ValueError("too many rows to permute")
    first = _network(F.col(position).cast("long") if isinstance(position, str) else position.cast("long"), n, seed)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, lambda x, _: F.when(x < n, x).otherwise(_network(x, n, seed)),
                         lambda x: F.when(x < n, x).otherwise(F.raise_error("cycle walk did not end").cast("long")))
    return walked


def permuted(df: DataFrame, seed: int, name: str = "place") -> DataFrame:
    """``df``, a straight read of Parquet files, with every row's place in a shuffled order of all
    rows. Equal rows have places of their own; the order depends on file order and row count."""
    n = df.count()                                                   # file footers
    return row_positions(df, "_pm_at").withColumn(name, place_of("_pm_at", n, seed)).drop("_pm_at") if n else df.withColumn(name, F.lit(None).cast("long"))


def permuted_prefix(df: DataFrame, k: int, seed: int, name: str = "place") -> DataFrame:
    """The first ``k`` rows of the shuffled order (all rows if there are fewer)."""
    return permuted(df, seed, name).where(F.col(name) < k)
