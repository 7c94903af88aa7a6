"""Record ids, dedup keys and the seeded row order.

Row positions and RNG permutations do not exist in a distributed table, so
a permutation is a sort by ``sha1(seed:stage:stable_key)``: deterministic,
independent of partitioning and input order, and reproducible in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import col_

SEP = "|||"


def sha1_join(*parts) -> Column:
    """sha1 of the parts joined by ``|||`` (parts must be non-null)."""
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(SEP))
        pieces.append(col_(p).cast("string"))
    return F.sha1(F.concat(*pieces))


def order_key(seed: int, stage: str, *keys) -> Column:
    """Seeded pseudo-random sort key of a row (40 hex chars)."""
    pieces = [F.lit(f"{seed}:{stage}")]
    for k in keys:
        pieces += [F.lit(":"), col_(k).cast("string")]
    return F.sha1(F.concat(*pieces))


def with_sub_order(key, sub) -> Column:
    """Append a small non-negative sub-position to an order key (keeps string order)."""
    return F.concat(col_(key), F.lit(":"), F.lpad(col_(sub).cast("string"), 6, "0"))
