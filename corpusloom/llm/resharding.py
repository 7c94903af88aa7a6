"""Minimum-cost-flow resharding.

Given where rows lie now (``old_shard``) and the capacities of the new shards, a
transport problem between old and new shards gives the bytes to send from each
old to each new shard so that the bytes moved (times an optional cost per pair)
are fewest. It has one node per shard, so it is solved on the driver from one
size per shard; rows never leave Spark.

Rows are grouped into *units* by a hash of their text, so equal texts share a
unit. A unit whose bytes exceed half of a shard is cut by a hash of the row id
into pieces of about ``1 / pieces`` of a shard, which also spreads a text that
holds a large part of all rows (rows that share both text and id stay together).
The unit table has at most ``old_shards * buckets + (pieces + 2) * new_shards``
rows whatever the input size.

Defined cases: a null text has no bytes (size 1) and CRC 0; rows with a null id
are kept and placed like others; repeated rows are placed each; an empty table
gives no rows; other columns of the input pass through ``place`` untouched,
working columns carry a ``_rs_`` prefix.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.session import scratch_path

UNIT = ["_rs_old", "_rs_bucket", "_rs_cut"]
RANGES = 4096                 # parts of the order in which a shard's slots are numbered


def min_cost_flow(sizes: list[int], capacities: list[int], cost=None) -> dict[tuple[int, int], int]:
    """Bytes to place from old shard i into new shard j, moving at least cost.

    ``cost(i, j)`` is the price of a byte sent from i to j; by default 0 when
    the byte stays (i == j) and 1 otherwise. Successive shortest augmenting
    paths on the shard graph; raises when the capacities are too small.
    """
    cost = cost or (lambda i, j: 0 if i == j else 1)
    n, m = len(sizes), len(capacities)
    if sum(sizes) > sum(capacities):
        raise ValueError("the new shards cannot hold the data")
    left, room = list(sizes), list(capacities)
    flow = {(i, j): 0 for i in range(n) for j in range(m)}
    while any(left):
        # label-correcting search from every old shard that still holds bytes
        dist = {("o", i): 0 for i in range(n) if left[i]}
        parent: dict = {}
        queue = deque(dist)
        while queue:
            kind, k = u = queue.popleft()
            if kind == "o":
                steps = [(("n", j), cost(k, j)) for j in range(m)]
            else:
                steps = [(("o", i), -cost(i, k)) for i in range(n) if flow[i, k]]
            for v, c in steps:
                if v not in dist or dist[u] + c < dist[v]:
                    dist[v], parent[v] = dist[u] + c, u
                    queue.append(v)
        end = min((("n", j) for j in range(m) if room[j]), key=lambda v: (dist[v], v[1]))
        path = [end]
        while path[-1] in parent:
            path.append(parent[path[-1]])
        path.reverse()
        amount = min(left[path[0][1]], room[end[1]])
        for a, b in zip(path, path[1:]):
            if a[0] == "n":                       # undo part of an earlier choice
                amount = min(amount, flow[b[1], a[1]])
        for a, b in zip(path, path[1:]):
            if a[0] == "o":
                flow[a[1], b[1]] += amount
            else:
                flow[b[1], a[1]] -= amount
        left[path[0][1]] -= amount
        room[end[1]] -= amount
    return {k: v for k, v in flow.items() if v}


def _with_units(df: DataFrame, text: str, old_shard: Column, buckets: int) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return (df.withColumn("_rs_size", (F.octet_length(body) + 1).cast("long"))
              .withColumn("_rs_crc", F.crc32(body.cast("binary")))
              .withColumn("_rs_old", old_shard.cast("int"))
              .withColumn("_rs_bucket", F.pmod(F.shiftright(F.xxhash64(body), 20), F.lit(buckets)).cast("int")))


def text_hash_shard(text: str, shards: int) -> Column:
    """The layout before resharding in the catalogue query: text hash modulo shards."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(shards))


def plan_units(units: DataFrame, old_shards: int, new_shards: int, cost=None) -> DataFrame:
    """New shard and first slot of every unit ``(UNIT, bytes, rows)``.

    Within an old shard the large units come first, so they stay where they are
    and the cuts between destinations fall on small units.
    """
    spark = units.sparkSession
    per_shard = {r["_rs_old"]: r["b"] for r in units.groupBy("_rs_old").agg(F.sum("bytes").alias("b")).collect()}
    sizes = [per_shard.get(i, 0) for i in range(old_shards)]
    total = sum(sizes)
    capacities = [total // new_shards + (j < total % new_shards) for j in range(new_shards)]
    flow = min_cost_flow(sizes, capacities, cost)
    spans = []
    for i in range(old_shards):
        at = 0
        for j in sorted((j for a, j in flow if a == i), key=lambda j: (j != i, j)):
            spans.append((i, j, at, at + flow[i, j]))
            at += flow[i, j]
    spans = spark.createDataFrame(spans or [(0, 0, 0, 0)], "_rs_old int, shard int, lo long, hi long")
    before = Window.partitionBy("_rs_old").orderBy(F.col("bytes").desc(), "_rs_bucket", "_rs_cut")
    middles = units.withColumn("mid", F.sum("bytes").over(before) - F.col("bytes") / 2)
    placed = (middles.join(F.broadcast(spans), "_rs_old")      # at most old_shards * new_shards spans
              .where((F.col("mid") >= F.col("lo")) & (F.col("mid") < F.col("hi")))
              .select(*UNIT, "rows", "shard"))
    first = Window.partitionBy("shard").orderBy(*UNIT)
    return (placed.withColumn("_rs_first", F.sum("rows").over(first) - F.col("rows"))
            .select(*UNIT, "shard", "_rs_first"))


def place(df: DataFrame, text: str = "text", row_id: str = "doc_id", new_shards: int = 16, old_shards: int = 12,
          old_shard: Column | None = None, buckets: int = 1024, pieces: int = 64, cost=None) -> DataFrame:
    """``df`` with ``_rs_bytes, _rs_crc, _rs_old, _rs_shard, _rs_slot``.

    The slot numbers the rows of a new shard from 0 without gaps. Two narrow
    shuffles on the unit key; the text itself is read but not moved unless the
    caller keeps it in ``df``.
    """
    old = old_shard if old_shard is not None else text_hash_shard(text, old_shards)
    rows = _located(_with_units(df, text, old, buckets), row_id, new_shards, old_shards, pieces, cost)
    within = Window.partitionBy(*UNIT).orderBy(F.col(row_id), F.col("_rs_size"), F.col("_rs_crc"))
    own = df.columns
    return (rows.withColumn("_rs_slot", F.col("_rs_first") + F.row_number().over(within) - 1)
            .select(*[F.col(f"`{c}`") for c in own], F.col("_rs_size").alias("_rs_bytes"), "_rs_crc", "_rs_old",
                    "_rs_shard", "_rs_slot"))


def _cut(rows: DataFrame, row_id: str, new_shards: int, pieces: int) -> DataFrame:
    """Adds ``_rs_cut``: the piece of a row's unit, 0 in units up to half a shard."""
    whole = rows.groupBy("_rs_old", "_rs_bucket").agg(F.sum("_rs_size").alias("bytes")).checkpoint()
    shard = max(1, (whole.agg(F.sum("bytes")).first()[0] or 0) // new_shards)
    large = (whole.where(F.col("bytes") > max(1, shard // 2))     # fewer than 2 * new_shards + 1 units, except in tiny tables
             .select("_rs_old", "_rs_bucket", F.ceil(F.col("bytes") * pieces / shard).alias("_rs_pieces")))
    return (rows.join(F.broadcast(large), ["_rs_old", "_rs_bucket"], "left")
            .withColumn("_rs_cut", F.pmod(F.xxhash64(F.col(row_id)), F.coalesce("_rs_pieces", F.lit(1))).cast("int"))
            .drop("_rs_pieces"))


def _located(rows: DataFrame, row_id: str, new_shards: int, old_shards: int, pieces: int, cost) -> DataFrame:
    """Rows of ``_with_units`` with ``_rs_shard`` and the first slot of their unit."""
    rows = _cut(rows, row_id, new_shards, pieces)
    units = (rows.groupBy(*UNIT).agg(F.sum("_rs_size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
             .checkpoint())                                      # bounded table, read several times
    plan = plan_units(units, old_shards, new_shards, cost)
    return rows.join(plan.withColumnsRenamed({"shard": "_rs_shard"}), UNIT)


def _slots_in_order(rows: DataFrame, order: list[str], row_id: str) -> DataFrame:
    """Adds ``_rs_slot``: the row's number in its shard by ``order``, whose first column
    is a number from 0. Each of ``RANGES`` parts of that number is ranked on its own
    and shifted by the sizes of the parts before it."""
    top = rows.agg(F.max(order[0])).first()[0] or 0
    parts = rows.withColumn("_rs_range", F.floor(F.col(order[0]) * RANGES / (top + 1)))
    group = ["_rs_shard", "_rs_range"]
    before = Window.partitionBy("_rs_shard").orderBy("_rs_range")
    offsets = (parts.groupBy(*group).agg(F.count(F.lit(1)).alias("_rs_n"))
               .withColumn("_rs_before", F.sum("_rs_n").over(before) - F.col("_rs_n")).drop("_rs_n"))
    within = Window.partitionBy(*group).orderBy(*order, F.col(row_id), "_rs_size", "_rs_crc")
    return (parts.withColumn("_rs_rank", F.row_number().over(within)).join(offsets, group)
            .withColumn("_rs_slot", F.col("_rs_before") + F.col("_rs_rank") - 1))


def ordered_assignments(df: DataFrame, arrange, order: list[str], keep: list[str], text: str = "text", row_id: str = "doc_id",
                        new_shards: int = 16, old_shards: int = 12, buckets: int = 1024, pieces: int = 64, cost=None) -> DataFrame:
    """``assignments`` whose slots follow, inside every shard, the columns ``order``.

    ``arrange`` adds them to narrow rows (``row_id``, the columns ``keep``, ``_rs_size``
    and ``_rs_crc``). These rows and its result are written, so that the texts are read
    once and every pass sees one order.
    """
    spark = df.sparkSession
    rows = _with_units(df, text, text_hash_shard(text, old_shards), buckets)
    path = scratch_path(spark, "ordered")
    rows.select(row_id, *keep, "_rs_size", "_rs_crc", "_rs_old", "_rs_bucket").write.parquet(f"{path}/rows")
    arrange(spark.read.parquet(f"{path}/rows")).write.parquet(f"{path}/arranged")
    rows = _located(spark.read.parquet(f"{path}/arranged"), row_id, new_shards, old_shards, pieces, cost)
    return _narrow(_slots_in_order(rows, order, row_id).withColumnsRenamed({"_rs_size": "_rs_bytes"}), row_id)


def assignments(df: DataFrame, text: str = "text", row_id: str = "doc_id", **kw) -> DataFrame:
    """One narrow row per input row: ``(row_id, size, text_crc32, old_shard, shard, slot)``."""
    spare = df.select(F.col(row_id), F.col(text))
    old = kw.pop("old_shard", None)
    if old is not None:
        spare = df.select(F.col(row_id), F.col(text), old.alias("_rs_given"))
        old = F.col("_rs_given")
    out = place(spare, text, row_id, old_shard=old, **kw)
    return _narrow(out, row_id)


def _narrow(out: DataFrame, row_id: str) -> DataFrame:
    return out.select(F.col(row_id), F.col("_rs_bytes").alias("size"), F.col("_rs_crc").cast("long").alias("text_crc32"),
                      F.col("_rs_old").alias("old_shard"), F.col("_rs_shard").cast("int").alias("shard"),
                      F.col("_rs_slot").cast("long").alias("slot"))


def rewrite_affected(spark: SparkSession, df: DataFrame, path: str, **kw) -> list[int]:
    """Write the rows of every shard whose contents change under ``path/shard=N``.

    A shard is left alone when no row enters or leaves it. Returns the shards
    written (a list of at most ``new_shards`` numbers). An input column named
    ``shard`` is replaced by the new shard.
    """
    placed = place(df, **kw)
    moved = placed.where(F.col("_rs_old") != F.col("_rs_shard"))
    touched = {x for r in moved.select("_rs_old", "_rs_shard").distinct().collect() for x in r}
    written = sorted(t for t in touched if t < kw.get("new_shards", 16))
    (placed.where(F.col("_rs_shard").isin(written or [-1]))
     .select(*[F.col(f"`{c}`") for c in df.columns if c != "shard"], F.col("_rs_shard").alias("shard"))
     .write.mode("append").partitionBy("shard").parquet(path))
    return written
