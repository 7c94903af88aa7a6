"""Selection operators: dedup, first-N, bucketed quotas, splits, subsamples.

The reference walks rows in a shuffled order and keeps Python hash sets. Here
the order is a column (``ord``, see ``functions.ids.order_key``) and every
selection is a window with a rank limit or a TakeOrdered threshold, so no
operator funnels a whole table through one task or the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import scratch_path


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back. Selections
    look at their order values several times; the source is read for them once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def first_per_key(df: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """First row of each ``key`` by ``order`` (a scan with a ``seen`` set).

    ``row_number() = 1`` plans a partial ``WindowGroupLimit`` below the
    shuffle, so a key with millions of copies leaves each map task as one row.
    """
    w = Window.partitionBy(key).orderBy(F.col(order).asc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


#: A block of order values small enough to be read as it is.
SMALL_BLOCK = 4096


def kth_per_group(df: DataFrame, ks: dict, group: str | None = None, order: str = "ord") -> dict:
    """Exact k-th smallest order value of every group with at least k rows.

    ``ks`` maps a group value to its k (one group, named None, without ``group``).
    Counts by order prefix, four more characters each time, narrow every group to a
    block of at most ``SMALL_BLOCK`` values, which is read and sorted. All groups
    share the jobs; the driver reads prefix counts, never more than 65,536 a group.
    """
    g = F.col(group) if group else F.lit(None).cast("string")
    at, left, found = dict.fromkeys(ks, ""), {v: k for v, k in ks.items() if k > 0}, {}
    size: dict = {}
    while left:
        here = F.lit(False)
        for v in left:
            here = here | (g.eqNullSafe(F.lit(v)) & F.col(order).startswith(at[v]))
        rows = df.where(here).select(g.alias("g"), F.col(order).alias("o"))
        small = [v for v in left if size.get(v, SMALL_BLOCK + 1) <= SMALL_BLOCK]
        if len(small) == len(left):
            blocks: dict = {}
            for r in rows.collect():
                blocks.setdefault(r["g"], []).append(r["o"])
            return found | {v: sorted(blocks[v])[k - 1] for v, k in left.items()}
        depth = {v: len(at[v]) + (0 if v in small else 4) for v in left}
        hist: dict = {}
        for r in rows.groupBy("g", F.substring("o", F.lit(1), _depth_of(depth)).alias("p")).agg(F.count("*").alias("c")).collect():
            hist.setdefault(r["g"], []).append((r["p"], r["c"]))
        for v in list(left):
            if v in small:
                continue
            for p, c in sorted(hist.get(v, [])):
                if c >= left[v]:
                    if p == at[v]:                   # equal values to the end: this is the value
                        found[v] = p
                        left.pop(v)
                    at[v], size[v] = p, c
                    break
                left[v] -= c
            else:
                left.pop(v)                          # fewer rows than k
    return found


def _depth_of(depth: dict):
    """Prefix length by group, for the column ``g``."""
    out = F.lit(4)
    for v, n in depth.items():
        out = F.when(F.col("g").eqNullSafe(F.lit(v)), n).otherwise(out)
    return out


def kth_order_value(df: DataFrame, k: int, order: str = "ord"):
    """Exact k-th smallest order value (None when there are fewer rows, '' for k <= 0)."""
    return "" if k <= 0 else kth_per_group(df, {None: k}, None, order).get(None)


def take_first_n(df: DataFrame, n: int, order: str = "ord") -> DataFrame:
    """First ``n`` rows by ``order`` (unique). Keeps all rows when there are fewer.

    The threshold comes from :func:`kth_order_value` over the order column
    only, written once; the wide rows are then filtered by it.
    """
    if n <= 0:
        return df.limit(0)
    t = kth_order_value(kept(df.select(order), "order"), n, order)
    return df if t is None else df.where(F.col(order) <= F.lit(t))


def _semi(df: DataFrame, chosen: DataFrame, order: str) -> DataFrame:
    """Rows of ``df`` whose order value was chosen; adaptive execution picks the join
    from measured sizes. The order value ends in a hash of the record, so rows that
    share one are the same record, which is returned once."""
    return df.join(chosen.select(order), order, "left_semi").dropDuplicates([order])


def first_n_per_key(df: DataFrame, n: int, key: str, order: str = "ord") -> DataFrame:
    """Scan in ``order``, take a row if its ``key`` is new, stop after ``n`` rows: the
    first row of every key, cut at the ``n``-th order value of those."""
    if n <= 0:
        return df.limit(0)
    firsts = first_per_key(df.select(order, key), key, order).select(order)
    last = kth_order_value(firsts, n, order)
    return _semi(df, firsts if last is None else firsts.where(F.col(order) <= F.lit(last)), order)


def take_first_n_per_group(df: DataFrame, group: str, n: int | None, order: str = "ord") -> DataFrame:
    """First ``n`` rows of every group by ``order``; all rows when ``n`` is None.

    ``group`` has few values (tasks). Their thresholds come from a narrow table that is
    written once; the wide rows are filtered, never shuffled. The source is read twice.
    """
    if n is None:
        return df
    if n <= 0:
        return df.limit(0)
    keep = F.lit(True)
    for v, cut in group_cuts(df, group, n, order).items():
        keep = keep & (~F.col(group).eqNullSafe(F.lit(v)) | (F.col(order) <= F.lit(cut)))
    return df.where(keep)


def group_cuts(df: DataFrame, group: str, n: int, order: str = "ord") -> dict:
    """The ``n``-th order value of every group with at least ``n`` rows; one pass over ``df``."""
    narrow = kept(df.select(group, order), "group-order")
    names = [r[0] for r in narrow.select(group).distinct().collect()]
    return kth_per_group(narrow, dict.fromkeys(names, n), group, order)


def _closing_rounds(live: DataFrame, key: str, bucket: str, quotas: dict[str, int], order: str):
    """Condition on ``live`` that keeps the rows a greedy scan may still take."""
    cuts: dict[str, str] = {}
    cond = F.lit(True)
    for _ in range(len(quotas)):
        first = first_per_key(live.where(cond), key, order)
        full = kth_per_group(first.select(bucket, order), {b: q for b, q in quotas.items() if b not in cuts}, bucket, order)
        if not full:
            break
        win = min(full, key=full.get)
        cuts[win] = full[win]
        cond = cond & ~((F.col(bucket) == win) & (F.col(order) > full[win]))
    return cond


def quota_sample(df: DataFrame, key: str, bucket: str, quotas: dict[str, int], order: str = "ord") -> DataFrame:
    """Greedy scan with per-bucket quotas and one shared ``seen`` set, done exactly.

    Greedy rule: walk rows by ``order``; take a row when its bucket is not full
    and its key was not taken before; a key is marked only when taken.

    Closing rounds: until the earliest point at which some bucket fills, the
    greedy scan takes exactly the first row of every key. Find that point
    (per bucket the T-th first-of-key row; the smallest wins), drop the later
    rows of that bucket (they can neither be taken nor mark a key), dedup again.
    Each round closes one bucket, so there are at most ``len(quotas) + 1``
    rounds, each returning one small row per bucket to the driver.
    """
    active = {b: q for b, q in quotas.items() if q > 0}
    if not active:
        return df.limit(0)
    live = df.select(order, key, bucket).where(F.col(bucket).isin(*active))
    cond = _closing_rounds(live, key, bucket, active, order)
    return _semi(df, first_per_key(live.where(cond), key, order), order)


def split_train_eval(df: DataFrame, ratio: float, order: str = "ord") -> DataFrame:
    """Adds ``split`` = 'eval' for the first ``ceil(ratio * n)`` rows by order, else 'train'."""
    if ratio <= 0:
        return df.withColumn("split", F.lit("train"))
    values = kept(df.select(order), "order")
    k = math.ceil(ratio * values.count())
    if k <= 0:
        return df.withColumn("split", F.lit("train"))
    cut = kth_order_value(values, k, order)
    if cut is None:
        return df.withColumn("split", F.lit("eval"))
    return df.withColumn("split", F.when(F.col(order) <= F.lit(cut), F.lit("eval")).otherwise(F.lit("train")))


def global_index(df: DataFrame, order: str = "ord", partitions: int | None = None,
                 name: str = "idx") -> DataFrame:
    """Dense 0-based position of every row by ``order`` without a global window.

    Range-partition and sort by the order, number rows inside each partition,
    then add the row counts of all earlier partitions (one small table of
    partition sizes). The numbered table is checkpointed to the shared
    checkpoint folder so both uses see the same partitioning.
    """
    spark = df.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = (df.repartitionByRange(p, F.col(order)).sortWithinPartitions(order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33)))
    numbered = numbered.checkpoint(eager=True)
    sizes = numbered.groupBy("_pid").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
                           .alias("_off"))
    # one row per partition: a bounded table, safe to broadcast
    return (numbered.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.coalesce(F.col("_off"), F.lit(0)) + F.col("_local"))
            .drop("_pid", "_local", "_off"))


def check_disjoint(a: DataFrame, b: DataFrame, key: str = "id") -> int:
    """Hold-out property: number of ``b`` keys also in ``a`` (a semi join count; 0 expected)."""
    return b.select(key).join(a.select(key), key, "left_semi").count()
