"""Pfair mixing of sources to target weights, with DataFrame functions only.

Each source has an integer share; its weight is the share over the sum M of all
shares. Rows of a source are dealt into blocks of ``block_rows`` rows in a seeded
hash order. Block i (from 0) of a source of weight w may take a slot from
floor(i / w) on and must have one before ceil((i + 1) / w). Earliest deadline
first over these windows keeps every source less than one block away from its
exact share at every slot while it still has blocks. The schedule repeats every M
slots, so only one frame of M slots is scheduled (a fold over M elements inside
one expression) and all blocks derive their slot from it.

A source that runs out leaves its later slots empty; no row is dropped or used
twice. Order by ``mix_slot, mix_pos`` to read the mixture.

Defined cases: a null source is a source of its own with the default share; null
or repeated ids are ordered by their hash and stay; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def frame_schedule(shares: DataFrame) -> DataFrame:
    """``(source, share, total, nth, slot_in_frame)`` for one frame of M slots.

    ``shares`` has ``(source, share)``, one row per source. It is gathered in one
    row, as is the frame: both are bounded by the number of sources and by M.
    """
    one = (shares.groupBy().agg(F.array_sort(F.collect_list(F.struct("source", "share"))).alias("src"))
           .withColumn("total", F.aggregate("src", F.lit(0), lambda a, s: a + s["share"])))
    m = F.col("total")
    released = lambda done, i, t: F.floor(F.get(done, i) * m / F.get(F.col("src"), i)["share"]) <= t
    deadline = lambda done, i: F.ceil((F.get(done, i) + 1) * m / F.get(F.col("src"), i)["share"])

    def step(acc: Column, t: Column) -> Column:
        done = acc["done"]
        ready = F.filter(F.transform(F.col("src"), lambda s, i: F.struct(
            deadline(done, i).cast("long").alias("deadline"), i.alias("i"), F.get(done, i).alias("nth"),
            (released(done, i, t) & (F.get(done, i) < s["share"])).alias("ok"))), lambda c: c["ok"])
        pick = F.array_min(ready)
        return F.struct(F.transform(done, lambda d, i: d + F.when(i == pick["i"], 1).otherwise(0)).alias("done"),
                        F.concat(acc["out"], F.array(F.struct(pick["i"].alias("i"), pick["nth"].alias("nth"),
                                                              t.alias("slot_in_frame")))).alias("out"))

    start = F.struct(F.transform("src", lambda s: F.lit(0)).alias("done"),
                     F.array().cast("array<struct<i:int,nth:int,slot_in_frame:int>>").alias("out"))
    folded = one.where(m > 0).select("src", "total", F.aggregate(F.sequence(F.lit(0), m - 1), start, step)["out"].alias("out"))
    cell = folded.select("src", "total", F.explode("out").alias("c"))
    own = F.get(F.col("src"), F.col("c.i"))
    return cell.select(own["source"].alias("source"), own["share"].alias("share"), "total",
                       F.col("c.nth").alias("nth"), F.col("c.slot_in_frame").alias("slot_in_frame"))


def _numbered(df: DataFrame, row_id: str, source: str, seed: str, ties: tuple = ()) -> DataFrame:
    """Adds ``_mx_seq``: the row's number in its source by seeded hash, from 0.

    Numbers come from 4,096 hash ranges per source, each ranked on its own and
    shifted by the sizes of the ranges before it, so a source that holds a third
    of all rows is spread over 4,096 groups.
    """
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(row_id).cast("string"), F.lit(""))))
    d = df.withColumn("_mx_key", key).withColumn("_mx_range", F.substring("_mx_key", 1, 3))
    group = ["_mx_source", "_mx_range"]
    d = d.withColumn("_mx_source", F.coalesce(F.col(source), F.lit("\x00")))
    before = Window.partitionBy("_mx_source").orderBy("_mx_range")
    offsets = (d.groupBy(*group).agg(F.count(F.lit(1)).alias("_mx_n"))
               .withColumn("_mx_before", F.sum("_mx_n").over(before) - F.col("_mx_n")).drop("_mx_n"))
    ranked = d.withColumn("_mx_rank", F.row_number().over(
        Window.partitionBy(*group).orderBy("_mx_key", F.col(row_id), *ties)))
    return ranked.join(offsets, group).withColumn("_mx_seq", F.col("_mx_before") + F.col("_mx_rank") - 1)


def mix(df: DataFrame, row_id: str = "doc_id", source: str = "source", shares: dict[str, int] | None = None,
        default_share: int = 1, block_rows: int = 32, seed: str = "mix", prefix: str = "mix_",
        ties: tuple = ()) -> DataFrame:
    """``df`` plus ``block, pos, release, deadline, slot``, each with ``prefix``
    (input columns of these names are replaced). ``ties`` are columns that order
    rows of one id."""
    spark = df.sparkSession
    found = df.select(F.coalesce(F.col(source), F.lit("\x00")).alias("source")).distinct()
    given = spark.createDataFrame([(str(k), int(v)) for k, v in (shares or {}).items()] or [("", default_share)],
                                  "source string, given int")
    share = found.join(F.broadcast(given), "source", "left").select(
        "source", F.coalesce("given", F.lit(default_share)).cast("int").alias("share"))
    frame = frame_schedule(share).withColumnsRenamed({"source": "_mx_source", "nth": "_mx_nth", "share": "_mx_share",
                                                      "total": "_mx_total", "slot_in_frame": "_mx_at"})
    d = _numbered(df, row_id, source, seed, ties)
    d = d.withColumn("_mx_block", F.floor(F.col("_mx_seq") / block_rows))
    per = share.withColumnsRenamed({"source": "_mx_source", "share": "_mx_a"})
    d = d.join(F.broadcast(per), "_mx_source").withColumn("_mx_nth", (F.col("_mx_block") % F.col("_mx_a")).cast("int"))
    d = d.join(F.broadcast(frame), ["_mx_source", "_mx_nth"])    # M rows: the sum of the shares
    base = F.floor(F.col("_mx_block") / F.col("_mx_a")) * F.col("_mx_total")
    n, a, m = F.col("_mx_nth"), F.col("_mx_a"), F.col("_mx_total")
    added = {"block": F.col("_mx_block").cast("long"), "pos": (F.col("_mx_seq") % block_rows).cast("int"),
             "release": (base + F.floor(n * m / a)).cast("long"), "deadline": (base + F.ceil((n + 1) * m / a)).cast("long"),
             "slot": (base + F.col("_mx_at")).cast("long")}
    return d.select(*[F.col(f"`{c}`") for c in df.columns if c not in {prefix + k for k in added}],
                    *[v.alias(prefix + k) for k, v in added.items()])
