"""Running history on a flat turns table: what stands before each turn.

Unlike the chat records, which cut a conversation to its last messages first, every
turn of a conversation of any length sees the ``window`` messages before it. No array
per conversation is built: conversations are cut into ranges of turn numbers, and a
range gets the last messages before it from a table of one short list per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def turn_history(turns: DataFrame, window: int, range_turns: int = 4096) -> DataFrame:
    """``(source_index, turn, role, content)`` -> the same rows with ``history`` (up to
    ``window`` messages before the row, in order), and ``has_user`` (a user message stands
    anywhere before it).

    Turns of one number are ordered by role and text; repeated turns all count; a null turn
    number comes first. Rows are shuffled once by (conversation, range), so a conversation
    with a third of all turns is spread over its ranges; what is handled per conversation is
    one list of ``window`` messages per range of ``range_turns`` numbers. The result does
    not depend on ``range_turns``.
    """
    key = ["source_index", "_range"]
    rows = turns.select("source_index", F.floor(F.col("turn") / range_turns).alias("_range"),
                        F.struct("turn", "role", "content").alias("_m"))
    user = F.coalesce(F.col("_m.role") == "user", F.lit(False))

    latest = Window.partitionBy(*key).orderBy(F.col("_m").desc())          # partial limit below the shuffle
    tails = (rows.withColumn("_r", F.row_number().over(latest)).where(F.col("_r") <= window)
             .select(*key, "_m", F.lit(False).alias("_u")))
    users = rows.groupBy(*key).agg(F.max(user).alias("_u")).select(*key, F.lit(None).alias("_m"), "_u")
    ranges = (tails.unionByName(users).groupBy(*key)
              .agg(F.array_sort(F.collect_list("_m")).alias("_tail"), F.max("_u").alias("_u")))

    before = Window.partitionBy("source_index").orderBy("_range")
    lists = F.flatten(F.collect_list("_tail").over(before.rowsBetween(-window, -1)))     # a range has a row at least
    carried = ranges.select(*key, lists.alias("_l"), F.max("_u").over(before.rowsBetween(Window.unboundedPreceding, -1)).alias("_u"))
    last = F.when(F.size("_l") > window, F.slice("_l", -window, window)).otherwise(F.col("_l"))
    carried = carried.select(*key, F.explode(last).alias("_m"), "_u", F.lit(True).alias("_carried"))

    ordered = Window.partitionBy(*key).orderBy("_m")
    message = F.struct(F.col("_m.role").alias("role"), F.col("_m.content").alias("content"))
    return (rows.select(*key, "_m", user.alias("_u"), F.lit(False).alias("_carried")).unionByName(carried)
            .withColumn("history", F.collect_list(message).over(ordered.rowsBetween(-window, -1)))
            .withColumn("has_user", F.coalesce(F.max("_u").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)))
            .where(~F.col("_carried"))
            .select("source_index", "_m.turn", "_m.role", "_m.content", "history", "has_user"))
