"""Profiles: length percentiles, bucket counts, reject counts, N:M sparsity audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_PS = (0.50, 0.90, 0.95)


def length_summary(df: DataFrame, group: str, metrics: list[str], ps=DEFAULT_PS) -> DataFrame:
    """Per group and metric: ``n``, the 0-based floor-rank percentiles
    ``sorted[min(n-1, int(n*p))]`` and the max.

    Exact and distributed: a histogram ``(group, metric, value) -> count`` is
    aggregated with partial (map-side) combine; the percentile walk is a
    running sum over that histogram, whose size is the number of distinct
    lengths, not the number of rows.
    """
    # one pass over the input, whatever the number of metrics
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("int").alias("v")) for m in metrics])
    long = df.select(F.col(group).alias("group"), F.explode(cells).alias("x")).select("group", "x.metric", "x.v")
    hist = long.groupBy("group", "metric", "v").agg(F.count("*").alias("c"))
    w = Window.partitionBy("group", "metric")
    h = (hist.withColumn("cum", F.sum("c").over(w.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("n", F.sum("c").over(w)))
    aggs = [F.first("n").alias("n")]
    for p in ps:
        rank = F.least(F.col("n") - 1, F.floor(F.col("n") * F.lit(float(p))))
        aggs.append(F.min(F.when(F.col("cum") > rank, F.col("v"))).alias(f"p{int(round(p * 100))}"))
    aggs.append(F.max("v").alias("max"))
    return h.groupBy("group", "metric").agg(*aggs).withColumn("n", F.col("n").cast("long"))


def bucket_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def nm_ok_groups(values, n: int = 2, m: int = 4):
    """(groups with exactly ``n`` non-zeros of ``m``, number of groups) for one array row."""
    v = F.col(values) if isinstance(values, str) else values
    g = F.floor(F.size(v) / m).cast("int")
    counts = F.transform(
        F.when(g > 0, F.sequence(F.lit(0), g - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.aggregate(F.slice(v, i * m + 1, m), F.lit(0), lambda a, x: a + F.when(x != 0, 1).otherwise(0)))
    ok = F.size(F.filter(counts, lambda c: c == n))
    return ok, g


def nm_sparsity(weights: DataFrame, tensor: str = "tensor", values: str = "values",
                n: int = 2, m: int = 4) -> DataFrame:
    """Per tensor: share of consecutive m-groups (per row) with exactly n non-zeros."""
    ok, g = nm_ok_groups(values, n, m)
    per_row = weights.select(tensor, ok.alias("ok"), g.alias("groups"))
    return (per_row.groupBy(tensor)
            .agg(F.sum("ok").cast("long").alias("ok_groups"), F.sum("groups").cast("long").alias("groups"))
            .withColumn("ratio", F.when(F.col("groups") > 0, F.col("ok_groups") / F.col("groups"))
                        .otherwise(F.lit(0.0))))


def target_tensors(audit: DataFrame, targets, ignore, tensor: str = "tensor") -> DataFrame:
    """Tensors whose name ends with a target projection and not with an ignored one."""
    t = F.col(tensor)
    hit = F.lit(False)
    for s in targets:
        hit = hit | t.endswith(s)
    for s in ignore:
        hit = hit & ~t.endswith(s)
    return audit.where(hit)


def nm_sparsity_sample(audit: DataFrame, k: int, seed: int = 0, tensor: str = "tensor") -> DataFrame:
    """Seeded random ``k`` tensors among those with a positive ratio, plus their mean
    ratio (null when none qualifies)."""
    from corpusloom.functions.ids import order_key
    from corpusloom.operators.sample import take_first_n

    c = audit.where(F.col("ratio") > 0).withColumn("ord", order_key(seed, "layers", tensor))
    picked = take_first_n(c, k, "ord")
    # at most k values: fold them in sorted order so the mean does not depend on
    # the order partial sums arrive in (bit-identical across runs and engines)
    total = F.aggregate(F.array_sort(F.collect_list("ratio")), F.lit(0.0), lambda a, x: a + x)
    mean = picked.agg(F.when(F.count("*") > 0, total / F.count("*")))   # null: nothing qualified
    return picked.withColumn("sample_mean", mean.scalar())
