"""Results do not depend on partitioning or input order."""

from pyspark.sql import functions as F

from corpusloom.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_selection_invariant_to_shuffle_partitions(spark):
    base = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for p in ("1", "4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", p)
            results.append([_rows(QUERIES[q](spark, SF)) for q in ("sft_sample_v2", "calib_sample_v1", "mc_subsample")])
        assert results[0] == results[1] == results[2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", base)


def test_quota_sample_invariant_to_input_order(spark):
    from corpusloom.operators.sample import quota_sample
    rows = [(f"{i * 7919 % 1000:04d}", f"k{i % 37}", ["short", "mid", "long"][i % 3]) for i in range(600)]
    df = spark.createDataFrame(rows, "ord string, key string, bucket string")
    q = {"short": 15, "mid": 25, "long": 5}
    a = _rows(quota_sample(df, "key", "bucket", q))
    b = _rows(quota_sample(df.orderBy(F.rand(3)).repartition(7), "key", "bucket", q))
    assert a == b
