"""Places of a shuffled order: permutations of every size, prefixes, seeds."""

from pyspark.sql import functions as F

from corpusloom.operators import permute as P


def plain_place(x, n, seed):
    def network(x):
        l, r = P.widths(n)
        for key in P.round_keys(seed):
            low, high = x % 2 ** r, x // 2 ** r
            x = low * 2 ** l + (high ^ ((low ^ key) * P.MULTIPLIER % P.MODULUS)) % 2 ** l
            l, r = r, l
        return x
    x = network(x)
    while x >= n:
        x = network(x)
    return x


def test_every_size_is_permuted(spark):
    for n in [1, 2, 3, 4, 5, 7, 8, 9, 64, 65, 1000]:
        for seed in (0, 42):
            got = [r[0] for r in spark.range(n).orderBy("id").select(P.place_of("id", n, seed)).collect()]
            assert sorted(got) == list(range(n)), n
            assert got == [plain_place(x, n, seed) for x in range(n)]


def test_large_domains_and_spread(spark):
    n = 10 ** 12 + 39
    at = [0, 1, 2, n - 1, n // 2, 123456789012]
    got = [r[0] for r in spark.createDataFrame([(k, x) for k, x in enumerate(at)], "k int, x long").orderBy("k").select(P.place_of("x", n, 7)).collect()]
    assert got == [plain_place(x, n, 7) for x in at]
    places = [r[0] for r in spark.range(4000).orderBy("id").select(P.place_of("id", 4000, 7)).collect()]
    for lo in range(0, 4000, 500):                              # a tenth of any run of rows falls in the first tenth
        assert 20 <= sum(p < 400 for p in places[lo:lo + 500]) <= 85


def test_prefix_of_files(spark, tmp_path):
    spark.createDataFrame([(k % 50, "same") for k in range(300)], "v int, place string").repartition(5).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    for k in (0, 1, 77, 300, 999):
        assert sorted(r["place"] for r in P.permuted_prefix(t, k, 3).collect()) == list(range(min(k, 300)))
    assert P.permuted(t, 3).select("v").exceptAll(t.select("v")).count() == 0
    spark.createDataFrame([], "v int").write.parquet(str(tmp_path / "none"))
    assert P.permuted_prefix(spark.read.parquet(str(tmp_path / "none")), 5, 3).collect() == []
    plan = P.permuted(t, 3)._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_ordered_files_grow_with_the_table(spark, tmp_path):
    """Written in order by as many tasks as the table has splits, not by a fixed few; repeated and null keys stay."""
    from corpusloom.plans import file_queries as Q
    rows = [(k % 900 if k % 300 else None, f"text {k}") for k in range(1000)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(12).write.parquet(str(tmp_path / "t"))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        ordered = Q.in_order(spark.read.parquet(str(tmp_path / "t")), "doc_id", 4)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    parts = [[r["doc_id"] for r in p] for p in ordered.rdd.glom().collect()]
    assert len(parts) >= 12 and max(map(len, parts)) < 250
    assert [k for p in parts for k in p] == sorted((k for k, _ in rows), key=lambda k: -1 if k is None else k)
    assert Q.in_order(spark.createDataFrame([(1, "a")], "doc_id long, text string").coalesce(1), "doc_id", 4).count() == 1
