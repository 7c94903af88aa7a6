"""Positions of rows in files: independent of splits, blank lines, files and folders."""

import json

import pytest

from corpusloom.sources import positions as P


def write(tmp_path, names, n):
    """``n`` JSON lines and some blank ones dealt over files; returns the values in file order."""
    rows, k = [], 0
    for name in names:
        out = []
        for _ in range(n // len(names)):
            if k % 5 == 2:
                out.append(["", " \t", " "][k % 3])
            out.append(json.dumps({"v": k, "t": "é" * (k % 40)}, ensure_ascii=False))
            rows.append(k)
            k += 1
        (tmp_path / name).write_text("\n".join(out) + "\n", encoding="utf-8")
    return rows


@pytest.mark.parametrize("split_bytes", [300, 1 << 27])
def test_positions_do_not_depend_on_splits(spark, tmp_path, split_bytes):
    rows = write(tmp_path, ["part-00009.json", "part-00010.json", "part-100000.json"], 300)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        read = lambda n: sorted((r["position"], r["v"]) for r in P.read_jsonl_positions(spark, str(tmp_path), "v int, t string", n).collect())
        splits = P.lines(spark, str(tmp_path)).select("_ps_file", "_ps_split").distinct().count()
        assert splits > 40 if split_bytes == 300 else splits == 3
        assert read(None) == list(enumerate(rows))
        for n in (1, 2, 99, 100, 101, 299, 300, 1000):
            assert read(n) == list(enumerate(rows))[:n]
        assert read(0) == read(-1) == [(0, 0)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_cap_of_zero_stops_at_a_blank_first_line(spark, tmp_path):
    (tmp_path / "a.json").write_text('\n{"v": 1}\n')
    assert P.first_lines(spark, str(tmp_path), 0).collect() == []
    assert [r["line"] for r in P.first_lines(spark, str(tmp_path), 1).collect()] == ['{"v": 1}']


def test_rows_of_parquet_files(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(0, 1000, numPartitions=7).selectExpr("id AS v", "'x' AS position").write.option("maxRecordsPerFile", 60).parquet(path)
    df = P.row_positions(spark.read.parquet(path), "n")
    assert [r["v"] for r in df.orderBy("n").collect()] == list(range(1000))
    assert sorted(r["n"] for r in df.collect()) == list(range(1000))
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    assert P.row_positions(spark.read.parquet(path).where("v < 0"), "n").collect() == []


def test_zip_goes_as_far_as_the_shorter_side(spark, tmp_path):
    left = spark.createDataFrame([(k, f"l{k}") for k in range(5)], "position long, a string")
    right = spark.createDataFrame([(k, f"r{k}") for k in range(3)], "position long, b string")
    assert sorted((r["a"], r["b"]) for r in P.positional_zip(left, right).collect()) == [("l0", "r0"), ("l1", "r1"), ("l2", "r2")]
    with pytest.raises(ValueError, match="both sides"):
        P.positional_zip(left, left)


def test_malformed_lines_and_default_ids(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "x"}\n\n{"id": null}\n{"other": 1}\n{"id": 7}\n')
    rows = P.with_default_id(P.read_jsonl_positions(spark, str(tmp_path), "id string"))
    assert [r["id"] for r in rows.orderBy("position").collect()] == ["x", "row_1", "row_2", "7"]
    (tmp_path / "b.json").write_text("{broken\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        P.read_jsonl_positions(spark, str(tmp_path), "id string").collect()
