import json

import pytest

from corpusloom.plans.file_queries import chat_split
from corpusloom.sources.inferred import infer_schema, read_jsonl_inferred, widened
from corpusloom.sources.jsonl import read_task_files, write_task_files

SF = "/root/testdata/sf0.001"


def lines(tmp_path, *texts):
    p = tmp_path / "lines.jsonl"
    p.write_text("\n".join(t if isinstance(t, str) else json.dumps(t) for t in texts) + "\n", encoding="utf-8")
    return str(p)


def test_names_are_not_taken_for_types():
    merged = "OBJECT<VOID: VOID, VARIANT: VARIANT, `a: VOID, b`: DECIMAL(3,1), e: ARRAY<OBJECT<>>, o: OBJECT<OBJECT: BIGINT>>"
    assert widened(merged) == "STRUCT<VOID: STRING, VARIANT: STRING, `a: VOID, b`: DOUBLE, e: ARRAY<STRING>, o: STRUCT<OBJECT: BIGINT>>"


def test_clashing_and_missing_fields(spark, tmp_path):
    path = lines(tmp_path, {"a": 1, "gone": None, "t": ["x"], "m": {"l": "en", "e": {}}}, "", {"a": "q", "n": 1.5, "t": None, "my f": [1, "b", {"z": 2}]},
                 {"a": {"k": [1, 2.5]}, "n": 3, "b": True, "m": {"l": "de", "more": 1}}, {})
    df = read_jsonl_inferred(spark, path)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    assert kinds == {"a": "string", "b": "boolean", "gone": "string", "m": "struct<e:string,l:string,more:bigint>", "my f": "array<string>",
                     "n": "double", "t": "array<string>"}
    rows = df.collect()
    assert [r["a"] for r in rows] == ["1", "q", '{"k": [1, 2.5]}', None]
    assert [r["n"] for r in rows] == [None, 1.5, 3.0, None]
    assert rows[1]["my f"] == ["1", "b", '{"z": 2}'] and rows[0]["t"] == ["x"]
    assert [r["m"] and r["m"]["l"] for r in rows] == ["en", None, "de", None]


def test_malformed_lines_and_files_without_records(spark, tmp_path):
    path = lines(tmp_path, {"a": 1}, '{"a": 2')
    assert infer_schema(spark, path).simpleString() == "struct<a:bigint>"
    with pytest.raises(Exception, match="(?i)malformed"):
        read_jsonl_inferred(spark, path).collect()
    assert len(read_jsonl_inferred(spark, path, "DROPMALFORMED").collect()) == 1
    for texts in (("", " "), ("[1, 2]",), ("{}",)):
        with pytest.raises(ValueError):
            infer_schema(spark, lines(tmp_path, *texts))


def test_split_scan_opens_one_folder_and_reads_roles_alone(spark):
    plan = chat_split(spark, SF)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    assert "split" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<source_index:bigint,messages:array<struct<role:string>>>" in scan


def test_manifest_counts_what_was_written(spark, tmp_path):
    schema = "id string, task string"
    runs = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame([(f"a\n{i} \r", "x" if i % 3 else "y") for i in range(30)], schema)
    seen = df.mapInPandas(lambda it: (runs.add(len(b)) or b for b in it), schema)
    manifest = write_task_files(spark, seen, str(tmp_path / "out"))
    assert sorted((r["name"], r["rows"]) for r in manifest.collect()) == [("x", 20), ("y", 10)]
    assert runs.value == 30                                                       # the corpus was computed once
    assert sorted(r[0] for r in read_task_files(spark, manifest, "id string").select("id").collect()) == sorted(r[0] for r in df.collect())


def test_failed_run_leaves_the_published_one(spark, tmp_path):
    from pyspark.sql import functions as F

    from corpusloom.sources.jsonl import damaged_task_files, read_manifest
    out, schema = str(tmp_path / "out"), "id string, task string"
    first = spark.createDataFrame([(f"a{i}", "x" if i % 3 else "y") for i in range(30)], schema).repartition(4)
    write_task_files(spark, first, out)
    published = sorted(map(tuple, read_manifest(spark, out).collect()))
    broken = first.withColumn("id", F.when(F.col("id") == "a17", F.raise_error("lost").cast("string")).otherwise(F.concat("id", F.lit("!"))))
    with pytest.raises(Exception, match="lost"):
        write_task_files(spark, broken, out)
    manifest = read_manifest(spark, out)
    assert sorted(map(tuple, manifest.collect())) == published and damaged_task_files(spark, manifest) == []
    back = read_task_files(spark, manifest, "id string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, first.collect()))
    assert back._jdf.queryExecution().toString().count("FileScan json") == 1      # all tasks in one scan
    second = write_task_files(spark, first.where("task = 'y'"), out)
    assert [(r["name"], r["rows"]) for r in second.collect()] == [("y", 10)] and second.first()["run"] > published[0][0]
    assert sorted(map(tuple, read_task_files(spark, manifest, "id string").collect())) == sorted(map(tuple, first.collect()))    # readers of the old run
    assert write_task_files(spark, first.where("false"), out).collect() == []


def test_changed_files_are_found(spark, tmp_path):
    from corpusloom.sources.jsonl import damaged_task_files
    df = spark.createDataFrame([(str(i), t) for i in range(9) for t in "xyz"], "id string, task string").coalesce(1)
    manifest = write_task_files(spark, df, str(tmp_path / "out"))
    folder = tmp_path / "out" / "tasks" / f"run={manifest.first()['run']}"
    part = next((folder / "task=y").glob("part-*"))
    part.with_name("part-changed.json").write_text(part.read_text().replace('"3"', '"4"'))
    part.write_text("")
    for crc in (folder / "task=y").glob(".*.crc"):
        crc.unlink()
    assert damaged_task_files(spark, manifest) == ["y"]
