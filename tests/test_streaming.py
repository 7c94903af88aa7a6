import pytest
from pyspark.sql import functions as F

from corpusloom.operators.instruct import instruct_records
from corpusloom.sources.fixtures import alpaca_from_documents
from corpusloom.plans import misc_queries as Q
from corpusloom.streaming.records import DOCUMENTS_SCHEMA, stream_distinct_records


def test_stateful_dedup_across_restarts(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    src, sink, ckpt = str(tmp_path / "src"), str(tmp_path / "sink"), str(tmp_path / "ckpt")
    docs.where(F.col("doc_id") < 100).coalesce(1).write.parquet(src + "/a")
    q = stream_distinct_records(spark, src + "/a", sink, ckpt, file_glob="*.parquet")
    q.awaitTermination()
    first = spark.read.parquet(sink).count()
    # a second file overlapping the first: only unseen keys may be emitted
    docs.coalesce(1).write.mode("append").parquet(src + "/a")
    stream_distinct_records(spark, src + "/a", sink, ckpt, file_glob="*.parquet").awaitTermination()
    out = spark.read.parquet(sink)
    want = instruct_records(alpaca_from_documents(docs)).select("dup_key").distinct().count()
    assert out.count() == want and out.select("dup_key").distinct().count() == want and first < want


@pytest.mark.parametrize("rows", [6, 0])
def test_streams_read_tables_of_one_and_of_several_files(spark, tmp_path, rows):
    texts = ["do this\nwith that\nand so", "do this\nwith that\nand so", None, "", "one line", "a b\nc d"][:rows]
    docs = spark.createDataFrame([(k + 1, t, "en", "src0", 1) for k, t in enumerate(texts)], DOCUMENTS_SCHEMA)
    docs.repartition(3).write.parquet(str(tmp_path / "folder/documents.parquet"))
    docs.coalesce(1).write.parquet(str(tmp_path / "written"))
    (tmp_path / "file").mkdir()
    next((tmp_path / "written").glob("part-*")).rename(tmp_path / "file/documents.parquet")
    for kind in ("folder", "file"):
        out = sorted(tuple(r) for r in Q.stream_alpaca_records(spark, str(tmp_path / kind)).select("source_index", "has_input").collect())
        assert out == ([(1, False), (2, False), (6, False)] if rows else []), kind
        keys = [r[0] for r in Q.stream_distinct_keys(spark, str(tmp_path / kind)).collect()]
        assert len(keys) == len(set(keys)) == (2 if rows else 0), kind
