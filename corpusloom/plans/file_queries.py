"""Catalogue: file order (caps, default ids, positional zip), drifting fields and splits over written files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import chat as C
from corpusloom.operators import permute as PM
from corpusloom.plans import sqlkit as Q
from corpusloom.plans.registry import query
from corpusloom.session import scratch_path
from corpusloom.sources import positions as P
from corpusloom.sources import jsonl as J
from corpusloom.sources.fixtures import table
from corpusloom.sources.inferred import read_jsonl_inferred
from corpusloom.sources.tables import read_split

FIRST_N = 300          # a cap that cuts at every test scale


def in_order(rows: DataFrame, order: str, least: int) -> DataFrame:
    """``rows`` in ascending order, in ``least`` ranges or as many as the scan has splits: no
    task takes a larger share as the table grows."""
    return rows.repartitionByRange(max(least, rows.rdd.getNumPartitions()), order).sortWithinPartitions(order)


def write_ordered_lines(rows: DataFrame, order: str, num_files: int, name: str) -> str:
    """``rows (order, lines array)`` as text files in ascending order, at least ``num_files`` of them
    where the rows allow; returns the path."""
    path = scratch_path(rows.sparkSession, name)
    in_order(rows, order, num_files).select(F.explode("lines").alias("value")).write.text(path)
    return path


def document_lines(spark, sf_dir, num_files: int = 6, **fields):
    """A JSON line per document by doc_id; every seventh is followed by a blank line."""
    d = table(spark, sf_dir, "documents")
    line = F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))
    blank = F.when(F.col("doc_id") % 7 == 3, F.array(line, F.lit(" \t"))).otherwise(F.array(line))
    return write_ordered_lines(d.select("doc_id", blank.alias("lines")), "doc_id", num_files, "ordered-lines")


@query("jsonl_first", sql=f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, doc_id, sha1(text) AS text_sha
FROM documents ORDER BY doc_id LIMIT {FIRST_N}""")
def jsonl_first(spark, sf_dir):
    path = document_lines(spark, sf_dir, doc_id=F.col("doc_id"), text=F.col("text"))
    rows = P.read_jsonl_positions(spark, path, "doc_id long, text string", n_max=FIRST_N)
    return rows.select("position", "doc_id", F.sha1("text").alias("text_sha"))


@query("row_default_ids", sql="""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position,
  CASE WHEN doc_id % 3 = 0 THEN 'row_' || (row_number() OVER (ORDER BY doc_id) - 1) ELSE 'doc_' || doc_id END AS id, sha1(text) AS text_sha FROM documents""")
def row_default_ids(spark, sf_dir):
    named = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("doc_"), F.col("doc_id").cast("string")))
    path = document_lines(spark, sf_dir, id=named, text=F.col("text"))
    rows = P.with_default_id(P.read_jsonl_positions(spark, path, "id string, text string"))
    return rows.select("position", "id", F.sha1("text").alias("text_sha"))


@query("positional_zip", sql="""WITH p AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, doc_id, text FROM documents),
o AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, doc_id AS output_id, upper(lang) AS output FROM documents WHERE source <> 'src3')
SELECT position, doc_id, sha1(text) AS text_sha, output_id, output FROM p JOIN o USING (position)""")
def positional_zip(spark, sf_dir):
    """Prompts in JSON lines and outputs in Parquet, written apart and matched by position alone."""
    prompts = P.read_jsonl_positions(spark, document_lines(spark, sf_dir, doc_id=F.col("doc_id"), text=F.col("text")), "doc_id long, text string")
    path = scratch_path(spark, "outputs")
    outputs = table(spark, sf_dir, "documents").where("source <> 'src3'").select(F.col("doc_id").alias("output_id"), F.upper("lang").alias("output"))
    in_order(outputs, "output_id", 4).write.parquet(path)
    pairs = P.positional_zip(prompts, P.row_positions(spark.read.parquet(path)))
    return pairs.select("position", "doc_id", F.sha1("text").alias("text_sha"), "output_id", "output")


PREFIX_SEED = 42
SQL_KEYS = "[" + ", ".join(map(str, PM.round_keys(PREFIX_SEED))) + "]"


@query("permuted_prefix", sql=f"""WITH RECURSIVE p AS (SELECT doc_id, sha1(text) AS text_sha, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents),
size AS (SELECT count(*) AS n, greatest(2, length(bin(count(*) - 1))) AS bits FROM p),
walk AS (
  SELECT doc_id, position AS x, 0 AS r, bits - bits // 2 AS a, bits // 2 AS c, n FROM p, size
  UNION ALL
  SELECT doc_id, (x & ((1::BIGINT << c) - 1)) * (1::BIGINT << a)
    + (xor(x >> c, (xor(x & ((1::BIGINT << c) - 1), ({SQL_KEYS})[r % {PM.ROUNDS} + 1]::BIGINT) * {PM.MULTIPLIER}) % {PM.MODULUS}) & ((1::BIGINT << a) - 1)),
    r + 1, c, a, n FROM walk WHERE r = 0 OR r % {PM.ROUNDS} <> 0 OR x >= n)
SELECT x AS place, doc_id, text_sha FROM walk JOIN p USING (doc_id)
WHERE r > 0 AND r % {PM.ROUNDS} = 0 AND x < n AND x < {FIRST_N}""")
def permuted_prefix(spark, sf_dir):
    """The first rows of a shuffled order of all documents, whose file order is that of their ids."""
    path = scratch_path(spark, "ordered-documents")
    in_order(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", 4).write.parquet(path)
    return PM.permuted_prefix(spark.read.parquet(path), FIRST_N, PREFIX_SEED).select("place", "doc_id", F.sha1("text").alias("text_sha"))


@query("jsonl_inferred", sql="""SELECT CASE WHEN doc_id % 5 = 0 THEN 'd' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS id,
  CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN CAST(n_chars AS DOUBLE) ELSE n_chars + 0.5 END AS size,
  lang AS meta_lang, CASE WHEN doc_id % 4 = 1 THEN source END AS meta_source,
  CASE WHEN doc_id % 7 = 0 THEN '{"n":' || n_chars || '}' ELSE lang END AS mixed, sha1(text) AS text_sha FROM documents""")
def jsonl_inferred(spark, sf_dir):
    """Lines whose fields come and go and whose types clash: numbers or text, whole or not, objects or text."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    number = k.cast("string")
    fields = {
        "id": F.when(k % 5 == 0, F.concat(F.lit('"d'), number, F.lit('"'))).otherwise(number),
        "size": F.when(k % 3 == 0, None).when(k % 2 == 0, F.col("n_chars").cast("string")).otherwise(F.concat(F.col("n_chars").cast("string"), F.lit(".5"))),
        "meta": F.to_json(F.struct("lang", F.when(k % 4 == 1, F.col("source")).alias("source"))),
        "mixed": F.when(k % 7 == 0, F.to_json(F.struct(F.col("n_chars").alias("n")))).otherwise(F.concat(F.lit('"'), "lang", F.lit('"'))),
        "text": F.get(F.split(F.to_json(F.struct("text")), '"text":', 2), F.lit(1)),
    }
    pairs = [F.concat(F.lit(f'"{name}":'), value) for name, value in fields.items() if name != "text"]
    line = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit(',"text":'), fields["text"])     # to_json closed the record
    path = scratch_path(spark, "drifting-lines")
    d.select(line.alias("value")).write.text(path)
    rows = read_jsonl_inferred(spark, path)
    return rows.select("id", "size", F.col("meta.lang").alias("meta_lang"), F.col("meta.source").alias("meta_source"), "mixed",
                       F.sha1("text").alias("text_sha"))


@query("chat_untrusted", sql=f"""WITH m AS (SELECT conv_id, list(struct_pack(role := role, content := {Q.strip('text')}) ORDER BY turn)
    FILTER (turn % 5 <> 4 AND turn % 7 <> 3 AND role IN ('system','user','assistant') AND {Q.strip('text')} <> '') AS m
  FROM conversations GROUP BY conv_id)
SELECT CAST(conv_id AS VARCHAR) AS id, CASE WHEN conv_id % 4 <> 0 THEN CAST(coalesce(len(m), 0) AS INTEGER) END AS num_messages,
  CASE WHEN conv_id % 4 <> 0 THEN coalesce({Q.msha('m')}, sha1('')) END AS messages_sha FROM m""")
def chat_untrusted(spark, sf_dir):
    """Chats among whose messages are numbers and bare texts; every fourth chat is no list at all."""
    t = table(spark, sf_dir, "conversations")
    one = (F.when(F.col("turn") % 5 == 4, F.lit('{"role":"user","content":7}')).when(F.col("turn") % 7 == 3, F.lit('"stray"'))
           .otherwise(F.to_json(F.struct("role", F.col("text").alias("content")))))
    chats = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", one.alias("json")))).alias("m"))
    whole = F.when(F.col("conv_id") % 4 == 0, F.lit('"not a list"')).otherwise(F.concat(F.lit("["), F.array_join(F.col("m.json"), ","), F.lit("]")))
    path = scratch_path(spark, "untrusted-chats")
    chats.select(F.concat(F.lit('{"id":"'), F.col("conv_id").cast("string"), F.lit('","messages":'), whole, F.lit("}")).alias("value")).write.text(path)
    rows = J.read_chat_jsonl_untrusted(spark, path).select("id", C.normalize_messages("messages").alias("m"))
    known = F.col("m").isNotNull()
    return rows.select("id", F.when(known, F.size("m")).alias("num_messages"), F.when(known, C.messages_sha("m")).alias("messages_sha"))


def written_splits(spark, sf_dir) -> str:
    """Nested chats written with one folder per split; every tenth chat is held out."""
    t = table(spark, sf_dir, "conversations")
    chats = t.groupBy(F.col("conv_id").alias("source_index")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("messages"))
    path = scratch_path(spark, "split-chats")
    split = F.when(F.col("source_index") % 10 == 0, "test_sft").otherwise("train_sft")
    chats.withColumn("split", split).write.partitionBy("split").parquet(path)
    return path


@query("chat_split", sql="""SELECT conv_id AS source_index, CAST(count(*) AS INTEGER) AS num_messages, string_agg(role, ',' ORDER BY turn) AS roles
FROM conversations WHERE conv_id % 10 <> 0 GROUP BY conv_id""")
def chat_split(spark, sf_dir):
    """One split by name; the scan opens its folder alone and reads the roles alone."""
    rows = read_split(spark, written_splits(spark, sf_dir), "train_sft")
    return rows.select("source_index", F.size("messages.role").alias("num_messages"), F.array_join("messages.role", ",").alias("roles"))
