"""Adapters from the driver's tables to the raw input shapes the operators read.

Each adapter is a plain projection of a whole table, except the chat adapter,
which has to assemble a flat turns table into per-conversation arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.config import DistillConfig
from corpusloom.functions.chat import ROLES
from corpusloom.functions.text import strip

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    """A table is one file or a folder of files."""
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def normalized_turns(conversations: DataFrame) -> DataFrame:
    """Per-turn message normalisation: known role, stripped non-empty content.

    Same result as normalising each conversation's message list, element by
    element, but row-local on the flat table.
    """
    return (conversations
            .select(F.col("conv_id").alias("source_index"), "turn", "role",
                    strip(F.col("text")).alias("content"))
            .where(F.col("role").isin(*ROLES) & (F.col("content") != "")))


def chat_from_turns(conversations: DataFrame, max_messages: int = 12) -> DataFrame:
    """``(source_index, messages)`` per conversation, normalised and pre-trimmed.

    Truncation to ``max_messages`` only ever needs the first message and the last
    ``max_messages``, so each conversation is cut to its first and its last
    ``max_messages + 1`` before it is grouped: both cuts are ``row_number() <= k``
    windows, which Spark plans as a partial ``WindowGroupLimit`` before the shuffle,
    and an array never exceeds that size. Turns of one number are ordered by their
    text; repeated turns all count.
    """
    t = normalized_turns(conversations).withColumn("m", F.struct("turn", "role", "content"))
    by_conv = Window.partitionBy("source_index")

    def cut(order, k, name):
        return (t.withColumn("_r", F.row_number().over(by_conv.orderBy(order))).where(F.col("_r") <= k)
                .select("source_index", F.lit(name).alias("side"), "m"))

    both = cut(F.col("m").asc(), 1, "first").unionByName(cut(F.col("m").desc(), max_messages + 1, "last"))
    side = lambda name: F.when(F.col("side") == name, F.col("m"))
    arrays = both.groupBy("source_index").agg(F.min(side("first")).alias("first"),
                                              F.array_sort(F.collect_list(side("last"))).alias("last"))
    whole = F.when(F.size("last") <= max_messages, F.col("last")).otherwise(
        F.concat(F.array("first"), F.slice("last", 2, max_messages)))
    return arrays.select("source_index", F.transform(whole, lambda x: F.struct(
        x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def alpaca_from_documents(documents: DataFrame) -> DataFrame:
    """Instruction rows from documents: line 1 = instruction, line 2 = input on every
    third document with more than two lines, the remaining lines = output."""
    # at most 3 pieces: lines 1, 2 and the untouched remainder (no full split of long texts)
    d = documents.select("doc_id", F.split(F.col("text"), "\n", 3).alias("ls"))
    d = d.select("doc_id", "ls", (((F.col("doc_id") % 3) == 0) & (F.size("ls") > 2)).alias("has_in"))
    start = F.when(F.col("has_in"), F.lit(3)).otherwise(F.lit(2))
    return d.select(
        F.col("doc_id").alias("source_index"),
        F.get(F.col("ls"), 0).alias("instruction"),
        F.when(F.col("has_in"), F.get(F.col("ls"), 1)).otherwise(F.lit("")).alias("input"),
        F.array_join(F.slice("ls", start, F.greatest(F.size("ls") - start + 1, F.lit(0))), "\n").alias("output"),
    )


def _words(c):
    return F.filter(F.split(c, " "), lambda x: x != "")


def hellaswag_from_documents(documents: DataFrame) -> DataFrame:
    """activity = source; ctx_a, ctx_b = lines 1-2; endings = all further lines; label = doc_id % 5
    (4 is out of range for four endings), '' or 'x' every 17th, null every 31st."""
    d = documents.select("doc_id", "source", F.split(F.col("text"), "\n").alias("ls"))
    k = F.col("doc_id")
    label = (F.when(k % 31 == 0, F.lit(None).cast("string"))
             .when(k % 17 == 0, F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("x")))
             .otherwise((k % 5).cast("string")))
    return d.select(k.alias("source_index"), F.col("source").alias("activity_label"),
                    F.get(F.col("ls"), 0).alias("ctx_a"), F.get(F.col("ls"), 1).alias("ctx_b"),
                    F.slice("ls", 3, F.greatest(F.size("ls") - 2, F.lit(0))).alias("endings"), label.alias("label"))


def _arc_rows(key, text):
    w = F.slice(_words(text), 1, 4)
    n = F.size(w)
    labels = (F.when(key % 9 == 0, F.array(*[F.lit(x) for x in "ABBD"]))
              .when(key % 2 == 0, F.array(*[F.lit(x) for x in "ABCD"]))
              .otherwise(F.array(*[F.lit(x) for x in "1234"])))
    labels = F.when(key % 7 == 0, F.transform(labels, lambda x: F.concat(F.lit(" "), x))).otherwise(labels)
    labels = F.slice(labels, 1, F.when(key % 13 == 0, F.greatest(n - 1, F.lit(0))).otherwise(n))
    keys = F.array(*[F.lit(x) for x in ["B", "A", "D", "C", "2", "4", "10", "K", "C"]])
    answer = F.when(key % 11 == 0, F.lit(None).cast("string")).otherwise(F.element_at(keys, (key % 9 + 1).cast("int")))
    return (key.alias("source_index"), text.alias("question"),
            F.struct(w.alias("text"), labels.alias("label")).alias("choices"), answer.alias("answerKey"))


def arc_from_tables(benchmark: DataFrame, conversations: DataFrame) -> DataFrame:
    """Questions from benchmark items and user turns; choices = the first four words;
    labels A-D or 1-4 (a duplicate, padded or short label list now and then)."""
    b = benchmark.select(*_arc_rows(F.col("item_id"), F.col("text")))
    u = (conversations.where(F.col("role") == "user")
         .select((F.lit(1_000_000_000) + F.col("conv_id") * 1000 + F.col("turn")).alias("k"), "text")
         .select(*_arc_rows(F.col("k"), F.col("text"))))
    return b.unionByName(u)


def winogrande_from_conversations(conversations: DataFrame) -> DataFrame:
    """sentence = a user turn; options = its first two words; answer cycles '1','2','','3',null."""
    u = conversations.where(F.col("role") == "user").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("k"), "text")
    ws = _words(F.col("text"))
    answers = F.array(F.lit("1"), F.lit("2"), F.lit(""), F.lit("3"), F.lit(None).cast("string"))
    return u.select(F.col("k").alias("source_index"), F.col("text").alias("sentence"),
                    F.get(ws, 0).alias("option1"), F.get(ws, 1).alias("option2"),
                    F.element_at(answers, (F.col("k") % 5 + 1).cast("int")).alias("answer"))


def truthfulqa_from_documents(documents: DataFrame) -> DataFrame:
    """question = line 1; choices = all further lines; one label 1 at doc_id % k, a second one
    every 11th document, one label missing every 13th."""
    d = documents.select("doc_id", F.split(F.col("text"), "\n").alias("ls"))
    d = d.select("doc_id", F.get(F.col("ls"), 0).alias("q"), F.slice("ls", 2, F.greatest(F.size("ls") - 1, F.lit(0))).alias("ch"))
    k = F.size("ch")
    key = F.col("doc_id")
    labels = F.when(k > 0, F.transform(F.sequence(F.lit(0), k - 1), lambda j: F.when(
        (j == key % k) | ((key % 11 == 0) & (j == (key + 1) % k)), 1).otherwise(0))
    ).otherwise(F.array().cast("array<int>"))
    labels = F.when(key % 13 == 0, F.slice(labels, 1, F.greatest(k - 1, F.lit(0)))).otherwise(labels)
    return d.select(key.alias("source_index"), F.col("q").alias("question"),
                    F.struct(F.col("ch").alias("choices"), labels.cast("array<int>").alias("labels")).alias("mc1_targets"))


# What the teacher fixture splices into its texts, by key % 7: configured markers and two near misses.
TEACHER_MARKERS = [DistillConfig().markers[k] for k in (1, 3, 6, 0, 2)] + [" ### ", "\n\n  \n"]


def teacher_from_documents(prompts: DataFrame, documents: DataFrame) -> DataFrame:
    """Generations ``(id, text)`` for prompt rows ``(id, source_index, turn_index)``:
    document ``source_index + turn_index`` with a marker after its first line; null
    text every 19th key; no row when the document is absent."""
    p = prompts.select("id", (F.col("source_index") + F.col("turn_index")).alias("k"))
    d = documents.select(F.col("doc_id").alias("k"), F.split(F.col("text"), "\n", 2).alias("ls"))
    marks = F.array(*[F.lit(m) for m in TEACHER_MARKERS])
    text = F.concat(F.get(F.col("ls"), 0), F.element_at(marks, (F.col("k") % 7 + 1).cast("int")), F.lit("\n"),
                    F.coalesce(F.get(F.col("ls"), 1), F.lit("")))
    return p.join(d, "k").select("id", F.when(F.col("k") % 19 == 0, F.lit(None).cast("string"))
                                 .otherwise(text).alias("text"))


# Model names of the prediction fixture and each letter's token ids.
PRED_MODELS = ["base", "sft", "kd"]
PRED_TASKS = ["hellaswag", "arc_challenge", "winogrande", "truthfulqa_mc"]
LETTER_IDS = [[0, 10], [1, 11], [2], [], [4, 14]]
PRED_LEADS = ["", "\n", "\t ", "\u00a0", " \x85"]


def predictions_from_embeddings(embeddings: DataFrame, quantize: bool = False) -> DataFrame:
    """Predictions ``(model_path, task, id, answer_idx, num_choices, text, logprobs)``:
    three models (given by checkpoint paths) = the vector rotated by 0/7/14; logprobs = its 20 largest
    components (index -> value), absent every 7th vector, where the text must
    decide; no output every 23rd vector. ``quantize`` rounds
    the values down to quarter steps first (the post-quantisation side)."""
    k = (F.lit(2) + F.col("vec_id") % 4).cast("int")
    tasks = F.array(*[F.lit(t) for t in PRED_TASKS])
    names = F.array(*[F.lit(f"/models/{n}-merged/{n}/") for n in PRED_MODELS])
    none = F.col("vec_id") % 23 == 0
    lead = F.element_at(F.array(*[F.lit(x) for x in PRED_LEADS]), (F.col("vec_id") % len(PRED_LEADS) + 1).cast("int"))
    e = embeddings.select("vec_id", "embedding", "label", F.explode(F.sequence(F.lit(0), F.lit(len(PRED_MODELS) - 1))).alias("r"))
    v, shift = F.col("embedding"), F.col("r") * 7
    value = lambda j: F.get(v, (j + shift) % F.size(v)).cast("double")
    rot = F.transform(v, lambda x, j: F.struct((F.floor(value(j) * 4) / 4 if quantize else value(j)).alias("v"), j.alias("t")))
    top = F.slice(F.sort_array(rot, False), 1, 20)
    lp = F.map_from_entries(F.transform(top, lambda s: F.struct(s["t"].alias("key"), s["v"].alias("value"))))
    out = e.select(
        F.get(names, F.col("r")).alias("model_path"), F.element_at(tasks, (F.col("vec_id") % 4 + 1).cast("int")).alias("task"),
        "vec_id", (F.col("label") % k).cast("int").alias("answer_idx"), k.alias("num_choices"),
        F.when(none, F.lit(None).cast("string")).otherwise(F.concat(lead, F.char(F.lit(65) + (F.col("vec_id") + F.col("r")) % 6))).alias("text"),
        F.when(none | (F.col("vec_id") % 7 == 3), F.lit(None)).otherwise(lp).alias("logprobs"))
    return out.withColumn("id", F.sha1(F.concat("task", F.lit("|||"), F.col("vec_id").cast("string"))))


# Projection names given to the ten embedding labels of the weights fixture.
WEIGHT_NAMES = ["q_proj", "k_proj", "v_proj", "o_proj", "gate_proj", "up_proj", "down_proj",
                "lm_head", "embed_tokens", "norm"]


def weights_from_embeddings(embeddings: DataFrame, zero_below: float = 0.08) -> DataFrame:
    """Weight rows ``(tensor, row_idx, values)``: components with |x| < 0.08 set to 0;
    one tensor per label, named ``layers.<label>.<projection>``."""
    names = F.array(*[F.lit(n) for n in WEIGHT_NAMES])
    return embeddings.select(
        F.concat(F.lit("layers."), F.col("label").cast("string"), F.lit("."),
                 F.element_at(names, (F.col("label") % 10 + 1).cast("int"))).alias("tensor"),
        F.col("vec_id").alias("row_idx"),
        F.transform("embedding", lambda x: F.when(F.abs(x) < F.lit(zero_below), F.lit(0.0).cast("float"))
                    .otherwise(x)).alias("values"))
