"""Batch generation / scoring with a user-supplied model over Arrow batches.

The model is a factory ``make() -> fn``; ``fn(list[str])`` returns one output per
prompt. ``mapInPandas`` runs it on Arrow batches of ``batch_size`` rows inside
the executors; the model is built once per Python worker and cached there.
Nothing is collected to the driver.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import EvalConfig
from corpusloom.session import ship_package

SCORED = "model string, id string, text string, logprobs map<int,double>"
_CACHE: dict = {}


def _model(key: str, make: Callable):
    m = _CACHE.get(key)
    if m is None:
        m = _CACHE[key] = make()
    return m


def micro_batches(batches, columns: list[str], batch_size: int, window: int = 16, by: str | None = None):
    """Rows of Arrow batches, as lists of ``columns``, in batches of exactly ``batch_size``
    (the last of a partition may be smaller), whatever the Arrow batches hold. Rows of
    ``window`` batches are sorted by the length of ``by`` first, so that texts of like
    length meet and little is padded; at most that many rows are held."""
    held: list[tuple] = []

    def given(rows):
        if by is not None:
            at = columns.index(by)
            rows = sorted(rows, key=lambda r: len(r[at] or ""))
        for s in range(0, len(rows), batch_size):
            yield [list(c) for c in zip(*rows[s:s + batch_size])]

    size = batch_size * window
    for pdf in batches:
        held += list(zip(*(pdf[c].tolist() for c in columns)))
        while len(held) >= size:
            yield from given(held[:size])
            held = held[size:]
    yield from given(held)


def generate(df: DataFrame, make: Callable, model_key: str, prompt_col: str = "prompt_text", id_col: str = "id", batch_size: int = 64,
             stop: Sequence[str] = (), max_new_tokens: int | None = None) -> DataFrame:
    """``(id, text)`` per prompt; ``text`` null when the model returns nothing.

    The model's output for a prompt is a text or an iterable of chunks. It is cut before
    the first of the ``stop`` strings and where the pre-token after ``max_new_tokens``
    begins, whichever comes first; no chunk is drawn beyond that."""
    import pandas as pd

    ship_package(df.sparkSession)

    def run(batches):
        from corpusloom.functions.stops import TextEnd
        fn, end = _model(model_key, make), TextEnd(stop, max_new_tokens)
        for ids, prompts in micro_batches(batches, [id_col, prompt_col], batch_size, by=prompt_col):
            texts = [end.cut(x) for x in fn(prompts)]
            if len(texts) != len(ids):
                raise ValueError(f"the model gave {len(texts)} outputs for {len(ids)} prompts")
            yield pd.DataFrame({"id": [str(i) for i in ids], "text": texts})

    return df.select(id_col, prompt_col).mapInPandas(run, "id string, text string")


def top_logprobs(logprobs: dict[int, float] | None, k: int) -> dict[int, float] | None:
    """The ``k`` highest, ties to the lower token id; NaN never counts."""
    if logprobs is None:
        return None
    real = ((t, v) for t, v in logprobs.items() if v is not None and v == v)
    return dict(heapq.nsmallest(k, real, key=lambda x: (-x[1], x[0])))


def score(df: DataFrame, make: Callable, model_key: str, prompt_col: str = "prompt_text",
          id_col: str = "id", batch_size: int = 64, top: int = EvalConfig().top_logprobs) -> DataFrame:
    """``(id, text, logprobs map<int,double>)``: one next token and its ``top`` logprobs."""
    import pandas as pd

    ship_package(df.sparkSession)

    def run(batches):
        fn = _model(model_key, make)
        for ids, prompts in micro_batches(batches, [id_col, prompt_col], batch_size, by=prompt_col):
            outs = list(fn(prompts))
            yield pd.DataFrame({"id": [str(i) for i in ids], "text": [None if o is None else o[0] for o in outs],
                                "logprobs": [None if o is None else top_logprobs(o[1], top) for o in outs]})

    return df.select(id_col, prompt_col).mapInPandas(run, "id string, text string, logprobs map<int,double>")


def scored_so_far(spark: SparkSession, ledger: str) -> DataFrame:
    """``(model, id, text, logprobs)`` of the ledger, without rows if it is not there yet."""
    try:
        return spark.read.schema(SCORED).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCORED)


def score_resumable(questions: DataFrame, make: Callable, model: str, ledger: str, prompt_col: str = "prompt_text", id_col: str = "id",
                    waves: int = 4, **kw) -> DataFrame:
    """``questions`` joined with the text and log-probabilities that ``model`` gives.

    Outputs go to the Parquet folder ``ledger`` in ``waves``, each committed as a whole by
    Spark's writer: ids that are there are never scored again, so a job that was stopped
    goes on behind its last complete wave, and several models share one folder. An id is
    scored once, however many questions have it. A question without an id is not scored
    and keeps nulls."""
    spark, key = questions.sparkSession, uuid.uuid4().hex          # the model is built once per worker and call
    own = lambda: scored_so_far(spark, ledger).where(F.col("model") == model)
    ids = questions.select(F.col(id_col).cast("string").alias("id"), F.col(prompt_col).alias("prompt_text")).where("id is not null")
    for wave in range(waves):
        todo = ids.where(F.pmod(F.xxhash64("id"), F.lit(waves)) == wave).join(own().select("id"), "id", "left_anti")
        todo = todo.groupBy("id").agg(F.min("prompt_text").alias("prompt_text"))
        scored = score(todo, make, key, **kw).withColumn("model", F.lit(model))
        scored.select("model", "id", "text", "logprobs").write.mode("append").parquet(ledger)
    out = own().select(F.col("id").alias("_scored_id"), "text", "logprobs")
    rows = questions.drop("text", "logprobs")
    return rows.join(out, F.col(id_col).cast("string") == F.col("_scored_id"), "left").drop("_scored_id")
