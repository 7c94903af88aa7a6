"""Token ids by dictionary encoding: each distinct piece of all texts is encoded once.

A splitter pattern cuts texts into pieces in the JVM; the distinct pieces with their
counts are one aggregate with map-side combine, the user's encoder sees each of them
once, and ids come back by a join on the piece. Pieces that make up at least one part
in ``hot_parts`` of all occurrences are at most ``hot_parts`` many: they are broadcast,
so that a frequent word is never a join key of the shuffle. The rest is joined by it.

This pays where an encoder call costs more than moving a word; a fast encoder is
better called per text (``functions.tokens.tokenizer_udf``).
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import scratch_path, ship_package
from corpusloom.sources.positions import row_positions

Encoder = Callable[[str], tuple[list[int], list[int]]]


def pieces(text, pattern: str) -> Column:
    """The pieces of a text in order; ``\\s`` of the pattern is Unicode white space."""
    return F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))


def rank_file_encoder(path: str) -> Callable[[], Encoder]:
    """Encoder factory of a vocabulary of ``<base64 token> <rank>`` lines: ids of a piece
    and the bytes of each id's token. The file is read here, once; tasks get its ranks."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}

    def make() -> Encoder:
        import tiktoken

        bpe = tiktoken.Encoding("pieces", pat_str=r"(?s:.)+", mergeable_ranks=ranks, special_tokens={})

        def encode(piece: str) -> tuple[list[int], list[int]]:
            ids = bpe.encode_ordinary(piece)
            return ids, [len(bpe.decode_single_token_bytes(i)) for i in ids]
        return encode
    return make


def _encoder_udf(make_encoder: Callable[[], Encoder]):
    made: list[Encoder] = []

    @F.pandas_udf("ids array<int>, sizes array<int>")
    def encode(words: pd.Series) -> pd.DataFrame:
        if not made:
            made.append(make_encoder())
        return pd.DataFrame([made[0](w) for w in words], columns=["ids", "sizes"])
    return encode


def build_dictionary(words: DataFrame, make_encoder: Callable[[], Encoder]) -> DataFrame:
    """``words (piece)`` -> written table ``(piece, n, code struct<ids, sizes>)``, a row per distinct piece."""
    spark = words.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "dictionary")
    counted = words.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    counted.select("piece", "n", _encoder_udf(make_encoder)("piece").alias("code")).write.parquet(path)
    return spark.read.parquet(path)


def encode_texts(rows: DataFrame, text: str, pattern: str, make_encoder: Callable[[], Encoder], hot_parts: int = 4096) -> DataFrame:
    """``rows`` with ``ids`` and ``sizes`` (token ids of ``text`` and their bytes, in order).

    The rows are written once and known by their place in the files, so repeated rows
    stay apart. A null text gives null arrays, an empty one empty arrays; columns named
    ``ids`` or ``sizes`` are replaced. What is gathered per row is its own text's ids.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "texts")
    rows.drop("ids", "sizes").write.parquet(path)
    placed = row_positions(spark.read.parquet(path), "_dc_row")
    words = placed.select("_dc_row", F.posexplode(pieces(F.col(text), pattern)).alias("_dc_at", "piece"))
    dictionary = build_dictionary(words.select("piece"), make_encoder)
    total = dictionary.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * hot_parts >= total
    hot, cold = F.broadcast(dictionary.where(is_hot).drop("n")), dictionary.where(~is_hot).drop("n")
    coded = words.join(hot, "piece").unionByName(words.join(hot, "piece", "left_anti").join(cold, "piece"))
    whole = coded.groupBy("_dc_row").agg(F.array_sort(F.collect_list(F.struct("_dc_at", "code"))).alias("_dc_code"))

    def joined(name):
        flat = F.flatten(F.transform("_dc_code", lambda x: x["code"][name]))
        return F.when(F.col(text).isNotNull(), F.coalesce(flat, F.array().cast("array<int>"))).alias(name)

    return placed.join(whole, "_dc_row", "left").select(*[c for c in placed.columns if c != "_dc_row"], joined("ids"), joined("sizes"))


def tokens_before(sizes, n_bytes) -> Column:
    """How many tokens start before byte ``n_bytes`` of their text."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).alias("n"))
    return F.aggregate(sizes, start, lambda a, size: F.struct((a["at"] + size).alias("at"), (a["n"] + (a["at"] < n_bytes).cast("int")).alias("n")),
                       lambda a: a["n"])
