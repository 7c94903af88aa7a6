"""Token counting and token ids.

The default counter is a pre-tokeniser regex that runs JVM-side
(``regexp_count``), so counting stays inside whole-stage codegen. A real
tokenizer can be plugged in through :func:`tokenizer_udf` (Arrow batches).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import PY_WS_CLASS, col_

# letter runs, digit runs of at most three, runs of other non-space symbols
PRETOKEN = "\\p{L}+|\\p{N}{1,3}|[^" + PY_WS_CLASS + "\\p{L}\\p{N}]+"


def count_tokens(c) -> Column:
    """Number of pre-tokens in a string (null -> 0), as int."""
    return F.coalesce(F.regexp_count(col_(c), F.lit(PRETOKEN)), F.lit(0)).cast("int")


def pretokens(c) -> Column:
    return F.regexp_extract_all(col_(c), F.lit(PRETOKEN), 0)


def token_ids(c) -> Column:
    """Stable stub ids per pre-token: ``(length % 1000) * 1e6 + (first code point % 1e6)``."""
    return F.transform(pretokens(c), lambda t: ((F.length(t) % 1000) * F.lit(1_000_000)
                                                 + F.ascii(t) % 1_000_000).cast("int"))


@dataclass(frozen=True)
class Tokens:
    """How a job counts tokens and turns a text into ids (functions of a column)."""

    count: Callable = count_tokens
    ids: Callable = token_ids


DEFAULT_TOKENS = Tokens()


def plugged_tokens(make_encoder: Callable[[], Callable[[str], list[int]]]) -> Tokens:
    """Counts and ids of a user tokenizer: both are sizes and values of one Arrow call."""
    encode = tokenizer_udf(make_encoder)
    return Tokens(lambda c: F.coalesce(F.size(encode(col_(c))), F.lit(0)).cast("int"), lambda c: encode(col_(c)))


def load_tokens(spec: str | None) -> Tokens:
    """``module:factory`` -> :func:`plugged_tokens`; None -> the default counter."""
    if not spec:
        return DEFAULT_TOKENS
    module, _, name = spec.partition(":")
    return plugged_tokens(getattr(importlib.import_module(module), name))


def tokenizer_udf(make_encoder: Callable[[], Callable[[str], list[int]]]):
    """Wrap a user tokenizer as an Arrow-batched ``pandas_udf`` returning ``array<int>``.

    ``make_encoder`` is called once per Python worker (cached), so a heavy
    tokenizer is loaded once and reused across batches.
    """
    from pyspark.sql import SparkSession

    from corpusloom.session import ship_package

    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
    cache: dict = {}

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _encode(texts: pd.Series) -> pd.Series:
        enc = cache.get("enc")
        if enc is None:
            enc = cache["enc"] = make_encoder()
        return texts.map(lambda t: None if t is None else list(enc(t)))

    return _encode
