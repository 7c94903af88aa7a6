"""SQL snippets (DuckDB dialect) mirroring the column expressions, for oracles.

They use the same constants as the Spark side but are written independently
(list functions, window forms) so that an oracle is a second formulation.
"""

from __future__ import annotations

from corpusloom.functions.chat import DEFAULT_TEMPLATE as T
from corpusloom.functions.text import PY_WS_CODEPOINTS
from corpusloom.functions.tokens import PRETOKEN

WS = "(" + "||".join(f"chr({c})" for c in PY_WS_CODEPOINTS) + ")"
WS_RUN = "'[" + "".join("\\x{%x}" % c for c in PY_WS_CODEPOINTS) + "]+'"
LINE_BREAKS = "'\\r\\n|[\\x{a}\\x{b}\\x{c}\\x{d}\\x{1c}\\x{1d}\\x{1e}\\x{85}\\x{2028}\\x{2029}]'"


def lit(s: str) -> str:
    """A SQL string expression for any Python string (control chars via chr)."""
    parts, buf = [], ""
    for ch in s:
        if ch == "'" or ord(ch) < 32:
            if buf:
                parts.append("'" + buf + "'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf or not parts:
        parts.append("'" + buf + "'")
    return "(" + "||".join(parts) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def norm(x: str) -> str:
    return strip(f"coalesce({x}, '')")


def ntok(x: str) -> str:
    return f"CAST(coalesce(len(regexp_extract_all({x}, '{PRETOKEN}')), 0) AS INTEGER)"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {WS_RUN}), lambda w: w <> '')"


def render(m: str, gen: bool) -> str:
    tail = T.generation_prompt if gen else ""
    return (f"({lit(T.bos)} || coalesce(array_to_string(list_transform({m}, lambda x: {lit(T.header_open)} || x.role || "
            f"{lit(T.header_close)} || x.content || {lit(T.eot)}), ''), '') || {lit(tail)})")


def msha(m: str) -> str:
    return f"sha1(array_to_string(list_transform({m}, lambda x: x.role || chr(31) || x.content), chr(30)))"


def roles(m: str) -> str:
    return f"array_to_string(list_transform({m}, lambda x: x.role), ',')"


def okey(seed: int, stage: str, *keys: str) -> str:
    inner = " || ':' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"sha1('{seed}:{stage}:' || {inner})"


def sub_ord(key: str, sub: str) -> str:
    return f"({key} || ':' || lpad(CAST({sub} AS VARCHAR), 6, '0'))"


def between(col: str, lo: int, hi: int) -> str:
    return f"({col} BETWEEN {lo} AND {hi})"
