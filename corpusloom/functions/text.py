"""Unicode-aware string helpers matching Python's ``str.strip/split/splitlines``.

Spark's ``trim`` strips spaces only, so the whitespace set is spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points for which Python's str.isspace() is true.
PY_WS_CODEPOINTS = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
PY_WS = "".join(chr(c) for c in PY_WS_CODEPOINTS)
# the same set as a regex character-class body (works in Java regex and RE2)
PY_WS_CLASS = "".join("\\x{%x}" % c for c in PY_WS_CODEPOINTS)
WS_RUN = "[" + PY_WS_CLASS + "]+"

# The line boundaries of Python's str.splitlines().
LINE_BREAKS = "\\r\\n|[\\x{a}\\x{b}\\x{c}\\x{d}\\x{1c}\\x{1d}\\x{1e}\\x{85}\\x{2028}\\x{2029}]"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.btrim(col_(c), F.lit(PY_WS))


def normalize(c) -> Column:
    """null -> '' then strip (the reference's ``normalize_text``)."""
    return strip(F.coalesce(col_(c), F.lit("")))


def prefix(c, n: int | None) -> Column:
    """First ``n`` code points (Python ``s[:n]``); the whole text when ``n`` is None."""
    return col_(c) if n is None else F.substring(col_(c), 1, n)


def words(c) -> Column:
    """Python ``str.split()``: split on whitespace runs, drop empties."""
    return F.filter(F.split(col_(c), WS_RUN), lambda x: x != "")


def lines(c) -> Column:
    """Python ``str.splitlines()`` pieces (a trailing empty piece may remain)."""
    return F.split(col_(c), LINE_BREAKS)


def clean_lines(c) -> Column:
    """Strip every line, drop empty lines, re-join with ``\\n``."""
    return F.array_join(F.filter(F.transform(lines(c), strip), lambda x: x != ""), "\n")
