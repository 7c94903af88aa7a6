"""Cutting generated text: at the first stop string, and after a number of tokens.

A model may give its text whole or in chunks. Stop strings are found by one automaton
over all of them, also where a stop runs over the border of two chunks, and no chunk
is asked for once the text is known to end.
"""

from __future__ import annotations

from collections.abc import Iterable

import ahocorasick
import regex

from corpusloom.functions.text import PY_WS_CODEPOINTS

_SPACES = "".join(f"\\x{c:02x}" if c < 256 else f"\\u{c:04x}" for c in PY_WS_CODEPOINTS)
#: The pre-tokens of ``functions.tokens``, in the syntax of the ``regex`` module.
_TOKEN = regex.compile(r"\p{L}+|\p{N}{1,3}|[^" + _SPACES + r"\p{L}\p{N}]+")


def token_starts(text: str) -> list[int]:
    """Start offset of every pre-token; a longer text keeps those of its beginning."""
    return [m.start() for m in _TOKEN.finditer(text)]


class TextEnd:
    """Where a generated text ends: before the stop string that is complete first (of
    several that end together the longest), or where the token after ``max_tokens`` begins."""

    def __init__(self, stop: Iterable[str] = (), max_tokens: int | None = None, starts=token_starts):
        stop = [s for s in stop if s]
        self.longest = max(map(len, stop), default=1)
        self.max_tokens, self.starts = max_tokens, starts
        self.stops = ahocorasick.Automaton()
        for s in stop:
            self.stops.add_word(s, len(s))
        if stop:
            self.stops.make_automaton()
        self.any = bool(stop)

    def _stop_in(self, text: str, start: int) -> tuple[int, int] | None:
        """Start and end of the stop that is complete first behind ``start``."""
        found = None
        if self.any:
            for last, size in self.stops.iter(text, max(0, start - self.longest + 1)):
                if last < start:
                    continue
                if found is not None and last + 1 > found[1]:
                    break
                found = (last + 1 - size if found is None else min(found[0], last + 1 - size), last + 1)
        return found

    def cut(self, output: str | Iterable[str] | None) -> str | None:
        if output is None:
            return None
        text = ""
        for chunk in [output] if isinstance(output, str) else output:
            begin, text = len(text), text + chunk
            stop, starts = self._stop_in(text, begin), [] if self.max_tokens is None else self.starts(text)
            limit = starts[self.max_tokens] if self.max_tokens is not None and len(starts) > self.max_tokens else len(text)
            if stop is not None and stop[1] <= limit:
                return text[:stop[0]]
            if limit < len(text) or (self.max_tokens is not None and len(starts) > self.max_tokens):
                return text[:limit]
        return text
