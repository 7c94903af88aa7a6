"""Token counts by compiled finite-state transducers.

Two deterministic transducers run one after the other.

* The *splitter* reads character classes and writes the piece boundaries of the
  byte-level pre-tokenizer (letters, numbers, other signs, white space, the seven
  contractions). It has 11 states. A batch of texts is cut into equal chunks; every
  chunk is run from all states at once, which gives a map from entry to exit
  state; the maps are composed by a parallel prefix scan, and a second run from the
  now known entry states writes the boundaries. Chunks may cut texts anywhere.
* The *counter* reads the bytes of a piece and annotates each transition with the
  change in the number of emitted tokens. Its state is, for every start still able
  to grow into a vocabulary entry, the trie node reached, the token that ends
  there and its count relative to the current one. By the pairwise validity of
  merges exactly one token can end at each position, so the machine is
  deterministic; states and transitions are compiled when first met and kept.

Both are exact: counts equal those of the library that owns the vocabulary file.
Marker strings of the vocabulary found in a text count as one token each and
separate the text before splitting, as the library does by default.

Defined cases: a null or empty text has 0 tokens; repeated rows and rows with
null ids are counted each; an empty table gives no rows; other columns pass.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1024
BATCH_CHARS = 1 << 20
KEEP_PIECES = 400_000
KEEP_STATES = 300_000

# Character classes of the splitter.
LETTER, SINGLE, RV, EL, EE, NUMBER, SPACE, OTHER_SPACE, QUOTE, SIGN, END = range(11)
# States of the splitter.
FRESH, IN_LETTERS, IN_NUMBER, IN_SIGNS, ONE_SPACE, RUN_SPACE, ONE_OTHER, RUN_OTHER, AFTER_QUOTE, QUOTE_RV, QUOTE_L = range(11)
HERE, BACK = 1, 2       # boundary before this character / before the one before it


def splitter_tables() -> tuple[np.ndarray, np.ndarray]:
    """``(next_state, marks)``, both indexed ``[state, class]``."""
    nxt, out = np.zeros((11, 11), np.uint8), np.zeros((11, 11), np.uint8)
    letters = (LETTER, SINGLE, RV, EL, EE)
    kind = {**{c: IN_LETTERS for c in letters}, NUMBER: IN_NUMBER, SIGN: IN_SIGNS, QUOTE: IN_SIGNS}

    def begin(cls):     # the state when a piece begins with this class
        return {SPACE: ONE_SPACE, OTHER_SPACE: ONE_OTHER, QUOTE: AFTER_QUOTE}.get(cls, kind.get(cls))

    for state in range(11):
        for cls in range(11):
            if cls == END:
                nxt[state, cls], out[state, cls] = FRESH, BACK if state in (QUOTE_RV, QUOTE_L) else 0
            elif state in (ONE_SPACE, RUN_SPACE, ONE_OTHER, RUN_OTHER):
                if cls in (SPACE, OTHER_SPACE):
                    nxt[state, cls] = RUN_SPACE if cls == SPACE else RUN_OTHER
                elif state in (ONE_SPACE, RUN_SPACE):            # the last space joins the next piece
                    nxt[state, cls], out[state, cls] = kind[cls], BACK if state == RUN_SPACE else 0
                else:
                    nxt[state, cls], out[state, cls] = begin(cls), HERE | (BACK if state == RUN_OTHER else 0)
            elif state == AFTER_QUOTE and cls in (SINGLE, RV, EL):
                nxt[state, cls] = {SINGLE: FRESH, RV: QUOTE_RV, EL: QUOTE_L}[cls]
            elif (state, cls) in ((QUOTE_RV, EE), (QUOTE_L, EL)):
                nxt[state, cls] = FRESH
            elif state in (QUOTE_RV, QUOTE_L):                   # no contraction: the letter began a piece
                same = cls in letters
                nxt[state, cls], out[state, cls] = (IN_LETTERS if same else begin(cls)), BACK | (0 if same else HERE)
            else:
                own = {IN_LETTERS: IN_LETTERS, IN_NUMBER: IN_NUMBER, IN_SIGNS: IN_SIGNS, AFTER_QUOTE: IN_SIGNS}.get(state)
                if own is not None and kind.get(cls) == own:
                    nxt[state, cls] = own
                else:
                    nxt[state, cls], out[state, cls] = begin(cls), HERE
    return nxt, out


def class_table() -> np.ndarray:
    """Class of every code point; one slot past the last for the end mark."""
    table = np.full(0x110001, SIGN, np.uint8)
    for pattern, cls in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", OTHER_SPACE)):
        for lo in range(0, 0x110000, 0x10000):
            plane = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "!" for c in range(lo, lo + 0x10000))
            for m in regex.finditer(pattern, plane):
                table[lo + m.start():lo + m.end()] = cls
    for chars, cls in (("stmd", SINGLE), ("rv", RV), ("l", EL), ("e", EE), (" ", SPACE), ("'", QUOTE)):
        for c in chars:
            table[ord(c)] = cls
    for c in range(0x1C, 0x20):                  # separators: not white space for this pattern
        table[c] = SIGN
    table[0x110000] = END
    return table


class Splitter:
    def __init__(self):
        self.next, self.marks = splitter_tables()
        self.classes = class_table()

    def boundaries(self, points: np.ndarray) -> np.ndarray:
        """True where a piece begins. ``points``: code points, texts ended by 0x110000."""
        n = len(points)
        rows = -(-n // CHUNK)
        cls = np.full(rows * CHUNK, END, np.uint8)
        cls[:n] = self.classes[points]
        cls = np.ascontiguousarray(cls.reshape(rows, CHUNK).T)
        flat, width = self.next.ravel(), 11
        # chunk maps: every entry state to its exit state
        maps = np.tile(np.arange(11, dtype=np.uint8), (rows, 1))
        for column in cls:
            maps = flat[maps * np.uint8(width) + column[:, None]]
        # inclusive prefix scan by doubling: composition is associative
        step = 1
        while step < rows:
            maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), axis=1)
            step *= 2
        state = np.concatenate([[FRESH], maps[:-1, FRESH]]).astype(np.uint8)
        marks = np.empty((CHUNK, rows), np.uint8)
        out = self.marks.ravel()
        for k, column in enumerate(cls):
            at = state * np.uint8(width) + column
            marks[k] = out[at]
            state = flat[at]
        marks = marks.T.reshape(-1)[:n]
        begin = (marks & HERE) > 0
        begin[:-1] |= (marks[1:] & BACK) > 0
        return begin


class _Pieces(dict):
    """Counts of short pieces met before; at most ``KEEP_PIECES`` of them."""

    def __init__(self, run):
        super().__init__()
        self.run = run

    def __missing__(self, text: str) -> int:
        n = self.run(text.encode("utf-8"))
        if len(text) <= 64:
            if len(self) >= KEEP_PIECES:
                self.clear()
            self[text] = n
        return n


class Counter:
    """Lazily compiled transducer over bytes with token-count annotations."""

    def __init__(self, tokens: list[bytes], merges: dict[tuple[int, int], tuple[int, int]]):
        self.tokens, self.merges = tokens, merges
        self.byte_id = {t[0]: i for i, t in enumerate(tokens) if len(t) == 1}
        self.child: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for i, t in enumerate(tokens):
            if not t or self._merge(t) != [i]:               # never the result of the merges
                continue
            node = 0
            for b in t:
                nxt = self.child[node].get(b)
                if nxt is None:
                    nxt = self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.token_at.append(-1)
                node = nxt
            self.token_at[node] = i
        self.valid: dict[tuple[int, int], bool] = {}
        self.pieces = _Pieces(self.run)
        self._reset()

    def _reset(self):
        start = ((0, -1, 0),)
        self.ids, self.states, self.steps = {start: 0}, [start], [{}]

    def _merge(self, data: bytes) -> list[int]:
        """The merge rules applied by rank; only for vocabulary entries and pairs of them."""
        parts = [self.byte_id[b] for b in data]
        while len(parts) > 1:
            best = min(((self.merges[p][0], k) for k, p in enumerate(zip(parts, parts[1:])) if p in self.merges), default=None)
            if best is None:
                break
            pair = (parts[best[1]], parts[best[1] + 1])
            made, out, k = self.merges[pair][1], [], 0
            while k < len(parts):
                if k + 1 < len(parts) and (parts[k], parts[k + 1]) == pair:
                    out.append(made)
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def _follows(self, left: int, right: int) -> bool:
        if left < 0:
            return True
        known = self.valid.get((left, right))
        if known is None:
            known = self._merge(self.tokens[left] + self.tokens[right]) == [left, right]
            if len(self.valid) > 2_000_000:
                self.valid.clear()
            self.valid[left, right] = known
        return known

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        grown, last, delta = [], None, 0
        for node, token, ahead in self.states[state]:
            to = self.child[node].get(byte)
            if to is None:
                continue
            grown.append((to, token, ahead))
            t = self.token_at[to]
            if last is None and t >= 0 and self._follows(token, t):
                last, delta = t, ahead + 1
        live = tuple((n, t, a - delta) for n, t, a in grown if self.child[n]) + ((0, last, 0),)
        to = self.ids.get(live)
        if to is None:
            to = self.ids[live] = len(self.states)
            self.states.append(live)
            self.steps.append({})
        self.steps[state][byte] = (to, delta)
        return to, delta

    def run(self, data: bytes) -> int:
        if len(self.states) > KEEP_STATES:
            self._reset()
        state, total, steps = 0, 0, self.steps
        for b in data:
            move = steps[state].get(b)
            if move is None:
                move = self._compile(state, b)
            state = move[0]
            total += move[1]
        return total


def byte_symbols() -> dict[str, int]:
    """The vocabulary file writes every byte as one printable character: bytes that
    print stand for themselves, the others take the code points from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def load_vocabulary(path: str) -> dict:
    """Read a byte-level merge vocabulary (JSON) on the driver; a bounded file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, own = spec["model"], byte_symbols()
    markers = [t["content"] for t in spec.get("added_tokens", [])]
    size = 1 + max(model["vocab"].values())
    tokens = [b""] * size
    for text, i in model["vocab"].items():
        if text not in markers:
            tokens[i] = bytes(own[c] for c in text)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    vocab = model["vocab"]
    rules = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in reversed(list(enumerate(merges)))}
    return {"tokens": tokens, "merges": rules, "markers": markers}


class TokenCounter:
    def __init__(self, vocabulary: dict):
        self.splitter = Splitter()
        self.counter = Counter(vocabulary["tokens"], vocabulary["merges"])
        self.markers = regex.compile("|".join(map(regex.escape, vocabulary["markers"]))) if vocabulary["markers"] else None

    def count(self, texts: list[str | None]) -> list[int]:
        totals = [0] * len(texts)
        batch, size = [], 0
        for k, text in enumerate(texts):
            parts = [text] if text else []
            if text and self.markers is not None and self.markers.search(text):
                parts = self.markers.split(text)
                totals[k] += len(parts) - 1
            for part in parts:
                if part:
                    batch.append((k, part))
                    size += len(part)
            if size >= BATCH_CHARS:
                self._flush(batch, totals)
                batch, size = [], 0
        self._flush(batch, totals)
        return totals

    def _flush(self, batch: list[tuple[int, str]], totals: list[int]) -> None:
        if not batch:
            return
        ends = np.cumsum([len(p) + 1 for _, p in batch])
        points = np.full(ends[-1], 0x110000, np.uint32)
        for (_, part), end in zip(batch, ends):
            points[end - 1 - len(part):end - 1] = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = np.flatnonzero(self.splitter.boundaries(points))
        cuts = np.searchsorted(begins, np.concatenate([[0], ends]))
        known = self.counter.pieces.__getitem__
        for j, (k, part) in enumerate(batch):
            at = (begins[cuts[j]:cuts[j + 1]] - (int(ends[j]) - 1 - len(part))).tolist()
            at.append(len(part))
            totals[k] += sum(map(known, [part[a:b] for a, b in zip(at, at[1:])]))


_READY: dict = {}


def token_count(text: Column, spark, path: str) -> Column:
    """Number of tokens of ``text`` under the vocabulary file at ``path``.

    The file is read once on the driver and broadcast (its size is that of the
    vocabulary); each Python worker compiles its machines once.
    """
    shared = spark.sparkContext.broadcast(load_vocabulary(path))

    def count(texts: pd.Series) -> pd.Series:
        if _READY.get("of") != path:
            _READY.update(of=path, machine=TokenCounter(shared.value))
        values = [None if t is None or t is pd.NA or (isinstance(t, float)) else t for t in texts]
        return pd.Series(_READY["machine"].count(values), dtype="int64")

    return F.pandas_udf(count, "long")(text)


def with_token_counts(df: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """``df`` plus ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    n = token_count(F.col(text), df.sparkSession, path)
    return (df.withColumn("n_bytes", F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long"))
            .withColumn("n_tokens", n).withColumn("over_limit", F.col("n_tokens") > limit))
