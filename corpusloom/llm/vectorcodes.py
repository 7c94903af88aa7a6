"""Vector codes: each part of a vector is replaced by its nearest codebook entry.

Components become integers ``floor(scale * x)``; a vector is cut into ``parts`` equal
consecutive parts, each with a codebook of ``entries`` rows that starts from the
smallest ids and is moved to the means of its cells in ``rounds`` rounds.

* Equal-average search. Entries are sorted by their component sum. For a part with
  sum S and dimension k, ``(S - S_entry)^2 / k`` is at most the squared distance, so
  the search starts at the entries whose sums are closest to S and expands outward;
  a side ends when the squared sum gap over k strictly exceeds the best distance (so
  an entry at an equal distance with a lower index is still met). A task sorts its
  parts by sum and searches them in tiles, whose members share a window of entries.
* Codebooks (``entries * dimension`` integers, whatever the input) are closed over by
  the tasks. A round sends one sum per entry and component of every task, added up
  map-side first; vectors are never shuffled or gathered.

Defined cases: rows whose vector is null or holds a null or non-finite component are
dropped; so are vectors whose length is not that of the first kept row in id order. If
the length is not a multiple of ``parts``, the first parts are one longer. Scaled
components are held within a bound at which no sum of squares overflows (|x| up to
131,072 is exact at 64 dimensions). Fewer rows than ``entries`` give fewer entries;
rows that share an id are ordered by their vector; a null id sorts last; a null label
is a label of its own; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import scratch_path

TILE = 256                      # parts searched with one window of entries
STEP = 16                       # entries by which a window grows on each side


def limit(dimension: int) -> int:
    """Greatest scaled component: ``(2 * limit)^2 * dimension`` stays below 2^62."""
    return int(2 ** 30 / max(1, dimension) ** 0.5)


def part_bounds(dimension: int, parts: int) -> list[tuple[int, int]]:
    longer, short = dimension % parts, dimension // parts
    sizes = [short + (k < longer) for k in range(parts)]
    ends = np.cumsum(sizes).tolist()
    return [(e - s, e) for s, e in zip(sizes, ends)]


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    bound = limit(x.shape[1])
    return np.clip(np.floor(x.astype(np.float64) * scale), -bound, bound).astype(np.int64)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(entry, squared distance)`` of each row of ``x``: the nearest row of ``book``,
    the lowest index among equals."""
    k = max(1, x.shape[1])
    by_sum = np.argsort(book.sum(axis=1), kind="stable")
    entries, sums = book[by_sum], book.sum(axis=1)[by_sum]
    own = x.sum(axis=1)
    order = np.argsort(own, kind="stable")
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    small = 4 * top * top * k < 2 ** 53                     # then products in doubles are exact
    ex = entries.astype(np.float64) if small else None
    best_at, best = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    none = np.iinfo(np.int64).max
    for start in range(0, len(x), TILE):
        rows = order[start:start + TILE]
        part, s = x[rows], own[rows]
        found, at = np.full(len(rows), none), np.full(len(rows), len(book))
        low = high = int(np.searchsorted(sums, s[len(s) // 2]))      # entries [low, high) are done
        while low > 0 or high < len(sums):
            spans = []
            reach = np.where(found == none, np.inf, found * float(k)) * (1 + 1e-12)     # rounded up: never too short
            if low > 0 and (np.maximum(s - sums[low - 1], 0).astype(np.float64) ** 2 <= reach).any():
                spans.append((max(0, low - STEP), low))
            if high < len(sums) and (np.maximum(sums[high] - s, 0).astype(np.float64) ** 2 <= reach).any():
                spans.append((high, min(len(sums), high + STEP)))
            if not spans:
                break
            for a, b in spans:
                if small:
                    own_part = part.astype(np.float64)
                    d = ((own_part * own_part).sum(axis=1)[:, None] - 2 * (own_part @ ex[a:b].T) + (ex[a:b] * ex[a:b]).sum(axis=1)).astype(np.int64)
                else:
                    d = np.stack([((part - e) ** 2).sum(axis=1) for e in entries[a:b]], axis=1)
                least = d.min(axis=1)
                first = np.where(d == least[:, None], by_sum[a:b], len(book)).min(axis=1)
                closer = (least < found) | ((least == found) & (first < at))
                found, at = np.where(closer, least, found), np.where(closer, first, at)
                low, high = min(low, a), max(high, b)
        best_at[rows], best[rows] = at, found
    return best_at, best


def _matrices(batches, scale: int, dimension: int):
    """``(batch, integer matrix)``; the vectors are the last column, all of one length."""
    for batch in batches:
        if batch.num_rows:
            flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
            yield batch, scaled(flat.reshape(batch.num_rows, dimension), scale)


def _sums(books, bounds, scale, dimension):
    """``(part, entry, k, sums)`` of a task: rows per entry and their component sums."""
    def run(batches):
        held = [(np.zeros(len(b), np.int64), np.zeros(b.shape, np.int64)) for b in books]
        rows, most = 0, max(1, 2 ** 62 // limit(dimension))
        def given():
            for part, (n, total) in enumerate(held):
                used = np.flatnonzero(n)
                yield pa.record_batch({"part": pa.array([part] * len(used), pa.int32()), "entry": pa.array(used, pa.int32()),
                                       "k": pa.array(n[used], pa.int64()), "sums": pa.array(total[used].tolist(), pa.list_(pa.int64()))})
                n[:] = 0
                total[:] = 0
        for batch, x in _matrices(batches, scale, dimension):
            if rows + len(x) > most:
                yield from given()
                rows = 0
            rows += len(x)
            for (a, b), book, (n, total) in zip(bounds, books, held):
                entry, _ = nearest(x[:, a:b], book)
                order = np.argsort(entry, kind="stable")
                used, first = np.unique(entry[order], return_index=True)
                n[used] += np.diff(np.append(first, len(entry)))
                total[used] += np.add.reduceat(x[order, a:b], first, axis=0)
        yield from given()
    return run


def _codes(books, bounds, scale, dimension):
    def run(batches):
        for batch, x in _matrices(batches, scale, dimension):
            found = [nearest(x[:, a:b], book) for (a, b), book in zip(bounds, books)]
            width = max(2, *(len(f"{len(b) - 1:x}") for b in books))
            code = ["".join(f"{e:0{width}x}" for e in row) for row in zip(*(at.tolist() for at, _ in found))]
            yield pa.record_batch({"i": batch.column(0), "l": batch.column(1), "code": pa.array(code, pa.string()),
                                   "error": pa.array(sum(d for _, d in found), pa.int64())})
    return run


def _kept(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> tuple[DataFrame, int]:
    """Rows ``(i, l, v)`` with usable vectors, and the length that they share."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    v = F.col(f"`{embedding}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").alias("i"), F.col(f"`{label}`").alias("l"), v.alias("v"))
    rows = rows.where(F.col("v").isNotNull() & F.coalesce(F.forall("v", finite), F.lit(False)) & (F.size("v") > 0))
    first = rows.orderBy(F.col("i").asc_nulls_last(), "v").select(F.size("v").alias("k")).limit(1).collect()
    dimension = first[0]["k"] if first else 0
    return rows.where(F.size("v") == dimension), dimension


def fit_codebooks(rows: DataFrame, dimension: int, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> list[np.ndarray]:
    """Codebooks of the parts; ``rows`` holds ``(i, l, v)`` with vectors of one length."""
    bounds = part_bounds(dimension, parts)
    start = rows.orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).select("v").collect()     # at most ``entries`` vectors
    if not start:
        return [np.zeros((0, b - a), np.int64) for a, b in bounds]
    x = scaled(np.array([r["v"] for r in start], np.float64), scale)
    books = [x[:, a:b] for a, b in bounds]
    for _ in range(rounds):
        sums = (rows.select("v").mapInArrow(_sums(books, bounds, scale, dimension), "part int, entry int, k long, sums array<long>")
                .select("part", "entry", "k", F.posexplode("sums").alias("at", "s"))
                .groupBy("part", "entry", "at").agg(F.sum(F.col("k").cast("decimal(38,0)")).alias("k"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
        books = [b.copy() for b in books]
        for r in sums.collect():                                         # one row per codebook component
            books[r["part"]][r["entry"], r["at"]] = int(r["s"]) // int(r["k"])
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(c) for b in books for c in b.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = 4,
           entries: int = 256, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """``(vec_id, label, code, error, label_error, codebooks_sha256)`` of every usable row."""
    rows, dimension = _kept(vectors, vec_id, embedding, label)
    books = fit_codebooks(rows, dimension, parts, entries, rounds, scale)
    kind = rows.schema
    path = scratch_path(vectors.sparkSession, "codes")
    rows.mapInArrow(_codes(books, part_bounds(dimension, parts), scale, dimension),
                    f"i {kind['i'].dataType.simpleString()}, l {kind['l'].dataType.simpleString()}, code string, error long").write.parquet(path)
    coded = vectors.sparkSession.read.parquet(path)
    most = F.lit(2 ** 63 - 1).cast("decimal(38,0)")
    total = coded.groupBy("l").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"))
    total = total.withColumnRenamed("l", "own")
    return (coded.join(total, F.col("l").eqNullSafe(F.col("own")), "left")
            .select(F.col("i").alias(vec_id), F.col("l").alias(label), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))
