"""Language-model scoring by deleted interpolation.

The model mixes maximum-likelihood n-gram estimates of every order up to ``order``
with the uniform distribution over the V known tokens and one unknown. The mixture
weights depend on how often the context was seen (log2 buckets of its count) and are
learned by expectation-maximisation on a deleted part of the training documents,
against counts from the part that was kept. The final estimates use all training
counts. A text is its lower-cased (A-Z) words and one end; contexts begin with a
start mark, which is never predicted.

Counts never travel one row per n-gram occurrence. Documents are dealt into blocks of
about ``BLOCK_BYTES`` of text by a hash of the row; a block sends the sorted distinct
n-gram hashes it holds with its counts, cut by hash range, as compressed arrays
(a map-side aggregation). One task per range adds them up and answers every block
with the totals in the block's own order; blocks then score their documents. What is
gathered grows with the corpus; nothing but two totals, V and N, and a histogram on
a fixed grid (context bucket and quarter-octave steps of each estimate) reaches the
driver, where the weights are fitted. A block sends one row per range that it has a
gram for: blocks x ranges of them, never more than it has distinct grams.

N-grams are named by 64-bit hashes. Defined cases: a null or empty text is its end
token alone; a null id counts as the text '' in the split; the deleted part and the
block follow from id and text together, so null ids and one repeated id spread;
repeated rows are documents of their own and share a block; an empty table gives no rows; without training documents the score is
the uniform model's; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import ascii_lower
from corpusloom.llm.substrings import WordHashes, hash_words, run_hashes
from corpusloom.session import scratch_path

BLOCK_BYTES = 10 << 20
MAX_BUCKET = 20
STEPS = 4                     # histogram cells per octave of an estimate
FLOOR = -60 * STEPS           # cell of an estimate of zero
START, END = np.uint64(0x53544152), np.uint64(0x454E4421)


def held_out_by_id(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def deleted_part(doc_id: str, text: str, percent: int) -> Column:
    """Whether a training row fits the weights; null ids and repeated ids part by their text."""
    return F.pmod(F.xxhash64(F.col(doc_id).cast("long"), F.col(text), F.lit("deleted")), F.lit(100)) < percent


# ---- arrays on the wire ---------------------------------------------------

def _pack(a: np.ndarray) -> bytes:
    """Byte planes, compressed: small numbers and steps leave the high planes empty."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T) if len(a) else np.zeros(0, np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(b: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel() if len(raw) else np.zeros(0, dtype)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b, np.uint64), dtype=np.uint64)


# ---- grams of one block ---------------------------------------------------

class Grams:
    """Padded tokens of a block's documents and the distinct n-grams of each order."""

    def __init__(self, texts: list[bytes], order: int, known: WordHashes):
        self.order = order
        lead = np.full(order - 1, START, np.uint64)
        parts = []
        for t in texts:
            parts += [lead, hash_words(t.split(), known), np.array([END])]
        h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        lens = np.array([len(p) for p in parts], np.int64).reshape(-1, 3).sum(axis=1)
        self.first = np.concatenate([[0], np.cumsum(lens)[:-1]]) if len(lens) else np.zeros(0, np.int64)
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), lens)
        self.pos = (np.arange(len(h)) - self.first[self.doc]).astype(np.int32) if len(h) else np.zeros(0, np.int32)
        self.keys, self.at, self.index = {}, {}, {}
        for k in range(1, order + 1):
            ends = np.flatnonzero(self.pos >= k - 1)
            self.at[k] = ends.astype(np.int32)
            self.keys[k], index = np.unique(run_hashes(h, k, 20 + k)[ends - k + 1], return_inverse=True)
            self.index[k] = index.astype(np.int32)

    def counts(self, k: int, weight: np.ndarray) -> np.ndarray:
        """Occurrences of each distinct gram in documents of weight 1."""
        return np.bincount(self.index[k], weight[self.doc[self.at[k]]], len(self.keys[k])).astype(np.uint32)

    def per_position(self, k: int, totals: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.pos))
        out[self.at[k]] = totals[self.index[k]]
        return out

    def estimates(self, totals: dict[int, np.ndarray], n: int):
        """At every predicted token: count, context bucket and one estimate per order."""
        own = np.flatnonzero(self.pos >= self.order - 1)
        seen = {k: self.per_position(k, totals[k]) for k in totals}
        p = [seen[1][own] / max(n, 1)]
        context = np.full(len(own), float(n))
        for k in range(2, self.order + 1):
            context = seen[k - 1][own - 1]
            # a run of k - 1 start marks stands order - k + 1 times before a text, once before its first token
            context = np.where(self.pos[own] == self.order - 1, context / (self.order - k + 1), context)
            p.append(np.divide(seen[k][own], context, out=np.zeros(len(own)), where=context > 0))
        bucket = np.minimum(np.log2(1 + context).astype(int), MAX_BUCKET)
        return own, seen[1][own], bucket, p


def _texts(column) -> list[bytes]:
    open_ = zstandard.ZstdDecompressor()
    return [open_.decompress(z) if z else b"" for z in column.to_pylist()]


def _cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    part = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(ranges + 1))


REQUEST = "k int, part int, block int, keys binary, kept binary, gone binary"
REPLY = "k int, part int, block int, kept binary, gone binary, v_new long, n_all long, n_kept long"


def _request(order: int, ranges: int):
    def run(table: pa.Table) -> pa.Table:
        g = Grams(_texts(table["z"]), order, WordHashes())
        kept = table["kept"].to_numpy().astype(float)
        gone = table["gone"].to_numpy().astype(float)
        block, rows = table["block"][0].as_py(), []
        for k in range(1, order + 1):
            cut, a, b = _cuts(g.keys[k], ranges), g.counts(k, kept), g.counts(k, gone)
            for r in range(ranges):
                lo, hi = cut[r], cut[r + 1]
                if hi > lo:
                    rows.append((k, r, block, _pack_sorted(g.keys[k][lo:hi]), _pack(a[lo:hi]), _pack(b[lo:hi])))
        k, r, block, keys, a, b = zip(*rows)
        return pa.table({"k": pa.array(k, pa.int32()), "part": pa.array(r, pa.int32()), "block": pa.array(block, pa.int32()),
                         "keys": pa.array(keys, pa.binary()), "kept": pa.array(a, pa.binary()), "gone": pa.array(b, pa.binary())})
    return run


def _add_up(table: pa.Table) -> pa.Table:
    """Totals of one hash range, handed back in each block's order."""
    keys = [_unpack_sorted(b) for b in table["keys"].to_pylist()]
    names, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = {}
    for c in ("kept", "gone"):
        sums[c] = np.bincount(at, np.concatenate([_unpack(b, np.uint32) for b in table[c].to_pylist()]), len(names)).astype(np.uint64)
    ends = np.cumsum([len(x) for x in keys])
    answer = {c: [_pack(sums[c][at[e - len(x):e]].astype(np.uint64)) for x, e in zip(keys, ends)] for c in sums}
    rest = [0] * (len(keys) - 1)
    return pa.table({"k": table["k"], "part": table["part"], "block": table["block"],
                     "kept": pa.array(answer["kept"], pa.binary()), "gone": pa.array(answer["gone"], pa.binary()),
                     "v_new": pa.array([int((sums["kept"] + sums["gone"] > 0).sum())] + rest, pa.int64()),
                     "n_all": pa.array([int(sums["kept"].sum() + sums["gone"].sum())] + rest, pa.int64()),
                     "n_kept": pa.array([int(sums["kept"].sum())] + rest, pa.int64())})


def _totals(replies: pa.Table, column: tuple[str, ...]) -> dict[int, np.ndarray]:
    """Counts per order, in the order of the block's sorted keys."""
    rows = sorted(zip(replies["k"].to_pylist(), replies["part"].to_pylist(), *(replies[c].to_pylist() for c in column)), key=lambda r: r[:2])
    out: dict[int, list] = {}
    for k, _, *parts in rows:
        out.setdefault(k, []).append(sum(_unpack(b, np.uint64) for b in parts))
    return {k: np.concatenate(v).astype(float) for k, v in out.items()}


def _cell(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.round(np.log2(np.maximum(p, 1e-18)) * STEPS), FLOOR).astype(np.int32)


def _histogram(order: int, n_kept: int):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"b": pa.array([], pa.int32()), "q": pa.array([], pa.list_(pa.int32())), "n": pa.array([], pa.int64())})
        g = Grams(_texts(docs["z"]), order, WordHashes())
        _, _, bucket, p = g.estimates(_totals(replies, ("kept",)), n_kept)
        grid, n = np.unique(np.stack([bucket, *map(_cell, p)], axis=1), axis=0, return_counts=True)
        return pa.table({"b": pa.array(grid[:, 0].astype(np.int32)), "q": pa.array(grid[:, 1:].astype(np.int32).tolist(), pa.list_(pa.int32())),
                         "n": pa.array(n.astype(np.int64))})
    return run


def fit_weights(cells: list[tuple[int, list[int], int]], order: int, v: int, rounds: int = 60) -> np.ndarray:
    """Weights ``[bucket, 0..order]`` (0: uniform) by EM; buckets without data take the overall ones."""
    def em(q, n):
        p = np.concatenate([np.full((len(q), 1), 1.0 / (v + 1)), np.where(q > FLOOR, 2.0 ** (q / STEPS), 0.0)], axis=1)
        w = np.full(order + 1, 1.0 / (order + 1))
        for _ in range(rounds):
            share = p * w
            share /= share.sum(axis=1, keepdims=True)
            w = (share * n[:, None]).sum(axis=0) / n.sum()
            w = np.maximum(w, 1e-6)
            w /= w.sum()
        return w

    if not cells:
        return np.tile(np.full(order + 1, 1.0 / (order + 1)), (MAX_BUCKET + 1, 1))
    b = np.array([c[0] for c in cells])
    q = np.array([c[1] for c in cells], float)
    n = np.array([c[2] for c in cells], float)
    out = np.tile(em(q, n), (MAX_BUCKET + 1, 1))
    for k in np.unique(b):
        out[k] = em(q[b == k], n[b == k])
    return out


def _score(order: int, n: int, v: int, weights: np.ndarray):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        m = docs.num_rows
        if m:
            g = Grams(_texts(docs["z"]), order, WordHashes())
            own, c, bucket, p = g.estimates(_totals(replies, ("kept", "gone")), n)
            w = weights[bucket]
            mix = w[:, 0] / (v + 1) + sum(w[:, k + 1] * p[k] for k in range(order))
            doc = g.doc[own]
            cols = [np.bincount(doc, minlength=m), np.bincount(doc, c > 0, m).astype(np.int64),
                    np.bincount(doc, np.log10((c + 1) / (n + v + 1)), m), np.bincount(doc, np.log10(mix), m)]
        else:
            cols = [np.zeros(0, np.int64)] * 2 + [np.zeros(0)] * 2
        return pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": pa.array(cols[0], pa.int64()),
                         "n_known": pa.array(cols[1], pa.int64()), "train_tokens": pa.array(np.full(m, n), pa.int64()),
                         "base_score": pa.array(cols[2], pa.float64()), "score": pa.array(cols[3], pa.float64())})
    return run


def _squeeze(batches):
    z = zstandard.ZstdCompressor(level=3)
    for b in batches:
        texts = [z.compress(t.as_buffer().to_pybytes()) for t in b.column("t")]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("block", "doc_id", "held_out", "kept", "gone")), pa.array(texts, pa.binary())],
                                         names=["block", "doc_id", "held_out", "kept", "gone", "z"])


def score_documents(docs: DataFrame, order: int = 2, doc_id: str = "doc_id", text: str = "text", held_out: Column | None = None,
                    deleted_percent: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``.

    Training rows are those where ``held_out`` is false; ``deleted_percent`` of
    them, by a hash of id and lower-cased text, are the deleted part that fits the weights.
    """
    spark = docs.sparkSession
    out = held_out if held_out is not None else held_out_by_id(doc_id)
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(out, F.lit(False)).alias("held_out"),
                      ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("t"))
    size, trained = src.agg(F.sum(F.octet_length("t") + 1), F.count_if(~F.col("held_out"))).first()
    blocks = max(1, -(-(size or 0) // block_bytes))
    apart = max(1, -(-blocks * deleted_percent // 100))             # the deleted part has blocks of its own
    gone = ~F.col("held_out") & deleted_part("doc_id", "t", deleted_percent)
    h = F.xxhash64("doc_id", "t", F.lit("block"))
    src = src.withColumn("gone", gone).withColumn("kept", ~F.col("held_out") & ~F.col("gone")).withColumn(
        "block", F.when(F.col("gone"), blocks + F.pmod(h, F.lit(apart))).otherwise(F.pmod(h, F.lit(blocks))).cast("int"))
    packed = src.mapInArrow(_squeeze, "block int, doc_id long, held_out boolean, kept boolean, gone boolean, z binary")
    path = scratch_path(spark, "ngrams")
    ranges = max(4, blocks // 2)
    (packed.groupBy("block").applyInArrow(_request(order, ranges), REQUEST)
     .groupBy("k", "part").applyInArrow(_add_up, REPLY).write.parquet(f"{path}/replies"))
    replies = spark.read.parquet(f"{path}/replies")
    v, n, n_kept = replies.where("k = 1").agg(F.sum("v_new"), F.sum("n_all"), F.sum("n_kept")).first()
    kept_docs = src.select("kept").where("kept").count() if order > 1 else 0
    # the start marks, order - 1 per document, are contexts only
    v, n, n_kept = (v or 0) - (1 if trained and order > 1 else 0), (n or 0) - (order - 1) * trained, (n_kept or 0) - (order - 1) * kept_docs
    cells = (packed.where("gone").groupBy("block").cogroup(replies.where(F.col("block") >= blocks).groupBy("block"))
             .applyInArrow(_histogram(order, n_kept), "b int, q array<int>, n long")
             .groupBy("b", "q").agg(F.sum("n").alias("n")).collect())       # at most the cells of the grid
    weights = fit_weights(sorted((r["b"], list(r["q"]), r["n"]) for r in cells), order, v)
    return (packed.groupBy("block").cogroup(replies.groupBy("block"))
            .applyInArrow(_score(order, n, v, weights), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                                        "base_score double, score double"))
