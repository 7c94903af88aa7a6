"""Substring deduplication by seed and extend.

A word is removed when it lies in a window of ``length`` (20) consecutive words
whose word sequence also starts earlier: in a smaller doc_id, or earlier in the
same document.

* Seed. Every window names one anchor, its ``SEED``-word run with the smallest hash
  (winnowing), so equal windows name equal anchors. Only anchors are shuffled,
  about one per eight words, and only those met twice are joined back.
* Extend. Consecutive windows that name one anchor are its *reach*: the anchor
  extended both ways as far as its windows go. Two occurrences with equal reaches
  repeat each other over the whole reach; all but the first lose it. Where an
  anchor has several different reaches (the ends of repeats), the first occurrence
  of each reach is extended window by window and equal windows are matched.
* Overlapping and adjacent matches of a document merge into its maximal repeats.

Equal reaches and windows are compared by 64-bit hashes within one 64-bit anchor
hash, that is by 128 bits. Counts and minima use map-side partial aggregation, and
the joins back to occurrences are plain sort-merge joins that adaptive execution
may split, so a passage in a third of all documents is neither gathered in one task
nor paired with itself. The text crosses the network once, compressed, plus once
more for the documents that hold ends of repeats.

A document is an id and a text: where one id, or null, has several texts, its rows
are told apart and ordered by the MD5 of the text (column ``r``, empty elsewhere).

Defined cases: null, empty and shorter texts have no window and lose nothing; a
null id sorts first; a repeated row (same id and text) is the same document and
gets the same result; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import scratch_path

LENGTH, SEED = 20, 5
BATCH_BYTES = 2 << 20
KEEP_WORDS = 150_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S1, _S2 = np.uint64(32), np.uint64(29)
NULL_ID = -(1 << 63)


class WordHashes(dict):
    """64-bit hash of a word; a bounded cache."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEEP_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def hash_words(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def run_hashes(h: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Order-dependent hash of each run of ``size`` words."""
    n = max(0, len(h) - size + 1)
    acc = np.full(n, seed, np.uint64)
    for j in range(size):
        acc ^= h[j:j + n]
        acc *= _M1
        acc ^= acc >> _S2
    acc *= _M2
    acc ^= acc >> _S1
    return acc


def reaches(h: np.ndarray, doc: np.ndarray, length: int = LENGTH, seed: int = SEED):
    """``(first window, windows, anchor hash, reach hash)`` of every anchor.

    ``h`` holds the word hashes of several documents, ``doc`` the document of each
    word; windows over a document's end are left out.
    """
    n = len(h) - length + 1
    if n <= 0:
        e = np.zeros(0, np.int64)
        return e, e, e.astype(np.uint64), e.astype(np.uint64)
    seeds = run_hashes(h, seed, 7)
    span = length - seed + 1
    at = np.arange(n) + np.lib.stride_tricks.sliding_window_view(seeds, span).argmin(axis=1)
    inside = doc[:n] == doc[length - 1:]
    starts = np.flatnonzero(inside & np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:n] != doc[:n - 1]) | ~inside[:-1]]))
    # a reach ends before the next start or at its document's last window
    last_of_doc = np.flatnonzero(inside & np.concatenate([~inside[1:] | (doc[1:n] != doc[:n - 1]), [True]]))
    ends = last_of_doc[np.searchsorted(last_of_doc, starts)]
    nxt = np.concatenate([starts[1:] - 1, [n]])
    counts = np.minimum(ends, nxt) - starts + 1
    windows = run_hashes(h, length, 11)
    reach = (windows[starts] * _M1) ^ (windows[starts + counts - 1] >> _S1) ^ (windows[starts + counts - 1] * _M2)
    reach = (reach + counts.astype(np.uint64)) * _M1
    return starts, counts, seeds[at[starts]], reach ^ (reach >> _S2)


def _with_hashes(batches, known_hashes: list):
    """The batches, with their third column noted row by row."""
    for batch in batches:
        known_hashes[:] = [0, batch.column(2)]
        yield batch


def _text_batches(batches, limit=BATCH_BYTES):
    """(ids, utf-8 texts) in slices of about ``limit`` bytes."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for i, t in zip(batch.column(0), batch.column(1)):
            raw = t.as_buffer().to_pybytes() if t.is_valid else b""
            ids.append(i.as_py())
            texts.append(raw)
            size += len(raw)
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def _find_reaches(length: int, seed: int):
    def run(batches):
        known, noted = WordHashes(), []
        for ids, texts in _text_batches(_with_hashes(batches, noted)):
            r = noted[1].slice(noted[0], len(ids))
            noted[0] += len(ids)
            hashes = [hash_words(t.split(), known) for t in texts]
            sizes = np.array([len(x) for x in hashes])
            h = np.concatenate(hashes)
            doc = np.repeat(np.arange(len(ids)), sizes)
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            starts, counts, anchor, reach = reaches(h, doc, length, seed)
            owner = doc[starts]
            p = (starts - first[owner]).astype(np.int32)
            # a reach met again in its own document: one row, with the later positions packed
            order = np.argsort(reach ^ (owner.astype(np.uint64) * _M2), kind="stable")
            same = (reach[order][1:] == reach[order][:-1]) & (owner[order][1:] == owner[order][:-1])
            lead = np.flatnonzero(np.concatenate([[True], ~same])) if len(order) else order
            sizes_ = np.diff(np.append(lead, len(order)))
            keep = order[lead]
            more = [p[order[k + 1:k + n]].tobytes() if n > 1 else None for k, n in zip(lead.tolist(), sizes_.tolist())]
            yield pa.record_batch({"d": np.array(ids, np.int64)[owner[keep]], "r": r.take(pa.array(owner[keep])), "a": anchor[keep].view(np.int64), "s": reach[keep].view(np.int64),
                                   "p": p[keep], "c": counts[keep].astype(np.int32), "more": pa.array(more, pa.binary())})
    return run


def _pack(batches):
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        z = [squeeze.compress(t.as_buffer().to_pybytes()) if t.is_valid else b"" for t in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array(z, pa.binary())], names=["d", "z"])


def _pack_identified(batches):
    for batch in batches:
        for packed in _pack([batch]):
            yield pa.record_batch([packed.column(0), packed.column(1), batch.column(2)], names=["d", "z", "r"])


def _digest(words: list[bytes], starts, ends) -> tuple[int, str]:
    """(removed, hash of the kept words) when [start, end) word ranges go."""
    n = len(words)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(np.asarray(starts, np.int64), n), 1)
    np.add.at(edge, np.minimum(np.asarray(ends, np.int64), n), -1)
    keep = np.cumsum(edge[:n]) == 0
    kept = words if keep.all() else [words[k] for k in np.flatnonzero(keep)]
    return n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


OUT = "d long, r binary, n_words long, n_removed long, kept_sha256 string"
FIRST_PASS = OUT + ", z binary, starts array<int>, ends array<int>, fine array<struct<a:bigint,w:bigint,p:int>>"


def _first_pass(length: int):
    def run(batches):
        open_, known = zstandard.ZstdDecompressor(), WordHashes()
        schema = pa.schema([("d", pa.int64()), ("r", pa.binary()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                            ("z", pa.binary()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
                            ("fine", pa.list_(pa.struct([("a", pa.int64()), ("w", pa.int64()), ("p", pa.int32())])))])
        for batch in batches:
            rows = []
            for d, r, z, found in zip(*(batch.column(k) for k in ("d", "r", "z", "found"))):
                raw, d, r = z.as_py(), d.as_py(), r.as_py()
                words = open_.decompress(raw).split() if raw else []
                found = found.as_py() or []
                gone = [(p, p + f["c"] + length - 1) for f in found
                        for p in ([] if f["first"] else [f["p"]]) + np.frombuffer(f["more"] or b"", np.int32).tolist()]
                ends = [f for f in found if f["first"] and f["end"]]
                starts, stops = [g[0] for g in gone], [g[1] for g in gone]
                fine = []
                if ends:
                    w = run_hashes(hash_words(words, known), length, 11).view(np.int64)
                    fine = [{"a": f["a"], "w": int(w[p]), "p": p} for f in ends
                            for p in range(f["p"], min(f["p"] + f["c"], len(w)))]
                if fine:
                    rows.append((d, r, len(words), None, None, raw, starts, stops, fine))
                else:
                    rows.append((d, r, len(words), *_digest(words, starts, stops), None, [], [], []))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)] if rows
                                             else [pa.array([], t.type) for t in schema], schema=schema)
    return run


def _second_pass(length: int):
    def run(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for d, r, z, starts, stops, more in zip(*(batch.column(k).to_pylist() for k in ("d", "r", "z", "starts", "ends", "more"))):
                words = open_.decompress(z).split()
                more = more or []
                rows.append((d, r, len(words), *_digest(words, starts + more, stops + [p + length for p in more])))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64()),
                                   pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.string())],
                                  names=["d", "r", "n_words", "n_removed", "kept_sha256"])
    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   seed: int = SEED) -> DataFrame:
    """Per document ``(doc_id, n_words, n_removed, kept_sha256)``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "repeats")

    def kept(df: DataFrame, name: str) -> DataFrame:
        """Written below the shared folder: cuts lineage, and gives the joins below
        plain inputs, so that adaptive execution may split a hot anchor."""
        df.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    src = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("d"), F.col(text).cast("string").alias("t"))
    body = F.coalesce(F.col("t"), F.lit(""))
    low, high = F.xxhash64(body), F.xxhash64(F.lit(1), body)
    shared = (src.groupBy("d").agg(F.min(low).alias("a"), F.max(low).alias("b"), F.min(high).alias("e"), F.max(high).alias("g"))
              .where("a <> b or e <> g").select("d", F.lit(True).alias("shared")))
    src = (src.join(kept(shared, "shared"), "d", "left")                 # ids of several texts: none in a table with a key
           .select("d", "t", F.when(F.col("shared"), F.unhex(F.md5(body.cast("binary")))).otherwise(F.lit(b"")).alias("r")))

    seeds = src.mapInArrow(_find_reaches(length, seed), "d long, r binary, a long, s long, p int, c int, more binary")
    met_times = F.sum(1 + F.coalesce(F.octet_length("more"), F.lit(0)) / 4)
    twice = kept(seeds.groupBy("a").agg(met_times.alias("n")).where("n > 1").select("a"), "twice")
    met = kept(seeds.join(twice, "a", "left_semi"), "seeds")
    firsts = met.groupBy("a", "s").agg(F.min(F.struct("d", "r", "p")).alias("f"), F.count(F.lit(1)).alias("n"))
    firsts = kept(firsts, "firsts")
    ends = kept(firsts.groupBy("a").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "ends")
    firsts = firsts.join(ends, "a", "left").select("a", "s", "f", "n", F.col("m").isNotNull().alias("end"))
    firsts = kept(firsts, "marked")
    here = (F.col("d") == F.col("f.d")) & (F.col("r") == F.col("f.r")) & (F.col("p") == F.col("f.p"))
    found = (met.join(firsts, ["a", "s"]).where(~here | F.col("end") | F.col("more").isNotNull())
             .select("d", "r", F.struct("p", "c", "a", here.alias("first"), "end", "more").alias("x"))
             .groupBy("d", "r").agg(F.collect_set("x").alias("found")))      # bounded by the document's length
    packed = src.mapInArrow(_pack_identified, "d long, z binary, r binary")
    (packed.join(found, ["d", "r"], "left").mapInArrow(_first_pass(length), FIRST_PASS).write.parquet(f"{path}/first"))
    state = spark.read.parquet(f"{path}/first")
    fine = state.where(F.col("kept_sha256").isNull()).select("d", "r", F.explode("fine").alias("x")).select("d", "r", "x.*")
    lead = kept(fine.groupBy("a", "w").agg(F.min(F.struct("d", "r", "p")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1"), "lead")
    more = (fine.join(lead, ["a", "w"]).where((F.col("d") != F.col("f.d")) | (F.col("r") != F.col("f.r")) | (F.col("p") != F.col("f.p")))
            .groupBy("d", "r").agg(F.collect_set("p").alias("more")))
    rest = (state.where(F.col("kept_sha256").isNull()).select("d", "r", "z", "starts", "ends").join(more, ["d", "r"], "left")
            .mapInArrow(_second_pass(length), OUT))
    done = state.where(F.col("kept_sha256").isNotNull()).select("d", "r", "n_words", "n_removed", "kept_sha256").unionByName(rest)
    return done.select(F.when(F.col("d") != NULL_ID, F.col("d")).alias(doc_id), "n_words", "n_removed", "kept_sha256")
