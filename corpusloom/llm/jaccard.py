"""Size-aware heavy-light join of documents by the Jaccard similarity of word n-grams.

A document's set holds its distinct ``shingle``-word runs (ASCII letters lower-cased;
with fewer words the whole sequence is the one element). Two documents link when
100 * |intersection| >= percent * |union|. The result names the component of every
document; equal sets are one class first, so copies never meet each other.

* Light sets (size <= boundary) list their fixed-size subsets: sets of sizes n <= m
  link exactly when they share a subset of c(n, m) elements, c being the least
  overlap that the threshold allows. A common subset is a link; within one subset
  group a star around one set of the smaller size carries all links.
* Heavy sets are found by scanning inverted lists: a set is listed under the first
  elements of a global order, as many as it could lack and still link, plus one
  (rare elements first, by a bounded sample; any order is exact). Within a list,
  sets of unlike size, or whose 2,048-bit parity sketches differ in more bits than
  the threshold allows, cannot link and are passed over.
* The boundary is chosen by cost from the histogram of set sizes.
* Pairs of both kinds are verified on the exact sets, in the JVM.

No pair is made that components do not need. A first scan proposes, for each set of
a list block of about ``BLOCK`` sets, its closest earlier set; of these the closest of
all lists is verified, and the links give components; a second scan proposes every remaining possible pair between *different*
components. In a longer list the entries of its largest component meet only those
outside it, block by block, so a group of near copies costs bit operations and rows in
proportion to its size.

Every stage holds one Python operator at most, and what an operator gives out is
bounded in rows or bytes.

The nodes of the graph are classes, ordered by their smallest id, which is the label
of a component; rows that share an id or have none are told apart by their text.

Defined cases: null, blank and word-free texts have size 0 and are alone; a null id
names a component only when no row of it has an id (then null); one id with several
texts may label several components; repeated rows are equal sets;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD_CLASS, ascii_lower
from corpusloom.llm.components import components
from corpusloom.llm.substrings import WordHashes, _text_batches, hash_words, run_hashes
from corpusloom.session import scratch_path

BLOCK = 2048
SAMPLE_DOCS = 10_000          # documents that decide the order of elements
SAMPLE_ELEMENTS = 50_000      # their most frequent elements, moved to the end of the order
MAX_LIGHT = 40                # sizes considered for the boundary
SCAN_COST = 8                 # cost of a list entry relative to a subset
SKETCH_BITS = 2048
LARGE = 512                   # sets with cell counts besides their parities
KEEP_WORDS = 30_000
SLICE_BYTES = 512 << 10       # texts hashed together
GIVEN = 50_000                # subsets given out together
MAX_SENT = 1_000_000          # keys of texts that are broadcast; more are joined by a shuffle
NO_ID = (1 << 63) - 1


def overlap(n: int, m: int, percent: int) -> int:
    """Least intersection of linked sets of sizes n and m."""
    return -(-percent * (n + m) // (100 + percent))


def partner_sizes(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subset_count(n: int, boundary: int, percent: int) -> int:
    from math import comb
    return sum(comb(n, overlap(n, m, percent)) for m in partner_sizes(n, percent) if m <= boundary)


def listed(n: int, percent: int) -> int:
    """Entries of a set of size n: what it may lack against any partner, plus one."""
    return n - -(-percent * n // 100) + 1


def choose_boundary(histogram: dict[int, int], percent: int) -> int:
    """Size up to which subsets cost less than list entries, for these set sizes."""
    best, best_cost = 0, None
    for x in range(MAX_LIGHT + 1):
        cost = sum(k * (subset_count(n, x, percent) if n <= x else 0) + k * SCAN_COST * (listed(n, percent) if 100 * n // percent > x else 0)
                   for n, k in histogram.items() if n <= 2 * MAX_LIGHT)
        if best_cost is None or cost < best_cost:
            best, best_cost = x, cost
    return best


def shingle_sets(words_hashed: list[np.ndarray], size: int) -> list[np.ndarray]:
    """Sorted distinct element hashes of each document."""
    lens = np.array([len(h) for h in words_hashed])
    if not len(lens):
        return []
    h = np.concatenate(words_hashed)
    runs = run_hashes(h, size, 3)
    first = np.concatenate([[0], np.cumsum(lens)[:-1]])
    out = []
    for own, k, n in zip(words_hashed, first, lens):
        if n >= size:
            out.append(np.unique(runs[k:k + n - size + 1]))
        else:
            out.append(run_hashes(own, n, 100 + n) if n else np.zeros(0, np.uint64))
    return out


def _class_of(s: np.ndarray) -> int:
    """64-bit name of a set (signed); 0 for the empty set."""
    h = xxhash.xxh64_intdigest(s.tobytes()) if len(s) else 0
    return h - (1 << 64) if h >= 1 << 63 else h


class _Words(WordHashes):
    """A smaller cache: most words of a text are among the frequent ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEEP_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _sets(batches, size, known=None):
    known = _Words() if known is None else known
    for ids, texts in _text_batches(batches, SLICE_BYTES):
        yield ids, shingle_sets([hash_words(t.split(), known) for t in texts], size)


def _sketch(s: np.ndarray) -> bytes:
    """Parity of the number of elements in each of ``SKETCH_BITS`` hash cells."""
    bits = np.bincount((s >> np.uint64(20)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _placed_sets(batch, size, known):
    """``(first row, (ids, sets))`` of the slices of a batch."""
    at = 0
    for ids, sets in _sets([batch], size, known):
        yield at, (ids, sets)
        at += len(ids)


def _text_hash(text: str) -> list:
    """Two 64-bit hashes of the text, ``h1`` and ``h2``."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return [F.xxhash64(t).alias("h1"), F.xxhash64(F.lit(1), t).alias("h2")]


def _names(size: int):
    def run(batches):
        known = _Words()
        for batch, at, ids, sets in ((b, at, *x) for b in batches for at, x in _placed_sets(b, size, known)):
            yield pa.record_batch({"d": pa.array(ids, pa.int64()), "h1": batch.column(2).slice(at, len(ids)),
                                   "h2": batch.column(3).slice(at, len(ids)), "n": pa.array([len(s) for s in sets], pa.int64()),
                                   "cls": pa.array([_class_of(s) for s in sets], pa.int64()),
                                   "sketch": pa.array([_sketch(s) for s in sets], pa.binary())})
    return run


def _elements(size: int):
    def run(batches):
        for _, sets in _sets(batches, size):
            for s in sets:
                yield pa.record_batch({"e": s.view(np.int64)})
    return run


def _first_elements(s: np.ndarray, k: int, common: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The first ``k`` elements of a sorted set in the global order: those not known to
    be frequent by hash, then the frequent ones by their count."""
    if not len(common):
        return s[:k]
    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
    often = common[at] == s
    rare = s[~often]
    if len(rare) >= k:
        return rare[:k]
    rest = s[often]
    return np.concatenate([rare, rest[np.lexsort((rest, weight[at[often]]))[:k - len(rare)]]])


LISTS = "lo int, hi int, e long, cls long, n int"


def _lists(size: int, percent: int, boundary: int, frequent):
    """Rows ``(lo, hi, e, cls, n)``: the subsets of light sets (sizes lo <= hi of the
    pair they serve, e the subset's hash) and the list entries of heavy ones (lo 0)."""
    def subsets(rows):
        lo, hi, lens, e, cls, n = rows
        wide = lambda x, t: np.repeat(np.array(x, t), lens)
        return pa.record_batch({"lo": wide(lo, np.int32), "hi": wide(hi, np.int32), "e": np.array(e, np.int64),
                                "cls": wide(cls, np.int64), "n": wide(n, np.int32)})

    def run(batches):
        common, weight = frequent.value
        rows = [[], [], [], [], [], []]
        for _, sets in _sets(batches, size):
            heavy, lens, names = [], [], []
            for s in sets:
                m = len(s)
                if not m:
                    continue
                name = _class_of(s)
                if m <= boundary:
                    own = s.tolist()
                    for other in partner_sizes(m, percent):
                        if other <= boundary:
                            at = len(rows[3])
                            rows[3].extend(hash(x) for x in combinations(own, overlap(m, other, percent)))
                            for column, v in zip((rows[0], rows[1], rows[2], rows[4], rows[5]), (min(m, other), max(m, other), len(rows[3]) - at, name, m)):
                                column.append(v)
                    if len(rows[3]) >= GIVEN:
                        yield subsets(rows)
                        rows = [[], [], [], [], [], []]
                if 100 * m // percent > boundary:
                    own = _first_elements(s, listed(m, percent), common, weight)
                    heavy.append(own)
                    lens.append(len(own))
                    names.append((name, m))
            if heavy:
                flat = np.concatenate(heavy).view(np.int64)
                zero = np.zeros(len(flat), np.int32)
                yield pa.record_batch({"lo": zero, "hi": zero, "e": flat, "cls": np.repeat(np.array([x for x, _ in names], np.int64), lens),
                                       "n": np.repeat(np.array([x for _, x in names], np.int32), lens)})
        if rows[3]:
            yield subsets(rows)
    return run


def _cell_counts(s: np.ndarray) -> bytes | None:
    """Elements in each of ``SKETCH_BITS`` hash cells, up to 255, of a large set. Parity
    says little about many elements; the counts of two sets differ by no more in sum
    than the sets differ in elements."""
    if len(s) < LARGE:
        return None
    return np.minimum(np.bincount((s >> np.uint64(20)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS), 255).astype(np.uint8).tobytes()


def _keep_sets(size: int):
    """``(cls, n, counts, s)``: name, size, cell counts and elements of the set of each text."""
    def run(batches):
        for _, sets in _sets(batches, size):
            ends = np.cumsum([0] + [len(s) for s in sets])
            flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            yield pa.record_batch({"cls": pa.array([_class_of(s) for s in sets], pa.int64()), "n": pa.array([len(s) for s in sets], pa.int32()),
                                   "counts": pa.array([_cell_counts(s) for s in sets], pa.binary()),
                                   "s": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))})
    return run


def _near_in_counts(percent: int):
    """The pairs ``(x, y, n, counts, m, others)`` whose cell counts allow a link."""
    def run(batches):
        for b in batches:
            n, m = (b.column(c).to_numpy().astype(np.int64) for c in (2, 4))
            ok = np.ones(b.num_rows, bool)
            for k, (p, q) in enumerate(zip(b.column(3), b.column(5))):
                if p.is_valid and q.is_valid:
                    own, other = (np.frombuffer(v.as_buffer(), np.uint8).astype(np.int16) for v in (p, q))
                    ok[k] = _room(n[k], m[k], int(np.abs(own - other).sum()), percent) >= 0
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["x", "y"]).filter(pa.array(ok))
    return run


def _room(n, m, apart, percent):
    """Differing elements that sets of sizes n, m may still have beyond the sketch bits seen."""
    return n + m - 2 * -(-percent * (n + m) // (100 + percent)) - apart


def _block_pairs(n, cls, comp, side, sketch, percent, every):
    """Pairs (later, earlier, differing sketch bits) of one list block: all between
    components, or the closest earlier set of each and, as pairs (x, x), the sets that
    have any possible partner. The order is that of sizes, then of names."""
    order = np.lexsort((cls, n))
    n, cls, comp, side, sketch = n[order], cls[order], comp[order], side[order], sketch[order]
    two = bool((side != side[0]).any())                          # two blocks: only pairs across them
    lowest = np.searchsorted(n, -(-percent * n // 100))
    xs, ys, ds, touched = [], [], [], np.zeros(len(n), bool)
    for i in range(1, len(n)):
        lo = lowest[i]
        if lo == i:
            continue
        ok = cls[lo:i] != cls[i]
        if two:
            ok &= side[lo:i] != side[i]
        if every:
            ok &= comp[lo:i] != comp[i]
            if not ok.any():
                continue
        at = lo + np.flatnonzero(ok)
        apart = np.bitwise_count(sketch[at] ^ sketch[i]).sum(axis=1, dtype=np.int64)
        fits = _room(n[at], n[i], apart, percent) >= 0
        at, apart = at[fits], apart[fits]
        if len(at):
            touched[at] = touched[i] = True
            if not every:
                least = [np.argmin(apart)]
                at, apart = at[least], apart[least]
            xs.append(np.full(len(at), cls[i]))
            ys.append(cls[at])
            ds.append(apart)
    if not every:
        xs.append(cls[touched])
        ys.append(cls[touched])
        ds.append(np.zeros(touched.sum(), np.int64))
    return xs, ys, ds


def _propose(percent: int, every: bool):
    """Candidate pairs of the list blocks of a partition sorted by block.

    Blocks of two sets, by far the most, are tested all at once; longer ones one by
    one. A block that runs over the end of a batch waits for the next batch.
    """
    def pairs(t: pa.Table) -> pa.RecordBatch:
        cls, comp, side = (t[c].to_numpy() for c in ("cls", "comp", "side"))
        n = t["n"].to_numpy().astype(np.int64)
        sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint64).reshape(len(n), SKETCH_BITS // 64)
        first = np.flatnonzero(_new_block(t))
        sizes = np.diff(np.append(first, len(n)))
        a = first[sizes == 2]
        b = a + 1
        apart = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64)
        ok = (cls[a] != cls[b]) & (np.minimum(n[a], n[b]) >= -(-percent * np.maximum(n[a], n[b]) // 100)) & (_room(n[a], n[b], apart, percent) >= 0)
        if every:
            ok &= comp[a] != comp[b]
        a, b, apart = a[ok], b[ok], apart[ok]
        swap = (n[a] > n[b]) | ((n[a] == n[b]) & (cls[a] > cls[b]))
        xs, ys, ds = [np.where(swap, cls[a], cls[b])], [np.where(swap, cls[b], cls[a])], [apart]      # the closest is the only one
        if not every:
            for met in (a, b):
                xs.append(cls[met])
                ys.append(cls[met])
                ds.append(np.zeros(len(met), np.int64))
        for lo, size in zip(first[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            own = slice(lo, lo + size)
            if every and (comp[own] == comp[lo]).all():
                continue
            more = _block_pairs(n[own], cls[own], comp[own], side[own], sketch[own], percent, every)
            for held, new in zip((xs, ys, ds), more):
                held += new
        return pa.record_batch({"x": np.concatenate(xs), "y": np.concatenate(ys), "apart": np.concatenate(ds).astype(np.int32)})

    def run(batches):
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            last = int(np.flatnonzero(_new_block(t))[-1]) if t.num_rows else 0
            if last:
                yield pairs(t.slice(0, last).combine_chunks())
            rest = t.slice(last)
        if rest is not None and rest.num_rows:
            yield pairs(rest.combine_chunks())
    return run


def _new_block(t: pa.Table) -> np.ndarray:
    """True at the first row of each block (e, i, j)."""
    out = np.zeros(t.num_rows, bool)
    out[:1] = True
    for c in ("e", "i", "j"):
        v = t[c].to_numpy()
        out[1:] |= v[1:] != v[:-1]
    return out


def _candidates(blocks: DataFrame, sketches: DataFrame, percent: int, every: bool) -> DataFrame:
    return (blocks.join(sketches, "cls").select("e", "i", "j", "cls", "n", "comp", "side", "sketch")
            .repartition("e", "i", "j").sortWithinPartitions("e", "i", "j")
            .mapInArrow(_propose(percent, every), "x long, y long, apart int").distinct())


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, path: str) -> DataFrame:
    """The pairs whose exact sets link. Pairs that the cell counts rule out are dropped
    before any set is moved."""
    small = sets.select("cls", "n", "counts")
    (pairs.where("x <> y").select("x", "y").join(small.toDF("x", "n", "counts"), "x").join(small.toDF("y", "m", "others"), "y")
     .select("x", "y", "n", "counts", "m", "others").mapInArrow(_near_in_counts(percent), "x long, y long").write.parquet(path))
    pairs = pairs.sparkSession.read.parquet(path)
    own = sets.select(F.col("cls").alias("x"), F.col("s").alias("sx"))
    other = sets.select(F.col("cls").alias("y"), F.col("s").alias("sy"))
    both = F.size(F.array_intersect("sx", "sy"))
    return (pairs.join(own, "x").join(other, "y")
            .where((100 + percent) * both >= percent * (F.size("sx") + F.size("sy"))).select("x", "y"))


def _size_neighbours(entries: DataFrame, percent: int) -> DataFrame:
    """The distinct entries ``(e, cls, n)`` whose list holds another set of like size. A
    list is counted by size first: no task sees the entries of one list together."""
    sizes = entries.groupBy("e", "n").agg(F.min("cls").alias("a"), F.max("cls").alias("b"))
    near = Window.partitionBy("e").orderBy("n")
    like = (sizes.withColumns({"before": F.lag("n").over(near), "after": F.lead("n").over(near)})
            .where((F.col("a") != F.col("b")) | (100 * F.col("before") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("after")))
            .select("e", "n"))
    return entries.distinct().join(like, ["e", "n"], "left_semi").select("e", "cls", "n")


def _between_components(placed: DataFrame) -> DataFrame:
    """List blocks ``(e, cls, n, comp, side, i, j)`` that bring together all entries of
    different components. The largest component of a list is cut into blocks that meet
    the blocks of the others; its entries never meet each other."""
    per = placed.groupBy("e", "comp").agg(F.count(F.lit(1)).alias("k"))
    per = per.groupBy("e").agg(F.max(F.struct("k", "comp")).alias("top"), F.sum("k").alias("g"), F.count(F.lit(1)).alias("comps"))
    blocks = lambda k: F.ceil(k / BLOCK).cast("int")
    whole = F.col("g") <= BLOCK
    cuts = per.where("comps > 1").select(
        "e", F.col("top.comp").alias("top"), whole.alias("whole"), F.when(whole, 1).otherwise(blocks(F.col("g") - F.col("top.k"))).alias("others"),
        F.when(whole, 0).otherwise(blocks(F.col("top.k"))).alias("tops"))
    rows = placed.join(cuts, "e")
    h = F.xxhash64("cls")
    in_top = ~F.col("whole") & (F.col("comp") == F.col("top"))
    rows = rows.withColumn("side", F.when(in_top, F.col("others") + F.pmod(h, F.greatest("tops", F.lit(1)))).otherwise(F.pmod(h, F.col("others"))).cast("int"))
    # an entry of the largest component meets the blocks of the others; any other entry meets all blocks
    last = F.when(in_top, F.col("others")).otherwise(F.col("others") + F.col("tops")) - 1
    return (rows.withColumn("to", F.explode(F.sequence(F.lit(0), last)))
            .select("e", "cls", "n", "comp", "side", F.least("side", "to").alias("i"), F.greatest("side", "to").alias("j")))


def _membership(docs: DataFrame, shingle: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text",
               boundary: int | None = None) -> DataFrame:
    """``(d, h1, h2, n_shingles, root)`` per row of ``docs``: the id (``NO_ID`` for a null
    one), the hashes of the text, and the least class ``(d, cls)`` reachable by links,
    where ``d`` is the smallest id of the class (null for a row without words)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "jaccard")
    src = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("d"),
                      ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("t"))
    hashed = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("d"),
                         ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("t"), *_text_hash(text))
    hashed.mapInArrow(_names(shingle), "d long, h1 long, h2 long, n long, cls long, sketch binary").write.parquet(f"{path}/names")
    names = spark.read.parquet(f"{path}/names")
    classes = (names.where("n > 0").groupBy("cls", "n").agg(F.min(F.struct("d", "h1", "h2")).alias("r"))
               .select("cls", "n", F.col("r.d").alias("rep"), F.col("r.h1").alias("h1"), F.col("r.h2").alias("h2")))
    if boundary is None:
        sizes = classes.where(F.col("n") <= 2 * MAX_LIGHT).groupBy("n").count().collect()     # at most 2 * MAX_LIGHT rows
        boundary = choose_boundary({r["n"]: r["count"] for r in sizes}, percent)
    # the order of elements: frequent ones of a bounded sample last (about SAMPLE_DOCS documents by hash)
    share = max(1, round(1_000_000 * min(1.0, SAMPLE_DOCS / max(1, names.count()))))
    sample = src.where(F.pmod(F.xxhash64("d"), F.lit(1_000_000)) < share)
    sample.mapInArrow(_elements(shingle), "e long").groupBy("e").count().where("count > 2").write.parquet(f"{path}/frequent")
    seen = spark.read.parquet(f"{path}/frequent")
    least, held = 3, 0
    for r in sorted(seen.groupBy("count").agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True):   # at most SAMPLE_DOCS counts
        held += r["k"]
        if held > SAMPLE_ELEMENTS:
            least = r["count"] + 1
            break
    top = seen.where(F.col("count") >= least).collect()                                                 # at most SAMPLE_ELEMENTS
    common = np.array([r["e"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(common)
    frequent = spark.sparkContext.broadcast((common[order], np.array([r["count"] for r in top], np.int64)[order]))

    # one pass writes the subsets of light sets and the list entries of heavy ones
    src.mapInArrow(_lists(shingle, percent, boundary, frequent), LISTS).write.parquet(f"{path}/lists")
    lists = spark.read.parquet(f"{path}/lists")

    # light: equal subsets are links to the least set of the smaller size
    key = ["lo", "hi", "e"]
    subsets = lists.where("lo > 0").distinct()
    centre = (subsets.groupBy(*key).agg(F.min(F.when(F.col("n") == F.col("lo"), F.col("cls"))).alias("y"), F.count(F.lit(1)).alias("k"))
              .where("k > 1 and y is not null"))
    light = subsets.join(centre, key).where("cls <> y").select(F.col("cls").alias("x"), "y").distinct()

    # heavy: lists met by two classes of like size
    entries = lists.where("lo = 0").select("e", "cls", "n")
    met = entries.groupBy("e").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a <> b").select("e")
    met.write.parquet(f"{path}/shared")
    entries.join(spark.read.parquet(f"{path}/shared"), "e", "left_semi").write.parquet(f"{path}/shared_entries")
    _size_neighbours(spark.read.parquet(f"{path}/shared_entries"), percent).write.parquet(f"{path}/met")
    met = spark.read.parquet(f"{path}/met")
    cuts = (met.groupBy("e").agg(F.count(F.lit(1)).alias("g"))
            .select("e", F.ceil(F.col("g") / BLOCK).cast("int").alias("nb")))
    own_block = F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int")
    spots = (met.join(cuts, "e").withColumns({"comp": F.col("cls"), "side": F.lit(0), "i": own_block, "j": own_block})
             .select("e", "cls", "n", "comp", "side", "i", "j"))
    rep = classes.select("cls", "rep")
    sketches = (names.join(met.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(F.first("sketch").alias("sketch")))
    _candidates(spots, sketches, percent, every=False).write.parquet(f"{path}/near")
    near = spark.read.parquet(f"{path}/near")
    # one pair per set is verified first, its closest earlier set of all lists; what it misses is left to the second scan
    closest = (near.where("x <> y").groupBy("x").agg(F.min(F.struct("apart", "y")).alias("c")).select("x", F.col("c.y").alias("y")))
    light.unionByName(closest).distinct().write.parquet(f"{path}/pairs")
    pairs = spark.read.parquet(f"{path}/pairs")
    # exact sets of the classes that have any possible partner, or may have one in another block: from one text of each
    wanted = (pairs.select(F.explode(F.array("x", "y")).alias("cls")).unionByName(near.where("x = y").select(F.col("x").alias("cls")))
              .unionByName(met.join(cuts.where("nb > 1"), "e").select("cls")).distinct().join(classes, "cls").select("h1", "h2"))
    wanted.write.parquet(f"{path}/wanted")
    wanted = spark.read.parquet(f"{path}/wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= MAX_SENT else wanted
    (hashed.select("h1", "h2", "d", "t").join(wanted, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"]).select("d", "t")
     .mapInArrow(_keep_sets(shingle), "cls long, n int, counts binary, s array<long>").write.parquet(f"{path}/sets"))
    sets = spark.read.parquet(f"{path}/sets")

    node = rep.select("cls", F.struct(F.col("rep").alias("d"), "cls").alias("node"))

    def by_rep(links):
        return (links.join(node.withColumnsRenamed({"cls": "x", "node": "u"}), "x")
                .join(node.withColumnsRenamed({"cls": "y", "node": "v"}), "y").select("u", "v"))

    def rooted(tree):
        tree = tree.select(F.col("node.cls").alias("cls"), "root")
        return node.join(tree, "cls", "left").select("cls", F.coalesce("root", "node").alias("root"))

    _verified(pairs, sets, percent, f"{path}/near_pairs").write.parquet(f"{path}/links")
    roots = components(by_rep(spark.read.parquet(f"{path}/links")))
    comp = rooted(roots).select("cls", F.col("root.cls").alias("comp"))
    # second scan: only lists that still hold several components
    met.join(comp, "cls").select("e", "cls", "n", "comp").write.parquet(f"{path}/placed")
    rest = _candidates(_between_components(spark.read.parquet(f"{path}/placed")), sketches, percent, every=True)
    by_rep(_verified(rest, sets, percent, f"{path}/near_rest")).write.parquet(f"{path}/rest")
    final = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(spark.read.parquet(f"{path}/rest")))
    return (names.join(rooted(final), "cls", "left")
            .select("d", "h1", "h2", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("root")).alias("root")))


def component_report(docs: DataFrame, **kw) -> DataFrame:
    """Per document ``(doc_id, n_shingles, component_id)``."""
    idn = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    found = _membership(docs, **kw).withColumn("component", F.coalesce("root.d", "d"))
    return found.select(idn("d").alias("doc_id"), F.col("n_shingles").cast("long").alias("n_shingles"),
                                         idn("component").alias("component_id"))


def representatives(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row of each group of linked documents: the one with the smallest id (a null
    id is the largest), of rows that share it the one with the smallest text hash.
    Rows without words all stay."""
    m = _membership(docs, shingle, percent, doc_id, text).where("n_shingles > 0")
    least = m.groupBy("root").agg(F.min(F.struct("d", "h1", "h2")).alias("f"))
    key = ["_jc_d", "_jc_h1", "_jc_h2"]
    least = least.select(*[F.col(f"f.{c[4:]}").alias(c) for c in key])
    own = [F.col(f"`{c}`") for c in docs.columns]
    h1, h2 = _text_hash(text)
    worded = F.coalesce(F.col(text), F.lit("")).rlike(WORD_CLASS)
    rows = docs.where(worded).withColumns({"_jc_d": F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)), "_jc_h1": h1, "_jc_h2": h2})
    one = Window.partitionBy(*key).orderBy(F.col(text))                # rows that repeat id and text
    return (rows.join(least, key, "left_semi").withColumn("_jc_n", F.row_number().over(one)).where("_jc_n = 1").select(*own)
            .unionByName(docs.where(~worded).select(*own)))
