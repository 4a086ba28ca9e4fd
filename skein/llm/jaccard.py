"""Exact Jaccard self-join of documents' word shingles in metric space.

Both the Jaccard distance and the symmetric difference of sets are metrics, and
the join prunes by the triangle inequality at each level:

1. *Sizes.*  The empty set as pivot: the sizes of two linked sets differ by a
   bounded factor.  Sets fall into bands by size, and a set near its band's
   upper end is replicated into the next band (the window).
2. *Projections.*  Within a band, linked sets differ in at most ``k`` shingles.
   The shingles' universe is cut into more than ``k`` parts; two linked sets
   agree entirely in some part.  Each part's contents are a pivot of that
   part's subspace, and the sets at distance 0 from it are its region.
   (Between unrelated texts the plain Jaccard distance is close to 1, so
   document pivots alone have windows that hold everything; measured, see
   README.)  A set leaves out its most frequent parts, as many as
   may go for linked sets to agree in one more: regions that boilerplate makes
   of unlike texts mostly vanish, and no link is lost.
3. *Documents.*  Every set has a sketch: how many of its shingles fall into each
   of as many buckets as it has shingles (a power of two), modulo 256.  The L1
   distance of sketches, the shorter way round in each bucket, obeys the
   triangle inequality and is never over the sets' symmetric difference; so is
   that of coarse sketches, a quarter as long, which the rows of regions carry.  In
   each region the set with the least hash is the pivot; regions with the same
   pivot are joined, and the sketch distance of all their other sets from it
   is computed; where that is low enough, the exact Jaccard distance too.
   Sets within the radius are linked to the pivot and need no comparison with
   each other.  The others, with the linked ones as far as needed, fall into
   Voronoi rings around the pivot, as wide as linked sets can differ; a ring's
   cell gets the next ring replicated as its boundary, for linked sets lie at
   most one ring apart.
4. *Recursion.*  A cell with more than ``CELL`` members chooses its own pivot
   and goes through step 3 again, up to ``DEPTH`` times; then it is cut into
   blocks, and pairs of blocks are compared.  In a cell, all sketches are
   compared; sets whose sketches are near form groups, and the groups are
   compared exactly by a product of their membership matrices.

Nothing is capped: every pair of linked sets meets in some region, is either
compared or known to have a common neighbour.  Sets that are equal are one
class from the start, so copies are never compared.  Shingles are 64-bit
hashes.

Defined results: null, empty and wordless texts have no shingles and stay
alone; fewer words than a shingle make one shingle; rows with equal ids get
the same component if their sets are equal or linked; a component's id is its
least id (null ids are left aside, and a component of null ids has null).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import LOWER, SPACED, append, chunks, discarded, mix, released, ship, stored, trimmed, utf8, window_hashes, word_hashes, words
from skein.llm.components import components

#: A band's upper size as a multiple of its lower one.
BAND = 1.5
#: Members of a cell that one task compares, and levels of document pivots.
CELL = 1000
DEPTH = 2
#: 64-bit words of the filters that tell tasks which parts and sets are needed again: 8 to 16 bits a key, and 32 MB
#: at most.  Beyond 33 million keys a filter lets more and more through, and the joins after it drop that.
FILTER_WORDS = 1 << 22
#: Words of a filter that the driver collects at once: beside the filter itself it never holds more of it.
PIECE = 1 << 19
#: One part in so many, more or less, is spare: the most frequent parts of a set, which texts share that are not alike
#: (boilerplate), need not be compared.
SPARE = 4
#: Coarse sketches have a quarter of a sketch's buckets, and 2^COARSE at least where the sketch has as many.
COARSE = 5


def _edges() -> np.ndarray:
    at, out = 1, []
    while at < 1 << 40:
        out.append(at)
        at = int(at * BAND) + 1
    return np.array(out, dtype=np.int64)


EDGES = _edges()


def _sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = utf8(texts)
    for lo, hi in chunks(offsets):
        part = LOWER[data[offsets[lo] : offsets[hi]]]
        s, e, d = words(part, offsets[lo : hi + 1] - offsets[lo], SPACED)
        h = word_hashes(part, s, e)
        shingles, cut = window_hashes(h, size), np.searchsorted(d, np.arange(hi - lo + 1)).tolist()
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            yield np.unique(shingles[a : b - size + 1]) if b - a >= size else window_hashes(h[a:b], b - a) if b > a else h[:0]


def signatures(x: np.ndarray, num: int, den: int) -> np.ndarray:
    """Hashes of the parts of a set, for its band and, in the window, the next one."""
    return parts_of(x, num, den)[0]


def parts_of(x: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`signatures`, and beside each how many of the set's parts of that band may still be left out, times
    two, plus which of the set's bands it is."""
    n, out, drops = len(x), [], []
    band = int(np.searchsorted(EDGES, n, side="right")) - 1
    for slot, i in enumerate(sorted({band, int(np.searchsorted(EDGES, n * den // num, side="right")) - 1}) if n else ()):
        differ = (den - num) * 2 * int(EDGES[i + 1] - 1) // (den + num)
        if not differ:
            continue  # linked sets of this band are equal
        # Up to ``spare`` parts may be left out, the empty ones and then the most frequent: linked sets agree in one
        # more part than that, and the rarest of these is among the first ``spare`` of neither set.
        spare = 1 + differ // SPARE
        m = differ + 1 + spare
        part = ((x >> np.uint64(7)) % np.uint64(m)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        p = part[order]
        first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
        value, which = np.add.reduceat(mix(x[order] + np.uint64(1)), first), p[first]
        left = spare - (m - len(first))
        if left < 0:
            left = 0
            full = np.zeros(m, dtype=np.uint64)
            full[which] = value
            value, which = full, np.arange(m)
        out.append(mix(value + mix(which.astype(np.uint64) + np.uint64(i << 40))))
        drops.append(np.full(len(value), 2 * left + slot, dtype=np.int64))
    return (np.concatenate(out), np.concatenate(drops)) if out else (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))


def level_of(n: int) -> int:
    """A sketch of n shingles has 2^level buckets: one or two shingles in each."""
    return max(0, n.bit_length() - 1)


def coarse_level(level):
    """The level of the coarse sketch; it never falls as the set grows."""
    return np.minimum(level, np.maximum(level - 2, COARSE))


def sketch(x: np.ndarray) -> bytes:
    """Shingles in each bucket modulo 256, a byte each."""
    k = level_of(len(x))
    counts = np.bincount((x >> np.uint64(64 - k)).astype(np.int64) if k else np.zeros(len(x), dtype=np.int64), minlength=1 << k)
    return counts.astype(np.uint8).tobytes()


def coarser(counts: np.ndarray, buckets: int) -> np.ndarray:
    """Sketches (rows) with fewer buckets: neighbours are added, modulo 256."""
    return counts.reshape(len(counts), buckets, -1).sum(axis=2, dtype=np.uint8)


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of sketches (rows) with equally many buckets: a bucket's is the shorter way round 256, so it is never
    over the buckets' difference, and the triangle inequality holds."""
    d = x - y
    return np.minimum(d, np.uint8(0) - d).sum(axis=1, dtype=np.int64)


def _stacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all sketches, where each begins, and their numbers of buckets."""
    data, at = utf8(column)
    return data, at[:-1], np.diff(at)


def _taken(data: np.ndarray, at: np.ndarray, buckets: int) -> np.ndarray:
    return data[at[:, None] + np.arange(buckets)]


def fingerprint(x: np.ndarray) -> int:
    """A hash of the set."""
    return int((mix(x ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(x))).view(np.int64))


def profiles(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, fp (a hash of the set) and sketch."""

    def step(texts: pa.Array):
        made = [(len(x), fingerprint(x), sketch(x)) for x in _sets(texts, size)]
        return [pa.array([m[i] for m in made], type=k) for i, k in enumerate((pa.int64(), pa.int64(), pa.binary()))]

    fields = [T.StructField("n_shingles", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("sketch", T.BinaryType())]
    return append(docs, ["text"], lambda: step, fields, keep=["doc_id"])


def regions_of(docs: DataFrame, size: int, num: int, den: int, ids: Broadcast, only: Broadcast | None = None) -> DataFrame:
    """(region, fp, drop): the parts of the sets of documents that the filter ``ids`` lets through, and what
    ``parts_of`` has beside them; with ``only``, the parts that this filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n = [], 0
            which = np.flatnonzero(_marked(ids.value, batch.column(1).to_numpy(zero_copy_only=False)))
            for x in _sets(batch.column(0).take(pa.array(which)), size):
                sig, drop = parts_of(x, num, den)
                if only is not None:
                    through = _marked(only.value, sig.view(np.int64))
                    sig, drop = sig[through], drop[through]
                held.append((sig.view(np.int64), np.full(len(sig), fingerprint(x), dtype=np.int64), drop))
                n += len(sig)
                if n > 1 << 17:
                    yield _rows(held)
                    held, n = [], 0
            if n:
                yield _rows(held)

    def _rows(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=["region", "fp", "drop"])

    ship(docs.sparkSession)
    return docs.where("doc_id is not null").select("text", F.xxhash64("doc_id")).mapInArrow(run, "region long, fp long, drop long")


def _rarest(parts: DataFrame) -> DataFrame:
    """``parts`` (region, fp, drop, often) without the most frequent ones of each set and band, as many as may go."""
    order = Window.partitionBy("fp", "drop").orderBy(F.desc("often"), "region")
    return parts.withColumn("place", F.row_number().over(order)).where(F.col("place") > F.floor(F.col("drop") / 2))


def _marks(keys: DataFrame, key: str) -> Broadcast:
    """A filter, sized by the number of keys (FILTER_WORDS at most), that lets all of them through and few others.
    The driver's JVM holds it until it is destroyed: do so when what needs it is stored."""
    n = min(FILTER_WORDS, 1 << (keys.count() // 8).bit_length())
    spot = F.pmod(F.xxhash64(key), F.lit(n * 64)) if key != "region" else F.pmod(F.col(key), F.lit(n * 64))
    marks = keys.select(spot.alias("p")).select((F.col("p") / 64).cast("long").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("b"))
    found = marks.groupBy("w").agg(F.expr("bit_or(b)").alias("b"))
    # A small one comes as it is made; of a large one each piece is read from the table of its words.
    several = stored(found, "marks") if n > PIECE else None
    bits = np.zeros(n, dtype=np.int64)
    for lo in range(0, n, PIECE):
        piece = found if several is None else several.where(F.col("w").between(lo, lo + PIECE - 1))
        for batch in piece.toArrow().to_batches():
            bits[batch["w"].to_numpy()] = batch["b"].to_numpy()
        trimmed()
    if several is not None:
        discarded(several)
    shared = keys.sparkSession.sparkContext.broadcast(bits)
    del bits
    released(keys.sparkSession)
    return shared


def _marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys % (len(bits) * 64)
    return (bits[place >> 6].view(np.uint64) >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


def contents(docs: DataFrame, wanted: DataFrame, size: int, ids: Broadcast) -> DataFrame:
    """(fp, x): the sets of ``wanted`` (fp, doc_id), recomputed from the texts.

    The filter ``ids`` of their documents keeps most others from being computed and
    shuffled.  An id may have several texts: the set is the one with the hash.
    """

    def step(texts: pa.Array, at: pa.Array):
        found: list[bytes | None] = [None] * len(texts)
        fps: list[int | None] = [None] * len(texts)
        which = np.flatnonzero(_marked(ids.value, at.to_numpy(zero_copy_only=False)))
        for i, x in zip(which.tolist(), _sets(texts.take(pa.array(which)), size), strict=True):
            found[i], fps[i] = x.tobytes(), fingerprint(x)
        return [pa.array(found, type=pa.binary()), pa.array(fps, type=pa.int64())]

    rows = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("_hash")).where("doc_id is not null")
    found = append(rows, ["text", "_hash"], lambda: step, [T.StructField("x", T.BinaryType()), T.StructField("fp", T.LongType())], keep=["doc_id"])
    return found.where("x is not null").join(wanted, ["doc_id", "fp"]).select("fp", "x").dropDuplicates(["fp"])


def _common(rows: DataFrame) -> DataFrame:
    """(pivot, fp, both, either): sizes of the intersection and the union of the sets x and y."""

    def step(xs: pa.Array, ys: pa.Array):
        both, either = [], []
        for x, y in zip(xs, ys, strict=True):
            a, b = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
            small, large = (a, b) if len(a) <= len(b) else (b, a)
            at = np.searchsorted(large, small)
            at[at == len(large)] = 0
            n = int((large[at] == small).sum())
            both.append(n)
            either.append(len(a) + len(b) - n)
        return [pa.array(both, type=pa.int64()), pa.array(either, type=pa.int64())]

    fields = [T.StructField("both", T.LongType()), T.StructField("either", T.LongType())]
    return append(rows, ["x", "y"], lambda: step, fields, keep=["pivot", "fp"])


def _join_up(n: int, pairs: Iterator[tuple[int, int]]) -> tuple[list[int], list[tuple[int, int]]]:
    """Each member's group, and as many of the pairs as join the groups."""
    parent, used = list(range(n)), []

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in pairs:
        if (p := top(i)) != (q := top(j)):
            parent[p] = q
            used.append((i, j))
    return [top(i) for i in range(n)], used


def _near_sketches(num: int, den: int):
    """The groups of a pair of blocks of a cell: sets with a chain of near sketches, of which no link of two
    sets linked to the cell's pivot is needed."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        linked, primary, block = (table[c].to_numpy() for c in ("linked", "primary", "block"))
        fps, sizes = table["fp"].to_numpy(), table["n_shingles"].to_numpy()
        order = np.argsort(sizes, kind="stable")
        linked, primary, block, fps, sizes = (v[order] for v in (linked, primary, block, fps, sizes))
        data, at, wide = _stacked(table["sketch"].combine_chunks().take(pa.array(order)))
        buckets = int(wide.min())
        counts = np.empty((len(at), buckets), dtype=np.uint8)
        for w in np.unique(wide).tolist():
            counts[wide == w] = coarser(_taken(data, at[wide == w], w), buckets)
        mixed = len(set(block.tolist())) > 1

        def pairs() -> Iterator[tuple[int, int]]:
            for i in range(len(counts) - 1):
                # The sets after it that aren't too large.
                end = int(np.searchsorted(sizes, sizes[i] * den // num, side="right"))
                if end <= i + 1:
                    continue
                apart = distance(counts[i + 1 : end], counts[i])
                near = apart * (den + num) <= (den - num) * (sizes[i + 1 : end] + sizes[i])
                near &= ~(linked[i + 1 : end] & linked[i]) & (primary[i + 1 : end] | primary[i])
                if mixed:
                    near &= block[i + 1 : end] != block[i]
                for j in np.flatnonzero(near).tolist():
                    yield i, i + 1 + j

        group, _ = _join_up(len(counts), pairs())
        of = np.array(group)
        kept = np.flatnonzero(np.bincount(of, minlength=len(of))[of] > 1)
        seed = np.uint64((key[0].as_py() * 31 + key[1].as_py() * 1000003 + key[2].as_py()) & 0xFFFFFFFFFFFFFFFF)
        return pa.table({"cell": pa.array(mix(fps[of[kept]].view(np.uint64) ^ mix(np.array([seed])))).view(pa.int64()), "fp": fps[kept], "linked": linked[kept]})

    return run


def _compare(num: int, den: int):
    """Links inside a group: enough of them to join what is linked."""

    def run(table: pa.Table) -> pa.Table:
        linked, fps = table["linked"].to_numpy(), table["fp"].to_numpy()
        xs = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in table["x"].combine_chunks()]
        sizes = np.array([len(x) for x in xs], dtype=np.int64)
        _, inverse, counts = np.unique(np.concatenate(xs), return_inverse=True, return_counts=True)
        shared = np.cumsum(counts > 1) - 1
        use = counts[inverse] > 1
        row, col = np.repeat(np.arange(len(xs)), sizes)[use], shared[inverse[use]]
        width = int(shared[-1]) + 1 if len(shared) else 0
        both = np.zeros((len(xs), len(xs)), dtype=np.float32)
        for lo in range(0, width, 4096):
            part = (col >= lo) & (col < lo + 4096)
            m = np.zeros((len(xs), min(4096, width - lo)), dtype=np.float32)
            m[row[part], col[part] - lo] = 1
            both += m @ m.T
        n = both.astype(np.int64)
        near = den * n >= num * (sizes[:, None] + sizes[None, :] - n)
        near &= ~(linked[:, None] & linked[None, :])
        a, b = np.nonzero(np.triu(near, 1))
        _, links = _join_up(len(xs), zip(a.tolist(), b.tolist(), strict=True))
        return pa.table({"u": pa.array([int(fps[i]) for i, _ in links], type=pa.int64()), "v": pa.array([int(fps[j]) for _, j in links], type=pa.int64())})

    return run


def _pairwise(xs: pa.Array, ps: pa.Array, levels: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distances of each row's two sketches: as fine as both are, and at the row's level."""
    (xd, xo, xw), (pd, po, pw) = _stacked(xs), _stacked(ps)
    at = np.minimum(xw, pw) if levels is None else np.minimum(np.minimum(xw, pw), 1 << levels)
    fine, apart = np.zeros(len(xw), dtype=np.int64), np.zeros(len(xw), dtype=np.int64)
    kinds, kind = np.unique(np.stack([xw, pw, at], axis=1), axis=0, return_inverse=True)
    for k, (w, v, m) in enumerate(kinds.tolist()):
        rows = np.flatnonzero(kind.reshape(-1) == k)
        n = min(w, v)
        x, y = coarser(_taken(xd, xo[rows], w), n), coarser(_taken(pd, po[rows], v), n)
        fine[rows] = distance(x, y)
        apart[rows] = distance(coarser(x, m), coarser(y, m)) if m < n else fine[rows]
    return fine, apart


def _may_link(a: np.ndarray, b: np.ndarray, d: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets of these sizes, with sketches so far apart, can be linked."""
    return (den * np.minimum(a, b) >= num * np.maximum(a, b)) & (d * (den + num) <= (den - num) * (a + b))


def _apart(rows: DataFrame, num: int, den: int) -> DataFrame:
    """``rows`` (region, level, pivot, fp) with sizes and coarse sketches (n, sketch; pn, psketch) becomes region,
    level, pivot, fp, n, apart (at the region's level) and near (the coarse sketches allow a link)."""

    def step(level: pa.Array, n: pa.Array, pn: pa.Array, xs: pa.Array, ps: pa.Array):
        a, b, given = (c.to_numpy(zero_copy_only=False) for c in (n, pn, level.fill_null(-1)))
        # The sizes in a region differ by less than a factor of two from its first pivot's.
        own = coarse_level(np.maximum(0, np.frexp(b.astype(np.float64))[1] - 2))
        levels = np.where(given < 0, own, given).astype(np.int64)
        fine, apart = _pairwise(xs, ps, levels)
        near = _may_link(a, b, fine, num, den)
        return [pa.array(levels, type=pa.int32()), pa.array(apart, type=pa.int64()), pa.array(near, type=pa.bool_())]

    fields = [T.StructField("level", T.IntegerType()), T.StructField("apart", T.LongType()), T.StructField("near", T.BooleanType())]
    return append(rows, ["level", "n", "pn", "sketch", "psketch"], lambda: step, fields, keep=["region", "pivot", "fp", "n"])


def _both(rows: DataFrame, classes: DataFrame, sketch: str) -> DataFrame:
    """``rows`` (pivot, fp, ...) with the sizes and sketches of both sets."""
    one = classes.select("fp", F.col("n_shingles").alias("n"), F.col(sketch).alias("sketch"))
    pivot = classes.select(F.col("fp").alias("pivot"), F.col("n_shingles").alias("pn"), F.col(sketch).alias("psketch"))
    return rows.where("fp != pivot").join(one, "fp").join(pivot, "pivot")


def _near(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Of the pairs (pivot, fp) those whose full sketches allow a link."""

    def step(n: pa.Array, pn: pa.Array, xs: pa.Array, ps: pa.Array):
        return [pa.array(_may_link(n.to_numpy(), pn.to_numpy(), _pairwise(xs, ps)[0], num, den), type=pa.bool_())]

    rows = append(_both(pairs, classes, "sketch"), ["n", "pn", "sketch", "psketch"], lambda: step, [T.StructField("near", T.BooleanType())], keep=["pivot", "fp"])
    return rows.where("near").select("pivot", "fp")


def _coarse(classes: DataFrame) -> DataFrame:
    """``classes`` with their coarse sketches."""

    def step(sketches: pa.Array):
        data, at, wide = _stacked(sketches)
        out: list[bytes | None] = [None] * len(at)
        for w in np.unique(wide).tolist():
            rows = np.flatnonzero(wide == w)
            made = coarser(_taken(data, at[rows], w), 1 << int(coarse_level(level_of(w))))
            for i, row in zip(rows.tolist(), made, strict=True):
                out[i] = row.tobytes()
        return [pa.array(out, type=pa.binary())]

    return append(classes, ["sketch"], lambda: step, [T.StructField("coarse", T.BinaryType())])


def _exact(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact intersections of pairs (pivot, fp)."""
    return _common(pairs.join(sets, "fp").join(sets.select(F.col("fp").alias("pivot"), F.col("x").alias("y")), "pivot"))


def _rings(rows: DataFrame, linked: DataFrame, num: int, den: int) -> DataFrame:
    """Cells (region, level, fp, linked, primary, n) of what is still to be compared after a round of pivots.

    ``rows``: what ``_apart`` gives; ``linked``: the pairs (pivot, fp) that are linked.
    """
    rows = rows.join(linked.withColumn("linked", F.lit(True)), ["pivot", "fp"], "left").withColumn("linked", F.coalesce("linked", F.lit(False)))
    # As far as two linked sets of the region can differ.
    most = rows.groupBy("region").agg(
        F.floor(F.lit(2 * (den - num)) * F.max("n") / F.lit(den + num)).alias("width"), F.count("*").alias("all"), F.min("linked").alias("shut")
    )
    rows = rows.join(most.where("all > 1 and not shut").select("region", F.greatest("width", F.lit(1)).alias("width")), "region")
    ring = F.floor(F.col("apart") / F.col("width"))
    # A ring is its own cell's primary part and the boundary of the cell below.
    both = F.when(ring > 0, F.array(ring, ring - 1)).otherwise(F.array(ring))
    cells = rows.select("region", "level", "fp", "linked", ring.alias("ring"), F.explode(both).alias("cell"))
    cells = cells.select(F.xxhash64("region", "cell").alias("region"), "level", "fp", "linked", (F.col("ring") == F.col("cell")).alias("primary"))
    size = cells.groupBy("region").agg(F.count("*").alias("n"), F.max("primary").alias("some"), F.min("linked").alias("shut")).where("n > 1 and some and not shut")
    return cells.join(size.select("region", "n"), "region")


def _groups(cells: DataFrame, classes: DataFrame, num: int, den: int, cell: int) -> DataFrame:
    """(cell, fp, linked): groups of sets with near sketches; cells are cut into blocks of about ``cell``
    members, of which each pair is looked at."""
    blocks = F.ceil(F.col("n") / cell).cast("int")
    rows = cells.withColumn("block", F.pmod(F.xxhash64("fp"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("region", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp", "linked", "primary")
    ship(cells.sparkSession)
    rows = rows.join(classes.select("fp", "n_shingles", F.col("coarse").alias("sketch")), "fp")
    return rows.groupBy("region", "i", "j").applyInArrow(_near_sketches(num, den), "cell long, fp long, linked boolean")


def linked_sets(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100, cell: int = CELL, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """(per document: doc_id, n_shingles, fp; links between sets by their class's least doc_id: u, v).

    Two sets link when ``den`` * intersection >= ``num`` * union.
    """
    prof, reps, found = _linked(docs, size, num, den, cell, depth)
    found = found.join(reps.select(F.col("fp").alias("u"), F.col("doc_id").alias("a")), "u").join(reps.select(F.col("fp").alias("v"), F.col("doc_id").alias("b")), "v")
    return prof.select("doc_id", "n_shingles", "fp"), found.select(F.col("a").alias("u"), F.col("b").alias("v"))


def _linked(docs: DataFrame, size: int, num: int, den: int, cell: int = CELL, depth: int = DEPTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(profiles; of each set its least doc_id: fp, doc_id; links between sets by their hashes: u, v)."""
    docs = docs.select("doc_id", "text")
    released(docs.sparkSession)
    prof = stored(profiles(docs, size), "profiles")
    some = prof.where("n_shingles > 0 and doc_id is not null")
    reps = some.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    # A document of each set will do: copies that the filter lets through are only counted more than once.
    ids = _marks(reps, "doc_id")
    shared = regions_of(docs, size, num, den, ids).groupBy("region").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = stored(shared, "shared")
    released(docs.sparkSession)
    # The parts are computed again rather than kept: a filter lets few others than the shared ones through.
    often = _marks(shared, "region")
    parts = regions_of(docs, size, num, den, ids, often).distinct()
    # Regions with the same pivot set become one: a pair that shares several parts is then compared once.
    members = stored(_rarest(parts.join(shared, "region")).select("region", "fp"), "parts")
    ids.destroy()
    often.destroy()
    released(docs.sparkSession)
    # What is left of a region may be one set, and its first pivot may have gone.
    pivots = members.groupBy("region").agg(F.min("fp").alias("pivot"), F.max("fp").alias("last")).where("pivot != last")
    members = stored(members.join(pivots, "region").select("pivot", "fp").distinct(), "regions")
    members = members.select(F.col("pivot").alias("region"), F.lit(None).cast("int").alias("level"), "pivot", "fp")
    # Equal sets are one class.
    classes = some.join(members.select("fp").distinct(), "fp", "left_semi").select("fp", "n_shingles", "sketch").dropDuplicates(["fp"])
    classes = stored(_coarse(classes), "classes")
    released(docs.sparkSession)
    close = F.lit(den) * F.col("both") >= F.lit(num) * F.col("either")
    links, groups, one = [], [], ["pivot", "fp"]
    for level in range(depth):
        rows = stored(_apart(_both(members, classes, "coarse"), num, den), "sketched")
        released(docs.sparkSession)
        pairs = stored(_near(rows.where("near").select(one).distinct(), classes, num, den), "pairs")
        needed = pairs.select("pivot").union(pairs.select("fp")).distinct().select(F.col("pivot").alias("fp"))
        needed = needed.join(reps, "fp")
        ids = _marks(needed, "doc_id")
        sets = stored(contents(docs, needed, size, ids), "sets")
        ids.destroy()
        linked = stored(_exact(pairs, sets).where(close).select(one), "linked")
        discarded(sets)
        released(docs.sparkSession)
        links.append(linked.select(F.col("pivot").alias("u"), F.col("fp").alias("v")))
        cells = stored(_rings(rows, linked, num, den), "cells")
        big, last = F.col("n") > cell, level + 1 == depth
        groups.append(stored(_groups(cells if last else cells.where(~big), classes, num, den, cell), "groups"))
        released(docs.sparkSession)
        if last or cells.where(big).isEmpty():
            break
        # Large cells choose new pivots among the sets without a link to the old one.
        cells = cells.where(big).select("region", "level", "fp", "linked")
        pivots = cells.groupBy("region").agg(F.min(F.when(~F.col("linked"), F.col("fp"))).alias("pivot"))
        members = stored(cells.join(pivots, "region").select("region", "level", "pivot", "fp"), "regions")
    near = reduce(DataFrame.unionByName, groups)
    released(docs.sparkSession)
    needed = near.select("fp").distinct().join(reps, "fp")
    ids = _marks(needed, "doc_id")
    sets = contents(docs, needed, size, ids)
    links.append(near.join(sets, "fp").groupBy("cell").applyInArrow(_compare(num, den), "u long, v long"))
    found = stored(reduce(DataFrame.unionByName, links), "found")
    ids.destroy()
    released(docs.sparkSession)
    return prof, reps, found


def _classified(docs: DataFrame, size: int, num: int, den: int, **options) -> DataFrame:
    """Per document: doc_id, n_shingles, fp, component_id, and the hash ``first`` of the set that stands for its
    component.  Components are of sets, not ids: two texts of one id are linked only if they are alike."""
    prof, _, links = _linked(docs, size, num, den, **options)
    comp = components(links).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    released(docs.sparkSession)
    reps = prof.where("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    rooted = reps.join(comp, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # The least id, and of its sets the one with the least hash; sets that have no id come last.
    least = rooted.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "fp")).alias("least"))
    # Stored, so that the join with all documents shuffles both sides, and a class with very many copies can be split.
    to = rooted.join(least, "root").select("fp", F.col("least.rep").alias("component_id"), F.col("least.fp").alias("first"))
    columns = ["doc_id", "n_shingles", "fp", "component_id", "first"]
    alone = prof.where("n_shingles = 0").select("doc_id", "n_shingles", "fp", F.col("doc_id").alias("component_id"), F.col("fp").alias("first"))
    return prof.where("n_shingles > 0").join(stored(to, "classes"), "fp").select(columns).unionByName(alone.select(columns))


def component_ids(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100, **options) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least id that links reach, itself included)."""
    return _classified(docs, size, num, den, **options).select("doc_id", "n_shingles", "component_id")


def near_duplicates_removed(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, **options) -> DataFrame:
    """``docs`` with one document of each component: that of the least id, and of its texts the one with the least
    hash.

    Documents without words stay, and so do repeated rows of the document that
    stays.  What goes is listed by id and text; a row without an id stays.
    """
    ids = _classified(docs, size, num, den, **options)
    gone = ids.where("n_shingles > 0 and not (doc_id = component_id and fp = first)").select("doc_id", "fp").distinct()
    gone = stored(gone.where("doc_id is not null"), "gone")
    several = ids.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a != b")
    several = stored(several.select("doc_id"), "several")
    released(docs.sparkSession)
    # The id tells the text, but for ids with several texts: of these the sets are looked at again.
    left = docs.join(gone.join(several, "doc_id", "left_anti").select("doc_id"), "doc_id", "left_anti")
    if several.isEmpty():
        return left.select(*docs.columns)

    def step(texts: pa.Array):
        return [pa.array([fingerprint(x) for x in _sets(texts, size)], type=pa.int64())]

    mixed = append(left.join(several, "doc_id", "left_semi"), ["text"], lambda: step, [T.StructField("_fp", T.LongType())])
    mixed = mixed.join(gone.withColumnRenamed("fp", "_fp"), ["doc_id", "_fp"], "left_anti")
    return left.join(several, "doc_id", "left_anti").select(*docs.columns).unionByName(mixed.select(*docs.columns))
