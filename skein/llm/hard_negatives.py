"""Hard negatives by exact integer scores from a residue-number-system matrix product.

Every vector's components become integers, floor(256 * x).  The score of two
rows is their integer inner product.  It is computed from products of the
component matrices modulo several primes below 256, in float32: balanced
residues are at most p/2, so a sum of up to 2^24 / (p/2)^2 products is exact.
Chinese remaindering with balanced digits then gives the signed score back.
By Cauchy and Schwarz no score is beyond the greatest squared length; as many
primes are taken as hold twice that.

A given set of anchor rows is scored against all rows in blocks (bounded rows of
either side in a task, no broadcast), twice: first for each anchor's best rows
of its own label (the positives), then for the best rows of other labels whose
score lies in a window below each positive's.  Each pair of blocks keeps its
best few, and the best of these are the result.

Rows with a null label, a null vector, or a null or non-finite component take
no part.  Components of shorter vectors count as 0 where others go on; an empty
vector scores 0 with all.  A repeated row is a row of its own (a copy of an
anchor is a possible positive of it, and an anchor itself); rows of equal score
and id are alike in the result.  A row with a null id is a candidate, after all
others of its score, never an anchor of the query.  An empty table, no anchors,
or anchors without positives give no rows.  Rows whose squared integer length
is 2^56 or more raise an error, as their scores would not fit.  Input columns
other than the three named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import ship, stored

#: Fixed rule: primes that a byte holds, the greatest first.
PRIMES = [p for p in range(255, 2, -2) if all(p % q for q in range(3, 16, 2))]

#: Rows and anchors of a pair of blocks, and the most bytes of the components of either.
BLOCK_ROWS = 16_384
BLOCK_BYTES = 8 << 20

#: Scores handled at once by the array code.
CELLS = 1 << 20

#: Squared lengths stay below this, so that a score times a percentage fits 64 bits.
LIMIT = 1 << 56

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90

BEST = "anchor long, place int, score long, id long"
BEST_ARROW = pa.schema([("anchor", pa.int64()), ("place", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])


# ------------------------------------------------------------------ arithmetic
def primes_for(bound: float) -> list[int]:
    """The first primes whose product holds every number from -bound to bound."""
    product, taken = 1, []
    for p in PRIMES:
        if product > 2 * bound + 1:
            break
        taken.append(p)
        product *= p
    return taken


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """The remainder of whole numbers (float64) that is nearest to 0."""
    return x - p * np.rint(x / p)


def residues(m: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """The matrix modulo each prime, in float32."""
    wide = m.astype(np.float64)
    return [_balanced(wide, p).astype(np.float32) for p in primes]


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all of ``b``, both given by residues."""
    total, scale, digits, scales = np.zeros((len(a[0]), len(b[0])), dtype=np.int64), 1, [], []
    for x, y, p in zip(a, b, primes):
        span = (1 << 24) // (p // 2) ** 2
        rest = np.zeros(total.shape)
        for lo in range(0, x.shape[1], span):
            rest = _balanced(rest + x[:, lo : lo + span] @ y[:, lo : lo + span].T, p)
        # The next digit in mixed radix: what the digits so far leave, over their scale, modulo p.
        for digit, s in zip(digits, scales):
            rest -= digit * (s % p)
        digit = _balanced(_balanced(rest, p) * pow(scale, -1, p), p)
        total += digit.astype(np.int64) * scale
        digits.append(digit)
        scales.append(scale)
        scale *= p
    return total


def best(score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest allowed scores of each row (all, if fewer), ties to the left: row and column of each."""
    lowest = np.iinfo(np.int64).min
    masked = np.where(allowed, score, lowest)
    width = masked.shape[1]
    if width > k:
        least = np.partition(masked, width - k, axis=1)[:, width - k]
        allowed = allowed & (masked >= least[:, None])
    r, c = np.nonzero(allowed)
    order = np.lexsort((c, -masked[r, c], r))
    r, c = r[order], c[order]
    nth = np.arange(len(r)) - np.searchsorted(r, r)
    return r[nth < k], c[nth < k]


# ------------------------------------------------------------------ blocks
class _Rows:
    """One block of either side: its columns and its components modulo each prime."""

    def __init__(self, table: pa.Table, primes: list[int], by_id: bool = False):
        table = table.combine_chunks()
        self.row = table.column("row").to_numpy()
        ids = table.column("id").combine_chunks()
        self.null = np.asarray(ids.is_null())
        self.id = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.label = table.column("label").to_numpy()
        v = table.column("v").combine_chunks()
        lengths = np.asarray(v.value_lengths().fill_null(0))
        m = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=np.int32)
        m[np.arange(m.shape[1])[None, :] < lengths[:, None]] = np.asarray(v.flatten())
        if by_id:
            order = np.lexsort((self.row, self.id, self.null))
            self.row, self.id, self.null, self.label, m = self.row[order], self.id[order], self.null[order], self.label[order], m[order]
        self.parts = residues(m, primes)

    def some(self, which: np.ndarray | slice, width: int) -> list[np.ndarray]:
        return [p[which, :width] for p in self.parts]


def _tiles(anchors: _Rows, rows: _Rows, primes: list[int], same_label: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Anchors (places), rows (places, in order) and their scores, in bounded pieces: of equal labels, or all."""
    width = min(anchors.parts[0].shape[1], rows.parts[0].shape[1])
    if same_label:
        groups = [(np.flatnonzero(anchors.label == x), np.flatnonzero(rows.label == x)) for x in np.intersect1d(anchors.label, rows.label)]
    else:
        groups = [(np.arange(len(anchors.row)), np.arange(len(rows.row)))]
    for a, r in groups:
        b = rows.some(r, width)
        step = max(1, CELLS // max(1, len(r)))
        for lo in range(0, len(a), step):
            part = a[lo : lo + step]
            yield part, r, scores(anchors.some(part, width), b, primes)


def _result(anchors: _Rows, rows: _Rows, found: list[tuple]) -> pa.Table:
    a, place, score, r = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (list(zip(*found)) or [()] * 4))
    a, r = a.astype(np.int64), r.astype(np.int64)
    arrays = [pa.array(anchors.row[a]), pa.array(place.astype(np.int32)), pa.array(score), pa.array(rows.id[r], mask=rows.null[r])]
    return pa.Table.from_arrays(arrays, schema=BEST_ARROW)


def _positives(primes: list[int], k: int):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, rows = _Rows(left, primes), _Rows(right, primes, by_id=True)
        found = []
        for a, r, s in _tiles(anchors, rows, primes, same_label=True):
            i, j = best(s, anchors.row[a][:, None] != rows.row[r][None, :], k)
            found.append((a[i], np.zeros(len(i), dtype=np.int64), s[i, j], r[j]))
        return _result(anchors, rows, found)

    return work


def _negatives(primes: list[int], k: int, low: int, high: int):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, rows = _Rows(left, primes), _Rows(right, primes, by_id=True)
        given = left.column("positives").combine_chunks()
        ends = np.concatenate([[0], np.cumsum(np.asarray(given.value_lengths()))])
        flat = np.asarray(given.flatten())
        found = []
        for a, r, s in _tiles(anchors, rows, primes, same_label=False):
            other = anchors.label[a][:, None] != rows.label[r][None, :]
            for place in range(int((ends[a + 1] - ends[a]).max(initial=0))):
                has = ends[a] + place < ends[a + 1]
                p = flat[np.where(has, ends[a] + place, 0)]
                least, most = -((-low * p) // 100), (high * p) // 100
                i, j = best(s, other & has[:, None] & (s >= least[:, None]) & (s <= most[:, None]), k)
                found.append((a[i], np.full(len(i), place + 1), s[i, j], r[j]))
        return _result(anchors, rows, found)

    return work


def _merged(df: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and place, numbered."""
    w = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def prepared(vectors: DataFrame, anchors: Column) -> DataFrame:
    """Rows that take part, stored with a number of their own: id, label, integer components, whether an anchor."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    fit = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(fit)
    rows = rows.select(
        F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), whole.alias("w"), F.coalesce(anchors, F.lit(False)).alias("is_anchor")
    )
    length = F.aggregate("w", F.lit(0.0), lambda s, x: s + x * x)
    numbers = F.transform("w", lambda x: x.try_cast("int"))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", "is_anchor", numbers.alias("v"), length.alias("square")), "vectors")


def mine(
    vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """For each row that ``anchors`` holds for and each of its ``positives`` best other rows of its label, the
    ``negatives`` best rows of other labels with ``low`` to ``high`` percent of the positive's score.

    ``vectors``: vec_id, embedding (array of float or double), label.  Returns
    anchor_id, positive_id, rank (from 1), negative_id and the two scores.
    """
    ship(vectors.sparkSession)
    rows = prepared(vectors, anchors)
    facts = rows.agg(F.count("*"), F.count_if("is_anchor"), F.max(F.size("v")), F.max("square")).first()
    n, n_anchors, width, square = facts[0], facts[1], facts[2] or 0, facts[3] or 0.0
    if not square < LIMIT:
        raise ValueError(f"a vector's squared integer length is {square:.3g}; below 2^56 is needed for exact scores")
    primes = primes_for(square * (1 + 1e-9) + 1)
    most = max(1, min(block_rows, BLOCK_BYTES // (4 * max(1, width))))
    row_blocks, anchor_blocks = max(1, math.ceil(n / most)), max(1, math.ceil(n_anchors / most))

    def against(anchor_rows: DataFrame, work) -> DataFrame:
        """``work`` of every block of anchors with every block of rows."""
        part = lambda c, m, salt: F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(m)).cast("int")
        every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        left = anchor_rows.select("*", part("row", anchor_blocks, 1).alias("a_block"), every(row_blocks).alias("r_block"))
        # Both sides come from one table: new names, as it were, for the columns of one.
        right = rows.select(*[F.col(c).alias(c) for c in ("row", "id", "label", "v")], part("row", row_blocks, 2).alias("r_block"), every(anchor_blocks).alias("a_block"))
        keys = ["a_block", "r_block"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, BEST)

    own = rows.where("is_anchor").select("row", "id", "label", "v")
    liked = stored(_merged(against(own, _positives(primes, positives)), positives).select("anchor", "rank", "score", "id"), "positives")
    listed = liked.groupBy("anchor").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("positives"))
    with_positives = own.join(listed.withColumnRenamed("anchor", "row"), "row")
    found = _merged(against(with_positives, _negatives(primes, negatives, low, high)), negatives)
    liked = liked.select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = own.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    out = found.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(liked, ["anchor", "place"]).join(ids, "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def report(vectors: DataFrame) -> DataFrame:
    """The query: labels of ids divisible by 7 moved on by one, anchors are the ids divisible by 100."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


SQL = """WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10"""
