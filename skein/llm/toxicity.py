"""Toxicity by the nearest labelled examples.

Examples are labelled training texts, drawn by a hash of their id: at most
about ``per_class`` of each label, and of these so many that they have about
``max_postings`` different words in all, each text's counted by itself
(documented bounds; the draw is a filter on the hash, so it is the same in
every run).  Terms are all their words (letters and digits, A-Z in lower
case).  A term's weight is its inverse document frequency times
``FLOOR + chi / (chi + HALF)``, where chi is the chi-square statistic (with
Yates's correction) of its presence and the label over the examples: words that go with a label lead, and
no word is left out.  Texts and examples become TF-IDF vectors of unit length
with these weights, and similarity is their exact cosine.

The index holds the examples in blocks with the highest weight of every term
in each block.  Terms that more than one of 24 examples has are kept as
rows of a matrix instead: their part of the cosines comes from one product for
many texts.  A search bounds every block's best cosine by the best of that part
and the maxima of the other terms, takes blocks in falling order of the bound
and leaves out those that can't reach the k-th best so far; this loses nothing.
Ties go to the lower example number.

The votes of the k nearest, weighted by 1 / (distance + ``soft``) and by how
many labelled rows an example stands for, give a raw share.  A logistic curve
calibrates it, fitted in ``FOLDS`` parts: the examples of a part are searched
in an index whose examples and weights come from the others alone.  A text
without any of the terms has no neighbours and gets the share of toxic among
such examples, drawn towards the share of all.

Defined results: null and empty texts have no terms; labels other than 0 and
1 and labels without a document are ignored; a repeated label row counts as
toxic if any says so; of several texts of one id one is the example, the same
in every run; without labelled examples every score is 0.0; repeated documents
each get their row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import ALNUM, LOWER, append, chunks, remainder, share, stored, trimmed, utf8, word_hashes, words

PER_CLASS = 3000
MAX_POSTINGS = 2_000_000
#: A term's weight: FLOOR for a word that says nothing of the label, half of the most at a chi-square of HALF.
FLOOR = 0.01
HALF = 15.0
FOLDS = 4
NEIGHBOURS = 15
BLOCK = 64
#: A term in more than one of DENSE examples is a row of the matrix; texts whose products are made at once.
DENSE = 24
TOGETHER = 128
#: Blocks searched before the bounds are compared again; then all the rest.
WAVES = (4, 16)
SOFT = 0.05

FIELDS = [
    T.StructField("score", T.DoubleType()),
    T.StructField("neighbours", T.ArrayType(T.LongType())),
    T.StructField("similarities", T.ArrayType(T.DoubleType())),
]


def _terms():
    """Distinct word hashes of each text and how often each occurs."""

    def step(texts: pa.Array):
        data, offsets = utf8(texts)
        terms, counts = [], []
        for lo, hi in chunks(offsets):
            part = LOWER[data[offsets[lo] : offsets[hi]]]
            s, e, d = words(part, offsets[lo : hi + 1] - offsets[lo], ALNUM)
            h = word_hashes(part, s, e).view(np.int64)
            cut = np.searchsorted(d, np.arange(hi - lo + 1))
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                t, c = np.unique(h[a:b], return_counts=True)
                terms.append(t)
                counts.append(c)
        return [_lists(terms), _lists(counts)]

    return step


def _lists(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tolist() for p in parts], type=pa.list_(pa.int64()))


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one after the other, and the range of each."""
    n = last - first
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n), of


class Index:
    """Unit vectors of examples in blocks, with each term's highest weight in each block that has it.

    A vector is a pair of arrays: term numbers, rising, and weights over 0.
    """

    def __init__(self, terms: np.ndarray, weights: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]]):
        self.terms, self.weights = np.asarray(terms, dtype=np.int64), np.asarray(weights, dtype=np.float64)  # terms: sorted
        n, v = len(vectors), len(self.terms)
        # Examples with the same strongest term stand together, which keeps the blocks' maxima apart.
        lead = np.array([t[np.argmax(w)] if len(t) else v for t, w in vectors], dtype=np.int64)
        self.example = np.lexsort((np.arange(n), lead))
        self.blocks = -(-n // BLOCK)
        place = np.empty(n, dtype=np.int64)
        place[self.example] = np.arange(n)
        t = np.concatenate([t.astype(np.int32) for t, _ in vectors]) if n else np.zeros(0, dtype=np.int32)
        at = np.repeat(place.astype(np.int32), [len(t) for t, _ in vectors])
        o = np.lexsort((at, t))
        t, at = t[o], at[o]
        w = np.concatenate([w for _, w in vectors])[o] if n else np.zeros(0)
        del o
        often = np.flatnonzero(np.bincount(t, minlength=v) > n / DENSE)
        self.row = np.full(v, -1, dtype=np.int64)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), n))
        in_row = self.row[t] >= 0
        self.dense[self.row[t[in_row]], at[in_row]] = w[in_row]
        t, self.posting, self.part = t[~in_row], at[~in_row], w[~in_row]
        del at, w, in_row
        # Runs: the postings of one term in one block.
        block = self.posting // BLOCK
        begin = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (block[1:] != block[:-1])])) if len(t) else np.zeros(0, dtype=np.int64)
        self.run = np.append(begin, len(t))
        self.run_block = block[begin]
        self.most = np.maximum.reduceat(self.part, begin) if len(t) else np.zeros(0)
        self.of_term = np.searchsorted(t[begin], np.arange(v + 1))

    def vector(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unit vector of a text with these words (sorted); empty if none is a term."""
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == hashes if len(self.terms) else np.zeros(len(hashes), dtype=bool)
        at = at[known]
        w = (1 + np.log(counts[known])) * self.weights[at]
        return at, w / math.sqrt(float((w * w).sum())) if len(w) else w

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[list[tuple[float, int]]]:
        """For each vector the k examples of highest cosine over 0: (cosine, example), best first."""
        for lo in range(0, len(vectors), TOGETHER):
            group = vectors[lo : lo + TOGETHER]
            often = np.zeros((len(group), len(self.dense)))
            for i, (t, w) in enumerate(group):
                row = self.row[t]
                often[i, row[row >= 0]] = w[row >= 0]
            for (t, w), dots in zip(group, often @ self.dense, strict=True):
                rare = self.row[t] < 0
                yield self._search(t[rare], w[rare], dots, k)

    def _search(self, t: np.ndarray, w: np.ndarray, dots: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The nearest of a text with these rare terms; ``dots``: the other terms' part of all cosines."""
        if not self.blocks:
            return []
        runs, of = _ranges(self.of_term[t], self.of_term[t + 1])
        block, w = self.run_block[runs], w[of]
        bound = np.maximum.reduceat(dots, np.arange(0, len(dots), BLOCK))
        bound += np.bincount(block, weights=w * self.most[runs], minlength=self.blocks)
        left = np.argsort(-bound, kind="stable")
        left = left[bound[left] > 0]
        sims, who = np.zeros(0), np.zeros(0, dtype=np.int64)
        for wave in (*WAVES, self.blocks):
            chosen = np.zeros(self.blocks, dtype=bool)
            chosen[left[:wave]] = True
            left = left[wave:]
            mine = np.flatnonzero(chosen[block])
            at, of_run = _ranges(self.run[runs[mine]], self.run[runs[mine] + 1])
            dot = dots + np.bincount(self.posting[at], weights=w[mine][of_run] * self.part[at], minlength=len(dots))
            # Parts of cosines are never more than the cosines: the k-th best of them all is at least this.
            least = np.partition(dot, -k)[-k] - 1e-9 if len(dot) > k else 0.0
            hit = np.flatnonzero((dot > 0) & (dot >= least) & np.repeat(chosen, BLOCK)[: len(dot)])
            sims, who = np.concatenate([sims, np.round(dot[hit], 12)]), np.concatenate([who, self.example[hit]])
            best = np.lexsort((who, -sims))[:k]
            sims, who = sims[best], who[best]
            # The slack keeps examples that tie with the k-th but for rounding.
            left = left[bound[left] >= max(least, sims[-1] - 1e-9 if len(sims) == k else 0.0)]
            if not len(left):
                break
        return list(zip(sims.tolist(), who.tolist(), strict=True))


def term_weights(terms: np.ndarray, toxic: np.ndarray, n1: int, n0: int) -> tuple[np.ndarray, np.ndarray]:
    """Terms of ``n1`` toxic and ``n0`` other examples, sorted, and their weights.

    ``terms``: the examples' different words, one example after the other;
    ``toxic``: 1 for those of toxic ones.
    """
    names, inverse = np.unique(terms, return_inverse=True)
    a = np.bincount(inverse, weights=toxic, minlength=len(names))
    n = np.bincount(inverse, minlength=len(names)).astype(np.float64)
    b, all_ = n - a, float(n1 + n0)
    c, d = n1 - a, n0 - b
    below = n * (c + d) * n1 * n0
    # Yates's correction: a word seen once or twice says little, whatever its label.
    apart = np.maximum(0.0, np.abs(a * d - b * c) - all_ / 2)
    chi = np.divide(all_ * apart**2, below, out=np.zeros(len(names)), where=below > 0)
    return names, (np.log((1 + all_) / (1 + n)) + 1) * (FLOOR + chi / (chi + HALF))


class Model:
    """Index, labels and weights of the examples, and the calibration."""

    def __init__(self, ids: list, labels: np.ndarray, texts: list[tuple[np.ndarray, np.ndarray]], weights: dict[int, float], k: int = NEIGHBOURS, curve=None):
        """texts: the examples' words (hashes, sorted) and counts; weights: how many labelled rows an example of a label stands for."""
        self.k, self.weight, self.curve = k, weights, curve or (1.0, 0.0)
        heavy = np.array([weights[int(y)] for y in labels])
        self.prior = float((heavy * labels).sum() / heavy.sum()) if len(labels) else 0.0
        full = np.array([len(h) > 0 for h, _ in texts], dtype=bool)
        self.bare = float(((heavy * labels)[~full].sum() + self.prior) / (heavy[~full].sum() + 1)) if len(labels) else 0.0
        if curve is None and len(labels):
            raw = np.zeros(len(labels))
            for f in range(FOLDS):
                mine = np.arange(len(labels)) % FOLDS == f
                rest = np.flatnonzero(~mine)
                other = Model([ids[i] for i in rest], labels[rest], [texts[i] for i in rest], weights, k, curve=self.curve)
                at = np.flatnonzero(mine & full)
                near = other.index.nearest([other.index.vector(*texts[i]) for i in at], k)
                raw[at] = [other.votes(x) for x in near]
                del other, near
            self.curve = _logistic(raw[full].tolist(), labels[full], heavy[full])
        kept = np.flatnonzero(full)
        self.ids, self.labels = [ids[i] for i in kept], np.asarray(labels, dtype=np.int64)[kept]
        sizes = [len(texts[i][0]) for i in kept]
        words_ = np.concatenate([texts[i][0] for i in kept]) if len(kept) else np.zeros(0, dtype=np.int64)
        n1 = int(np.sum(labels)) if len(labels) else 0
        names, value = term_weights(words_, np.repeat(self.labels, sizes), n1, len(labels) - n1)
        plain = Index(names, value, [])
        self.index = Index(names, value, [plain.vector(*texts[i]) for i in kept])

    def votes(self, near: list[tuple[float, int]]) -> float:
        """Log odds of the weighted votes, with one vote's weight on the prior."""
        yes, all_ = self.prior, 1.0
        for sim, i in near:
            w = self.weight[int(self.labels[i])] / (1.0 - sim + SOFT)
            yes, all_ = yes + w * int(self.labels[i]), all_ + w
        p = min(max(yes / all_, 1e-6), 1 - 1e-6)
        return math.log(p / (1 - p))

    def scores(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[float, list[int], list[float]]]:
        """Score, neighbours' ids and similarities of each text, given as words (hashes, sorted) and counts."""
        for near in self.index.nearest([self.index.vector(h, c) for h, c in texts], self.k):
            if not near:
                yield self.bare, [], []
                continue
            z = self.curve[0] * self.votes(near) + self.curve[1]
            yield 1 / (1 + math.exp(-min(max(z, -30), 30))), [self.ids[i] for _, i in near], [s for s, _ in near]


def _logistic(raw: list[float], labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic curve, by Newton steps with a small penalty."""
    if not raw or len(set(labels.tolist())) < 2:
        return 1.0, 0.0
    x, v, y = np.stack([np.array(raw), np.ones(len(raw))], axis=1), np.array([1.0, 0.0]), labels
    w = weights / weights.mean()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        g = x.T @ (w * (p - y)) + 1e-2 * (v - [1.0, 0.0])
        h = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        v = v - np.linalg.solve(h, g)
    return float(max(v[0], 0.05)), float(v[1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_postings: int = MAX_POSTINGS, k: int = NEIGHBOURS) -> Model:
    """Learn from the labelled rows given (leave held-out ones out before)."""
    nothing = Model([], np.zeros(0, dtype=np.int64), [], {}, k)
    known = labels.select(F.col("doc_id").alias("i"), F.col("toxic").cast("int").alias("y")).where("i is not null and y in (0, 1)")
    known = known.groupBy("i").agg(F.max("y").alias("y"))
    # Two rows: how many labelled ids have each label.
    total = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not total:
        return nothing
    rate = {y: min(1.0, per_class / n) for y, n in total.items()}
    wanted = F.when(F.col("y") == 1, rate.get(1, 0.0)).otherwise(rate.get(0, 0.0))
    # Bounded by about 2 * per_class ids.
    texts = docs.select(F.col("doc_id").alias("i"), F.col("text")).join(F.broadcast(known.where(share(F.col("i"), 17) < wanted)), "i")
    lists = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("terms", "counts")]
    rows = append(texts, ["text"], _terms, lists, keep=["i", "y"])
    rows = rows.groupBy("i", "y").agg(F.min(F.struct("terms", "counts")).alias("t")).select("i", "y", "t.terms", "t.counts")
    rows = stored(rows, "toxicity")
    postings = rows.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first().n
    if postings > max_postings:
        rows = rows.where(share(F.col("i"), 18) < max_postings / postings)
    # The examples, bounded in rows and in words.
    table = rows.orderBy("i").toArrow()
    if not table.num_rows:
        return nothing
    y = np.array(table["y"].to_pylist(), dtype=np.int64)
    # Parts of the table's own arrays, not copies of them.
    words_ = list(zip(_arrays(table["terms"]), _arrays(table["counts"]), strict=True))
    model = Model(table["i"].to_pylist(), y, words_, {x: total[x] / int((y == x).sum()) for x in set(y.tolist())}, k)
    del table, words_
    trimmed()
    return model


def _arrays(column: pa.ChunkedArray):
    for chunk in column.chunks:
        for x in chunk:
            yield x.values.to_numpy()


def _scored(model: Model):
    keys = model.index.terms

    def step(texts: pa.Array):
        out: list[tuple] = []
        data, offsets = utf8(texts)
        for lo, hi in chunks(offsets):
            part = LOWER[data[offsets[lo] : offsets[hi]]]
            s, e, d = words(part, offsets[lo : hi + 1] - offsets[lo], ALNUM)
            h = word_hashes(part, s, e).view(np.int64)
            known = np.flatnonzero(np.isin(h, keys)) if len(keys) else np.zeros(0, dtype=np.int64)
            h, d = h[known], d[known]
            cut = np.searchsorted(d, np.arange(hi - lo + 1))
            out += model.scores([np.unique(h[a:b], return_counts=True) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)])
        return [
            pa.array([x[0] for x in out], type=pa.float64()),
            pa.array([x[1] for x in out], type=pa.list_(pa.int64())),
            pa.array([x[2] for x in out], type=pa.list_(pa.float64())),
        ]

    return step


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with score, and as evidence the ids of the nearest examples and their similarities."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    trimmed()
    return append(docs, [text], lambda: _scored(shared.value), FIELDS, keep=keep)


def trained(labels: DataFrame, fold: int = 5) -> DataFrame:
    """Label rows outside the held-out fold (crc32 of the id modulo ``fold`` is 0)."""
    return labels.where(remainder(F.col("doc_id"), fold) != 0)
