"""Periodic runs of words, found by longest common extensions on suffix trees.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) that neither neighbour extends, of ``MIN_LENGTH`` words and
``MIN_PERIODS`` periods at least.  For each text:

1. Stretches in which a run can lie are told from word windows that come back
   nearby (:func:`stretches`); no run is lost, as a run is covered by such
   windows.  Texts without one, which are most, end here.
2. Ukkonen's algorithm builds the suffix tree of a stretch and that of its
   reversal (:func:`suffix_tree`).  The depth of the lowest common ancestor of
   two leaves, a range minimum over the Euler tour, is the longest common
   extension of two positions, in constant time.
3. By the runs theorem every run has a root that is the longest Lyndon word
   from its first position, in the order of the words or in its inverse.  The
   longest Lyndon word from i ends before the next smaller suffix; so 2n
   candidates, extended to both sides, give all runs (:func:`find_runs`).

Results for odd rows: a null, empty or blank text has no words and no runs; a
text of any length is handled whole, in one task, with memory in proportion to
its longest stretch; repeated rows have equal results; of equal exponents the
smallest start, then the smallest period is the strongest.  An empty table
gives an empty one; input columns named as results are replaced.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import SPACED, append, chunks, let, mix, utf8, window_hashes, word_hashes, words

#: A run's least words and periods.
MIN_LENGTH = 24
MIN_PERIODS = 3

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])
RUN_ARROW = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


# ------------------------------------------------------------------ suffix trees
class SuffixTree:
    """Suffix tree of numbers from 1 up, with longest common extensions of its positions.

    ``rank``: place of each suffix in the order of the numbers; ``inverse``:
    in the inverse order (in both, a prefix comes before what it begins).
    """

    def __init__(self, text: list[int], inverse: bool = False):
        n = self.n = len(text)
        depth, parent, first, leaf = suffix_tree(text)
        walk = _preorder(parent, first)
        at = np.flatnonzero(leaf[walk] >= 0)
        suffixes = leaf[walk[at]]
        self.rank = np.empty(n + 1, dtype=np.int64)
        self.rank[suffixes] = np.arange(n + 1)
        # Between two leaves the tour goes down from their lowest common ancestor, so of the nodes it goes
        # down from, that one has the least depth.  Entries between neighbouring leaves are merged first.
        down = depth[parent[walk]]
        low = np.minimum.reduceat(down, at[:-1] + 1) if n else np.zeros(0, dtype=np.int64)
        self.least = [low.astype(np.int32)]
        while (span := 1 << len(self.least)) <= n:
            last = self.least[-1]
            self.least.append(np.minimum(last[: n - span + 1], last[span // 2 : span // 2 + n - span + 1]))
        if inverse:
            top = int(first.max(initial=0)) + 1
            walk = _preorder(parent, np.where(first > 0, top - first, 0))
            order = leaf[walk]
            self.inverse = np.empty(n + 1, dtype=np.int64)
            self.inverse[order[order >= 0]] = np.arange(n + 1)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common prefix of the suffixes from i and from j (different places, n at most)."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.zeros(len(a), dtype=np.int64)
        for k in np.unique(level):
            m = level == k
            out[m] = np.minimum(self.least[k][a[m]], self.least[k][b[m] - (1 << int(k))])
        return out


def suffix_tree(text: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ukkonen's suffix tree of ``text`` and an end mark 0: of each node its depth in numbers, its parent, the
    first number on the way from there, and the suffix that it ends (-1 for inner nodes).  Node 0 is the root."""
    text = [*text, 0]
    n = len(text)
    wide = max(text) + 1
    begin, end, link, depth, leaf = [0], [0], [0], [0], [-1]
    child: dict[int, int] = {}
    node = length = edge = pending = made = 0
    for i, c in enumerate(text):
        pending += 1
        last = 0  # the inner node that waits for its suffix link
        while pending:
            if not length:
                edge = i
            key = node * wide + text[edge]
            to = child.get(key)
            if to is None:
                child[key] = len(begin)
                if last:
                    link[last] = node
                    last = 0
            else:
                b = begin[to]
                on = end[to] - b
                if leaf[to] < 0 and length >= on:
                    edge += on
                    length -= on
                    node = to
                    continue
                if text[b + length] == c:
                    length += 1
                    if last:
                        link[last] = node
                    break
                inner = len(begin)
                begin.append(b)
                end.append(b + length)
                link.append(0)
                depth.append(depth[node] + length)
                leaf.append(-1)
                child[key] = inner
                begin[to] = b + length
                child[inner * wide + text[b + length]] = to
                child[inner * wide + c] = inner + 1
                if last:
                    link[last] = inner
                last = inner
            # Leaves are made in the order of their suffixes.
            begin.append(i)
            end.append(n)
            link.append(0)
            depth.append(n - made)
            leaf.append(made)
            made += 1
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - pending + 1
    parent, first = np.zeros(len(begin), dtype=np.int64), np.zeros(len(begin), dtype=np.int64)
    keys, nodes = np.fromiter(child.keys(), np.int64, len(child)), np.fromiter(child.values(), np.int64, len(child))
    parent[nodes], first[nodes] = keys // wide, keys % wide
    return np.array(depth, dtype=np.int64), parent, first, np.array(leaf, dtype=np.int64)


def _preorder(parent: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The nodes as a walk from the root meets them, children by their first number."""
    nodes = np.lexsort((first[1:], parent[1:])) + 1
    ends = np.cumsum(np.bincount(parent[1:], minlength=len(parent))).tolist()
    backwards = nodes[::-1].tolist()
    total = len(backwards)
    out, stack = [], [0]
    while stack:
        x = stack.pop()
        out.append(x)
        stack += backwards[total - ends[x] : total - (ends[x - 1] if x else 0)]
    return np.array(out, dtype=np.int64)


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each place the next one with a smaller rank (the last place has the smallest)."""
    ranks = rank.tolist()
    out, stack = [0] * (len(ranks) - 1), []
    for j, r in enumerate(ranks):
        while stack and ranks[stack[-1]] > r:
            out[stack.pop()] = j
        stack.append(j)
    return np.array(out, dtype=np.int64)


def find_runs(text: list[int], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """All runs of the numbers (from 1 up): rows of start, length and period, by start and period.
    ``min_periods`` is 2 or more."""
    n = len(text)
    if n < max(min_length, min_periods):
        return np.zeros((0, 3), dtype=np.int64)
    tree = SuffixTree(text, inverse=True)
    i = np.arange(n)
    p = np.concatenate([next_smaller(tree.rank) - i, next_smaller(tree.inverse) - i])
    i = np.concatenate([i, i])
    some = p <= n // min_periods
    i, p = i[some], p[some]
    right = np.zeros(len(i), dtype=np.int64)
    m = i + p < n
    right[m] = tree.extension(i[m], i[m] + p[m])
    del tree
    back = SuffixTree(text[::-1])
    left = np.zeros(len(i), dtype=np.int64)
    m = i > 0
    left[m] = back.extension(n - i[m], n - i[m] - p[m])
    found = np.stack([i - left, left + p + right, p], axis=1)
    found = found[found[:, 1] >= np.maximum(min_length, min_periods * found[:, 2])]
    return np.unique(found[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


# ------------------------------------------------------------------ texts
def stretches(h: np.ndarray, text: np.ndarray, min_length: int, min_periods: int) -> list[tuple[int, int]]:
    """Ranges of words, each within one text, that hold every run of words with hashes ``h`` in texts ``text``.

    A run of L words and period q holds two equal windows of k words, q apart,
    wherever the first one begins within its first L - q - k + 1 words.  With
    k = min_length - min_length // min_periods (L - q at least), the windows
    and their copies cover the run.  So words outside windows that come back
    within a ``min_periods``-th of their stretch are in no run, and neither is
    a run cut: this repeats until nothing more goes.  Equal hashes of
    different words only keep more.
    """
    k = min_length - min_length // min_periods
    if len(h) < k:
        return []
    hashed = window_hashes(h, k)
    edges = np.flatnonzero(np.diff(text)) + 1
    lo, hi = np.concatenate([[0], edges]), np.concatenate([edges, [len(h)]])
    left = None
    while len(lo):
        long = hi - lo >= min_length
        lo, hi = lo[long], hi[long]
        if left == (hi - lo).sum():
            break
        left = int((hi - lo).sum())
        counts = hi - lo - k + 1
        part = np.repeat(np.arange(len(lo)), counts)
        at = np.arange(len(part)) - np.repeat(np.cumsum(counts) - counts, counts) + lo[part]
        key = mix(hashed[at] ^ mix(part.astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key, kind="stable")
        key, place, of = key[order], at[order], part[order]
        near = (key[1:] == key[:-1]) & (of[1:] == of[:-1]) & (place[1:] - place[:-1] <= (hi - lo)[of[1:]] // min_periods)
        hit = np.unique(np.concatenate([place[1:][near], place[:-1][near]]))
        if not len(hit):
            return []
        cut = np.flatnonzero((np.diff(hit) > k) | (text[hit[1:]] != text[hit[:-1]]))
        lo = hit[np.concatenate([[0], cut + 1])]
        hi = hit[np.concatenate([cut, [len(hit) - 1]])] + k
    return list(zip(lo.tolist(), hi.tolist()))


def _numbers(pieces: list[bytes]) -> list[int]:
    """The words' places in their order, from 1 up."""
    place = {w: n for n, w in enumerate(sorted(set(pieces)), 1)}
    return [place[w] for w in pieces]


def _strongest(runs: np.ndarray) -> int:
    """Row of the greatest length over period; the smallest start, then period of equal ones."""
    ratio = runs[:, 1] / runs[:, 2]
    close = np.flatnonzero(ratio >= ratio.max() * (1 - 1e-12))
    return int(min(close, key=lambda r: (-Fraction(int(runs[r, 1]), int(runs[r, 2])), runs[r, 0], runs[r, 2])))


def _handler(min_length: int, min_periods: int):
    def step(column: pa.Array) -> list[pa.Array]:
        data, offsets = utf8(column)
        runs, lists, best, kept_bytes, sizes = [], [0], [], [], [np.zeros(1, dtype=np.int64)]
        for lo, hi in chunks(offsets):
            part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            s, e, t = words(part, at, SPACED)
            begins = np.searchsorted(t, np.arange(hi - lo))
            found: dict[int, list[np.ndarray]] = {}
            keep = np.ones(len(s), dtype=bool)
            for a, b in stretches(word_hashes(part, s, e), t, min_length, min_periods):
                raw = part[s[a] : e[b - 1]].tobytes()
                pieces = [raw[x:y] for x, y in zip((s[a:b] - s[a]).tolist(), (e[a:b] - s[a]).tolist())]
                rows = find_runs(_numbers(pieces), min_length, min_periods)
                for start, length, period in rows.tolist():
                    keep[a + start + period : a + start + length] = False
                if len(rows):
                    found.setdefault(int(t[a]), []).append(rows + [a - begins[t[a]], 0, 0])
            for d in range(hi - lo):
                rows = np.concatenate(found[d]) if d in found else None
                lists.append(lists[-1] + (0 if rows is None else len(rows)))
                best.append(None if rows is None else _strongest(rows))
                if rows is not None:
                    runs.append(rows)
            joined, ends = _joined(part, at, s[keep], e[keep], t[keep])
            kept_bytes.append(joined)
            sizes.append(ends[1:] + sizes[-1][-1])
        flat = np.concatenate(runs) if runs else np.zeros((0, 3), dtype=np.int64)
        structs = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(RUN_ARROW))
        text = np.concatenate(kept_bytes) if kept_bytes else np.zeros(0, dtype=np.uint8)
        ends = np.concatenate(sizes)
        collapsed = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(text))
        places = np.array([-1 if b is None else lists[d] + b for d, b in enumerate(best)], dtype=np.int64)
        strongest = structs.take(pa.array(places, mask=places < 0)) if len(places) else pa.array([], RUN_ARROW)
        return [pa.ListArray.from_arrays(pa.array(lists, type=pa.int32()), structs), strongest, collapsed.cast(pa.string())]

    return step


def _joined(data: np.ndarray, offsets: np.ndarray, s: np.ndarray, e: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's words [s, e) joined by one space, and where each text ends."""
    more = np.zeros(len(s), dtype=bool)
    more[:-1] = t[1:] == t[:-1]
    # The byte after a word that another one follows is white space of the same text.
    out = data.copy()
    out[e[more]] = 0x20
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[s] += 1
    edge[e + more] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    ends = np.zeros(len(offsets), dtype=np.int64)
    ends[1:] = np.cumsum(np.bincount(t, weights=e - s + more, minlength=len(offsets) - 1).astype(np.int64))
    return out[inside], ends


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) with each text's ``runs`` (start, length, period; by start and period),
    the ``strongest`` of them (greatest length over period), and the text ``collapsed``: its words joined by one
    space, without those that a run holds after its first period."""
    if min_periods < 2 or min_length < min_periods:
        raise ValueError("a run has two periods at least, and min_length is min_periods at least")
    fields = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("strongest", RUN), T.StructField("collapsed", T.StringType())]
    return append(docs, [text], lambda: _handler(min_length, min_periods), fields, keep)


def cycled(text: Column, doc_id: Column) -> Column:
    """The texts of a tenth of the ids with their words from some place on repeated in a cycle; others as they are.

    With h the crc32 of the id's digits and g = h div 10, where h is divisible
    by 10 word i from a = g % n on becomes word a + (i - a) % p, with
    p = 1 + (n - a) div (3 + g % 8).  A null id counts as an empty one (h = 0).
    """
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def rewrite(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        turn = lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(F.transform(w, turn), " ")).otherwise(text)

    return F.when((h % 10 == 0) & text.isNotNull(), let(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)")), rewrite)).otherwise(text)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its cycled text's number of runs, the strongest run, and digests of all runs and of
    the collapsed text."""
    texts = docs.select("doc_id", cycled(F.col("text"), F.col("doc_id")).alias("text"))
    done = periodic_runs(texts, keep=["doc_id"])
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return done.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.start",
        "strongest.length",
        "strongest.period",
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
