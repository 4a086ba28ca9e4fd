"""Benchmark decontamination: windows of test words looked up while the training texts are scanned.

The windows of the test items form a hash set that is broadcast: sorted hashes
in an array, and for each the place of its words in the items' text, some 30
bytes a window beside the text.  Its size is bounded: the items, cut into
pieces that overlap by a window less one word, are dealt out to blocks of about
``block_bytes`` of text, one scan of the documents per block, stored before the
next one.  A window whose hash is in the set is verified word by word, so the
result is exact.

Words are maximal runs of ASCII letters and digits and non-ASCII characters,
A-Z in lower case.  A window has ``size`` words; an item with fewer, but not
none, is one window of its own length.

Defined results: a null or empty text has no words and no hits; an item with
a null id or null text is left out; a repeated item counts once per id;
repeated documents each get their row; with an empty benchmark nothing is hit.
The report's and ``find_hits``' columns replace input columns of the same name;
``remove_hits`` leaves all columns but the text as they were.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import ALNUM, LOWER, append, chunks, filtered, stored, utf8, window_hashes, word_hashes, words

SIZE = 10
BLOCK_BYTES = 16 << 20
#: An item has at most so much of a block in one piece: 1 / PIECES.
PIECES = 16

#: ``hit_runs``: word numbers (first, past the last) of the merged hit runs, one after the other.
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_runs", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def _texts(column: pa.Array):
    """For each chunk of texts: lower-case bytes, word starts, ends, text numbers, first text, number of texts."""
    data, offsets = utf8(column)
    for lo, hi in chunks(offsets):
        part = LOWER[data[offsets[lo] : offsets[hi]]]
        s, e, d = words(part, offsets[lo : hi + 1] - offsets[lo], ALNUM)
        yield part, s, e, d, lo, hi - lo


class Table:
    """The items' windows of ``k`` words: hashes, sorted, with the first word and the item of each; the items' text."""

    def __init__(self, k: int, hashes: np.ndarray, first: np.ndarray, item: np.ndarray, text: "Texts"):
        o = np.lexsort((item, hashes))
        self.k, self.hashes, self.first, self.item, self.text = k, hashes[o], first[o], item[o], text
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[self.hashes >> np.uint64(44)] = True

    def items_of(self, h: np.uint64, said: bytes) -> list[str]:
        """Items with this window, its words compared one by one."""
        lo, hi = np.searchsorted(self.hashes, h), np.searchsorted(self.hashes, h, side="right")
        return [self.text.names[i] for f, i in zip(self.first[lo:hi].tolist(), self.item[lo:hi].tolist(), strict=True) if self.text.words(f, self.k) == said]


class Texts:
    """Lower-case text of a block of items, and the places of its words."""

    def __init__(self, names: list[str], raw: bytes, s: np.ndarray, e: np.ndarray):
        self.names, self.raw, self.s, self.e = names, raw, s.astype(np.uint32), e.astype(np.uint32)

    def words(self, first: int, k: int) -> bytes:
        return b" ".join(self.raw[a:b] for a, b in zip(self.s[first : first + k].tolist(), self.e[first : first + k].tolist(), strict=True))


def window_table(items: list[tuple[str, str]], size: int = SIZE) -> list[Table]:
    """A table per window length."""
    names = [i for i, _ in items]
    raw, starts, ends, hashes, owner, base = [], [], [], [], [], 0
    for part, s, e, d, lo, _ in _texts(pa.array([t for _, t in items], type=pa.string())):
        raw.append(part.tobytes())
        starts.append(s + base)
        ends.append(e + base)
        hashes.append(word_hashes(part, s, e))
        owner.append(d + lo)
        base += len(part)
    if not raw:
        return []
    s, e, h, d = (np.concatenate(x) for x in (starts, ends, hashes, owner))
    text = Texts(names, b"".join(raw), s, e)
    n = np.bincount(d, minlength=len(items))
    short = np.minimum(n, size)
    out = []
    for k in sorted(set(short.tolist()) - {0}):
        w = window_hashes(h, k)
        first = np.flatnonzero((d[: len(w)] == d[k - 1 :]) & (short[d[: len(w)]] == k))
        out.append(Table(k, w[first], first.astype(np.uint32), d[first].astype(np.uint32), text))
    return out


def _merged(runs: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(runs):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _scan(tables: list[Table]):
    """Scans a batch: number of words, hit runs and items of each text, joined with those found before."""

    def step(texts: pa.Array, runs: pa.Array | None = None, items: pa.Array | None = None):
        n = len(texts)
        counts = np.zeros(n, dtype=np.int64)
        hit = [list(zip(x[::2], x[1::2], strict=True)) for x in runs.to_pylist()] if runs is not None else [[] for _ in range(n)]
        names = [set(x) for x in items.to_pylist()] if items is not None else [set() for _ in range(n)]
        for part, s, e, d, lo, m in _texts(texts):
            counts[lo : lo + m] = np.bincount(d, minlength=m)
            h, firsts = word_hashes(part, s, e), np.searchsorted(d, np.arange(m))
            for t in tables:
                k, w = t.k, window_hashes(h, t.k)
                if not len(w):
                    continue
                may = np.flatnonzero(t.bits[w >> np.uint64(44)] & (d[: len(w)] == d[k - 1 :]))
                at = np.minimum(np.searchsorted(t.hashes, w[may]), len(t.hashes) - 1)
                may = may[t.hashes[at] == w[may]]
                for j in may.tolist():
                    said = b" ".join(part[s[q] : e[q]].tobytes() for q in range(j, j + k))
                    if of := t.items_of(w[j], said):
                        at = int(d[j])
                        first = j - int(firsts[at])
                        hit[lo + at].append((first, first + k))
                        names[lo + at].update(of)
        return [
            pa.array(counts),
            pa.array([_merged(x) for x in hit], type=pa.list_(pa.int64())),
            pa.array([sorted(x) for x in names], type=pa.list_(pa.string())),
        ]

    return step


def _pieces(size: int, most: int):
    """Texts cut at words into pieces of about ``most`` bytes, each with the ``size - 1`` words after it: every window is in one piece.

    A shorter text, or one of ``size`` words at most, stays as it is.
    """

    def step(texts: pa.Array):
        out = []
        for text in texts.to_pylist():
            raw = text.encode()
            if len(raw) <= most:
                out.append([text])
                continue
            s, e, _ = words(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]), ALNUM)
            n, a, parts = len(s), 0, []
            while a <= n - size:
                b = max(a + 1, int(np.searchsorted(s, s[a] + most)))
                parts.append(raw[s[a] : e[min(n, b + size - 1) - 1]].decode())
                a = b
            out.append(parts or [text])
        return [pa.array(out, type=pa.list_(pa.string()))]

    return step


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = SIZE,
    block_bytes: int = BLOCK_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_runs`` and ``items`` (ids of the items with occurring windows, sorted)."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).dropna()
    total = bench.agg(F.coalesce(F.sum(F.octet_length("t") + F.octet_length("i")), F.lit(0)).alias("b")).first().b
    blocks = max(1, -(-int(total) // block_bytes))
    if blocks > 1:
        cut = append(bench, ["t"], lambda: _pieces(size, max(1, block_bytes // PIECES)), [T.StructField("p", T.ArrayType(T.StringType()))], keep=["i"])
        bench = cut.select("i", F.explode("p").alias("t"))
        bench = stored(bench.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)).cast("int")), "decontamination", "items")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in {f.name for f in FIELDS}]
    out = docs
    for k in range(blocks):
        # One block of items, of bounded size, goes through the driver into the broadcast.
        rows = (bench.where(F.col("block") == k) if blocks > 1 else bench).select("i", "t").collect()
        shared = spark.sparkContext.broadcast(window_table([(r.i, r.t) for r in rows], size))
        seen = ["hit_runs", "items"] if k else []
        more = [] if k + 1 == blocks or text in kept else [text]
        out = append(out, [text, *seen], lambda shared=shared: _scan(shared.value), FIELDS, keep=kept + more)
        if k + 1 < blocks:
            # One scan, and one block in a worker's memory, at a time.
            out = stored(out, "decontamination", "scan")
    return out


def _cut(share: float):
    """Texts without the hit runs; null for texts of which more than ``share`` of the words are hit."""

    def step(texts: pa.Array, n_words: pa.Array, runs: pa.Array):
        out = texts.to_pylist()
        counts, spans = n_words.to_pylist(), runs.to_pylist()
        for i in [i for i, r in enumerate(spans) if r]:
            r = spans[i]
            if sum(r[1::2]) - sum(r[::2]) > share * counts[i]:
                out[i] = None
                continue
            raw = out[i].encode()
            data = np.frombuffer(raw, dtype=np.uint8)
            s, e, _ = words(data, np.array([0, len(data)]), ALNUM)
            at, kept = 0, []
            for a, b in zip(r[::2], r[1::2], strict=True):
                kept.append(raw[at : s[a]])
                at = int(e[b - 1])
            kept.append(raw[at:])
            out[i] = b"".join(kept).decode()
        return [pa.array(out, type=pa.string())]

    return step


def remove_hits(docs: DataFrame, benchmark: DataFrame, max_share: float = 0.5, text: str = "text", **options) -> DataFrame:
    """``docs`` with the hit words cut out of the text; a document with more than ``max_share`` of its words hit goes.

    The cut runs from the first byte of a run's first word to the last byte of its last one.
    """

    def work(rows: DataFrame) -> DataFrame:
        found = find_hits(rows, benchmark, text=text, **options)
        clean = append(found, [text, "n_words", "hit_runs"], lambda: _cut(max_share), [T.StructField("_cut", T.StringType())])
        hit = F.size("hit_runs") > 0
        clean = clean.where(~hit | F.col("_cut").isNotNull())
        return clean.withColumn(text, F.when(hit, F.col("_cut")).otherwise(F.col(f"`{text}`")))

    return filtered(docs, work, [f.name for f in FIELDS])


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items."""
    found = find_hits(docs, benchmark, keep=["doc_id"], **options)
    n_hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda a, x: x - a)  # past the last minus first, summed
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_runs") > 0).alias("contaminated"),
        "items",
    )
