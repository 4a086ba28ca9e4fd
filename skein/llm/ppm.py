"""Language-model scores by prediction by partial matching over bytes, and a word-count baseline.

The model is a trie of byte contexts up to ``ORDER`` bytes long with the
counts of the bytes that follow in the training texts; a text is preceded by
``ORDER`` start marks and followed by an end mark (bytes that UTF-8 never
has).  A byte is coded in its longest known context: with count n of it, T of
all and q different bytes there, it has probability n / (T + q), and the
escape to the next shorter context q / (T + q).  Bytes of the longer contexts
are excluded from the shorter ones' counts.  Below the empty context the bytes
left are equally likely.  A text's score is the sum of log10 over its bytes
and its end.

Nothing is held whole by the driver or broadcast but the contexts of up to one
byte (at most 257 * 256 counts).  Texts form *blocks* of about ``BLOCK``
bytes:

1. Each block's different words and byte strings of ORDER + 1 are counted
   within the tasks that read them.
2. Sums over the blocks give the words' counts and the trie; each string's
   cost comes from a join of its contexts' distributions, level by level.
3. Each block gets back the counts and costs it asked for, packed as arrays
   of up to ``PACKED`` keys, and its texts are scored by lookup.

Defined results: a null text counts as an empty one, which has the end only;
without training texts all words are unknown and all bytes equally likely;
null ids get the fold of an empty text; repeated rows are separate texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import LOWER, SPACED, chunks, discarded, released, ship, stored, trimmed, utf8, word_hashes, words

ORDER = 5
START, END = 0xFE, 0xFF
SYMBOLS = 255  # bytes and the end mark, without the start mark
BLOCK = 32 << 20
#: A longer text is a block of its own.
ALONE = 4 << 20
#: Different keys that a counting task holds before it hands them on.
HELD = 3 << 20
#: Answers in a packed row, and answers that a packing task holds.
PACKED, PACKING = 1 << 16, 1 << 21
#: Parts of the strings that are answered one after the other.
TURNS = 2

#: Parquet's second version writes rising numbers as packed differences, in fewer bytes.
PACKED_NUMBERS = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false"}

#: Words have negative keys, byte strings others; this one is a text's end as a token.
TOP = np.uint64(1 << 63)
END_WORD = -1


def strings(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For each byte and end: the byte string up to it as a number, the latest byte lowest; and its text's number."""
    n, d = len(offsets) - 1, np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    pad = order + 1
    padded = np.full(len(data) + n * pad, START, dtype=np.uint8)
    padded[np.arange(len(data)) + d * pad + order] = data
    ends = offsets[1:] + np.arange(1, n + 1) * pad - 1
    padded[ends] = END
    keep = np.ones(len(padded), dtype=bool)
    firsts = offsets[:-1] + np.arange(n) * pad
    for k in range(order):
        keep[firsts + k] = False
    at = np.flatnonzero(keep)
    code = padded[at].astype(np.int64)
    for k in range(1, pad):
        code |= padded[at - k].astype(np.int64) << (8 * k)
    return code, np.repeat(np.arange(n), np.diff(offsets) + 1)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words (A-Z in lower case), and their text's number."""
    low = LOWER[data]
    s, e, d = words(low, offsets, SPACED)
    return (word_hashes(low, s, e) | TOP).view(np.int64), d


def _sum(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    # The keys come as sorted runs, which a stable sort only merges.
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(keys) else counts[:0].astype(np.int64)


def _within(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which of the keys the sorted table has."""
    if not len(table):
        return np.zeros(len(keys), dtype=bool)
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


def _asked(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, and how often each occurs in training texts."""
    seen, n = np.unique(keys[train], return_counts=True)
    other = np.unique(keys[~train]) if not train.all() else keys[:0]
    other = other[~_within(other, seen)]
    return np.concatenate([seen, other]), np.concatenate([n, np.zeros(len(other), dtype=np.int64)])


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (block, key, train): each block's keys, mostly once."""
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def out(block: int) -> Iterator[pa.RecordBatch]:
            parts = held.pop(block)
            keys, n = _sum(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
            for lo in range(0, len(keys), 1 << 17):
                k, c = keys[lo : lo + (1 << 17)], n[lo : lo + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), block)), pa.array(k), pa.array(c)], names=["block", "key", "train"])

        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            blocks, train = batch.column("block").to_numpy(), batch.column("train").to_numpy(zero_copy_only=False)
            turns = np.flatnonzero(np.diff(blocks)) + 1
            for first, last in zip([0, *turns.tolist()], [*turns.tolist(), len(blocks)], strict=True):
                for lo, hi in chunks(offsets[first : last + 1]):
                    lo, hi = lo + first, hi + first
                    part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                    t = train[lo:hi]
                    found = [_asked(x, t[d]) for x, d in (strings(part, at, order), tokens(part, at))]
                    found.append((np.array([END_WORD]), np.array([t.sum()])))
                    mine = held.setdefault(int(blocks[lo]), [])
                    mine += found
                    size += sum(len(k) for k, _ in found)
                    if len(mine) > 48:
                        size -= sum(len(k) for k, _ in mine)
                        mine[:] = [_sum(np.concatenate([k for k, _ in mine]), np.concatenate([c for _, c in mine]))]
                        size += len(mine[0][0])
                    if size > HELD:
                        for b in list(held):
                            yield from out(b)
                        size = 0
        for b in list(held):
            yield from out(b)
        trimmed(collect=False)

    return run


class Table:
    """Numbers by 64-bit key, looked up for whole arrays; ``FREE`` is no key."""

    FREE = np.int64(-(1 << 63))

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        if (keys == self.FREE).any():
            raise ValueError("a key that stands for none")
        self.shift = np.uint64(64 - max(4, (3 * max(1, len(keys)) // 2).bit_length()))
        self.size = 1 << (64 - int(self.shift))
        self.keys, self.values = np.full(self.size, self.FREE), np.zeros(self.size)
        left = np.arange(len(keys))
        at = self._at(keys)
        while len(left):
            free = self.keys[at] == self.FREE
            self.keys[at[free]], self.values[at[free]] = keys[left[free]], values[left[free]]
            lost = self.keys[at] != keys[left]
            left, at = left[lost], (at[lost] + 1) % self.size

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray, without: float) -> np.ndarray:
        out = np.full(len(keys), without)
        at, left = self._at(keys), None
        while len(at):
            there = self.keys[at]
            same = there == keys
            more = np.flatnonzero(~same & (there != self.FREE))
            if left is None:
                out = np.where(same, self.values[at], without)
                left = more
            else:
                out[left[same]] = self.values[at[same]]
                left = left[more]
            keys, at = keys[more], (at[more] + 1) % self.size
        return out


RESULT = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("log_counts", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ]
)


ANSWERS = "block long, words boolean, keys binary, numbers binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ANSWERS: rising keys as differences, which take less disk, and their values (64 bits each), words and strings apart."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        blocks, keys, values = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((keys, blocks))  # words first
        blocks, keys, values = blocks[order], keys[order], values[order]
        turns = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(keys < 0) != 0)) + 1
        for first, last in zip([0, *turns.tolist()], [*turns.tolist(), len(blocks)], strict=True):
            for lo in range(first, last, PACKED):
                hi = min(lo + PACKED, last)
                row = [[int(blocks[lo])], [bool(keys[lo] < 0)], [np.diff(keys[lo:hi], prepend=0).tobytes()], [values[lo:hi].tobytes()]]
                kinds = (pa.int64(), pa.bool_(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, type=k) for x, k in zip(row, kinds, strict=True)], names=["block", "words", "keys", "numbers"])
        held.clear()

    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy() for c in ("block", "key", "value")))
        size += batch.num_rows
        if size > PACKING:
            yield from out()
            size = 0
    if size:
        yield from out()
    trimmed(collect=False)


def _unpacked(answers: pa.Table, words_: bool) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values of the packed rows of words, or of strings."""
    rows = answers.filter(answers["words"] if words_ else pc.invert(answers["words"]))
    keys = [np.cumsum(np.frombuffer(x.as_buffer(), dtype=np.int64)) for x in rows["keys"]]
    numbers = [np.frombuffer(x.as_buffer(), dtype=np.float64) for x in rows["numbers"]]
    return np.concatenate([np.zeros(0, dtype=np.int64), *keys]), np.concatenate([np.zeros(0), *numbers])


def _score(smooth: float, names: list[str], order: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        trimmed(collect=False)  # of the block before
        costs, (asked, values) = Table(*_unpacked(answers, False)), _unpacked(answers, True)
        # A word without an answer occurs in this block alone: its own count is the whole one.
        known = []
        for batch in docs.to_batches():
            data, offsets = utf8(batch.column("text"))
            train = batch.column("train").to_numpy(zero_copy_only=False)
            for lo, hi in chunks(offsets):
                k, d = tokens(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                known.append(_asked(k, train[lo:hi][d]))
            known.append((np.array([END_WORD]), np.array([train.sum()])))
        own, n = _sum(np.concatenate([k for k, _ in known]), np.concatenate([c for _, c in known])) if known else (asked[:0], values[:0])
        alone = ~_within(own, np.sort(asked))
        counts = Table(np.concatenate([asked, own[alone]]), np.concatenate([values, n[alone].astype(np.float64)]))
        del known, asked, values, own, n, alone
        end = float(counts.get(np.array([END_WORD]), 0.0)[0])
        out: list[list[np.ndarray]] = [[], [], [], []]
        for batch in docs.to_batches():
            data, offsets = utf8(batch.column("text"))
            for lo, hi in chunks(offsets):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                k, d = tokens(part, at)
                c, m = counts.get(k, 0.0), hi - lo
                out[0].append(np.bincount(d, minlength=m) + 1)
                out[1].append(np.bincount(d[c > 0], minlength=m) + int(end > 0))
                out[2].append(np.bincount(d, weights=np.log10(c + smooth), minlength=m) + math.log10(end + smooth))
                s, d = strings(part, at, order)
                out[3].append(np.bincount(d, weights=costs.get(s, np.nan), minlength=m))
        made = [np.concatenate(x) if x else np.zeros(0) for x in out]
        columns = [docs[c] for c in names] + [pa.array(made[0].astype(np.int64)), pa.array(made[1].astype(np.int64)), pa.array(made[2]), pa.array(made[3])]
        return pa.table(columns, names=[*names, *RESULT.fieldNames()])

    return run


def costs_of(wanted: list[int], levels: list[dict[int, int]]) -> list[float]:
    """log10 of the probability of each wanted byte, from the counts in its contexts, longest first."""
    out: dict[int, float] = {}
    so_far, seen = 0.0, set()
    left = set(wanted)
    for level in levels:
        counts = {s: n for s, n in level.items() if s not in seen}
        if not counts:
            continue
        below = sum(counts.values()) + len(counts)
        for s in left & counts.keys():
            out[s] = so_far + math.log10(counts[s] / below)
        left -= counts.keys()
        seen |= counts.keys()
        so_far += math.log10(len(counts) / below)
        if not left:
            break
    for s in left:
        out[s] = so_far - math.log10(SYMBOLS - len(seen))
    return [out[s] for s in wanted]


def _price(order: int, low: dict[int, dict[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, prices = [], []
            for row in batch.to_pylist():
                levels = [dict(zip(row[f"s{k}"], row[f"n{k}"], strict=True)) for k in range(order, 1, -1) if row[f"s{k}"]]
                levels += [low.get(row["context"] & 0xFF, {}), low.get(-1, {})]
                codes += [row["context"] << 8 | s for s in row["wanted"]]
                prices += costs_of(row["wanted"], levels)
            yield pa.RecordBatch.from_arrays([pa.array(codes, type=pa.int64()), pa.array(prices, type=pa.float64())], names=["key", "value"])
        trimmed(collect=False)

    return run


def string_costs(asked: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, value): log10 probability of the last byte of each string asked for, after the others."""
    spark = asked.sparkSession
    total = stored(asked.groupBy("key").agg(F.sum("train").alias("n")), "strings")
    level = total.where("n > 0").select((F.shiftright("key", 8)).alias("context"), F.col("key").bitwiseAND(F.lit(255)).alias("s"), "n")
    rows = total.groupBy(F.shiftright("key", 8).alias("context")).agg(F.collect_list(F.col("key").bitwiseAND(F.lit(255))).alias("wanted"))
    low: dict[int, dict[int, int]] = {}
    for k in range(order, -1, -1):
        if k < order:
            shorter = F.col("context").bitwiseAND(F.lit((1 << 8 * k) - 1)) if k else F.lit(-1).cast("long")
            level = level.groupBy(shorter.alias("context"), "s").agg(F.sum("n").alias("n"))
        if k > 1:
            # A context's bytes: 256 at most.
            by = level.groupBy(F.col("context").alias("c")).agg(F.collect_list(F.struct("s", "n")).alias("x"))
            by = by.select("c", F.col("x.s").alias(f"s{k}"), F.col("x.n").alias(f"n{k}"))
            wider = rows.join(by, F.col("context").bitwiseAND(F.lit((1 << 8 * k) - 1)) == F.col("c"), "left").drop("c")
            # One level's shuffle and table on disk at a time.
            before, rows = rows, stored(wider, "contexts")
            if k < order:
                discarded(before)
            released(spark)
        else:
            for r in level.collect():  # at most 256 * 256 rows, then 256
                low.setdefault(r.context, {})[r.s] = r.n
    ship(spark)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("value", T.DoubleType())])
    costs = stored(rows.mapInArrow(_price(order, low), schema), "costs")
    for finished in (rows, total):
        discarded(finished)
    return costs


def blocks_of(docs: DataFrame, place: Column | None, block_bytes: int) -> DataFrame:
    """``docs`` with ``block``.  ``place``: a struct of a string and a row number that tell where a row
    lies (neighbours form a block without moving); without it, rows are dealt by a hash and moved."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    total = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    blocks = max(1, -(-int(total.b) // block_bytes))
    rows = max(1, int(total.n) // blocks)
    if place is None:
        own = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))
        return docs.withColumn("block", own).repartition(blocks, "block").sortWithinPartitions("block")
    number = F.xxhash64(place["file"], F.floor(place["row"] / rows))
    alone = F.xxhash64(place["file"], place["row"], F.lit("alone"))
    return docs.withColumn("block", F.when(size > ALONE, alone).otherwise(number)).drop("place")


def score(docs: DataFrame, train: Column, place: Column | None = None, smooth: float = 0.1, order: int = ORDER, block_bytes: int = BLOCK) -> DataFrame:
    """Per document: doc_id, train (the condition), n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", train.alias("train"), *([place.alias("place")] if place is not None else []))
    rows = blocks_of(rows, F.col("place") if place is not None else None, block_bytes)
    rows = rows.select("block", "doc_id", "text", "train")
    ship(spark)
    asked = rows.select("block", "text", "train").mapInArrow(_count(order), "block long, key long, train long")
    asked = stored(asked, "asked", **PACKED_NUMBERS)
    of_words = asked.where("key < 0")
    costs = string_costs(asked.where("key >= 0").select("key", "train"), order)
    # Words of several blocks are answered; of the others one row each is kept for the number of words.
    w = Window.partitionBy("key")
    summed = of_words.select(
        "block", "key", F.sum("train").over(w).alias("n"), F.count("*").over(w).alias("blocks"), F.row_number().over(w.orderBy("block")).alias("i")
    )
    several, first = F.col("blocks") > 1, (F.col("i") == 1) & (F.col("n") > 0)
    summed = summed.where(several | first).select(
        F.when(several, F.col("block")).alias("block"), F.when(several, F.col("key")).alias("key"), F.when(several, F.col("n")).cast("double").alias("value"), first.alias("first")
    )
    summed = stored(summed, "words")
    released(spark)
    n = int(of_words.agg(F.coalesce(F.sum("train"), F.lit(0)).alias("n")).first().n)
    v = summed.where("first").count()
    # The largest shuffle, in turns: that of one is on disk at a time.
    turns = []
    for i in range(TURNS):
        mine = F.pmod("key", F.lit(TURNS)) == i
        said = asked.where("key >= 0").where(mine).select("block", "key").join(costs.where(mine), "key").select("block", "key", "value")
        if i == 0:
            said = said.unionByName(summed.where("key is not null").select("block", "key", "value"))
        turns.append(stored(said.mapInArrow(_pack, ANSWERS), "answers"))
        del said
        released(spark)
    answers = reduce(DataFrame.unionByName, turns)
    for finished in (asked, summed, costs):
        discarded(finished)
    released(spark)
    names = ["doc_id", "train"]
    schema = T.StructType([rows.schema[c] for c in names] + RESULT.fields)
    scored = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(smooth, names, order), schema)
    below = math.log10(n + smooth * (v + 1))
    return scored.select(
        "doc_id",
        "train",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.lit(below)).alias("base_score"),
        "score",
    )
