import itertools
import math
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from llm_rows import SF001, none, odd  # noqa: F401
from pyspark.sql import functions as F

from skein.llm import common, ppm
from skein.llm.common import remainder


def brute(rows, order=ppm.ORDER, smooth=0.1):
    """rows: (doc_id, text, train)."""
    trie, words = defaultdict(Counter), Counter()
    symbols = lambda t: [ppm.START] * order + list((t or "").encode()) + [ppm.END]
    split = lambda t: [w for w in re.split(rb"[\x20\x09-\x0D]+", (t or "").encode().lower()) if w] + [None]
    for _, t, train in rows:
        if train:
            s = symbols(t)
            for i in range(order, len(s)):
                for k in range(order + 1):
                    trie[tuple(s[i - k : i])][s[i]] += 1
            words.update(split(t))
    n, v = sum(words.values()), len(words)
    out = []
    for i, t, train in rows:
        s, total = symbols(t), 0.0
        for at in range(order, len(s)):
            seen = set()
            for k in range(order, -1, -1):
                left = {x: c for x, c in trie[tuple(s[at - k : at])].items() if x not in seen}
                if not left:
                    continue
                below = sum(left.values()) + len(left)
                if s[at] in left:
                    total += math.log10(left[s[at]] / below)
                    break
                total += math.log10(len(left) / below)
                seen |= set(left)
            else:
                total -= math.log10(ppm.SYMBOLS - len(seen))
        w = split(t)
        base = sum(math.log10((words[x] + smooth) / (n + smooth * (v + 1))) for x in w)
        out.append((i, train, len(w), sum(words[x] > 0 for x in w), n, base, total))
    return sorted(out, key=repr)


def close(got, want):
    got = sorted(map(tuple, got), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9, abs_tol=1e-9), (g, w)


@pytest.mark.parametrize("block", [ppm.BLOCK, 2000])
def test_scores_equal_brute_force(spark, odd, block):
    docs = odd.select("doc_id", F.substring("text", 1, 3000).alias("text"), "score", "n_words")
    train = remainder(F.col("doc_id"), 3) != 0
    rows = [tuple(r) for r in docs.select("doc_id", "text", train).collect()]
    close(ppm.score(docs, train, block_bytes=block).collect(), brute(rows))


def test_whole_table_by_place(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("n_chars < 1500")
    train = remainder(F.col("doc_id"), 10) != 0
    rows = [tuple(r) for r in docs.select("doc_id", "text", train).collect()]
    placed = docs.select("doc_id", "text", F.struct(F.lit("f").alias("file"), F.monotonically_increasing_id().alias("row")).alias("p"))
    close(ppm.score(placed, train, place=F.col("p"), block_bytes=20000).collect(), brute(rows))


def test_probabilities_sum_to_one():
    levels = [{65: 3, 66: 1}, {65: 4, 66: 2, 67: 9}, {}, {i: i + 1 for i in range(40)}, {ppm.END: 2, 5: 1}]
    every = [s for s in range(256) if s != ppm.START]
    total = sum(10**x for x in ppm.costs_of(every, levels))
    assert math.isclose(total, 1.0, rel_tol=1e-9)
    assert math.isclose(sum(10**x for x in ppm.costs_of(every, [])), 1.0)


def test_strings_and_lookup():
    code, d = ppm.strings(np.frombuffer(b"abc", dtype=np.uint8), np.array([0, 2, 2, 3]), 2)
    s, e = ppm.START, ppm.END
    assert [tuple(int(c) >> k & 255 for k in (16, 8, 0)) for c in code] == [(s, s, 97), (s, 97, 98), (97, 98, e), (s, s, e), (s, s, 99), (s, 99, e)]
    assert d.tolist() == [0, 0, 0, 1, 2, 2]
    r = np.random.default_rng(2)
    keys = np.unique(r.integers(-(1 << 62), 1 << 62, 5000))
    t = ppm.Table(np.r_[keys, keys[:100]], np.r_[keys % 97, keys[:100] % 97].astype(float))
    assert np.array_equal(t.get(keys, -1), keys % 97) and (t.get(keys + 1, -1.0)[~np.isin(keys + 1, keys)] == -1).all()
    assert ppm.Table(keys[:0], keys[:0]).get(keys[:3], 7.0).tolist() == [7, 7, 7]


def test_no_training_texts_and_no_texts(spark, odd, none):
    rows = [(i, t, False) for i, t in ((r.doc_id, r.text) for r in odd.where("doc_id in (2, 8) or doc_id is null").collect())]
    docs = odd.where("doc_id in (2, 8) or doc_id is null").select("doc_id", "text")
    close(ppm.score(docs, F.lit(False)).collect(), brute(rows))
    assert ppm.score(none, F.lit(True)).count() == 0


def test_a_byte_five_places_back_tells(spark):
    rows = [(i, t, i < 40) for i, t in enumerate(["xabcd1", "zabcd2"] * 20 + ["xabcd1", "xabcd2"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    got = {r.doc_id: r.score for r in ppm.score(docs, F.col("train")).where("not train").collect()}
    assert got[40] > got[41] + 1


def test_answers_come_as_packed_rows(monkeypatch):
    # Few long rows for a block, not a row for each string and word.
    monkeypatch.setattr(ppm, "PACKED", 1000)
    monkeypatch.setattr(ppm, "PACKING", 20_000)
    r = np.random.default_rng(5)
    want = {(b, int(k)): float(r.random()) for b in range(3) for k in r.integers(-(1 << 62), 1 << 48, 20_000)}
    keys = np.array([k for _, k in want], dtype=np.int64)
    blocks, values = np.array([b for b, _ in want], dtype=np.int64), np.array(list(want.values()))
    o = r.permutation(len(keys))
    batches = [pa.RecordBatch.from_arrays([pa.array(x[o][lo : lo + 5000]) for x in (blocks, keys, values)], names=["block", "key", "value"]) for lo in range(0, len(o), 5000)]
    rows = pa.Table.from_batches(list(ppm._pack(iter(batches))))
    assert rows.num_rows < 3 * 2 * 4 + len(keys) / 1000 * 2 and max(len(x.as_py()) for x in rows["keys"]) <= 8000
    for b in range(3):
        mine = rows.filter(pc.equal(rows["block"], b))
        got = {}
        for words in (True, False):
            k, v = ppm._unpacked(mine, words)
            assert ((k < 0) == words).all()
            got |= dict(zip(k.tolist(), v.tolist(), strict=True))
        assert got == {k: v for (x, k), v in want.items() if x == b}
    assert list(ppm._pack(iter([]))) == [] and len(ppm._unpacked(rows.slice(0, 0), True)[0]) == 0


def test_sums_of_sorted_runs():
    keys = np.concatenate([np.arange(-5, 5), np.arange(0, 9, 2), np.array([3])])
    u, n = ppm._sum(keys, np.arange(len(keys)))
    assert u.tolist() == sorted(set(keys.tolist()))
    assert n.tolist() == [sum(c for c, k in enumerate(keys.tolist()) if k == x) for x in u.tolist()]
    assert [len(x) for x in ppm._sum(keys[:0], keys[:0])] == [0, 0]


def test_finished_tables_go(spark, odd, workdir, monkeypatch):
    monkeypatch.setattr(common, "fresh_path", lambda s, *name: os.path.join(workdir, *name))
    numbers = itertools.count()
    monkeypatch.setattr(ppm, "stored", lambda df, *name, **options: common.stored(df, f"{name[0]}-{next(numbers)}", **options))
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    whole = ppm.score(docs, remainder(F.col("doc_id"), 10) != 0, block_bytes=1 << 16)
    keys = docs.count()
    assert {n.split("-")[0] for n in os.listdir(os.path.join(workdir, "llm"))} == {"answers"}
    assert whole.count() == keys
    # Rising keys lie as packed differences.
    rows = docs.select(F.lit(1).cast("long").alias("block"), "text", F.lit(True).alias("train")).coalesce(1).mapInArrow(ppm._count(ppm.ORDER), "block long, key long, train long")
    packed = common.stored(rows, "packed", **ppm.PACKED_NUMBERS)
    size = sum(os.path.getsize(os.path.join(packed._stored_at, f)) for f in os.listdir(packed._stored_at) if f.endswith(".parquet"))
    assert size < 7 * packed.count()
