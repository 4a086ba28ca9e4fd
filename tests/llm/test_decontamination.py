import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from llm_rows import SF001, none, odd  # noqa: F401
from skein.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = split(t)
        if i is not None and w:
            k = min(10, len(w))
            for j in range(len(w) - k + 1):
                windows.setdefault(tuple(w[j : j + k]), set()).add(str(i))
    sizes, out = {len(w) for w in windows}, []
    for i, t in docs:
        w, hit, ids = split(t), set(), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if of := windows.get(tuple(w[j : j + k])):
                    hit |= set(range(j, j + k))
                    ids |= of
        out.append((i, len(w), len(hit), len(ids), sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 60])
def test_report_equals_brute_force(spark, odd, block):
    long_item = " ".join(f"Q{i}" for i in range(14))
    items = [(1, long_item), (1, long_item), (2, "two words"), (3, None), (None, "a text without"), (4, "!!"), (10, "q3-q4, Q5 q6 q7 q8 q9 q10 q11 q12"), (5, "")]
    more = [
        (50, "before " + long_item.lower() + " after"), (51, "Two words, two words! two"), (52, "q2 q3 q4 q5 q6 q7 q8 q9 q10 q11 q12"), (53, "q0 q1 q2 q3 q4 q5 q6 q7 q8")
    ]
    docs = odd.select("doc_id", "text", "n_words", "items").unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, dc.report(docs, bench, block_bytes=block).select(COLUMNS).collect()), key=repr)
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()], items)


def test_whole_table_equals_brute_force(spark):
    docs, bench = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert sorted(map(tuple, dc.report(docs, bench).select(COLUMNS).collect()), key=repr) == want
    assert any(w[5] for w in want)


def test_removal(spark, odd, none):
    item = " ".join(f"q{i}" for i in range(12))
    docs = spark.createDataFrame(
        [(1, f"Keep these words: {item.upper()}, and these too; they are the larger part of all words in here.", 1), (2, item + " rest", 2), (3, "clean", 3), (4, None, 4)],
        "doc_id int, text string, n_words int",
    )
    bench = spark.createDataFrame([("i", item)], "item_id string, text string")
    got = {r.doc_id: (r.text, r.n_words) for r in dc.remove_hits(docs, bench).collect()}
    assert got == {1: ("Keep these words: , and these too; they are the larger part of all words in here.", 1), 3: ("clean", 3), 4: (None, 4)}
    assert dc.remove_hits(odd, bench.limit(0)).count() == odd.count()
    assert dc.report(none, bench).count() == 0


def test_pieces_hold_every_window_once():
    text = "  ".join(f"wörd{i}," for i in range(57)) + " x"
    (parts,) = dc._pieces(10, 40)(pa.array([text]))[0].to_pylist()
    assert len(parts) > 5 and all(len(split(p)) >= 10 for p in parts)
    found = [tuple(w[j : j + 10]) for w in map(split, parts) for j in range(len(w) - 9)]
    w = split(text)
    assert found == [tuple(w[j : j + 10]) for j in range(len(w) - 9)]
    assert dc._pieces(10, 4)(pa.array(["only four words here", ""]))[0].to_pylist() == [["only four words here"], [""]]


def test_equal_hashes_are_told_apart():
    (table,) = dc.window_table([("a", "p q r"), ("b", "x y z"), ("c", "P q; r")], 3)
    table.hashes[:] = table.hashes[0]  # as if all collided
    assert sorted(table.items_of(table.hashes[0], b"p q r")) == ["a", "c"] and table.items_of(table.hashes[0], b"x y z") == ["b"]
    assert table.items_of(table.hashes[0], b"x y q") == []


def test_a_full_block_has_bounded_memory():
    """16 MB of items: the table's arrays, with the text, are under 200 MB."""
    r = np.random.default_rng(5)
    names = np.char.add("w", r.integers(0, 50_000, 2_800_000).astype("U"))
    items = [(str(i), " ".join(x)) for i, x in enumerate(np.split(names, 700))]
    assert 15 << 20 < sum(len(t) for _, t in items) < 20 << 20
    (table,) = dc.window_table(items)
    held = sum(x.nbytes for x in (table.hashes, table.first, table.item, table.bits, table.text.s, table.text.e)) + len(table.text.raw)
    assert held < 200 << 20 and len(table.hashes) > 2_700_000
