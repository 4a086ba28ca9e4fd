import random
import re

import pytest
from pyspark.sql import functions as F

from llm_rows import SF01, none, odd  # noqa: F401
from skein.llm import jaccard
from skein.llm.components import components


def sets_of(rows, size):
    out = []
    for i, t in rows:
        w = [x for x in re.split(rb"[\x20\x09-\x0D]+", (t or "").encode().lower()) if x]
        out.append((i, frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])))
    return out


def brute(rows, size, num, den):
    sets = sets_of(rows, size)
    least = {}
    for i, s in sets:
        if s and i is not None:
            least[s] = min(i, least.get(s, i))
    parent = {i: i for i in least.values()}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    items = list(least.items())
    for a, (x, i) in enumerate(items):
        for y, j in items[:a]:
            n = len(x & y)
            if den * n >= num * (len(x) + len(y) - n):
                p, q = sorted((top(i), top(j)))
                parent[q] = p
    return sorted(((i, len(s), top(least[s]) if s and s in least else i if not s else None) for i, s in sets), key=repr)


def copies(seed, groups, each, edits, words=120):
    r, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{k}" if k % 3 else f"common{k}" for k in range(r.randint(8, words))]
        for _ in range(each):
            w = list(base)
            for _ in range(r.randint(0, edits)):
                at = r.randrange(len(w))
                w[at : at + 1] = r.choice([[], [f"new{r.random()}"], [w[at], "extra"]])
            rows.append((len(rows) * 7 % 10007, " ".join(w)))
    return rows


@pytest.mark.parametrize("size, num, cell, depth", [(3, 90, 1500, 2), (5, 80, 4, 2), (2, 85, 3, 1)])
def test_components_equal_brute_force(spark, odd, size, num, cell, depth):
    rows = copies(size, 6, 14, 6) + [tuple(r) for r in odd.select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(map(tuple, jaccard.component_ids(docs, size, num, 100, cell=cell, depth=depth).collect()), key=repr)
    want = [w for w in brute(rows, size, num, 100) if w[0] is not None or w[1] == 0]
    assert [g for g in got if g[0] is not None or g[1] == 0] == want
    assert len(got) == len(rows)


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = sorted(map(tuple, jaccard.component_ids(docs, 5, 80, 100).collect()), key=repr)
    assert got == brute(rows, 5, 80, 100)


def test_linked_sets_share_a_signature():
    """The projections lose no pair: sets at the threshold's edge, all sizes."""
    import numpy as np

    r = np.random.default_rng(1)
    for n in [*range(1, 80), 150, 333, 1000]:
        x = r.integers(1, 1 << 63, n, dtype=np.uint64)
        for drop in range(n):
            add = 0
            while 100 * (n - drop) >= 90 * (n + add + 1):
                add += 1
            if 100 * (n - drop) < 90 * (n + add):
                break
            y = np.concatenate([x[drop:], r.integers(1, 1 << 63, add, dtype=np.uint64)])
            if drop + add:
                a, b = (jaccard.signatures(np.unique(v), 90, 100) for v in (x, y))
                assert len(np.intersect1d(a, b)), (n, drop, add)
                # Nor does leaving out the most frequent parts, however the frequencies lie: here those of x and y alike.
                for often in (lambda r: r % np.uint64(7), lambda r: np.isin(r, a) & np.isin(r, b)):
                    left = [rarest(*jaccard.parts_of(np.unique(v), 90, 100), often) for v in (x, y)]
                    assert left[0] & left[1], (n, drop, add)


def rarest(parts, drops, often):
    """The plan's choice, in Python."""
    kept = set()
    for d in set(drops.tolist()):
        mine = parts[drops == d]
        ranked = sorted(zip((-often(mine).astype(int)).tolist(), mine.view("int64").tolist(), strict=True))
        kept |= {r for _, r in ranked[d // 2 :]}
    return kept


def test_rarest_parts_of_the_plan(spark):
    rows = [(r, 1, 2 * 2, often) for r, often in [(5, 9), (6, 3), (7, 9), (8, 1)]] + [(5, 1, 1, 9), (5, 2, 0, 9), (6, 2, 9, 3)]
    got = jaccard._rarest(spark.createDataFrame(rows, "region long, fp long, drop long, often long"))
    assert sorted((r.region, r.fp, r["drop"]) for r in got.collect()) == [(5, 1, 1), (5, 2, 0), (6, 1, 4), (8, 1, 4)]


def test_boilerplate_makes_no_large_cells(spark):
    """Different texts that share a passage, and near copies among them: whole links, and few pairs looked at."""
    r, shared, rows = random.Random(7), " ".join(f"b{i}" for i in range(60)), []
    for g in range(300):
        own = [f"o{g}w{i}" for i in range(r.randint(60, 90))]
        rows.append((len(rows), " ".join(own[:30]) + " " + shared + " " + " ".join(own[30:])))
        if g % 10 == 0:
            rows.append((len(rows), rows[-1][1] + " end"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, jaccard.component_ids(docs, 5, 80, 100, cell=20).collect()), key=repr)
    assert got == brute(rows, 5, 80, 100)


def test_removal_keeps_one_of_each_component(spark, none):
    rows = [(1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (3, None, "z"), (None, "a b c d e f g", "n"), (4, "other words stand here", "z")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, fp string")
    got = jaccard.near_duplicates_removed(docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == {1, 3, 4, None}
    assert jaccard.component_ids(none).count() == 0 and jaccard.near_duplicates_removed(none).count() == 0


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "u long, v long")
    got = {r.u: r.v for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}
    assert components(links.limit(0)).count() == 0


def test_whole_table_with_the_registered_parameters(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, jaccard.component_ids(docs, 3, 90, 100).collect()), key=repr)
    assert got == brute([tuple(r) for r in docs.collect()], 3, 90, 100)


def test_one_id_on_several_texts(spark):
    """Links are between texts: an id's texts keep theirs, and only the text that is a copy goes."""
    text = lambda k: " ".join(f"{k}w{i}" for i in range(100))
    rows = [(1, text("a")), (1, text("b")), (5, text("a") + " more"), (6, text("b") + " more"), (2, text("a")), (2, text("unique"))]
    rows += [(7, text("p")), (3, text("p") + " x"), (7, text("q")), (9, text("q") + " x"), (11, text("r")), (11, text("r") + " x"), (11, text("r"))]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_shingles int").repartition(4)
    for _ in range(2):
        ids = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.component_ids(docs).collect()}
        assert ids == {(1, 98, 1), (5, 99, 1), (6, 99, 1), (2, 98, 1), (2, 98, 2), (7, 98, 3), (3, 99, 3), (7, 98, 7), (9, 99, 7), (11, 98, 11), (11, 99, 11)}
        left = sorted((r.doc_id, r.text.split()[0][0], len(r.text.split())) for r in jaccard.near_duplicates_removed(docs).collect())
        assert [x for x in left if x[0] != 11] == [(1, "a", 100), (1, "b", 100), (2, "u", 100), (3, "p", 101), (7, "q", 100)]
        # Of one id's two like texts one stays, with its repeats.
        assert [x for x in left if x[0] == 11] in ([(11, "r", 100)] * 2, [(11, "r", 101)])


def test_a_filter_is_collected_in_pieces_and_whole(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PIECE", 1 << 12, raising=False)
    kind = type(spark.range(0))
    got, collect = [], kind.toArrow
    monkeypatch.setattr(kind, "toArrow", lambda df: got.append(collect(df)) or got[-1])
    bits = jaccard._marks(spark.range(1 << 17).select(F.xxhash64("id").alias("region")), "region").value
    assert len(bits) == 1 << 15 and max(t.num_rows for t in got) <= 1 << 12
    keys = spark.range(1 << 18).select(F.xxhash64("id").alias("region")).toPandas()["region"].to_numpy()
    assert jaccard._marked(bits, keys[: 1 << 17]).all() and jaccard._marked(bits, keys[1 << 17 :]).mean() < 0.15


def test_filters_are_let_go(spark, monkeypatch):
    made, marks = [], jaccard._marks
    monkeypatch.setattr(jaccard, "_marks", lambda *a: made.append(marks(*a)) or made[-1])
    docs = spark.createDataFrame(copies(3, 6, 14, 6), "doc_id long, text string")
    left = jaccard.near_duplicates_removed(docs, cell=4)
    assert made and not any(b._jbroadcast.isValid() for b in made)
    assert 0 < left.count() < docs.count()
