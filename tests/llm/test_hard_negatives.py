"""Hard negatives against whole numbers of Python and against DuckDB."""

import math
import random

import numpy as np
import pytest
from llm_rows import SF001

from skein.llm import hard_negatives as H


@pytest.mark.parametrize("largest,width", [(3, 1), (200, 64), (40_000, 300), (1 << 22, 3000), (5, 0)])
def test_scores_are_exact(largest, width):
    rng = np.random.default_rng(largest)
    a, b = (rng.integers(-largest, largest + 1, (7, width)) for _ in range(2))
    a[0], b[0] = largest, -largest
    want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    primes = H.primes_for(float(width * largest * largest) + 1)
    assert H.scores(H.residues(a, primes), H.residues(b, primes), primes).tolist() == want


def test_primes():
    assert H.PRIMES[:4] == [251, 241, 239, 233] and all(all(p % q for q in range(2, p)) for p in H.PRIMES)
    assert math.prod(H.primes_for(H.LIMIT)) > 2 * H.LIMIT


def test_best_keeps_the_first_of_ties():
    s = np.array([[5, 7, 7, 7, 1], [2, 2, 2, 2, 2], [9, 8, 7, 6, 5]])
    r, c = H.best(s, s != 9, 2)
    assert list(zip(r.tolist(), c.tolist())) == [(0, 1), (0, 2), (1, 0), (1, 1), (2, 1), (2, 2)]


def brute(rows):
    """(vec_id, embedding, label) rows by the contract, with one row's copies as rows of their own."""
    fit = [r for r in rows if r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    fit = [(i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label) for i, v, label in fit]
    out = []
    for n, (i, v, label) in enumerate(fit):
        if i is None or i % 100:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, other) for m, (j, w, other) in enumerate(fit) if m != n]
        scored.sort(key=lambda r: (-r[0], r[1] is None, r[1]))
        for p, j, _ in [r for r in scored if r[2] == label][:5]:
            some = [r for r in scored if r[2] != label and 30 * p <= 100 * r[0] <= 90 * p][:10]
            out += [(i, j, k, r[1], p, r[0]) for k, r in enumerate(some, 1)]
    return sorted(out, key=str)


SCHEMA = "vec_id long, embedding array<float>, label int, rank string, anchor_id int, score int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows(spark):
    rng = random.Random(3)
    near = lambda: [rng.choice([0.1, 0.2, 0.25, -0.1, 0.0]) for _ in range(6)]
    rows = [(i, near(), rng.randint(0, 2)) for i in range(95, 220)]
    rows += [(100, rows[5][1], rows[5][2])] * 2 + [(i, [0.5] * 6, 1) for i in range(300, 340)]  # repeated anchor; one vector many times
    rows += [(None, near(), 1), (None, near(), 2), (400, None, 1), (500, near(), None), (600, [0.1, None], 1), (700, [], 1), (701, [], 2)]
    rows += [(800, [float("nan")], 1), (900, [float("inf")], 1), (1000, [0.25] * 9, 1), (1001, [0.2], 2), (1002, [3.0e4] * 9, 2), (1100, [3.1e4] * 3, 1)]
    want = brute(rows)
    assert len(want) > 100
    for block in (16_384, 17):
        moved = H.report(table(spark, rows)) if block == 16_384 else None
        got = moved if moved is not None else H.mine(
            table(spark, rows).selectExpr("vec_id", "embedding", "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label"),
            H.F.col("vec_id") % 100 == 0, block_rows=block,
        )
        assert result(got) == want


def test_empty_and_hopeless(spark):
    assert H.report(table(spark, [(1, [0.5], 1)]).limit(0)).count() == 0
    assert H.report(table(spark, [(1, [0.5], 1), (2, [0.4], 2)])).count() == 0
    assert H.report(table(spark, [(100, [0.5], 1), (2, [0.4], 2)])).count() == 0
    with pytest.raises(ValueError):
        H.report(table(spark, [(100, [3.0e38], 1)]))


def test_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding, r.label) for r in df.select("vec_id", "embedding", "label").collect()])
    assert result(H.report(df)) == want and len(want) > 10
