from collections import Counter

import pytest

from llm_rows import none, odd  # noqa: F401
from skein.llm import sharding


def brute(names, size):
    """The turns, by lists of all preferences."""
    order = []
    for s in sorted(names):
        a, b = sharding._number("offset", s) % size, sharding._number("step", s) % (size - 1) + 1
        order.append([(a + j * b) % size for j in range(size)])
    table, k = {}, 0
    while len(table) < size:
        table[next(x for x in order[k % len(order)] if x not in table)] = k % len(order)
        k += 1
    return [table[i] for i in range(size)]


def test_table_equals_brute_force_and_is_even():
    names = tuple(f"s{i}" for i in range(7))
    table = sharding.fill(names, 101)
    assert table == brute(names, 101)
    loads = Counter(sharding.fill(sharding.SHARDS)).values()
    assert max(loads) - min(loads) <= 1 and len(loads) == len(sharding.SHARDS)
    heavy = Counter(sharding.fill({"a": 3, "b": 1}, 1009))
    assert abs(heavy[0] - 3 * heavy[1]) <= 4


def test_few_slots_move_when_a_shard_leaves():
    names = sorted(sharding.SHARDS)
    before, after = sharding.fill(tuple(names)), sharding.fill(tuple(names[1:]))
    moved = sum(1 for a, b in zip(before, after) if a != 0 and names[a] != names[1:][b])
    assert moved < 0.1 * sharding.SIZE


def test_bad_parameters():
    for shards, size in (((), 7), (("a",), 8), (tuple("abcdefgh"), 7), ({"a": 0}, 7)):
        with pytest.raises(ValueError):
            sharding.fill(shards, size)


def test_odd_rows(spark, odd, none):
    got = sharding.place(odd, "doc_id")
    assert got.count() == odd.count() and set(got.columns) == set(odd.columns)
    same = got.where("doc_id = 5").select("slot", "shard").distinct().collect()
    assert len(same) == 1 and same[0].shard in sharding.SHARDS
    assert got.where("shard is null").count() == 0
    assert sharding.report(none).count() == 0
    assert "Python" not in sharding.report(odd)._jdf.queryExecution().toString().replace("PythonRDD", "")


def test_report_equals_brute_force(spark, odd):
    from hashlib import md5

    first = sharding.fill(sharding.SHARDS)
    for r in sharding.report(odd).collect():
        key = md5(("null" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()
        assert r.slot == int(key[:15], 16) % sharding.SIZE and r.shard == sorted(sharding.SHARDS)[first[r.slot]]
