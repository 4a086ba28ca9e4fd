import re
from collections import Counter, defaultdict

import pytest

from llm_rows import SF001, none, odd  # noqa: F401
from skein.llm import line_frequency as lf

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute(rows, min_docs, max_share):
    lines = lambda t: [y for x in (t or "").split("\n") if (y := SPACE.sub(" ", x.lower()).strip(" "))]
    hosts, many = Counter(s for _, _, s in rows), defaultdict(set)
    for i, t, s in rows:
        for x in set(lines(t)):
            many[s, x].add(i)
    bad = {k for k, ids in many.items() if len(ids) > min_docs and len(ids) > max_share * hosts[k[0]]}
    out = []
    for i, t, s in rows:
        t = t or ""
        w = [x for x in SPACE.split(t) if x]
        at = defaultdict(list)
        for k in range(len(w) - 2):
            at[tuple(w[k : k + 3])].append(k)
        rep = {k + j for v in at.values() if len(v) > 1 for k in v for j in range(3)}
        ls = [x for x in t.split("\n") if SPACE.sub("", x)]
        gone = [x for x in lines(t) if (s, x) in bad]
        n, g = len(w), sum(len(x.split(" ")) for x in gone)
        failed = n < 50 or 100 * len(rep) > 50 * n
        kept = not failed and g <= 0.5 * n and n - g >= 50
        out.append((i, n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(ls) - len(set(ls)), len(rep), failed, g, len(set(gone)), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_docs, max_share", [(1, 0.0), (2, 0.3), (10, 0.005)])
def test_report_equals_brute_force(spark, odd, min_docs, max_share):
    shared = "one line that all of them have"
    body = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(30)]
    more = [(100 + i, f"{b}\n{shared}\n" + ("One  LINE that\tall of them have " * (i % 2)), "a" if i % 3 else "b") for i, b in enumerate(body)]
    docs = odd.select("doc_id", "text", "source", "kept").unionByName(
        spark.createDataFrame(more, "doc_id long, text string, source string"), allowMissingColumns=True
    )
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    got = sorted(map(tuple, lf.report(docs, min_docs, max_share).collect()), key=repr)
    assert got == brute(rows, min_docs, max_share)


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    assert sorted(map(tuple, lf.report(docs, 2, 0.1).collect()), key=repr) == brute(rows, 2, 0.1)


def test_cleaned_text(spark, none):
    rows = [(i, f"own {i}\nShared  line\nlast {i}", "h", i) for i in range(5)] + [(9, "Shared line", "other", 1), (10, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string, n_chars int")
    got = {r.doc_id: r.text for r in lf.cleaned(docs, 3, 0.0).collect()}
    assert got == {**{i: f"own {i}\nlast {i}" for i in range(5)}, 9: "Shared line", 10: None}
    assert lf.report(none).count() == 0 and lf.cleaned(none).count() == 0


def test_no_python_in_the_plan(spark, odd):
    plan = lf.report(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_repeats_of_one_document_are_one(spark):
    text = "\n".join(" ".join(f"w{k}x{i}" for i in range(12)) for k in range(8))
    rows = [(1, text, "h")] * 11 + [(2, text, "h")]
    got = lf.report(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert [(r.n_removed_words, r.kept) for r in got] == [(0, True)] * 12


def test_limit_does_not_grow_with_the_host(spark):
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    rows = [(i, body(i) + ("\na line of eleven documents" if i < 11 else ""), "h") for i in range(4000)]
    got = lf.report(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("n_removed_lines > 0")
    assert sorted(r.doc_id for r in got.collect()) == list(range(11))
