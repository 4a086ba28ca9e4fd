import math

import numpy as np
import pytest
from llm_rows import SF01, none, odd  # noqa: F401
from pyspark.sql import functions as F

from skein.llm import toxicity
from skein.llm.common import remainder

SF1 = "/root/testdata/sf0.1"


@pytest.mark.parametrize("dense", [1, 8, 1000])
def test_search_equals_all_cosines(monkeypatch, dense):
    # No term, some terms and all terms as rows of the matrix.
    monkeypatch.setattr(toxicity, "DENSE", dense)
    r = np.random.default_rng(3)
    terms = sorted(r.integers(-(1 << 60), 1 << 60, 40).tolist())
    idf = r.uniform(0.5, 3, 40).tolist()
    index = toxicity.Index(terms, idf, [])

    def text():
        pick = np.sort(r.choice(40, r.integers(1, 9), replace=False))
        return np.array(terms)[pick], r.integers(1, 4, len(pick))

    vectors = [index.vector(*text()) for _ in range(2000)]
    vectors += vectors[:90]  # ties
    vectors.append((np.zeros(0, dtype=np.int64), np.zeros(0)))
    index = toxicity.Index(terms, idf, vectors)
    assert index.blocks > sum(toxicity.WAVES)
    dense = np.zeros((len(vectors), 40))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    queries = [index.vector(*text()) for _ in range(200)]
    for q, got in zip(queries, index.nearest(queries, 15), strict=True):
        x = np.zeros(40)
        x[q[0]] = q[1]
        sims = np.round(dense @ x, 12)
        want = [i for i in np.lexsort((np.arange(len(sims)), -sims))[:15].tolist() if sims[i] > 0]
        assert [i for _, i in got] == want
        assert all(math.isclose(s, sims[i], abs_tol=1e-9) for s, i in got)


def test_term_weights_by_hand():
    # Word 5 is in both toxic examples alone, 7 in all, 9 in one of the two others.
    terms, toxic = np.array([5, 7, 5, 7, 7, 9, 7]), np.array([1, 1, 1, 1, 0, 0, 0])
    names, w = toxicity.term_weights(terms, toxic, 2, 2)
    assert names.tolist() == [5, 7, 9]
    idf = [math.log(5 / (1 + n)) + 1 for n in (2, 4, 1)]
    chi = [4 * (4 - 2) ** 2 / (2 * 2 * 2 * 2), 0.0, 4 * (2 - 2) ** 2 / (1 * 3 * 2 * 2)]
    assert np.allclose(w, [i * (toxicity.FLOOR + c / (c + toxicity.HALF)) for i, c in zip(idf, chi)])


def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF1}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, toxicity.trained(labels))
    out = toxicity.score(docs, model).join(labels.where("toxic is not null"), "doc_id").where(remainder(F.col("doc_id"), 5) == 0)
    rows = [(r.score, r.toxic, r.text, r.neighbours) for r in out.select("score", "toxic", "text", "neighbours").collect()]
    assert all(0 <= s <= 1 for s, *_ in rows)
    assert sum(not n for _, _, t, n in rows if t) < 0.05 * len(rows)
    bad, clean = [s for s, y, *_ in rows if y == 1], [s for s, y, *_ in rows if y == 0]
    assert sum(s >= 0.5 for s in bad) >= 0.9 * len(bad)
    assert sum(s >= 0.5 for s in clean) < 0.01 * len(clean)
    # Calibrated: scores add up to about the number of toxic rows.
    assert 0.85 * len(bad) < sum(s for s, *_ in rows) < 1.15 * len(bad)


def test_fit_repeats_itself(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    one, two = (toxicity.fit(docs, toxicity.trained(labels)) for _ in range(2))
    assert one.index.terms.tolist() == two.index.terms.tolist() and one.ids == two.ids and one.curve == two.curve
    few = toxicity.fit(docs, toxicity.trained(labels), max_postings=5000)
    assert 0 < len(few.ids) < len(one.ids) and len(few.index.part) < 10_000


def test_one_id_with_two_texts(spark):
    docs = spark.createDataFrame([(i % 30, f"{'bad' if i % 2 else 'good'} word{i}") for i in range(60)], "doc_id int, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id int, toxic int")
    fits = [toxicity.fit(d, labels) for d in (docs, docs.orderBy(F.desc("text")).repartition(3))]
    assert len(fits[0].ids) == 30 and fits[0].index.terms.tolist() == fits[1].index.terms.tolist()


def test_odd_rows(spark, odd, none):
    docs = spark.createDataFrame([(i, "bad words" if i % 2 else "good things", "x") for i in range(40)], "doc_id int, text string, neighbours string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)] + [(None, 1, 1), (3, None, None), (99, 1, 1), (4, 1, 7)], "doc_id int, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[1].score > 0.5 > got[2].score and 1 in got[3].neighbours and len(got) == 40
    scored = toxicity.score(odd, model)
    assert scored.count() == odd.count() and scored.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(none, model).count() == 0
    empty = toxicity.fit(odd, labels.limit(0))
    assert {r.score for r in toxicity.score(odd, empty).collect()} == {0.0}
    assert {r.score for r in toxicity.score(odd, toxicity.fit(none, labels)).collect()} == {0.0}


def test_empty_text_gets_the_share_of_texts_without_terms(spark):
    docs = spark.createDataFrame([(i, "awful" if i < 20 else "" if i < 50 else "nice") for i in range(100)], "doc_id int, text string")
    labels = spark.createDataFrame([(i, int(i < 20 or i == 30)) for i in range(100)], "doc_id int, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.text: r.score for r in toxicity.score(docs, model).collect()}
    assert got[""] < 0.2 and got["awful"] > 0.8


def test_the_driver_keeps_no_memory_of_the_fit(spark):
    def resident():
        with open("/proc/self/smaps_rollup") as f:
            return sum(int(line.split()[1]) for line in f if line.startswith(("Pss_Anon:", "Pss_Shmem:"))) / 1024

    words = F.transform(F.sequence(F.lit(1), F.lit(400)), lambda x: F.concat(F.lit("w"), F.pmod(F.xxhash64("doc_id", x), F.lit(60000))))
    docs = spark.range(3000).select(F.col("id").alias("doc_id")).withColumn("text", F.concat_ws(" ", words))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    toxicity.fit(docs.limit(20), labels)
    before = resident()
    model = toxicity.fit(docs, labels)
    own = sum(x.nbytes for x in vars(model.index).values() if isinstance(x, np.ndarray)) / (1 << 20)
    assert len(model.ids) > 2500 and own > 10
    assert resident() - before < own + 40
