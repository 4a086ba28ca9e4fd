import corpus_pipeline
import pytest
from llm_rows import SF001, SF01, none, odd  # noqa: F401
from test_decontamination import split
from test_jaccard import brute

from skein.llm import toxicity
from skein.llm.common import stored


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage got and gave on the table."""
    docs, out = spark.read.parquet(f"{SF01}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = stored(stage(spark, docs, SF01), "steps")
        out[name] = (docs, made)
        docs = made
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_toxic_documents_go_and_clean_ones_stay(spark, steps):
    docs, made = steps["toxicity"]
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, toxicity.trained(labels)))
    assert texts(made) == texts(scored.where("score < 0.5")) and made.columns == docs.columns
    clean = labels.where("toxic = 0")
    assert made.join(clean, "doc_id").count() >= 0.98 * docs.join(clean, "doc_id").count()


def test_one_of_each_group_stays(steps):
    docs, made = steps["near_duplicates"]
    rows = list(texts(docs).items())
    assert sorted(texts(made)) == sorted({i for i, n, c in brute(rows, 5, 80, 100) if not n or i == c}) and made.columns == docs.columns


def test_no_benchmark_window_is_left(spark, steps):
    docs, made = steps["decontamination"]
    before, after = texts(docs), texts(made)
    windows = set()
    for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect():
        w = split(r.text)
        windows |= {tuple(w[j : j + 10]) for j in range(max(1, len(w) - 9))}
    hit = {i for i, t in before.items() if any(tuple(split(t)[j : j + 10]) in windows for j in range(len(split(t))))}
    assert hit and set(before) - set(after) <= hit
    for i, t in after.items():
        assert t == before[i] if i not in hit else len(t) < len(before[i])
    assert all(r.n_chars == len(r.text) for r in made.collect())


def test_pseudonyms_and_pieces(steps):
    docs, made = steps["pii"]
    assert sorted(texts(docs)) == sorted(texts(made)) and made.columns == docs.columns
    kept, pieces = steps["pieces"]
    assert pieces.count() == kept.count() and pieces.where("not lossless").count() == 0


def test_run_and_odd_rows(spark, odd, none):
    assert corpus_pipeline.run(spark, SF001).count() > 0
    for table in (odd, none):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF001), "odd", name)
        assert docs.count() == (0 if table is none else docs.count())
