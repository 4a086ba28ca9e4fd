import pytest
from llm_rows import SF01, none, odd  # noqa: F401

from skein.llm import licences


@pytest.fixture(scope="module")
def model(spark):
    return licences.fit(spark.read.parquet(f"{SF01}/documents.parquet"))


def test_families_are_found(spark, model):
    texts = {
        1: ("Licensed under the Apache License, Version 2.0.", ["apache"]),
        2: ("Words before.\nReleased under the MIT License.\nThis work is licensed under the GNU General Public License, version 3.", ["gpl", "mit"]),
        3: ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"]),
        4: ("LICENSED UNDER CC BY 4.0", ["cc-by"]),
        5: ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", ["lgpl"]),
        6: ("This work is licensed under the GNU Affero General Public License, version 3.", ["agpl"]),
        7: ("The notice is on the door, and the terms of the contest are free to read in any version.", []),
        8: ("A licence to drive is a public matter; software is distributed in shops.", []),
        9: (None, []),
        10: ("", []),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id int, text string")
    got = {r.doc_id: r.families for r in licences.report(docs, model).collect()}
    assert got == {i: f for i, (_, f) in texts.items()}


def test_every_template_sentence_is_its_family(spark, model):
    rows = [(f"{f}:{i}", s, f) for f, ss in licences.TEMPLATES.items() for i, s in enumerate(ss)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, family string")
    for r in licences.report(docs, model).collect():
        family = r.doc_id.split(":")[0]
        shared = {"agpl", "gpl", "lgpl"} if "redistribute it" in dict((x[0], x[1]) for x in rows)[r.doc_id] else {family}
        assert r.families and set(r.families) <= shared, (r.doc_id, r.families)


def test_table(spark, model):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = {r.doc_id: r.families for r in licences.report(docs, model).collect()}
    marks = {"Apache License, Version 2.0": "apache", "MIT License": "mit", "GNU General Public License, version 3": "gpl", "CC BY-NC 4.0": "cc-by-nc"}
    for r in docs.select("doc_id", "text").collect():
        assert got[r.doc_id] == sorted({f for m, f in marks.items() if m in r.text}), r.doc_id


def test_prediction_equals_the_model(spark, model):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    for r in licences.report(docs, model).where("size(licences) > 0").limit(20).collect():
        text = docs.where(docs.doc_id == r.doc_id).first().text.split("\n")
        for x in r.licences:
            grams = sorted({g for k in (2, 3) for g in licences.plain(text[x.line], k)} & set(model.weights))
            p = model.probabilities(grams)
            assert abs(max(p) - x.probability) < 1e-9 and model.classes[p.index(max(p))] == x.family


def test_odd_rows(odd, none, model):
    got = licences.scan(odd, model)
    assert got.count() == odd.count() and got.where("size(licences) > 0").count() == 0
    assert licences.report(none, model).count() == 0
    plan = licences.report(odd, model)._jdf.queryExecution().toString()
    assert "ArrowEval" not in plan and "BatchEvalPython" not in plan and "MapIn" not in plan


def test_fit_without_documents(spark, none):
    model = licences.fit(none)
    docs = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id int, text string")
    assert licences.report(docs, model).first().families == ["mit"]
