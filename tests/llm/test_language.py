import numpy as np
from llm_rows import SF01, none, odd  # noqa: F401
from pyspark.sql import functions as F

from skein.llm import language
from skein.llm.common import remainder


def test_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    net = language.fit(language.trained(docs))
    got = language.predict(docs, net).where(remainder(F.col("doc_id"), 4) == 2).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    again = language.fit(language.trained(docs))
    assert all(np.array_equal(a, b) for a, b in zip(net.parameters(), again.parameters()))


def test_gradients():
    r = np.random.default_rng(1)
    net = language.Network(["a", "b", "c"])
    windows, target = r.integers(0, 256, (6, 40)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])
    for p in net.parameters():
        p += r.normal(0, 0.01, p.shape).astype(np.float32)

    def loss():
        z = net.logits(windows, net.table()).astype(np.float64)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(6), target]).mean())

    for p, g in zip(net.parameters(), net.gradients(windows, target)):
        flat, at = p.reshape(-1), int(np.abs(g).reshape(-1).argmax())
        old, eps = flat[at], 1e-2
        flat[at] = old + eps
        up = loss()
        flat[at] = old - eps
        down = loss()
        flat[at] = old
        assert abs((up - down) / (2 * eps) - g.reshape(-1)[at]) < 0.05 * abs(g.reshape(-1)[at]) + 2e-3


def test_batches_equal_single_windows(spark):
    net = language.Network(["a", "b"])
    texts = ["x" * 700 + "é" * 100, "short", "", None, "7 7", "z" * 256]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").coalesce(1)
    for r in language.predict(docs, net).collect():
        if not r.text or r.text == "7 7":
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        raw, total = r.text.encode(), np.zeros(2)
        for lo in range(0, len(raw), language.WINDOW):
            w = np.zeros((1, language.WINDOW), dtype=np.uint8)
            part = raw[lo : lo + language.WINDOW]
            w[0, : len(part)] = np.frombuffer(part, dtype=np.uint8)
            total += net.logits(w, net.table())[0] * len(part)
        p = np.exp(total / len(raw))
        assert r.lang_pred == "ab"[int(p.argmax())] and abs(r.score - p.max() / p.sum()) < 1e-5


def test_odd_rows(odd, none):
    net = language.fit(odd)
    got = language.predict(odd, net)
    assert got.count() == odd.count()
    assert {r.lang_pred for r in got.where("text is null or trim(text) = ''").collect()} == {"und"}
    assert language.fit(none) is None
    assert {r.lang_pred for r in language.predict(odd, None).collect()} == {"und"}
    assert language.predict(none, net).count() == 0
