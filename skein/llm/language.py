"""Language identification by a byte convolutional network.

Training: at most about ``PER_LANGUAGE`` labelled texts of each language (a
documented bound, drawn by a hash of the id), two windows of ``WINDOW`` bytes
from each, go to the driver, where numpy trains the network: a vector for each
byte, filters of several widths, the highest response of each filter over the
window, and a softmax.  Everything is seeded, so a fit repeats itself.

Prediction: each whole text is cut into windows of fixed length (the last one
padded), the windows of many texts form batches, and a text's logits are the
mean over its windows, weighted by their bytes.  A filter's response to a
byte at one of its places is looked up in a table made once from vectors and
filters.

Defined results: a text that is null or has no letter is ``und`` with score 0;
without labelled texts every text is ``und``; labels that differ by spelling
are different languages; ties go to the label first in order; repeated rows
each get their row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import append, remainder, share, stored, utf8

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
VECTOR = 8
PER_LANGUAGE = 400
EPOCHS = 12
#: Rows of the table of languages that are broadcast.
FEW = 100_000
BATCH = 64
#: Windows handled at once in prediction: their responses take a few MB.
WINDOWS = 64

FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


class Network:
    """Parameters of the network over bytes; code 0 pads."""

    def __init__(self, languages: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        self.languages = languages
        self.vectors = r.normal(0, 0.5, (256, VECTOR)).astype(np.float32)
        self.filters = [r.normal(0, (2 / (w * VECTOR)) ** 0.5, (w, VECTOR, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS]
        n = FILTERS * len(WIDTHS)
        self.out = r.normal(0, n**-0.5, (n, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), dtype=np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, *self.filters, *self.bias, self.out, self.out_bias]

    def table(self) -> np.ndarray:
        """Response of each byte at each place of each width's filters."""
        return np.concatenate([np.einsum("bv,vf->bf", self.vectors, f[j]) for f in self.filters for j in range(f.shape[0])], axis=1)

    def pooled(self, windows: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Highest responses (rectified), and for training where they are and the raw ones."""
        each = table[windows]
        tops, places, raw, at = [], [], [], 0
        for w, bias in zip(WIDTHS, self.bias, strict=True):
            n = windows.shape[1] - w + 1
            a = each[:, :n, at : at + FILTERS].copy()
            for j in range(1, w):
                a += each[:, j : j + n, at + j * FILTERS : at + (j + 1) * FILTERS]
            at += w * FILTERS
            places.append(a)
            tops.append(a.max(axis=1) + bias)
            raw.append(tops[-1])
        return np.maximum(np.concatenate(tops, axis=1), 0), places, raw

    def logits(self, windows: np.ndarray, table: np.ndarray) -> np.ndarray:
        return self.pooled(windows, table)[0] @ self.out + self.out_bias

    def gradients(self, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        top, responses, raw = self.pooled(windows, self.table())
        z = top @ self.out + self.out_bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(target)), target] -= 1
        p /= len(target)
        g_out, g_out_bias = top.T @ p, p.sum(axis=0)
        back = (p @ self.out.T) * (top > 0)
        g_vectors = np.zeros_like(self.vectors)
        g_filters, g_bias = [], []
        for k, (w, f) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            g = back[:, k * FILTERS : (k + 1) * FILTERS]
            place = responses[k].argmax(axis=1)
            gf = np.zeros_like(f)
            for j in range(w):
                at = windows[np.arange(len(windows))[:, None], place + j]  # the byte under each filter's best place
                gf[j] = np.einsum("nfv,nf->vf", self.vectors[at], g)
                np.add.at(g_vectors, at, g[:, :, None] * f[j].T[None])
            g_filters.append(gf)
            g_bias.append(g.sum(axis=0))
        return [g_vectors, *g_filters, *g_bias, g_out.astype(np.float32), g_out_bias]


def train(windows: np.ndarray, target: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on shuffled batches; every language has the same weight in the draw."""
    net, r = Network(languages, seed), np.random.default_rng(seed + 1)
    params = net.parameters()
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    by = [np.flatnonzero(target == k) for k in range(len(languages))]
    per = max((len(x) for x in by), default=0)
    for _ in range(epochs):
        order = r.permutation(np.concatenate([r.choice(x, per) for x in by]))
        for lo in range(0, len(order), BATCH):
            pick, t = order[lo : lo + BATCH], t + 1
            for i, g in enumerate(net.gradients(windows[pick], target[pick])):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                params[i] -= (0.01 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, label: str = "lang", per_language: int = PER_LANGUAGE) -> Network | None:
    """A network learnt from the rows given (leave held-out ones out before); None without labels."""
    rows = docs.select(F.col("doc_id"), F.col("text"), F.col(f"`{label}`").alias("lang")).where("lang is not null and text rlike '\\\\p{L}'")
    total = rows.groupBy("lang").agg(F.count("*").alias("n"))
    # About per_language rows a language, by the id's hash.  The languages are one row each: broadcast if they are
    # few (else left to the planner), so that no text moves and no language meets in one task.
    total = stored(total, "languages")
    small = F.broadcast(total) if total.count() <= FEW else total
    draw = rows.join(small, "lang").where(share(F.col("doc_id"), 31) * F.col("n") < per_language)
    raw = F.encode("text", "utf-8")
    n = F.octet_length("text")
    # The first window, and one from a place that the id's hash gives.
    later = (F.greatest(n - WINDOW, F.lit(0)) * share(F.col("doc_id"), 32)).cast("int") + 1
    got = draw.select("lang", "doc_id", F.substring(raw, 1, WINDOW).alias("a"), raw.substr(later, F.lit(WINDOW)).alias("b"))
    got = got.orderBy("lang", "doc_id", "a").collect()  # bounded: a few hundred bytes for each text drawn
    languages = sorted({r.lang for r in got})
    if not languages:
        return None
    pieces = [(bytes(x), languages.index(r.lang)) for r in got for x in (r.a, r.b)]
    windows = np.zeros((len(pieces), WINDOW), dtype=np.uint8)
    for i, (x, _) in enumerate(pieces):
        windows[i, : len(x)] = np.frombuffer(x, dtype=np.uint8)
    return train(windows, np.array([y for _, y in pieces]), languages)


def _predicted(net: Network | None):
    table = net.table() if net else None

    def step(texts: pa.Array, letters: pa.Array):
        n = len(texts)
        if net is None:
            return [pa.array(["und"] * n, type=pa.string()), pa.array([0.0] * n)]
        data, offsets = utf8(texts)
        size = np.diff(offsets)
        count = -(-size // WINDOW)
        doc = np.repeat(np.arange(n), count)
        start = offsets[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
        length = np.minimum(offsets[doc + 1] - start, WINDOW)
        total = np.zeros((n, len(net.languages)))
        for lo in range(0, len(doc), WINDOWS):
            s, l, d = start[lo : lo + WINDOWS], length[lo : lo + WINDOWS], doc[lo : lo + WINDOWS]
            at = s[:, None] + np.arange(WINDOW)
            windows = data[np.minimum(at, len(data) - 1)]
            if (l < WINDOW).any():
                windows[np.arange(WINDOW) >= l[:, None]] = 0
            np.add.at(total, d, net.logits(windows, table) * l[:, None])
        z = total / np.maximum(size, 1)[:, None]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best, known = p.argmax(axis=1), np.array([bool(x) for x in letters.to_pylist()], dtype=bool)
        return [
            pa.array([net.languages[b] if k else "und" for b, k in zip(best, known, strict=True)], type=pa.string()),
            pa.array(np.where(known, p.max(axis=1), 0.0), type=pa.float64()),
        ]

    return step


def predict(docs: DataFrame, net: Network | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kept = docs.columns if keep is None else keep
    rows = docs.withColumn("_letters", F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False)))
    return append(rows, [text, "_letters"], lambda: _predicted(shared.value), FIELDS, keep=kept)


def trained(docs: DataFrame, fold: int = 4, left_out: int = 2) -> DataFrame:
    """Rows outside the held-out fold."""
    return docs.where(remainder(F.col("doc_id"), fold) != left_out)
