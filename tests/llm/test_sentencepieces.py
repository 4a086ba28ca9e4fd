import numpy as np
import pytest
import sentencepiece
from llm_rows import ODD, SF001, none, odd  # noqa: F401

from skein.llm import sentencepieces as sp

TEXTS = [t for _, t, *_ in ODD if t is not None] + ["  two  spaces ", "\n\n a\tb \r\n", "\x00\x01", "<s> <0x0A> </s> <unk>", "aaaa" * 300, "▁ ▁▁a b▁ c", "\U0001d11e漢字ß"]


@pytest.fixture(scope="module")
def vocabulary():
    return sp.Vocabulary()


def test_without_dropout_equals_the_library(vocabulary):
    model = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)
    e = sp.Encoder(vocabulary, 0, 0.0)
    for t in TEXTS:
        if sp.MARK not in t:
            assert e.encode(t).tolist() == model.encode(t), t[:40]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6, 1.0])
def test_every_text_decodes_to_itself(vocabulary, dropout):
    for seed in (0, 9):
        e = sp.Encoder(vocabulary, seed, dropout)
        for t in TEXTS:
            assert e.decode(e.encode(t)) == t


def test_seeds_vary_and_repeat(vocabulary):
    text = "tokenization of reasonable sentences varies " * 20
    a, b, c = (sp.Encoder(vocabulary, s, 0.3).encode(text) for s in (1, 1, 2))
    assert np.array_equal(a, b) and not np.array_equal(a, c)
    whole = sp.Encoder(vocabulary, 1, 0.0).encode(text)
    assert len(a) > len(whole)
    assert len(sp.Encoder(vocabulary, 1, 1.0).encode(text)) >= len(text.replace(" ", ""))
    # Within a text, one word has several segmentations.
    words = {sp.Encoder(vocabulary, 1, 0.3).encoded(" tokenization", v) for v in range(4)}
    assert len(words) > 1


def test_words_kept_or_not_make_no_difference(vocabulary):
    few = sp.Encoder(vocabulary, 3, 0.2, cached=2)
    many = sp.Encoder(vocabulary, 3, 0.2)
    for t in TEXTS:
        assert np.array_equal(few.encode(t), many.encode(t))


def test_columns(spark, odd, none):
    encoded = sp.encode(odd, seed=4)
    for r in sp.decode(encoded).collect():
        assert r.decoded == r.text
        assert (r.piece_ids is None) == (r.text is None)
    rows = sp.report(odd, seed=4).collect()
    assert len(rows) == odd.count() and all(r.lossless is (None if r.text is None else True) for r in rows)
    assert len({r.pieces_sha256 for r in rows if r.doc_id == 5}) == 1
    ids = {(r.doc_id, r.text): r.piece_ids for r in encoded.collect()}
    assert all(r.n_pieces == len(ids[r.doc_id, r.text] or []) for r in rows)
    assert sp.report(none).count() == 0 and sp.encode(none).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert sp.report(docs, seed=42).where("not lossless").count() == 0


def test_every_occurrence_of_a_word_draws_anew(vocabulary):
    n, e = 4000, sp.Encoder(vocabulary, 5, 0.1)
    _, skips, candidates = sp.Encoder(vocabulary, 5, 0.0).word(" the", 0)
    assert candidates > 0 and not skips
    for drawn in (e.numbers("the " * n, n).tolist(), [int(e.numbers(f"the {i}", 1)[0]) for i in range(n)]):
        assert len(set(drawn)) == n
        assert abs(sum(not e.word(" the", x)[1] for x in drawn) / n - 0.9**candidates) < 0.03
    # In one text the segmentations don't come again in turn.
    e = sp.Encoder(vocabulary, 5, 0.3)
    made = [e.encoded(" tokenization", x) for x in e.numbers("text", 400).tolist()]
    assert len(set(made)) > 8 and not any(made[k:] == made[:-k] for k in range(1, 9))


def test_kept_words_equal_those_encoded_alone(vocabulary):
    text = " ".join(["tokenization", "reasonable", "the", "x" * 60, "sentences"] * 300)
    for dropout in (0.1, 0.5, 1.0, 1e-18):
        e = sp.Encoder(vocabulary, 8, dropout)
        words = e.words(" " + text)
        alone = [p for w, x in zip(words, e.numbers(text, len(words))) for p in e.word(w, int(x))[0]]
        assert e.encode(text).tolist() == alone == e.encode(text).tolist()


def test_skip_rate_of_a_frequent_word(vocabulary):
    e, skipped, asked = sp.Encoder(vocabulary, 7, 0.1), 0, 0
    for x in e.numbers("a text", 20000):
        _, skips, candidates = e.word(" tokenization", int(x))
        skipped, asked = skipped + len(skips), asked + candidates
    assert abs(skipped / asked - 0.1) < 0.005


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0, 1e-18])
def test_words_not_kept_are_encoded_together(vocabulary, monkeypatch, dropout):
    e, alone = sp.Encoder(vocabulary, 8, dropout), sp.Encoder(vocabulary, 8, dropout)
    r = np.random.default_rng(4)
    made = ["".join(r.choice(list("aeinrst xéß漢▁\n\U0001d11e"), r.integers(1, 60))) for _ in range(300)]
    texts = [*TEXTS, *made, "", "tokenization of reasonable sentences varies " * 20]
    found = [alone.words(" " + t) if t else [] for t in texts]
    want = [[p for w, x in zip(f, alone.numbers(t, len(f))) for p in alone.word(w, int(x))[0]] for t, f in zip(texts, found)]
    one = sp.Encoder.word
    monkeypatch.setattr(sp.Encoder, "word", lambda self, w, x: one(self, w, x) if len(w) > sp.LONGEST else pytest.fail(f"{w!r} was encoded by itself"))
    assert [x.tolist() for x in e.encode_all(texts)] == want == [e.encode(t).tolist() for t in texts]


def test_an_encoder_ends_with_its_broadcast(vocabulary):
    # No words of an earlier step stay in a worker: the encoder is the broadcast's value.
    import pickle

    e = pickle.loads(pickle.dumps(sp.Encoder(vocabulary, 8, 0.3)))
    assert np.array_equal(e.encode(TEXTS[0]), sp.Encoder(vocabulary, 8, 0.3).encode(TEXTS[0]))
    assert not hasattr(sp, "_ENCODERS")


def naive(e, word, number):
    """A word's ids by looking at all pairs for each candidate."""
    v, ids, codes = e.v, [], list(word)
    parts, lost = [v.characters.get(c, sp.NONE) for c in codes], [False] * len(codes)
    k, turn, stop = 0, 0, None
    while True:
        free = [(v.pairs[x] >> 17, i) for i in range(len(parts) - 1) if not lost[i] and (x := parts[i] << 17 | parts[i + 1]) in v.pairs]
        if not free:
            break
        while e.runs and (stop is None or (again and stop <= turn)):
            run = e.run(number, k)
            stop, again, k = (turn if stop is None else stop) + run, run == sp.RUN, k + 1
        _, i = min(free)
        if turn == stop:
            lost[i], stop = True, None
        else:
            parts[i : i + 2] = [v.pairs[parts[i] << 17 | parts[i + 1]] & 0x1FFFF]
            codes[i : i + 2] = [codes[i] + codes[i + 1]]
            del lost[i + 1]
            lost[i] = False
            if i:
                lost[i - 1] = False
        turn += 1
    for c, p in zip(codes, parts):
        ids += [v.bytes[b] for b in c.encode()] if p == sp.NONE else [p]
    return ids


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_words_equal_the_naive_agenda(vocabulary, dropout):
    e, r = sp.Encoder(vocabulary, 8, dropout), np.random.default_rng(7)
    made = "".join(r.choice(list("aaeeiinnrrsstt  xéß漢▁\n"), 4000))
    for t in [made, *TEXTS, "tokenization of reasonable sentences varies " * 60]:
        words = e.words(" " + t) if t else []
        numbers = e.numbers(t, len(words)).tolist()
        assert e.encode(t).tolist() == [p for w, x in zip(words, numbers) for p in naive(e, w, x)]


@pytest.mark.parametrize("apart", [True, False])
def test_words_are_those_of_the_expression(vocabulary, apart):
    import copy
    import re

    v, r = copy.copy(vocabulary), np.random.default_rng(3)
    assert v.words == sp.APART
    if not apart:
        v.latin, v.kinds = np.zeros_like(v.latin), np.where(v.kinds == sp.LETTER, sp.OTHER, v.kinds)
    for n in (1, 2, 7, 3000):
        text = "".join(r.choice(list("  \n\t\ra09Zz.-¿À×Ö÷ÿĀɏɐ߿ࠀ漢\U0001d11e\x00\x7f\x80"), n))
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        found = re.findall(sp.APART if apart else sp.JOINED, text)
        assert np.flatnonzero(v.begins(data)).tolist() == np.cumsum([0, *(len(w.encode()) for w in found[:-1])]).tolist()


def test_kept_words_take_no_steps_of_their_own(vocabulary):
    import sys

    def calls(n):
        seen = []
        sys.setprofile(lambda frame, event, arg: seen.append(event) if event.endswith("call") else None)
        try:
            e.encode(text[: n * len(line)])
        finally:
            sys.setprofile(None)
        return len(seen)

    e, line = sp.Encoder(vocabulary, 4), "tokenization of the reasonable sentences that the others have "
    text = line * 4000
    for n in (1000, 4000):
        e.encode(text[: n * len(line)])
    # Words that are kept, with as many calls for 36,000 as for 9,000: before, each with a skip took several.
    assert calls(4000) < 2 * calls(1000) < 4000


def test_room_for_new_words(vocabulary):
    r = np.random.default_rng(2)
    made = ["".join(r.choice(list("aeinrst"), 5)) for _ in range(6000)]
    texts = [" ".join(["tokenization of sentences"] * 50 + made[lo : lo + 100]) for lo in range(0, 6000, 100)]
    e, all_kept = sp.Encoder(vocabulary, 3, cached=1500), sp.Encoder(vocabulary, 3)
    rooms = 0
    for t in texts:
        before = e.kept.start.n
        assert np.array_equal(e.encode(t), all_kept.encode(t))
        k = e.kept
        rooms += k.start.n < before
        n = k.start.n
        # Words asked for again stay; every child is a node, and of a bounded number.
        assert n < 1500 + 600 and b" tokenization" in k.roots and max(k.roots.values()) < n
        assert k.children.all[: k.children.n].max() < n
        assert int(k.first.all[n - 1] + k.slots.all[n - 1]) == k.children.n and int(k.start.all[n - 1] + k.size.all[n - 1]) == k.ids.n
    assert rooms > 2
    some = k.roots[b" tokenization"]
    assert (k.children.all[k.first.all[some] :][: k.slots.all[some]] >= 0).any()


def test_lossless_is_what_the_ids_stand_for(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one text"), (2, None), (3, ""), (4, "a b"), (5, "the end")], "doc_id long, text string")
    assert {r.doc_id: r.lossless for r in sp.report(docs, seed=1).collect()} == {1: True, 2: None, 3: True, 4: True, 5: True}
    made = sp.Encoder.__init__

    def broken(self, *args, **more):
        made(self, *args, **more)
        self.flat = np.where(self.flat == ord("x"), ord("y"), self.flat)

    monkeypatch.setattr(sp.Encoder, "__init__", broken)
    assert {r.doc_id: r.lossless for r in sp.report(docs, seed=1).collect()} == {1: False, 2: None, 3: True, 4: True, 5: True}
