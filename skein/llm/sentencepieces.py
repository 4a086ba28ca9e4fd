"""SentencePiece (merge-type) encoding with seeded merge-dropout, and lossless decoding.

The vocabulary is a public model file, read once by the driver; its path is a
parameter.  A text is prefixed with one space, spaces become word-begin marks,
and characters merge to pieces: an agenda holds the adjacent pairs that form a
piece, best piece first and leftmost among equals; a pair taken from it is
skipped with probability ``dropout`` by a hash keyed with the seed, and is
then lost unless a neighbouring merge makes it anew.  With ``dropout`` 0 the
result is the model's own segmentation.  A character without a piece becomes
its UTF-8 bytes' pieces, and so does the word-begin mark itself where a text
holds it; so every text decodes to itself.

No piece with other characters goes on across a space or a line end, and, where
the vocabulary has none that does, none joins Latin letters and digits with
other characters; so a text falls into words that are encoded alone.  The
skips are keyed by the seed, the text's hash and the word's place, so every
occurrence of a word draws anew.  How many candidates lie before the next skip
is drawn at once (a geometric number); a word's segmentation depends on its
skipped candidates alone, and is kept in a tree by the word and these.  All words
of some texts go down the trees together, a skip of each at a time, as array
operations; those that are not kept are encoded together, one candidate of each
at a time.

Defined results: a null text has null ids, which decode to null; an empty one
has no ids, which decode to the empty text; repeated rows are encoded alike;
a long text without spaces is one word, encoded in n log n steps.
"""

from __future__ import annotations

import heapq
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skein.llm.common import append, chunks, utf8

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
DROPOUT = 0.1
#: Segmentations kept in a worker (about 100 bytes each), the longest word of them and the most skips in one.
CACHED = 1_600_000
LONGEST, DEEP = 48, 3

#: In place of an id: no piece (or no merge), and merged into the piece before.
NONE, GONE = -1, -2
#: A table's slot without a pair (ids are not below 0, so no pair has this key).
FREE = -(1 << 62)
#: Splitmix64's step and multipliers; the longest run without a skip that one draw gives (a longer one
#: goes on with the next draw), more than a kept word has candidates.
STEP, MULTIPLY, ALL = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB), (1 << 64) - 1
RUN = 256
#: A skip past the end of every word of LONGEST characters.
NEVER = 3 * LONGEST
#: Words encoded together, and words looked up at a time.
TOGETHER, LOOKED = 1 << 14, 1 << 18
#: The place in a word below its rank (LONGEST at most), and in place of both: no pair.
PLACE, LAST = 6, np.iinfo(np.int32).max

#: Latin letters and digits, and the words of a text: with pieces that join these with others, and without.
LATIN = "0-9A-Za-zÀ-ÖØ-öø-ɏ"
JOINED = r" *[^ \n]+| +|\n+"
APART = rf" *[{LATIN}]+| *[^ \n{LATIN}]+| +|\n+"
#: Kinds of characters: a space, a line end, Latin and other ones; and by two neighbours' kinds whether a word
#: begins between them (spaces belong to the word after them).
BLANK, LINE, LETTER, OTHER = range(4)
EDGE = np.array([a != b and not (a == BLANK and b >= LETTER) for a in range(4) for b in range(4)])


class Vocabulary:
    """Pieces that merges may make, with their rank, and each id's bytes."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [0] * 256
        self.pieces: dict[str, int] = {}
        self.rank: list[float] = []
        self.content: list[bytes] = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            self.rank.append(-model.get_score(i))
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.content.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.content.append(b"")
            else:
                self.pieces[piece] = i
                self.content.append(piece.replace(MARK, " ").encode())
        # Merges by the ids of both sides: the made piece's rank (equal for equal scores) and id.
        ranks = {r: k for k, r in enumerate(sorted({self.rank[i] for i in self.pieces.values()}))}
        self.characters = {p: i for p, i in self.pieces.items() if len(p) == 1 and p != MARK}
        if MARK in self.pieces:
            self.characters[" "] = self.pieces[MARK]  # the mark as such is no space
        self.pairs = {
            self.pieces[p[:k]] << 17 | self.pieces[p[k:]]: ranks[self.rank[i]] << 17 | i
            for p, i in self.pieces.items()
            for k in range(1, len(p))
            if p[:k] in self.pieces and p[k:] in self.pieces
        }
        # The same as arrays: each character's id, the last entry for all others; the pairs by hash.
        self.of_code = np.full(max(map(ord, self.characters), default=0) + 2, NONE, dtype=np.int32)
        self.of_code[[ord(c) for c in self.characters]] = list(self.characters.values())
        self.tables = _tables(self.pairs)
        crossing = [p for p in self.pieces if len(p) > 1 and ("\n" in p or MARK in p.lstrip(MARK))]
        if crossing:
            raise ValueError("the model has pieces across words; encode whole texts as one word instead")
        latin = re.compile(f"[{LATIN}]").match
        mixed = any(bool(latin(a)) != bool(latin(b)) for p in self.pieces for a, b in zip(p.lstrip(MARK), p.lstrip(MARK)[1:], strict=False))
        self.words = JOINED if mixed else APART
        # The kinds of bytes (those beyond ASCII as parts of other characters), and which characters of two bytes are Latin.
        self.kinds = np.full(256, OTHER, dtype=np.uint8)
        self.kinds[[0x20, 0x0A]] = BLANK, LINE
        self.latin = np.array([not mixed and bool(latin(chr(c))) for c in range(0x800)])
        self.kinds[:0x80][self.latin[:0x80]] = LETTER

    def begins(self, data: np.ndarray) -> np.ndarray:
        """Which bytes begin a word (of one text)."""
        kinds = self.kinds[data]
        two = np.flatnonzero((data >= 0xC2) & (data < 0xE0))
        if len(two):
            two = two[self.latin[(data[two] & 0x1F).astype(np.int64) << 6 | data[two + 1] & 0x3F]]
            kinds[two] = kinds[two + 1] = LETTER
        out = np.ones(len(data), dtype=bool)
        out[1:] = EDGE[kinds[:-1] << 2 | kinds[1:]]
        return out

    def made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What each two neighbours' ids would make: its rank and id; below 0 none."""
        keys = left.astype(np.int64) << 17 | right
        out, rest = np.full(len(keys), NONE, dtype=np.int64), None
        for level, known, makes in self.tables:
            at = _slot(keys, level)
            there = known[at]
            same = there == keys
            if rest is None:
                out[same] = makes[at[same]]
                rest = np.flatnonzero(~same & (there != FREE))
            else:
                out[rest[same]] = makes[at[same]]
                rest = rest[~same & (there != FREE)]
            if not len(rest):
                break
            keys = left[rest].astype(np.int64) << 17 | right[rest]
        return out


def _slot(keys: np.ndarray, level: int) -> np.ndarray:
    """A slot of 17 bits, other bits of the product at each level."""
    return ((keys.view(np.uint64) * np.uint64(STEP)) >> np.uint64(47 - 7 * level)).astype(np.int64) & 0x1FFFF


def _tables(pairs: dict[int, int]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Tables of pairs by slot; those that find theirs taken are in the next one."""
    keys, made = (np.fromiter(x, dtype=np.int64, count=len(pairs)) for x in (pairs.keys(), pairs.values()))
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    while len(keys):
        if len(out) > 6:
            raise ValueError("the model has too many merges for the tables")
        known, makes = np.full(1 << 17, FREE, dtype=np.int64), np.zeros(1 << 17, dtype=np.int64)
        slots, first = np.unique(_slot(keys, len(out)), return_index=True)
        known[slots], makes[slots] = keys[first], made[first]
        out.append((len(out), known, makes))
        rest = np.ones(len(keys), dtype=bool)
        rest[first] = False
        keys, made = keys[rest], made[rest]
    return out


def _mixed(x: int) -> int:
    """Splitmix64's number for a state."""
    x = (x ^ x >> 30) * MULTIPLY[0] & ALL
    x = (x ^ x >> 27) * MULTIPLY[1] & ALL
    return x ^ x >> 31


def _all_mixed(x: np.ndarray) -> np.ndarray:
    """The same for many; in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(MULTIPLY[0])
    x ^= x >> np.uint64(27)
    x *= np.uint64(MULTIPLY[1])
    x ^= x >> np.uint64(31)
    return x


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    out = np.repeat(starts - ends + sizes, sizes)
    out += np.arange(len(out))
    return out


class Rows:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.all, self.n = np.zeros(1 << 10, dtype=kind), 0

    def add(self, more: np.ndarray) -> None:
        n = self.n + len(more)
        if n > len(self.all):
            grown = np.zeros(max(n, len(self.all) * 3 // 2), dtype=self.all.dtype)
            grown[: self.n] = self.all[: self.n]
            self.all = grown
        self.all[self.n : n] = more
        self.n = n


class Kept:
    """Segmentations: a tree for each word, from the one without skips; a child has one skip more, after its parent's.

    A node has its ids, its number of candidates and, for each candidate, a
    slot for the child that skips it.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.roots: dict[bytes, int] = {}
        self.ids, self.children = Rows(np.int32), Rows(np.int32)
        self.start, self.size, self.candidates = Rows(np.int64), Rows(np.int32), Rows(np.int16)
        self.first, self.slots = Rows(np.int64), Rows(np.int16)
        # Asked for since it was made, or since the last time that room was made.
        self.used = Rows(np.bool_)

    def add(self, ids: np.ndarray, sizes: np.ndarray, candidates: np.ndarray, leaf: bool = False) -> np.ndarray:
        """New nodes; a leaf has no slots."""
        n, slots = self.start.n, np.zeros(len(sizes), dtype=np.int64) if leaf else candidates.astype(np.int64)
        self.start.add(self.ids.n + np.cumsum(sizes) - sizes)
        self.first.add(self.children.n + np.cumsum(slots) - slots)
        self.ids.add(ids)
        self.children.add(np.full(slots.sum(), NONE, dtype=np.int32))
        for rows, more in ((self.size, sizes), (self.candidates, candidates), (self.slots, slots), (self.used, np.zeros(len(sizes), dtype=bool))):
            rows.add(more)
        return np.arange(n, self.start.n)

    def cut(self, n: int) -> None:
        """Forget all but the first n nodes; none of those has the others as children."""
        if n < self.start.n:
            self.ids.n, self.children.n = int(self.start.all[n]), int(self.first.all[n])
            for rows in (self.start, self.size, self.candidates, self.first, self.slots, self.used):
                rows.n = n

    def room(self) -> None:
        """At the limit, keep only what was asked for again (with a node its parents were, too), if that is not most of all."""
        if self.start.n < self.limit:
            return
        kept = np.flatnonzero(self.used.all[: self.used.n])
        if len(kept) > self.limit * 3 // 4:
            kept = kept[:0]
        new = np.full(self.start.n + 1, NONE, dtype=np.int32)  # the last entry: no child
        new[kept] = np.arange(len(kept))
        size, candidates, slots = self.size.all[kept], self.candidates.all[kept], self.slots.all[kept]
        ids = self.ids.all[_ranges(self.start.all[kept], size)]
        children = new[self.children.all[_ranges(self.first.all[kept], slots)]]
        roots = self.roots
        self.clear()
        self.ids.add(ids)
        self.children.add(children)
        self.start.add(np.cumsum(size, dtype=np.int64) - size)
        self.first.add(np.cumsum(slots, dtype=np.int64) - slots)
        for rows, more in ((self.size, size), (self.candidates, candidates), (self.slots, slots), (self.used, np.zeros(len(kept), dtype=bool))):
            rows.add(more)
        self.roots = {w: i for w, i in zip(roots, new[np.fromiter(roots.values(), dtype=np.int64, count=len(roots))].tolist(), strict=True) if i >= 0}


class Encoder:
    """Encodes words of one seed."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 0, dropout: float = DROPOUT, cached: int = CACHED):
        self.v, self.seed, self.dropout = vocabulary, seed, dropout
        self.key = seed.to_bytes(8, "little", signed=True)
        # A draw under the k-th greatest of these has no skip in its first k candidates.
        self.runs = [min(ALL, int((1 - dropout) ** k * (1 << 64))) for k in range(RUN, 0, -1)] if dropout else []
        self.limits = np.array(self.runs, dtype=np.uint64)
        # By a word's number of candidates: a first draw under it has no skip.
        self.under = np.array([ALL, *self.runs[::-1]], dtype=np.uint64)
        self.kept = Kept(cached)
        self.words = re.compile(vocabulary.words).findall
        content = [np.frombuffer(c, dtype=np.uint8) for c in vocabulary.content]
        self.lengths = np.array([len(c) for c in content], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.concatenate(content)

    def run(self, number: int, k: int) -> int:
        """How many candidates lie before the skip, from the k-th draw of an occurrence; RUN: no skip yet."""
        return RUN - bisect_right(self.runs, _mixed(number + (k + 1) * STEP & ALL))

    def stop(self, number: int, k: int, at: int, end: int) -> tuple[int, int]:
        """The next skipped candidate from ``at`` (past ``end``: none), and the next draw."""
        if not self.runs:
            return end + 1, k
        while at <= end:
            r = self.run(number, k)
            at, k = at + r, k + 1
            if r < RUN:
                break
        return at, k

    def word(self, word: str, number: int) -> tuple[list[int], tuple[int, ...], int]:
        """Ids of a word (spaces in front included) for an occurrence's number, the skipped candidates and the number of all."""
        skips: list[int] = []
        turn = draw = 0
        pairs, characters, n = self.v.pairs.get, self.v.characters.get, len(word)
        ids = [characters(c, NONE) for c in word]
        # What the pair that begins at each place would make: its rank and id; below 0 none.
        makes = [pairs(a << 17 | b, NONE) for a, b in zip(ids, ids[1:], strict=False)]
        makes.append(NONE)
        shift = n.bit_length()
        agenda = [(m >> 17) << shift | i for i, m in enumerate(makes) if m >= 0]
        if agenda:
            heapq.heapify(agenda)
            pop, push, here = heapq.heappop, heapq.heappush, (1 << shift) - 1
            stop, draw = self.stop(number, 0, 0, 3 * n)
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            while agenda:
                x = pop(agenda)
                i = x & here
                m = makes[i]
                if m < 0 or m >> 17 != x >> shift:
                    continue  # the pair is gone
                turn += 1
                if turn > stop:
                    skips.append(stop)
                    makes[i] = NONE
                    stop, draw = self.stop(number, draw, turn, 3 * n)
                    continue
                made, j = m & 0x1FFFF, after[i]
                ids[i], ids[j], makes[j] = made, GONE, NONE
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                    m = makes[i] = pairs(made << 17 | ids[k], NONE)
                    if m >= 0:
                        push(agenda, (m >> 17) << shift | i)
                else:
                    makes[i] = NONE
                if (h := before[i]) >= 0:
                    m = makes[h] = pairs(ids[h] << 17 | made, NONE)
                    if m >= 0:
                        push(agenda, (m >> 17) << shift | h)
        if NONE not in ids:
            return [p for p in ids if p >= 0], tuple(skips), turn
        return self._bytes(word, ids), tuple(skips), turn

    def together(self, words: pa.Array, skips: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Many words of LONGEST characters at most with the skipped candidates of each (a row of rising numbers, NEVER
        in the last column): all ids, how many each has, the numbers of candidates, and the words' order in these."""
        sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(sizes, kind="stable")
        parts = [order[lo : lo + TOGETHER] for lo in range(0, len(order), TOGETHER)]
        made = [self._together(words.take(pa.array(part)), skips[part], sizes[part]) for part in parts]
        return *(np.concatenate(x) for x in zip(*made, strict=True)), order

    def _together(self, words: pa.Array, skips: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        count, width = len(words), int(n.max())
        codes = np.frombuffer(utf8(words)[0].tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        flat = self.v.of_code[np.minimum(codes, len(self.v.of_code) - 1)]
        of = np.repeat(np.arange(count), n)
        place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        # A column for each word, with an empty row above and one below it, as flat arrays.
        # best: rank and row of the pair that begins there; makes: the id it would make.
        rows = width + 2
        ids = np.full(rows * count, GONE, dtype=np.int32)
        own = (place + 1) * count + of
        ids[own] = flat
        best = np.full(rows * count, LAST, dtype=np.int32)
        makes = np.zeros(rows * count, dtype=np.int32)
        after, before = np.arange(rows * count) + count, np.arange(rows * count) - count

        def begin(at: np.ndarray, pair: np.ndarray) -> None:
            best[at] = np.where(pair >= 0, pair >> 17 << PLACE | at // count, LAST)
            makes[at] = pair & 0x1FFFF

        inner = np.flatnonzero(of[1:] == of[:-1])
        begin(own[inner], self.v.made(flat[inner], flat[inner + 1]))
        stop = skips[:, 0].copy()
        nth, candidates, turn = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int16), 0
        while True:
            top = best.reshape(rows, count).min(axis=0)
            c = np.flatnonzero(top < LAST)
            if not len(c):
                break
            turn += 1
            candidates[c] = turn
            at = (top[c] & ((1 << PLACE) - 1)).astype(np.int64) * count + c
            skipped = turn > stop[c]
            if skipped.any():
                c = c[skipped]
                best[at[skipped]] = LAST
                nth[c] += 1
                stop[c] = skips[c, nth[c]]
                at = at[~skipped]
            x, j, h = makes[at], after[at], before[at]
            k = after[j]
            after[at], before[k] = k, at
            ids[at], ids[j], best[j] = x, GONE, LAST
            pair = self.v.made(np.concatenate([x, ids[h]]), np.concatenate([ids[k], x]))
            begin(at, pair[: len(at)])
            begin(h, pair[len(at) :])
        table = ids.reshape(rows, count)[1:-1].T
        if (flat == NONE).any() and len(odd := np.flatnonzero((table == NONE).any(axis=1))):
            spelt = {k: self._bytes(words[k].as_py(), table[k, : n[k]].tolist()) for k in odd.tolist()}
            made = [spelt[k] if k in spelt else row[row >= 0] for k, row in enumerate(table)]
            return np.concatenate(made).astype(np.int32), np.array([len(x) for x in made]), candidates
        there = table >= 0
        return table[there], there.sum(axis=1), candidates

    def _bytes(self, word: str, ids: list[int]) -> list[int]:
        """The ids, characters without a piece as their bytes' pieces."""
        out: list[int] = []
        for i, p in enumerate(ids):
            if p >= 0:
                out.append(p)
            elif p == NONE:
                out += [self.v.bytes[b] for b in word[i].encode()]
        return out

    def encoded(self, word: str, number: int) -> bytes:
        """A word's ids as bytes for an occurrence's number."""
        return array("i", self.word(word, number)[0]).tobytes()

    def numbers(self, text: str, n: int) -> np.ndarray:
        """A number for each word's place, by the seed and the text's hash."""
        return self._numbers([text.encode()], np.array([n]))

    def _numbers(self, texts: list, n: np.ndarray) -> np.ndarray:
        """The same for the n words of each text's bytes, one text after the other."""
        starts = [int.from_bytes(blake2b(t, digest_size=8, key=self.key).digest(), "little") for t in texts]
        out = np.arange(1, n.sum() + 1, dtype=np.uint64) - np.repeat(np.cumsum(n) - n, n).astype(np.uint64)
        out *= np.uint64(STEP)
        out += np.repeat(np.array(starts, dtype=np.uint64), n)
        return _all_mixed(out)

    def draws(self, numbers: np.ndarray, k: int) -> np.ndarray:
        """The k-th draw for each number."""
        return _all_mixed(numbers + np.uint64((k + 1) * STEP & ALL))

    def runs_of(self, draws: np.ndarray) -> np.ndarray:
        """How many candidates lie before the skip, for each draw; RUN: no skip yet."""
        return RUN - np.searchsorted(self.limits, draws, side="right")

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        ids, cut = self.encode_bytes(*utf8(pa.array(texts, type=pa.large_string())))
        return [ids[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, given as all their bytes and where each begins (and the last ends), and where each
        text's ids begin (and the last's end)."""
        some = np.flatnonzero(offsets[1:] > offsets[:-1])
        if not len(some):
            return np.zeros(0, dtype=np.int32), np.zeros(len(offsets), dtype=np.int64)
        spaced, ends = np.insert(data, offsets[some], 0x20), offsets[1:][some] + np.arange(1, len(some) + 1)
        begins = self.v.begins(spaced)
        begins[ends[:-1]] = True
        starts = np.append(np.flatnonzero(begins), len(spaced))
        del begins
        last = np.searchsorted(starts, ends)  # the number of words up to each text's end
        n = np.diff(last, prepend=0)
        numbers = self._numbers([data[offsets[i] : offsets[i + 1]] for i in some.tolist()], n) if self.runs else np.zeros(last[-1], dtype=np.uint64)
        made, sizes = [], [np.zeros(1, dtype=np.int64)]
        for lo in range(0, len(numbers), LOOKED):
            at = starts[lo : lo + LOOKED + 1]
            ids, size = self._looked_up(spaced[at[0] : at[-1]], at - at[0], numbers[lo : lo + LOOKED])
            made.append(ids)
            sizes.append(size)
        cut = np.zeros(len(offsets), dtype=np.int64)
        cut[some + 1] = np.diff(np.cumsum(np.concatenate(sizes))[last], prepend=0)
        return np.concatenate(made), np.cumsum(cut)

    def _looked_up(self, data: np.ndarray, offsets: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that lie one after the other, and how many each has."""
        kept, n = self.kept, len(numbers)
        kept.room()
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        # Each occurrence's word, and the distinct words.
        of, words = words.indices.to_numpy(), words.dictionary
        keys, words = words.to_pylist(), words.cast(pa.large_string())
        root = np.fromiter((kept.roots.get(w, NONE) for w in keys), dtype=np.int64, count=len(keys))
        kept.used.all[root[root >= 0]] = True
        long = pc.utf8_length(words).to_numpy(zero_copy_only=False) > LONGEST
        new = np.flatnonzero((root < 0) & ~long)
        if len(new):
            root[new] = self._new(words, new, np.full((len(new), 1), NEVER))
            kept.roots.update(zip([keys[i] for i in new.tolist()], root[new].tolist(), strict=True))
        node = root[of]
        todo = np.flatnonzero(node >= 0) if long.any() else np.arange(n)
        if self.runs:
            first = self.draws(numbers[todo], 0)
            may = np.flatnonzero(first >= self.under[kept.candidates.all[node[todo]]])
            todo, at = todo[may], self.runs_of(first[may])
            skips = np.full((len(todo), DEEP + 1), NEVER)
            for depth in range(1, DEEP + 2):
                on = np.flatnonzero(at < kept.candidates.all[node[todo]])
                todo, at, skips = todo[on], at[on], skips[on]
                if not len(todo) or depth > DEEP:
                    break
                skips[:, depth - 1] = at
                slot = kept.first.all[node[todo]] + at
                child = kept.children.all[slot]
                kept.used.all[child[child >= 0]] = True
                if len(none := np.flatnonzero(child < 0)):
                    slots, one, same = np.unique(slot[none], return_index=True, return_inverse=True)
                    one = none[one]
                    made = self._new(words, of[todo[one]], skips[one], leaf=depth == DEEP)
                    kept.children.all[slots] = made
                    child[none] = made[same]
                node[todo] = child
                at = at + 1 + self.runs_of(self.draws(numbers[todo], depth))
        # Those with more skips, and long words, are kept for this time only.
        here = kept.start.n
        for lo in range(0, len(todo) if self.runs else 0, TOGETHER):
            part = slice(lo, lo + TOGETHER)
            columns = [*skips[part, :DEEP].T, at[part]]
            while (columns[-1] < NEVER).any():
                columns.append(np.minimum(columns[-1] + 1 + self.runs_of(self.draws(numbers[todo[part]], len(columns))), NEVER))
            node[todo[part]] = self._new(words, of[todo[part]], np.stack(columns, axis=1), leaf=True)
        if long.any():
            for i in np.flatnonzero(long[of]).tolist():
                ids = np.frombuffer(self.encoded(keys[of[i]].decode(), int(numbers[i])), dtype=np.int32)
                node[i] = kept.add(ids, np.array([len(ids)]), np.zeros(1, dtype=np.int16), leaf=True)[0]
        sizes = kept.size.all[node].astype(np.int64)
        ids = kept.ids.all[_ranges(kept.start.all[node], sizes)]
        kept.cut(here)
        return ids, sizes

    def _new(self, words: pa.Array, at: np.ndarray, skips: np.ndarray, leaf: bool = False) -> np.ndarray:
        """Nodes for some of the words, with the skips of each."""
        *made, order = self.together(words.take(pa.array(at)), skips)
        out = np.empty(len(at), dtype=np.int64)
        out[order] = self.kept.add(*made, leaf=leaf)
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids)[1:].tobytes().decode()  # without the space in front

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        """What ids of one or more texts stand for, with the space in front of each."""
        out = [np.zeros(0, dtype=np.uint8)]
        for lo in range(0, len(ids), 1 << 16):
            part = ids[lo : lo + (1 << 16)]
            out.append(self.flat[_ranges(self.starts[part], self.lengths[part])])
        return np.concatenate(out)


def _broadcast(spark: SparkSession, model: str, seed: int = 0, dropout: float = 0.0, cached: int = CACHED):
    """The encoder: a worker has one while the broadcast lives, so its words outlive a task, but not the query's steps."""
    return spark.sparkContext.broadcast(Encoder(Vocabulary(model), seed, dropout, cached))


def _encoded(e: Encoder, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Some texts at a time: their bytes and where each begins (and the last ends), and the same of their ids."""
    data, offsets = utf8(texts)
    for lo, hi in chunks(offsets):
        at = offsets[lo : hi + 1]
        part = data[at[0] : at[-1]]
        yield part, at - at[0], *e.encode_bytes(part, at - at[0])


def encode(docs: DataFrame, model: str = MODEL, seed: int = 0, dropout: float = DROPOUT, text: str = "text", cached: int = CACHED) -> DataFrame:
    """``docs`` with ``piece_ids``."""
    shared = _broadcast(docs.sparkSession, model, seed, dropout, cached)

    def start():
        e = shared.value

        def step(texts: pa.Array):
            made = [x[2:] for x in _encoded(e, texts)]
            flat = np.concatenate([np.zeros(0, dtype=np.int32), *(ids for ids, _ in made)])
            ends = np.cumsum(np.concatenate([[0], *(np.diff(cut) for _, cut in made)]))
            null = texts.is_null().to_numpy(zero_copy_only=False)
            offsets = pa.array(ends.astype(np.int32), mask=np.append(null, False))
            return [pa.ListArray.from_arrays(offsets, pa.array(flat, type=pa.int32()))]

        return step

    return append(docs, [text], start, [T.StructField("piece_ids", T.ArrayType(T.IntegerType()))])


def decode(docs: DataFrame, model: str = MODEL, ids: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids stand for."""
    shared = _broadcast(docs.sparkSession, model)

    def start():
        e = shared.value

        def step(lists: pa.Array):
            return [pa.array([None if not x.is_valid else e.decode(x.values.to_numpy()) for x in lists], type=pa.string())]

        return step

    return append(docs, [ids], start, [T.StructField(out, T.StringType())])


REPORT = [
    T.StructField("n_pieces", T.LongType()),
    T.StructField("n_byte_pieces", T.LongType()),
    T.StructField("pieces_sha256", T.StringType()),
    T.StructField("lossless", T.BooleanType()),
]


def report(docs: DataFrame, model: str = MODEL, seed: int = 0, dropout: float = DROPOUT, text: str = "text", keep: list[str] | None = None, cached: int = CACHED) -> DataFrame:
    """``docs`` with what encoding and decoding give: number of pieces and of byte pieces, SHA-256 of
    the ids (little-endian 32 bits each), and whether they decode to the text.

    The ids go from the encoder to the decoder in the task, in place of a
    column about twice as large as the texts.
    """
    shared = _broadcast(docs.sparkSession, model, seed, dropout, cached)

    def start():
        e = shared.value
        is_byte = np.zeros(len(e.lengths), dtype=bool)
        is_byte[e.v.bytes] = True

        def step(texts: pa.Array):
            rows = []
            for data, offsets, ids, cut in _encoded(e, texts):
                n_bytes = np.concatenate([[0], np.cumsum(is_byte[ids])])[cut]
                decoded = e.decode_bytes(ids)
                # Where each text lies in what was decoded, if its ids stand for as many bytes as it has and the space.
                length = np.concatenate([[0], np.cumsum(e.lengths[ids])])[cut]
                numbers = zip(np.diff(cut).tolist(), np.diff(n_bytes).tolist(), cut.tolist(), length.tolist(), offsets.tolist(), strict=False)
                for k, (n, b, c, d, at) in enumerate(numbers):
                    text, back = data[at : offsets[k + 1]], decoded[d : length[k + 1]][1:]
                    rows.append((n, b, sha256(ids[c : c + n].astype("<i4", copy=False)).hexdigest(), back.tobytes() == text.tobytes()))
            null = texts.is_null().to_numpy(zero_copy_only=False)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
            return [pa.array([r[i] for r in rows], type=k, mask=null if i > 1 else None) for i, k in enumerate(kinds)]

        return step

    return append(docs, [text], start, REPORT, keep=keep)
