r"""Operator 5: byte-pair encoding by speculation and verification, and decoding.

A word's tokens are first guessed by greedy longest match.  A sequence of
tokens is the true encoding exactly if each token encodes to itself and no
merge that comes early enough joins two neighbours, which is tested for all
neighbours of a batch's new words at once by walking down both tokens' merge
histories in numpy.  Only words with a failing pair are merged exactly: words of up to
``SHORT`` characters side by side, one merge of each at a time, longer ones by a heap.

Texts never leave their partition: there is no shuffle, and each task keeps the
words that it has met lately, in two generations, with their ids and what they decode to.

Null texts count as empty and have no tokens; repeated rows get a row each.
Special tokens that occur in a text are taken as such, as the library does.  Of merges of
equal rank the leftmost is done first.  Very long texts are encoded whole, in the memory of their task.
An empty table gives no rows; extra columns are left out, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common as C

VOCABULARY = "word_bpe_49k.json"
MEMORY = 200_000  # words in each of the two generations that a task keeps
SHORT = 48  # characters up to which words are merged side by side
#: fixed values: the white space of the tokenizer's patterns, and its contractions
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(1)
def word_pattern() -> str:
    """Runs of letters, contractions, single numbers, runs of anything else that isn't white.

    The tokenizer tries contractions first; they begin with no letter, so the order is the same.
    """
    runs: dict[str, list[str]] = {"L": [], "N": []}
    for major, out in runs.items():
        start = None
        for c in range(sys.maxunicode + 2):
            there = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == major
            if there and start is None:
                start = c
            elif not there and start is not None:
                out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
                start = None
    letters, numbers = "".join(runs["L"]), "".join(runs["N"])
    return f"[{letters}]+|{CONTRACTIONS}|[{numbers}]|[^{WHITE}{letters}{numbers}]+"


#: what that comes to in lower-case ASCII
ASCII_PATTERN = f"[a-z]+|{CONTRACTIONS}|[0-9]|[^\\t-\\r a-z0-9]+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if it prints, else the next free one from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class Coder:
    """Encodes and decodes texts by one vocabulary file."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.decimal = {i: str(i) for i in self.tokens}
        self.split = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.word, self.ascii_word = re.compile(pattern), re.compile(ASCII_PATTERN)
        self.to_char = byte_alphabet()
        # every beginning of a token: its id if it is one itself, else -1; a blank stands for the end of a word
        self.starts: dict[str, int] = {}
        for t, i in self.ids.items():
            if self.end and t.endswith(self.end):
                t = t.removesuffix(self.end) + " "
            for to in range(1, len(t)):
                self.starts.setdefault(t[:to], -1)
            self.starts[t] = i
        n = max(self.ids.values()) + 1
        self.left, self.right = np.arange(n), np.arange(n)
        pairs, made = [], []
        for m in model["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            i = self.ids[a + b]
            self.left[i], self.right[i] = self.ids[a], self.ids[b]
            pairs.append((self.ids[a], self.ids[b]))
            made.append(i)
        if made != sorted(set(made)):
            raise ValueError("the vocabulary's ids must follow the order of its merges")
        self.merge = dict(zip(pairs, made))
        keys = np.array([a * n + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.n, self.keys, self.made = n, keys[order], np.array(made, np.int64)[order]
        # a token encodes to itself if its halves do and no merge before its own crosses them
        self.sound = np.ones(n, bool)
        made_ = np.array(made, np.int64)
        fits = self.compatible(self.left[made_], self.right[made_], made_)
        for i, ok in zip(made, fits.tolist()):
            self.sound[i] = ok and self.sound[self.left[i]] and self.sound[self.right[i]]
        self.known: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For tokens a and b side by side, whether no merge would have joined across them first.

        Undoes the merges of both from the last to the first.  A merge across
        the border counts if it comes before the merge undone last: strictly
        for one undone on the left; also at equal rank for one on the right,
        as of equal merges the left is done first.
        """
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), self.n, np.int64) if before is None else before.copy()
        good, open_ = np.ones(len(a), bool), np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            key = x * self.n + y
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            joined = np.where(self.keys[at] == key, self.made[at], self.n + 1)
            bad = joined < limit[open_]
            good[open_[bad]] = False
            leaf_x, leaf_y = self.left[x] == x, self.left[y] == y
            undo_x = ~leaf_x & (leaf_y | (x > y))
            undo_y = ~leaf_y & ~undo_x
            limit[open_] = np.where(undo_x, x, np.where(undo_y, y + 1, 0))
            a[open_] = np.where(undo_x, self.right[x], x)
            b[open_] = np.where(undo_y, self.left[y], y)
            open_ = open_[~bad & (undo_x | undo_y)]
        return good

    def guess(self, w: str) -> list[int]:
        """Greedy longest match; the last token is one that ends a word."""
        starts, out, at, n = self.starts, [], 0, len(w)
        w += " " if self.end else ""
        while at < n:
            to = at + 1
            while (t := starts.get(w[at:to])) is not None:
                if t >= 0 and (to != n or len(w) == n):  # before the end, the last character is left for a token that ends
                    best, reached = t, to
                if to > n:
                    break
                to += 1
            out.append(best)
            at = reached
        return out

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that a and b merge to, whose id is the merge's rank; ``n`` if they don't."""
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.made[at], self.n)

    def exact_many(self, words: list[str]) -> list[list[int]]:
        """``exact`` of short words at once: in each round every word does its next merge, the leftmost of least rank."""
        out: list[list[int]] = [[]] * len(words)
        wide = max(map(len, words))
        ids = np.full((len(words), wide + 1), -1, np.int64)
        for i, w in enumerate(words):
            ids[i, :len(w) - 1] = [self.ids[c] for c in w[:-1]]
            ids[i, len(w) - 1] = self.ids[w[-1] + self.end]
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        place, cols = np.arange(len(words)), np.arange(wide)
        while len(place):
            at = ranks.argmin(1)
            made = ranks[np.arange(len(place)), at]
            done = made == self.n
            if done.any():
                for i, row in zip(place[done].tolist(), ids[done].tolist()):
                    out[i] = [x for x in row if x >= 0]
                place, ids, ranks, at, made = place[~done], ids[~done], ranks[~done], at[~done], made[~done]
            row = np.arange(len(place))
            ids[:, :-1] = np.take_along_axis(ids, cols + (cols > at[:, None]), 1)  # what follows the pair moves up
            ids[:, -1] = -1
            ids[row, at] = made
            ranks = np.take_along_axis(np.pad(ranks, ((0, 0), (0, 1)), constant_values=self.n), cols + (cols >= at[:, None]), 1)
            ranks[row, at] = self.rank(ids[row, at], ids[row, at + 1])
            left = at > 0
            ranks[row[left], at[left] - 1] = self.rank(ids[row[left], at[left] - 1], made[left])
        return out

    def exact(self, w: str) -> list[int]:
        """The merges in order of rank, leftmost first, over a linked list."""
        ids = [self.ids[c] for c in w[:-1]] + [self.ids[w[-1] + self.end]]
        n, merge = len(ids), self.merge
        nxt, prev = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := merge.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            r, i, x, y = heapq.heappop(queue)
            j = nxt[i]
            if ids[i] != x or j < 0 or ids[j] != y:
                continue
            ids[i], ids[j], nxt[i] = r, -1, nxt[j]
            if nxt[i] >= 0:
                prev[nxt[i]] = i
                if (s := merge.get((r, ids[nxt[i]]))) is not None:
                    heapq.heappush(queue, (s, i, r, ids[nxt[i]]))
            if (p := prev[i]) >= 0 and (s := merge.get((ids[p], r))) is not None:
                heapq.heappush(queue, (s, p, ids[p], r))
        return [i for i in ids if i >= 0]

    def learn(self, words: list[str]) -> None:
        """Adds new words to the table: guesses, tests all adjacent pairs, and merges the failing words."""
        to_char = self.to_char
        spelt = [w if w.isascii() and w.isprintable() else "".join([to_char[b] for b in w.encode("utf-8", "surrogatepass")]) for w in words]
        found = [self.guess(w) for w in spelt]
        flat = np.array([t for g in found for t in g], np.int64)
        owner = np.repeat(np.arange(len(words)), [len(g) for g in found])
        inner = owner[1:] == owner[:-1]
        fails = np.bincount(owner[~self.sound[flat]], minlength=len(words))
        fails += np.bincount(owner[1:][inner][~self.compatible(flat[:-1][inner], flat[1:][inner])], minlength=len(words))
        failing = sorted(np.flatnonzero(fails).tolist(), key=lambda i: len(spelt[i]))  # those of like length together
        short = [i for i in failing if len(spelt[i]) <= SHORT]
        for at in range(0, len(short), 4096):
            part = short[at:at + 4096]
            for i, ids in zip(part, self.exact_many([spelt[i] for i in part])):
                found[i] = ids
        for i in failing[len(short):]:
            found[i] = self.exact(spelt[i])
        for w, ids in zip(words, found):
            self.known[w] = self.entry(ids)

    def entry(self, ids: list[int]) -> tuple[int, str, str]:
        """The number of tokens, their ids in decimal, and their decoded strings, each joined by spaces."""
        return len(ids), " ".join([self.decimal[i] for i in ids]), self.decode(ids)

    def pieces(self, text: str) -> Iterator[list[str] | int]:
        """Lists of words of normalised stretches, and the special tokens between them."""
        at = 0
        for m in self.split.finditer(text):
            yield self.words(text[at:m.start()])
            yield self.special[m[0]]
            at = m.end()
        yield self.words(text[at:])

    def words(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_word.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no rule for a final sigma
        return self.word.findall(text.lower())

    def entries(self, texts: list[str | None]) -> Iterator[list[tuple[int, str, str]]]:
        """For each text, the entries of its words and special tokens."""
        split = [[*self.pieces(t or "")] for t in texts]
        if len(self.known) > MEMORY:
            self.known, self.older = {}, self.known
        new = {w for p in split for x in p if not isinstance(x, int) for w in x}.difference(self.known)
        if self.older:
            again = [w for w in new if w in self.older]
            self.known.update((w, self.older[w]) for w in again)
            new.difference_update(again)
        if new:
            self.learn([*new])
        known = self.known
        for p in split:
            out: list[tuple[int, str, str]] = []
            for x in p:
                if isinstance(x, int):
                    out.append(self.entry([x]))
                else:
                    out += map(known.__getitem__, x)
            yield out

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [[int(i) for e in es if e[0] for i in e[1].split(" ")] for es in self.entries(texts)]

    def decode(self, ids: list[int]) -> str:
        """The tokens' strings joined by spaces, as for a vocabulary file without a decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])


def batches(texts: list[str | None], chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about that many characters."""
    start = n = 0
    for i, t in enumerate(texts):
        n += len(t or "")
        if n >= chars:
            yield start, i + 1
            start, n = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _coded(df: DataFrame, given: str, made: list[tuple[str, pa.DataType, str]], work, path: str | None) -> DataFrame:
    """Rows (doc_id, made...): ``work(coder, values)`` yields tuples of the made columns for the values of ``given``."""
    path, pattern = path or vocabulary_path(), word_pattern()
    names, kinds = [m[0] for m in made], [m[1] for m in made]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(path, pattern)
        for p in parts:
            cols = [*zip(*work(coder, p[given].to_pylist()))] or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([p["doc_id"], *map(pa.array, cols, kinds)], ["doc_id", *names])

    schema = ", ".join([f"doc_id {dict(df.dtypes)['doc_id']}", *[f"{n} {sql}" for n, _, sql in made]])
    return df.select("doc_id", given).mapInArrow(run, schema)


def encode(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row.  ``path`` must hold the vocabulary on every executor."""
    def work(coder: Coder, texts: list) -> Iterator[tuple]:
        for a, b in batches(texts):
            for ids in coder.encode(texts[a:b]):
                yield (ids,)

    return _coded(docs, text, [("ids", pa.list_(pa.int32()), "array<int>")], work, path)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) from rows (doc_id, ids)."""
    def work(coder: Coder, rows: list) -> Iterator[tuple]:
        for ids in rows:
            yield (coder.decode(ids or []),)

    return _coded(encoded, "ids", [("text", pa.string(), "string")], work, path)


def round_trip(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, and digests of the ids and of the decoded text; texts and ids stay in their task."""
    def work(coder: Coder, texts: list) -> Iterator[tuple]:
        from hashlib import sha256

        for a, b in batches(texts):
            for es in coder.entries(texts[a:b]):
                n, ids, decoded = zip(*es) if es else ((), (), ())
                yield sum(n), sha256(" ".join(ids).encode()).hexdigest(), sha256(" ".join(decoded).encode()).hexdigest()

    return _coded(docs, text, [("n_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"),
                               ("decoded_sha256", pa.string(), "string")], work, path)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows of every document."""
    return round_trip(C.table(spark, sf_dir, "documents"))
