"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by the score of the
piece they would form, best first and leftmost among equals; the best pair is
merged, its neighbours' pairs enter the agenda, and entries whose symbols have
changed meanwhile are passed over.  Symbols left that are no piece become
their UTF-8 bytes.  Short pre-tokens are encoded together: their agendas are
parts of one array of ranks, and each round takes the best entry of every
agenda that has one.  Each distinct pre-token of a slice is encoded once, and
the sentencepiece library encodes and decodes the same pre-tokens beside it,
plus one whole text per slice; a difference ends the job.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pieces import SPACE, PieceModel, piece_model
from .tables import batch_of, text_slices

# Bytes, about, of encoded pre-tokens that a worker remembers between slices,
# and of the texts it works on at a time (both bound memory only).
REMEMBERED = 48_000_000
SLICE = 500_000
# what "surrogateescape" makes of a byte that is part of no character
_NO_CHARACTER = re.compile("[\udc80-\udcff]")


def encode_word(model: PieceModel, word: str) -> list[int]:
    """Ids of one pre-token by the score-ordered agenda."""
    ids, scores = model.ids, model.scores
    if word in ids and len(word) == 1:
        return [ids[word]]
    sym = list(word)
    n = len(sym)
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    agenda = []
    for i in range(n - 1):
        s = scores.get(sym[i] + sym[i + 1])
        if s is not None:
            agenda.append((-s, i, 2))
    heapq.heapify(agenda)
    while agenda:
        _, i, size = heapq.heappop(agenda)
        a = sym[i]
        if not a:
            continue
        j = right[i]
        if j >= n or len(a) + len(sym[j]) != size:
            continue  # one of the two has been merged since
        a = sym[i] = a + sym[j]
        sym[j] = ""
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            s = scores.get(a + sym[k])
            if s is not None:
                heapq.heappush(agenda, (-s, i, size + len(sym[k])))
        k = left[i]
        if k >= 0:
            s = scores.get(sym[k] + a)
            if s is not None:
                heapq.heappush(agenda, (-s, k, size + len(sym[k])))
    out = []
    for s in sym:
        if s:
            i = ids.get(s)
            if i is not None:
                out.append(i)
            else:
                out.extend(model.byte_ids[b] for b in s.encode())
    return out


class WordBatch:
    """The agenda for many short pre-tokens at once.

    A symbol is a piece's id, or a character that is no piece (its code point
    beyond the ids).  ``rank`` of a pair is the place of the merged piece in
    the order of scores; words that hold a piece whose score another one shares
    are left to ``encode_word``."""

    LONGEST = 48

    def __init__(self, model: PieceModel):
        self.model = model
        self.v = len(model.pieces)
        merged = [p for p in model.ids if len(p) > 1]
        shared = Counter(model.scores[p] for p in merged)
        tied = sorted((p for p in merged if shared[model.scores[p]] > 1), key=len)
        self.tied: list[str] = []
        for p in tied:
            if not any(t in p for t in self.tied):
                self.tied.append(p)
        order = sorted(set(merged) - set(tied), key=lambda p: -model.scores[p])
        self.by_rank = np.array([model.ids[p] for p in order], np.int64)
        self.none = len(order)
        table = {}
        for rank, p in enumerate(order):
            for k in range(1, len(p)):
                a, b = self._symbol(p[:k]), self._symbol(p[k:])
                if a is not None and b is not None:
                    table[a << 32 | b] = rank
        self.keys = np.array(sorted(table), np.int64)
        self.ranks = np.array([table[k] for k in self.keys.tolist()], np.int64)
        points = np.arange(0x110000, dtype=np.int64) + self.v
        for p, i in model.ids.items():
            if len(p) == 1:
                points[ord(p)] = i
        self.points = points

    def takes(self, word: str) -> bool:
        return len(word) <= self.LONGEST and not any(t in word for t in self.tied)

    def _symbol(self, s: str) -> int | None:
        return self.model.ids.get(s, self.v + ord(s) if len(s) == 1 else None)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, one after the other; number of ids of each)."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.points[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        name = np.arange(len(words))
        rank = np.full(len(sym), self.none)
        ends = np.cumsum(size) - 1
        rank[:-1] = self._rank(sym[:-1], sym[1:])
        rank[ends] = self.none
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(name):
            start = np.cumsum(size) - size
            n = len(sym)
            best = np.minimum.reduceat(rank * n + np.arange(n), start)
            open_ = best < self.none * n
            if not open_.all():
                mine = np.repeat(open_, size)
                done.append((name[~open_], size[~open_], sym[~mine]))
                rank_, at = best[open_] // n, best[open_] % n
                at = (np.cumsum(mine) - 1)[at]
                name, size, sym, rank = name[open_], size[open_], sym[mine], rank[mine]
                if not len(name):
                    break
            else:
                rank_, at = best // n, best % n
            sym[at] = self.by_rank[rank_]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, rank = sym[keep], rank[keep]
            at = at - np.arange(len(at))
            size = size - 1
            start = np.cumsum(size) - size
            last = at == start + size - 1
            rank[at] = np.where(last, self.none, self._rank(sym[at], sym[np.minimum(at + 1, len(sym) - 1)]))
            left = at[at > start]
            rank[left - 1] = self._rank(sym[left - 1], sym[left])
        parts = [(name, *self._bytes(sym, size)) for name, size, sym in done]
        lengths = np.zeros(len(words), np.int64)
        for name, sym, size in parts:
            lengths[name] = size
        start = np.cumsum(lengths) - lengths
        flat = np.empty(int(lengths.sum()), np.int32)
        for name, sym, size in parts:  # where a word's ids go, in the order of the words
            flat[np.repeat(start[name] - (np.cumsum(size) - size), size) + np.arange(len(sym))] = sym
        return flat, lengths

    def _bytes(self, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece, as their UTF-8 byte pieces."""
        odd = np.flatnonzero(sym >= self.v)
        if not len(odd):
            return sym, size
        raw = [[self.model.byte_ids[b] for b in chr(c).encode()] for c in (sym[odd] - self.v).tolist()]
        width = np.ones(len(sym), np.int64)
        width[odd] = [len(r) for r in raw]
        out = np.repeat(sym, width)
        out[np.repeat(sym >= self.v, width)] = np.concatenate(raw)
        return out, np.add.reduceat(width, np.cumsum(size) - size)


@functools.lru_cache(maxsize=4)
def word_batch(model: PieceModel) -> WordBatch:
    return WordBatch(model)


def encode_words(model: PieceModel, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all pre-tokens, one after the other; number of ids of each):
    short ones together, long ones by ``encode_word``."""
    batch = word_batch(model)
    short = np.fromiter(map(batch.takes, words), bool, len(words))
    if short.all() and words:
        return batch.encode(words)
    at = np.flatnonzero(short)
    flat, size = batch.encode([words[i] for i in at.tolist()]) if len(at) else (np.zeros(0, np.int32), np.zeros(0, int))
    own: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
    for i, ids in zip(at.tolist(), np.split(flat, np.cumsum(size)[:-1]) if len(at) else (), strict=True):
        own[i] = ids
    for i in np.flatnonzero(~short).tolist():
        own[i] = np.array(encode_word(model, words[i]), np.int32)
    return (np.concatenate(own) if own else flat), np.fromiter(map(len, own), np.int64, len(own))


@functools.lru_cache(maxsize=4)
def _id_texts(model: PieceModel) -> list[str]:
    """What each id reads as; a byte from 128 on as its "surrogateescape"."""
    out = [p.replace(SPACE, " ") for p in model.pieces]
    for i, b in model.id_bytes.items():
        out[i] = bytes([b]).decode("utf-8", "surrogateescape")
    return out


def decode_ids(model: PieceModel, ids: list[int]) -> str:
    """Text of ids: pieces joined, byte pieces read as UTF-8 (a byte that is
    part of no character becomes U+FFFD), U+2581 as space.  With the first
    space that encoding has added: it is taken off a whole text only."""
    text = "".join(map(_id_texts(model).__getitem__, ids))
    if _NO_CHARACTER.search(text):
        text = text.encode("utf-8", "surrogateescape").decode("utf-8", "surrogateescape")
        text = _NO_CHARACTER.sub("\ufffd", text)
    return text


@functools.lru_cache(maxsize=4)
def _id_names(n: int) -> list[str]:
    return list(map(str, range(n)))


class Codec:
    """Encodes and decodes whole texts; remembers pre-tokens between slices, up
    to REMEMBERED bytes of them.

    ``ids`` holds the decimal ids of a pre-token joined by commas, ``texts``
    what they decode to where that is not the pre-token itself."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.ids: dict[str, str] = {}
        self.texts: dict[str, str] = {}
        self.size = 0
        self.is_byte = np.zeros(len(model.pieces), bool)
        self.is_byte[list(model.byte_ids.values())] = True
        self.digits = np.array([len(str(i)) for i in range(len(model.pieces))])

    def _checked(self, words: list[str]) -> tuple[dict[str, str], dict[str, str]]:
        """The two tables for new pre-tokens, each held against the library."""
        flat, size = encode_words(self.model, words)
        lib = self.model.library_ids(words)
        if not np.array_equal(size, np.fromiter(map(len, lib), np.int64, len(lib))) or not np.array_equal(
                flat, np.fromiter(itertools.chain.from_iterable(lib), np.int32, len(flat))):
            raise AssertionError("an encoding differs from the library's")
        del lib
        every, to = flat.tolist(), np.cumsum(size)
        whole = ",".join(map(_id_names(len(self.model.pieces)).__getitem__, every))
        comma = np.cumsum(self.digits[flat] + 1)[to - 1]  # one place past each pre-token's ids and their commas
        ids = {w: whole[i:j - 1] for w, i, j in zip(words, [0, *comma.tolist()], comma.tolist())}
        decoded, texts = [w.replace(SPACE, " ") for w in words], {}
        odd = np.logical_or.reduceat(self.is_byte[flat], to - size)
        for i in np.flatnonzero(odd).tolist():
            text = decode_ids(self.model, every[to[i] - size[i]:to[i]])
            if text != decoded[i]:
                decoded[i] = texts[words[i]] = text
        plain = np.repeat(~odd, size)
        if decode_ids(self.model, flat[plain].tolist()) != "".join(itertools.compress(decoded, ~odd)):
            raise AssertionError("a decoding differs from its text")
        # pre-tokens start with a space, so no character crosses from one to the next
        if self.model.lib.decode(every) != "".join(decoded)[1:]:
            raise AssertionError("a decoding differs from the library's")
        return ids, texts

    def encode(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Per whole text: its ids in decimal, joined by commas, and what they
        decode to."""
        split = [self.model.words(t) for t in texts]
        need: set[str] = set()
        for words in split:
            need.update(words)
        new = [w for w in need if w not in self.ids]
        ids_of, text_of = self.ids, self.texts
        if new:
            ids, odd = self._checked(new)
            if self.size < REMEMBERED:
                self.size += sum(map(len, ids)) + sum(map(len, ids.values())) + 200 * len(ids)
                self.ids.update(ids)
                self.texts.update(odd)
            else:
                ids_of, text_of = ids, {**self.texts, **odd}
                ids_of.update((w, self.ids[w]) for w in need.difference(new))
        whole = min((i for i, t in enumerate(texts) if t), key=lambda i: len(texts[i]), default=None)
        for i, (text, words) in enumerate(zip(texts, split, strict=True)):
            ids = ",".join(map(ids_of.__getitem__, words))
            if text_of and not text_of.keys().isdisjoint(words):
                back = "".join(text_of.get(w) or w.replace(SPACE, " ") for w in words)[1:]
            else:
                back = text.replace(SPACE, " ")
            if i == whole:  # the cut into pre-tokens, on one whole text
                lib = self.model.lib.encode(text)
                if (ids, back) != (",".join(map(str, lib)), self.model.lib.decode(lib)):
                    raise AssertionError("a whole text differs from the library's")
            yield ids, back


def encode_documents(docs: DataFrame, path: str, with_text: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids (decimal, comma-joined) and
    decoded text, or with ``with_text=False`` their SHA-256 digests
    (ids_sha256, decoded_sha256; lowercase hex).

    A null or empty text has no ids and decodes to ''.  U+2581 in a text is a
    space to the library, and so it is here.  Very long texts are encoded whole,
    one at a time.  Repeated rows, and rows that share a doc_id, are encoded each; a
    null doc_id is kept; an empty table gives no rows; other columns are
    ignored."""
    names = ("ids", "decoded") if with_text else ("ids_sha256", "decoded_sha256")
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), *((n, pa.string()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(piece_model(path))
        for part, texts in text_slices(batches, limit=SLICE):
            n, first, second = [], [], []
            for ids, text in codec.encode(texts):
                n.append(ids.count(",") + 1 if ids else 0)
                first.append(ids if with_text else hashlib.sha256(ids.encode()).hexdigest())
                second.append(text if with_text else hashlib.sha256(text.encode()).hexdigest())
            yield batch_of(schema, [part.column("doc_id"), n, first, second])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id long, n_tokens long, {names[0]} string, {names[1]} string")
