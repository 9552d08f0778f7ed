"""SentencePiece encoding of merge-type vocabularies with a score-ordered agenda.

A text is normalised as the vocabulary says and becomes a chain of symbols, one
per character.  The agenda (a heap) holds every adjacent pair whose
concatenation is a piece, best score first, leftmost first among equals.  The
top pair is joined if both its symbols are still as they were when it was entered, and the
pairs with the new neighbours are entered.  When the agenda is empty the symbols are
the pieces; one that is none becomes its UTF-8 bytes' pieces (byte fallback) or
the unknown id, which adjoining unknown symbols share.

No merge crosses two adjoining characters that stand side by side in no piece.  So
texts are cut into chunks before each run of word-start marks, and before a run of
characters (punctuation, mostly) that no piece holds behind others; each chunk is merged
on its own and remembered in a bounded table.  Long chunks use the heap, after cutting them at
every such place.  The short chunks of a batch that are not yet known are merged side by side in numpy: each
has its agenda of adjacent pairs' ranks, in each round every chunk joins its top
pair, the leftmost of the best, and enters the pairs with the new neighbours.

Every chunk is checked, when it is merged, against the sentencepiece library, a batch
of chunks at a time; a difference stops the job.  ``differences`` compares whole texts with the library.

Defined cases: null texts are empty and have no ids; null and repeated ids are
kept, each row has its own result; texts of any length are encoded whole, a few rows at a time; an
empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
MARK = "▁"
ROWS = 64
REMEMBERED = 400_000
LONG = 64
CODES = 0x110000
NONE = 1 << 40
_codecs: dict = {}


def model_path(name: str = MODEL) -> str:
    """Place of a public vocabulary file (package ``public_tokenizers``); pass any other path instead."""
    import public_tokenizers
    return public_tokenizers.path(name)


class Codec:
    """A merge-type vocabulary, and the merges of the chunks met so far."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.library = sp = SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        ids = range(self.size)
        reserved = {i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        if any(sp.is_unused(i) for i in ids):
            raise ValueError("vocabularies with unused pieces are not merge-only")
        self.unknown = sp.unk_id()
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.falls_back = all(sp.is_byte(i) for i in self.bytes)
        names = {sp.id_to_piece(i): i for i in ids if i not in reserved}
        ranks = np.unique([-sp.get_score(i) for i in ids], return_inverse=True)[1].tolist()
        self.pieces = {p: (i, ranks[i]) for p, i in names.items()}  # id and rank, the best score's lowest
        self.spanned = {p[k:k + 2] for p in names for k in range(len(p) - 1)}
        self.chunk = self._chunks()
        # symbols by number: a piece's id, or behind the ids the code point of a character that is no piece
        self.symbol = np.arange(CODES, dtype=np.int64) + self.size
        for p, i in names.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        number = {**{c: self.size + ord(c) for p in names for c in p}, **names}
        joins = sorted((number[p[:k]] * (self.size + CODES) + number[p[k:]], ranks[i], i) for p, i in names.items()
                       for k in range(1, len(p)) if p[:k] in number and p[k:] in number)
        self.pair, self.pair_rank, self.pair_piece = (np.array(c, np.int64) for c in zip(*joins, strict=True))
        self.known: dict[str, int] = {}
        self.store = Store()

    def _chunks(self) -> re.Pattern:
        """Cuts where no piece spans: before marks, and before characters that no piece has behind a word character."""
        inside = {c for p in self.spanned for c in p}
        if any(b == MARK and a != MARK for a, b in self.spanned):
            return re.compile(r"(?s).+")
        word = {c for c in inside if c.isalnum()}
        while more := {b for a, b in self.spanned if a in word and b not in word}:
            word |= more
        letters = "".join(map(re.escape, sorted(word)))
        other = f"[^{letters}{MARK}]"
        return re.compile(f"{MARK}+{other}*[{letters}]*|{other}+[{letters}]*|[{letters}]+")

    def merge(self, text: str) -> list[str]:
        """The symbols left of ``text`` when no adjacent pair is a piece."""
        symbols = list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pieces = self.pieces
        agenda = []
        for left in range(n - 1):
            found = pieces.get(symbols[left] + symbols[left + 1])
            if found:
                agenda.append((found[1], left, left + 1, len(symbols[left]) + len(symbols[left + 1])))
        heapify(agenda)
        while agenda:
            _, left, right, size = heappop(agenda)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue  # a symbol of the pair has been joined since
            symbols[left], symbols[right] = a + b, ""
            after[left] = nxt = after[right]
            if nxt < n:
                before[nxt] = left
                found = pieces.get(a + b + symbols[nxt])
                if found:
                    heappush(agenda, (found[1], left, nxt, size + len(symbols[nxt])))
            prev = before[left]
            if prev >= 0:
                found = pieces.get(symbols[prev] + a + b)
                if found:
                    heappush(agenda, (found[1], prev, left, len(symbols[prev]) + size))
        return [s for s in symbols if s]

    def _top(self, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each adjacent pair; ``NONE`` where it is no piece or of two chunks."""
        key = left * (self.size + CODES) + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        hit = same & (self.pair[at] == key)
        return np.where(hit, self.pair_rank[at], NONE), self.pair_piece[at]

    def merge_short(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(chunk number, symbol) of all symbols left of ``chunks``, merged side by side."""
        symbol = self.symbol[np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)]
        own = np.repeat(np.arange(len(chunks)), [len(c) for c in chunks])
        rank, piece = np.full(len(own), NONE), np.zeros(len(own), np.int64)
        rank[:-1], piece[:-1] = self._top(symbol[:-1], symbol[1:], own[:-1] == own[1:])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(own):
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            sizes = np.diff(np.r_[starts, len(own)])
            best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            if (best == NONE).any():
                live = best < NONE
                done.append((own[~live], symbol[~live]))
                own, symbol, rank, piece, best = (c[live] for c in (own, symbol, rank, piece, best))
                if not len(own):
                    break
            top = np.flatnonzero(rank == best)
            top = top[np.r_[True, own[top[1:]] != own[top[:-1]]]]  # the leftmost of each chunk
            symbol[top] = piece[top]
            stay = np.ones(len(own), bool)
            stay[top + 1] = False
            own, symbol, rank, piece = (c[stay] for c in (own, symbol, rank, piece))
            at = top - np.arange(len(top))  # one symbol before each has gone
            at = np.concatenate([at, at[at > 0] - 1])
            right = np.minimum(at + 1, len(own) - 1)
            rank[at], piece[at] = self._top(symbol[at], symbol[right], (own[at] == own[right]) & (at < right))
        own, symbol = (np.concatenate(c) for c in zip(*done, strict=True)) if done else (own, symbol)
        order = np.argsort(own, kind="stable")
        return own[order], symbol[order]

    def _long(self, chunk: str) -> list[int]:
        """Symbol numbers of a long chunk, cut where no piece spans two adjoining characters."""
        cuts = [k for k in range(1, len(chunk)) if chunk[k - 1:k + 1] not in self.spanned]
        return [self.pieces[s][0] if s in self.pieces else self.size + ord(s)
                for a, b in zip([0, *cuts], [*cuts, len(chunk)], strict=True) for s in self.merge(chunk[a:b])]

    def merged(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cuts) of the chunks, one after the other."""
        short = np.array([k for k, c in enumerate(chunks) if len(c) <= LONG], np.int64)
        own, symbol = self.merge_short([chunks[k] for k in short])
        own = short[own] if len(own) else own
        far = [(k, s) for k, c in enumerate(chunks) if len(c) > LONG for s in self._long(c)]
        if far:
            own, symbol = (np.concatenate(c) for c in zip((own, symbol), np.array(far, np.int64).T, strict=True))
            order = np.argsort(own, kind="stable")
            own, symbol = own[order], symbol[order]
        odd = np.flatnonzero(symbol >= self.size)  # no piece: its UTF-8 bytes, or the unknown id
        codes, which = np.unique(symbol[odd] - self.size, return_inverse=True)
        spelt = [[self.bytes[b] for b in chr(c).encode()] if self.falls_back else [self.unknown] for c in codes.tolist()]
        count = np.ones(len(own), np.int64)
        count[odd] = np.array([len(s) for s in spelt], np.int64)[which] if spelt else 1
        ids = np.repeat(symbol, count)
        first = (np.cumsum(count) - count)[odd]
        for k in range(max(map(len, spelt), default=0)):
            has = count[odd] > k
            ids[first[has] + k] = np.array([s[min(k, len(s) - 1)] for s in spelt], np.int64)[which[has]]
        sizes = np.bincount(np.repeat(own, count), minlength=len(chunks))
        return ids.astype(np.int32), np.r_[0, np.cumsum(sizes)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cuts) of the texts, one after the other; chunks not yet known are merged and checked first."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.store = Store()
        chunked = [self.chunk.findall(t) for t in self.library.normalize(texts)] if texts else []
        flat = [c for chunks in chunked for c in chunks]
        known = self.known
        number = np.fromiter(map(known.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new = list(dict.fromkeys(flat[k] for k in missing))
            ids, cuts = self.merged(new)
            self._check(new, ids, cuts)
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.store.add(ids, cuts)
            number[missing] = np.fromiter((known[flat[k]] for k in missing), np.int64, len(missing))
        ids, sizes = self.store.take(number)
        ends = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum([len(c) for c in chunked])].astype(np.int64)]
        if not self.falls_back and len(ids):  # adjoining unknown symbols of a text share an id across chunks too
            text = np.repeat(np.arange(len(texts)), np.diff(ends))
            again = np.r_[False, (ids[1:] == self.unknown) & (ids[:-1] == self.unknown) & (text[1:] == text[:-1])]
            ids, ends = ids[~again], np.r_[0, np.cumsum(np.bincount(text[~again], minlength=len(texts)))]
        return ids, ends

    def _check(self, chunks: list[str], ids: np.ndarray, cuts: np.ndarray) -> None:
        """Compare with the library: chunks that start with marks and end otherwise follow each other as in a text."""
        joins = [c.startswith(MARK) and not c.endswith(MARK) for c in chunks]
        marked = [c for c, ok in zip(chunks, joins, strict=True) if ok]
        text = "".join(marked)[1:].replace(MARK, " ")
        if marked and self.library.normalize(text) == "".join(marked):
            own = ids[np.repeat(np.array(joins, bool), np.diff(cuts))]
            if not np.array_equal(self._joined(own), self.library.encode(text)):
                raise AssertionError(f"chunks merged otherwise than by the library: {self._first_difference(marked)!r}")
            rest = [k for k, ok in enumerate(joins) if not ok]
        else:
            rest = list(range(len(chunks)))
        for k in rest:
            c = chunks[k]
            asked = c[1:].replace(MARK, " ") if c.startswith(MARK) else c
            if self.library.normalize(asked) == c and self._joined(ids[cuts[k]:cuts[k + 1]]).tolist() != self.library.encode(asked):
                raise AssertionError(f"chunk merged otherwise than by the library: {c!r}")

    def _first_difference(self, chunks: list[str]) -> str | None:
        ids, cuts = self.merged(chunks)
        return next((c for k, c in enumerate(chunks)
                     if self._joined(ids[cuts[k]:cuts[k + 1]]).tolist() != self.library.encode(c[1:].replace(MARK, " "))), None)

    def _joined(self, ids: np.ndarray) -> np.ndarray:
        """``ids`` of one text with adjoining unknown ids as one, where there is no byte fallback."""
        if self.falls_back or not len(ids):
            return ids
        return ids[np.r_[True, (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)]]


class Store:
    """Runs of ids, by number."""

    def __init__(self):
        self.ids, self.start, self.size, self.n, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0, 0

    @staticmethod
    def _room(column: np.ndarray, need: int) -> np.ndarray:
        return column if need <= len(column) else np.concatenate([column, np.zeros(max(need, 2 * len(column)) - len(column), column.dtype)])

    def add(self, ids: np.ndarray, cuts: np.ndarray) -> None:
        n = len(cuts) - 1
        self.ids = self._room(self.ids, self.used + len(ids))
        self.start, self.size = (self._room(c, self.n + n) for c in (self.start, self.size))
        self.ids[self.used:self.used + len(ids)] = ids
        self.start[self.n:self.n + n], self.size[self.n:self.n + n] = cuts[:-1] + self.used, np.diff(cuts)
        self.n, self.used = self.n + n, self.used + len(ids)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the runs one after the other, size of each)."""
        sizes = self.size[numbers]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.ids[np.repeat(self.start[numbers], sizes) + within], sizes


def codec(path: str) -> Codec:
    """The codec of ``path``, kept for the life of a Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time: texts may be very long, and lists of ids take many times their size."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _encode(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in _slices(batches):
            found, cuts = own.encode([t or "" for t in batch.column("text").to_pylist()])
            ids = pa.ListArray.from_arrays(cuts.astype(np.int32), found)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "token_ids"])
    return encode


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, token_ids) of every row of ``docs`` (doc_id, text)."""
    return _texts(docs).mapInArrow(_encode(path or model_path()), "doc_id long, token_ids array<int>")


def _lists(column: pa.Array) -> list[list[int]]:
    flat, cuts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _decode(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = codec(path).library
        for batch in _slices(batches):
            ids = batch.column("token_ids")
            texts = [library.decode(i) for i in _lists(ids)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(texts, pa.string())],
                                             names=["doc_id", "token_ids", "text"])
    return decode


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, token_ids, text): the ids of ``encode`` turned back into texts by the library."""
    return encoded.select("doc_id", "token_ids").mapInArrow(
        _decode(path or model_path()), "doc_id long, token_ids array<int>, text string")


def differences(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, own, library): rows whose whole text the library encodes otherwise."""
    path = path or model_path()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in _slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids, cuts = own.encode(texts)
            found = [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            rows = [(i, a, b) for i, a, b in zip(batch.column("doc_id").to_pylist(), found,
                                                 own.library.encode(texts, num_threads=1) if texts else [], strict=True) if a != b]
            ids, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(a, kind), pa.array(b, kind)],
                                             names=["doc_id", "own", "library"])
    return _texts(docs).mapInArrow(compare, "doc_id long, own array<int>, library array<int>")
