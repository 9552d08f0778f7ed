"""Substring deduplication with a count-min prefilter.

A window is ``window`` consecutive words of one document.  A word is removed
when a window covering it also starts in a document with a smaller id;
windows are judged on the input, never on what is left.

Method.  Each partition counts its windows in a count-min sketch; the
partition sketches are merged (saturating at two) and the merged sketch never
underestimates.  A second pass over the texts emits only the windows whose
estimate is two or more and groups exactly these by a 96-bit hash, so no
repeated window is lost and a false alarm of the sketch costs a row, never a
result.  Before that shuffle each Arrow batch settles the repeats it holds
itself, so that a window shared by a third of all documents sends one open
row per batch, not one per document.

What the sketch counts: a window is represented by the smallest of the
hashes of its ``window - gram + 1`` inner grams, and each text position that
is such a minimum is counted once.  Equal windows have equal minima, so a
window in two documents gives two counted positions: the estimate is an upper
bound of the window's count, with about a third of the insertions.

Size.  The sketch has ``ROWS`` rows; its width follows the corpus (about two
cells per word) up to ``max_cells`` (default 2**28: 64 MB while counting in
a task, 32 MB broadcast).  This is the proven bound of the broadcast.  Above
it the share of false alarms grows and more windows take the exact pass; the
result stays the same.

Defined cases: a null text has no words; a document shorter than a window
keeps all its words; a null id neither removes nor loses words; rows sharing
an id are one document as far as "smaller id" goes, and each row gets its own
result row; repeated words inside one document are kept; an empty table gives
an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from livemart.llm._words import (U64, column_buffers, mix64, row_groups, window_hashes, windows_inside, word_hashes,
                                 word_spans)

ROWS = 2
_GROUP_BYTES = 4 << 20
_CHUNK = 1 << 20  # cells per merged piece of the sketch
_NONE = np.zeros(0, dtype=np.int64)


class _Grams:
    """Inner grams of the windows of a group of rows, and their minima."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, window: int, gram: int):
        start, end, self.first = word_spans(offsets, data)
        self.words = word_hashes(data, start, end)
        self.inside, self.row = windows_inside(self.first, len(self.words), window)
        self.grams = window_hashes(self.words, gram, seed=1)
        self.span = window - gram + 1
        n = len(self.inside)
        self.smallest = self.grams[:n].copy()
        for s in range(1, self.span):
            np.minimum(self.smallest, self.grams[s:s + n], out=self.smallest)

    def minima(self) -> np.ndarray:
        """Hashes of the positions that are the minimum of some window."""
        n, marked = len(self.inside), np.zeros(len(self.grams), dtype=bool)
        for s in range(self.span):
            marked[s:s + n] |= self.inside & (self.grams[s:s + n] == self.smallest)
        return self.grams[marked]


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(hashes + U64(0xA24BAED4963EE407 * (row + 1) % (1 << 64))) >> U64(64 - bits)).astype(np.uint32)


def _count(once: np.ndarray, twice: np.ndarray, cells: np.ndarray) -> None:
    """Add one to each named cell of the two packed planes ("seen", "seen twice or more")."""
    if not len(cells):
        return
    cells.sort()
    fresh = np.concatenate(([True], cells[1:] != cells[:-1]))
    bit = np.uint8(0x80) >> (cells & 7).astype(np.uint8)
    place = cells >> 3
    head = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    place = place[head]
    twice[place] |= (once[place] & np.bitwise_or.reduceat(bit, head)) | np.bitwise_or.reduceat(
        np.where(fresh, np.uint8(0), bit), head)
    once[place] |= np.bitwise_or.reduceat(bit, head)


def _build(window: int, gram: int, bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = (np.zeros((ROWS, (1 << bits) // 8), dtype=np.uint8) for _ in range(2))
        for batch in batches:
            offsets, data = column_buffers(batch.column(0))
            for i, j in row_groups(offsets, _GROUP_BYTES):
                minima = _Grams(offsets[i:j + 1], data, window, gram).minima()
                for r in range(ROWS):
                    _count(once[r], twice[r], _cells(minima, r, bits))
        step = min(_CHUNK, 1 << bits) // 8
        for r in range(ROWS):
            for k, c in enumerate(range(0, once.shape[1], step)):
                if once[r, c:c + step].any():
                    a, b = (zlib.compress(plane[r, c:c + step].tobytes(), 1) for plane in (once, twice))
                    yield pa.RecordBatch.from_pydict({
                        "piece": pa.array([r * (once.shape[1] // step) + k], pa.int32()),
                        "once": pa.array([a], pa.binary()), "twice": pa.array([b], pa.binary())})
    return build


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the partition sketches piece by piece (rows sorted by piece)."""
    current, once, twice = None, None, None

    def out():
        return pa.RecordBatch.from_pydict({"piece": pa.array([current], pa.int32()),
                                           "twice": pa.array([twice.tobytes()], pa.binary())})
    for batch in batches:
        for piece, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            a = np.frombuffer(zlib.decompress(a.as_py()), np.uint8)
            b = np.frombuffer(zlib.decompress(b.as_py()), np.uint8)
            if piece != current:
                if current is not None:
                    yield out()
                current, once, twice = piece, a.copy(), b.copy()
            else:
                twice |= b | (once & a)
                once |= a
    if current is not None:
        yield out()


def _suspects(window: int, gram: int, bits: int, shared):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value

        def repeated(hashes: np.ndarray) -> np.ndarray:
            found = np.ones(len(hashes), dtype=bool)
            for r in range(ROWS):
                cell = _cells(hashes, r, bits)
                found &= (sketch[r][cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
            return found

        for batch in batches:
            offsets, data = column_buffers(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            found: list[tuple[np.ndarray, ...]] = []
            for i, j in row_groups(offsets, _GROUP_BYTES):
                g = _Grams(offsets[i:j + 1], data, window, gram)
                starts = np.flatnonzero(g.inside)
                starts = starts[repeated(g.smallest[starts])]
                found.append((window_hashes(g.words, window, seed=2)[starts].view(np.int64) if len(starts) else _NONE,
                              (window_hashes(g.words, window, seed=3)[starts] >> U64(32)) if len(starts) else _NONE,
                              ids[i + g.row[starts]] if len(starts) else _NONE))
            h1, h2, owner = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (_NONE,) * 3
            if not len(h1):
                continue
            h2 = h2.astype(np.uint32).view(np.int32)
            order = np.lexsort((owner, h2, h1))
            h1, h2, owner = h1[order], h2[order], owner[order]
            new = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
            low = owner[np.flatnonzero(new)[np.cumsum(new) - 1]]
            keep = new | (owner > low)  # a window's repeats in its own first document say nothing
            yield pa.RecordBatch.from_pydict({"h1": h1[keep], "h2": h2[keep], "id": owner[keep],
                                              "settled": pa.array((owner > low)[keep])})
    return emit


def _strip(window: int):
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = column_buffers(batch.column("text"))
            lists = batch.column("drop_windows")
            n_words, n_removed, kept = [], [], []
            for i, drop in enumerate(lists):
                row = offsets[i:i + 2]
                words = data[row[0]:row[1]].tobytes().split()
                keep = None
                if drop.is_valid:
                    start, end, _ = word_spans(row, data)
                    hashes = window_hashes(word_hashes(data, start, end), window, seed=2).view(np.int64)
                    hit = np.flatnonzero(np.isin(hashes, drop.values.to_numpy(zero_copy_only=False)))
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(edge, hit, 1)
                    np.add.at(edge, hit + window, -1)
                    keep = np.cumsum(edge[:-1]) == 0
                n_words.append(len(words))
                n_removed.append(0 if keep is None else int(len(words) - keep.sum()))
                kept.append(b" ".join(words if keep is None else [w for w, k in zip(words, keep, strict=True) if k]))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})
    return strip


def merged_sketch(texts: DataFrame, window: int, gram: int, max_cells: int) -> tuple[int, np.ndarray]:
    """(bits per row, packed "two or more" plane of each row) over all texts."""
    spark = texts.sparkSession
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = int(np.clip(np.ceil(np.log2(max(chars, 1) / 3)), 16, np.log2(max_cells))) - (ROWS - 1).bit_length()
    # few, large partition sketches: one per core, or per 4 GB of text beyond that
    parts = max(spark.sparkContext.defaultParallelism, -(-chars // (4 << 30)))
    pieces = (texts.coalesce(parts)
              .mapInArrow(_build(window, gram, bits), "piece int, once binary, twice binary")
              .repartition("piece").sortWithinPartitions("piece")
              .mapInArrow(_merge, "piece int, twice binary"))
    step = min(_CHUNK, 1 << bits)
    plane = np.zeros((ROWS, (1 << bits) // step, step // 8), dtype=np.uint8)
    for r in pieces.toLocalIterator():  # at most max_cells / 8 bytes in all
        plane[divmod(r.piece, plane.shape[1])] = np.frombuffer(r.twice, np.uint8)
    return bits, plane.reshape(ROWS, -1)


def substring_dedup(docs: DataFrame, window: int = 13, gram: int = 8, max_cells: int = 1 << 28) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space) of every row of ``docs``."""
    if not 0 < gram <= window:
        raise ValueError("gram must lie between 1 and window")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bits, plane = merged_sketch(docs.select("text"), window, gram, max_cells)
    shared = docs.sparkSession.sparkContext.broadcast(plane)
    suspects = docs.where("doc_id is not null and text is not null").mapInArrow(
        _suspects(window, gram, bits, shared), "h1 long, h2 int, id long, settled boolean")
    # a batch settles its own repeats, so at most one open row per window and
    # batch meets in a group; settled rows are spread under keys of their own
    spread = F.when(F.col("settled"), F.xxhash64("id", "h1"))
    group = Window.partitionBy(F.coalesce(spread, F.col("h1")).alias("k1"), "h2", "settled")
    drops = (suspects.withColumn("low", F.min("id").over(group)).where("settled or id > low")
             .groupBy(F.col("id").alias("doc_id")).agg(F.collect_list("h1").alias("drop_windows")))
    return docs.join(drops, "doc_id", "left").mapInArrow(
        _strip(window), "doc_id long, n_words long, n_removed long, kept_text string")


def digest(result: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
