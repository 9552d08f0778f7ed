"""Benchmark decontamination by template canonicalisation.

Texts are cut into tokens (runs of letters, numbers with inner points or
commas).  A token becomes a typed placeholder when it is a number, a unit of
measure (its short forms only after a number), or a name (capitalised inside a sentence; adjoining
names are one); other tokens are lower-cased words.  Windows of ``window``
template tokens of the benchmark items are hash-joined with the windows of
the documents, so a question with other numbers, names or units still meets
its template.  Then the slots decide: the values that the document puts into
the item's placeholders must be consistent (one item value always becomes the
same document value); windows against the majority do not count.  They are
judged within each occurrence of the item, since a document may hold it several
times with other values: the windows of one alignment, those of alignments that
follow each other in the item's order (words put in or left out), and all
together.  A document holds an item when the consistent windows of one of these
cover at least ``min_share`` of the item's windows; the best is reported, and of
equals one with the item's own values.

Items without a usable template are met word by word: a second, exact join takes
the windows of the untyped lower-cased tokens of every item, whatever they are,
and reports the item when ``min_share`` of them are met.  Letters of scripts
written without spaces are tokens of their own.  Whether an item's first word is
a name depends on what stands before it, so both readings are joined; read as a
name, it must still be that word.

Scale: the documents are read once per block of the benchmark and never
shuffled; a block of the benchmark is broadcast.  Its size is bounded by
``block_items`` and ``block_chars``; a larger benchmark takes more blocks.

Defined cases: null or empty texts match nothing; templates need ``MIN_TOKENS``
tokens and their windows at least half plain words (rows of numbers are no
template); items shorter than a window are one window of their own length; items
of fewer than ``MIN_TOKENS`` tokens are met only byte for byte, and those without
a space or sign inside only where they stand alone between ends of sentences;
items without letters and digits take no part; ``n_windows`` counts template
windows, or exact ones where no template reaches ``min_share``; equal items are
reported each; null ids are kept
as null; repeated rows give repeated results; empty tables give an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemart.llm._words import U64, column_buffers, constants, row_groups, window_hashes, windows_inside, word_hashes

MIN_TOKENS = 5
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces "
         "pound pounds ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours "
         "day days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees "
         "meter meters metre metres kilometer kilometers kilometre kilometres mph kmh").split()
_GROUP_BYTES = 4 << 20
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, dtype=np.int32)
_BREAK[[ord(c) for c in ".!?:;|\n\"()"]] = 1
_NUMBER, _UNIT, _NAME = (constants(3, 51)[k] for k in range(3))
_unit_hashes: list[np.ndarray] = []


def _units() -> np.ndarray:
    if not _unit_hashes:
        raw = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
        ends = np.append(np.flatnonzero(raw == 32), len(raw))
        _unit_hashes.append(np.sort(word_hashes(raw, np.append(0, ends[:-1] + 1), ends)))
    return _unit_hashes[0]


class Templates:
    """Template tokens of a group of rows: hash, plain-word flag, slot value, first and last word, and each row's first token.

    The untyped tokens are kept as ``words``.  With ``opens`` false a row's
    first token is read as one inside a sentence.
    """

    def __init__(self, offsets: np.ndarray, data: np.ndarray, opens: bool = True):
        lo, hi = int(offsets[0]), int(offsets[-1])
        raw = data[lo:hi]
        offsets = offsets - lo
        kind = _KIND[raw]
        inner = (raw == 46) | (raw == 44)
        inner[1:] &= kind[:-1] == 2
        inner[:-1] &= kind[1:] == 2
        edge = offsets[(offsets > 0) & (offsets < len(raw))]
        if len(raw):
            inner[0] = inner[-1] = False
            inner[edge] = inner[edge - 1] = False
        kind = np.where(inner, np.uint8(2), kind)
        alone, signs = _unspaced(raw)
        kind[signs] = 0
        change = np.ones(len(raw) + 1, dtype=bool)
        change[1:-1] = kind[1:] != kind[:-1]
        change[edge] = change[alone] = True
        cut = np.flatnonzero(change)
        real = kind[cut[:-1]] != 0
        start, end = cut[:-1][real], cut[1:][real]
        latin = np.zeros(len(raw), dtype=bool)  # capital letters of two bytes, first byte 0xC3
        latin[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
        low = _LOWER[raw] + latin.astype(np.uint8) * np.uint8(32)
        words = word_hashes(low, start, end)
        first = np.searchsorted(start, offsets)
        number = kind[start] == 2
        inside = np.ones(len(start), dtype=bool)
        inside[first[:-1][first[:-1] < len(start)]] = not opens
        broken = _BREAK[raw]
        broken[signs] = 1
        breaks = np.concatenate(([0], np.cumsum(broken)))
        inside[1:] &= breaks[start[1:]] == breaks[end[:-1]]
        capital = ((raw[start] >= 65) & (raw[start] <= 90)) | latin[np.minimum(start + 1, len(raw) - 1)] \
            if len(start) else np.zeros(0, dtype=bool)
        name = capital & inside & ~number
        unit = np.zeros(len(start), dtype=bool)
        unit[1:] = np.isin(words[1:], _units())
        unit[1:] &= (number[:-1] & inside[1:]) | (end[1:] - start[1:] > 2)
        name &= ~unit
        keep = np.ones(len(start), dtype=bool)
        keep[1:] = ~(name[1:] & name[:-1] & inside[1:])
        head = np.flatnonzero(keep)
        self.value = np.add.reduceat(words, head) if len(head) else words
        self.plain = ~(number | unit | name)[head]
        token = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, words)))
        self.token = token[head]
        self.lead = words[head]
        self.last = words[np.append(head[1:], len(words)) - 1] if len(head) else words
        self.first = np.searchsorted(head, first)
        self.words, self.start, self.end, self.first_word = words, start, end, first
        self.raw, self.breaks, self.offsets = raw, breaks, offsets

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, row, hash) of the windows of ``size`` tokens, at least half of them plain words."""
        inside, row = windows_inside(self.first, len(self.token), size)
        n = len(inside)
        plain = np.concatenate(([0], np.cumsum(self.plain)))
        good = np.flatnonzero(inside & (2 * (plain[size:size + n] - plain[:n]) >= size))
        return good, row[good], window_hashes(self.token, size, 60 + size)[good]

    def word_windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, row, hash) of the windows of ``size`` untyped tokens."""
        inside, row = windows_inside(self.first_word, len(self.words), size)
        good = np.flatnonzero(inside)
        return good, row[good], window_hashes(self.words, size, 160 + size)[good]

    def holds(self, row: int, word: int, size: int, short: tuple[bytes, int, bool]) -> bool:
        """Whether an item of ``size`` tokens stands at ``word`` byte for byte, and alone if it has to."""
        text, lead, alone = short
        at = int(self.start[word]) - lead
        if at < self.offsets[row] or at + len(text) > self.offsets[row + 1] or \
                self.raw[at:at + len(text)].tobytes() != text:
            return False
        after = word + size
        return not alone or bool(
            (word == self.first_word[row] or self.breaks[self.start[word]] > self.breaks[self.end[word - 1]])
            and (after == self.first_word[row + 1] or self.breaks[self.start[after]] > self.breaks[self.end[after - 1]]))


def _unspaced(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where characters of scripts without spaces begin or end, and the bytes of their signs."""
    lead = np.flatnonzero(raw >= 0xE0)
    lead = lead[lead + 1 < len(raw)]
    one, two = raw[lead], raw[lead + 1]

    def block(byte: int, lo: int, hi: int) -> np.ndarray:
        return (one == byte) & (two >= lo) & (two <= hi)
    # Thai and Lao; Myanmar; Khmer; kana to unified ideographs; compatibility and wide forms; further ideographs
    found = (block(0xE0, 0xB8, 0xBB) | block(0xE1, 0x80, 0x82) | block(0xE1, 0x9E, 0x9F)
             | (one >= 0xE3) & (one <= 0xE9) | block(0xEF, 0xA4, 0xAB) | block(0xEF, 0xBC, 0xBE) | block(0xF0, 0xA0, 0xB3))
    lead, one, two = lead[found], one[found], two[found]
    ends = np.minimum(lead + np.where(one == 0xF0, 4, 3), len(raw))
    three = raw[np.minimum(lead + 2, len(raw) - 1)] if len(lead) else two
    sign = block(0xE3, 0x80, 0x80) & ((three < 0x85) | (three > 0x87)) | block(0xEF, 0xBC, 0xBC) & (
        (three < 0x90) | (three > 0x99) & (three < 0xA1) | (three > 0xBA))
    signs = (lead[sign][:, None] + np.arange(3)).ravel()
    return np.concatenate((lead, ends)), signs[signs < len(raw)]


def _indexed(parts: list[tuple]) -> tuple[np.ndarray, ...]:
    """Columns of (hash, ...) parts sorted by hash, and which leading 20 bits there are."""
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    order = np.argsort(columns[0], kind="stable")
    there = np.zeros(1 << 20, dtype=bool)
    there[(columns[0] >> U64(44)).astype(np.int64)] = True
    return *(c[order] for c in columns), there


def _met(hashes: np.ndarray, value: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes that are in ``value``, with their range there."""
    maybe = np.flatnonzero(there[(hashes >> U64(44)).astype(np.int64)])
    lo, hi = (np.searchsorted(value, hashes[maybe], side=s) for s in ("left", "right"))
    return maybe[hi > lo], lo[hi > lo], hi[hi > lo]


class Benchmark:
    """The windows of a block of items, sorted by hash.

    An item has one view, its template, or two where its first word would be
    one name with the next (the slot then holds the rest of that name, as
    ``merged`` says); ``item_of`` gives a view's item.  ``by_size`` has
    the template windows of the views: hash, view, position, and whether the
    first word is read as a name.  ``exact`` has each different window of the
    items' untyped tokens: hash, item, at how many positions.
    """

    def __init__(self, ids: list, texts: pa.Array, window: int):
        offsets, data = column_buffers(texts)
        self.ids = ids
        found: dict[int, list] = {}
        exact: dict[int, list] = {}
        self.item_of: list[int] = []
        self.n_windows: list[int] = []
        self.slots: list[tuple[np.ndarray, np.ndarray]] = []
        self.first_word: list[int] = []
        self.merged: list[bool] = []
        self.exact_windows = np.zeros(len(ids), dtype=np.int64)
        self.short: dict[int, tuple[bytes, int, bool]] = {}
        for k in range(len(ids)):
            t = Templates(offsets[k:k + 2], data)
            if not len(t.words):
                continue
            named = Templates(offsets[k:k + 2], data, opens=False)
            merged = len(named.token) < len(t.token)
            if merged:
                named.value = np.concatenate((named.value[:1] - t.words[:1], named.value[1:]))
            for view in (t, named) if merged else (t,):
                size = min(window, len(view.token))
                if size < MIN_TOKENS:
                    continue
                v = len(self.item_of)
                self.item_of.append(k)
                self.slots.append((view.plain, view.value))
                self.first_word.append(int(t.words[0]))
                self.merged.append(view is named)
                start, _, value = view.windows(size)
                self.n_windows.append(len(start))
                found.setdefault(size, []).append(
                    (value, np.full(len(start), v, np.int32), start.astype(np.int32), np.zeros(len(start), dtype=bool)))
                if not merged and len(start) and start[0] == 0 and named.token[0] != t.token[0]:
                    start, _, value = named.windows(size)
                    if len(start) and start[0] == 0:
                        found[size].append((value[:1], np.full(1, v, np.int32), np.zeros(1, np.int32), np.ones(1, dtype=bool)))
            size = min(window, len(t.words))
            value, times = np.unique(t.word_windows(size)[2], return_counts=True)
            self.exact_windows[k] = times.sum()
            exact.setdefault(size, []).append((value, np.full(len(value), k, np.int32), times.astype(np.int32)))
            if size < MIN_TOKENS:
                text = t.raw.tobytes()
                lead = len(text) - len(text.lstrip())
                self.short[k] = (text.strip(), int(t.start[0]) - lead, bool((t.start[1:] == t.end[:-1]).all()))
        self.by_size = {size: _indexed(parts) for size, parts in found.items()}
        self.exact = {size: _indexed(parts) for size, parts in exact.items()}


def _templates_met(t: Templates, bench: Benchmark, min_share: float) -> dict[tuple[int, int], tuple[int, int, bool]]:
    """{(row, item): (windows met, windows, slots changed)} by the best view of the item."""
    found: dict[tuple[int, int], tuple[int, int, bool]] = {}
    for size, (value, view, pos, named, there) in bench.by_size.items():
        start, row, hashes = t.windows(size)
        hits: dict[tuple[int, int], list] = {}
        for m, a, b in zip(*_met(hashes, value, there), strict=True):
            for k in range(a, b):
                v = int(view[k])
                word = t.last if named[k] else t.lead if bench.merged[v] and pos[k] == 0 else None
                if word is None or int(word[start[m]]) == bench.first_word[v]:
                    hits.setdefault((int(row[m]), v), []).append((int(start[m]), int(pos[k])))
        for (r, v), places in hits.items():
            n = bench.n_windows[v]
            if len({p for _, p in places}) < min_share * n:
                continue
            values = t.value
            if bench.merged[v]:
                values = {at + j: int(values[at + j]) for at, _ in places for j in range(size)}
                for at in {at for at, p in places if p == 0}:
                    values[at] = (values[at] - bench.first_word[v]) % (1 << 64)
            good, other = _best(places, *bench.slots[v], values, size, min_share * n)
            best = found.get((r, bench.item_of[v]))
            if good and (best is None or (good * best[1], not other) > (best[0] * n, not best[2])):
                found[r, bench.item_of[v]] = good, n, other
    return found


def _words_met(t: Templates, bench: Benchmark, min_share: float) -> dict[tuple[int, int], tuple[int, int, bool]]:
    """The same by the untyped tokens; nothing is changed there."""
    found: dict[tuple[int, int], tuple[int, int, bool]] = {}
    for size, (value, item, times, there) in bench.exact.items():
        start, row, hashes = t.word_windows(size)
        m, lo, hi = _met(hashes, value, there)
        if size < MIN_TOKENS:
            for w, a, b in zip(m, lo, hi, strict=True):
                for k in item[a:b].tolist():
                    if t.holds(int(row[w]), int(start[w]), size, bench.short[k]):
                        found[int(row[w]), k] = 1, 1, False
            continue
        pairs = np.unique(np.stack((row[m], lo, hi)), axis=1)  # a window counts once in a row
        wide = pairs[2] - pairs[1]
        place = np.repeat(pairs[1] - np.cumsum(wide) + wide, wide) + np.arange(wide.sum())
        both, at = np.unique(np.repeat(pairs[0], wide) * len(bench.ids) + item[place], return_inverse=True)
        met = np.bincount(at, weights=times[place], minlength=len(both)).astype(np.int64)
        total = bench.exact_windows[both % max(1, len(bench.ids))]
        for x in np.flatnonzero(met >= min_share * total):
            found[int(both[x] // len(bench.ids)), int(both[x] % len(bench.ids))] = int(met[x]), int(total[x]), False
    return found


def _consistent(hits: list, plain: np.ndarray, values: np.ndarray, doc_values: np.ndarray | dict[int, int],
                size: int) -> tuple[int, bool]:
    """(item windows met with consistent slots, whether any slot got another value)."""
    votes: Counter = Counter()
    slots = {}
    for at, pos in hits:
        pairs = [(int(values[pos + j]), int(doc_values[at + j])) for j in range(size) if not plain[pos + j]]
        slots[at, pos] = pairs
        votes.update(set(pairs))
    chosen: dict[int, int] = {}
    for (mine, theirs), _ in sorted(votes.items(), key=lambda x: (-x[1], x[0])):
        chosen.setdefault(mine, theirs)
    good = {pos for (at, pos), pairs in slots.items() if all(chosen[a] == b for a, b in pairs)}
    return len(good), any(a != b for a, b in chosen.items())


def _occurrences(hits: list) -> Iterator[list]:
    """The hits of each alignment, of alignments in the item's order, and all of them."""
    runs: dict[int, list] = {}
    for at, pos in hits:
        runs.setdefault(at - pos, []).append((at, pos))
    yield hits
    if len(runs) == 1:
        return
    yield from runs.values()
    longest: dict[int, tuple[int, int, int]] = {}  # of a window met at several places of the item
    for shift, run in runs.items():
        for at, pos in run:
            longest[at] = max(longest.get(at, (0, 0, 0)), (len(run), -abs(shift), pos))
    chain: list[tuple[int, int]] = []
    for at in sorted(longest):
        pos = longest[at][2]
        if chain and pos <= chain[-1][1]:
            yield chain
            chain = []
        chain.append((at, pos))
    yield chain


def _best(hits: list, plain: np.ndarray, values: np.ndarray, doc_values: np.ndarray | dict[int, int], size: int,
          least: float) -> tuple[int, bool]:
    """``_consistent`` of the best occurrence with at least ``least`` windows; (0, False) without one."""
    found = (0, False)
    for part in _occurrences(hits):
        if len({pos for _, pos in part}) >= max(least, found[0]):
            good, other = _consistent(part, plain, values, doc_values, size)
            if good >= least and (good, not other) > (found[0], found[0] > 0 and not found[1]):
                found = good, other
    return found


def _match(shared, min_share: float):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench: Benchmark = shared.value
        for batch in batches:
            offsets, data = column_buffers(batch.column("text"))
            ids = batch.column("doc_id")
            rows, items, met, total, changed = [], [], [], [], []
            for i, j in row_groups(offsets, _GROUP_BYTES):
                t = Templates(offsets[i:j + 1], data)
                held = _words_met(t, bench, min_share) | _templates_met(t, bench, min_share)
                for (r, k), (good, n, other) in held.items():
                    rows.append(i + r)
                    items.append(bench.ids[k])
                    met.append(good)
                    total.append(n)
                    changed.append(other)
            if rows:
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.take(pa.array(rows)), "item_id": pa.array(items, pa.int64()),
                    "n_windows": pa.array(met, pa.int64()), "item_windows": pa.array(total, pa.int64()),
                    "reparameterised": pa.array(changed)})
    return match


def _blocks(benchmark: DataFrame, window: int, block_items: int, block_chars: int) -> Iterator[Benchmark]:
    """The benchmark in blocks of bounded size."""
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                                 F.col("text").cast("string").alias("text")).where("text is not null")
    n, chars = benchmark.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block_items), -(-chars // block_chars))
    for k in range(blocks):
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toArrow()
        yield Benchmark(part.column("item_id").to_pylist(), part.column("text").combine_chunks(), window)


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = 8, min_share: float = 0.5,
          block_items: int = 20_000, block_chars: int = 32 << 20) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, reparameterised) for each document that holds an item."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for block in _blocks(benchmark, window, block_items, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        rows = docs.where("text is not null").mapInArrow(
            _match(shared, min_share),
            "doc_id long, item_id long, n_windows long, item_windows long, reparameterised boolean")
        found = rows if found is None else found.union(rows)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 8, min_share: float = 0.5,
                  block_items: int = 20_000, block_chars: int = 32 << 20) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no benchmark item, judged row by row without a shuffle."""
    names = [f"c{k}" for k in range(len(docs.columns))]  # names of the input may clash with ours
    place = docs.columns.index("text")
    left = docs.toDF(*names)
    for block in _blocks(benchmark, window, block_items, block_chars):
        left = left.mapInArrow(_keep(docs.sparkSession.sparkContext.broadcast(block), place, min_share), left.schema)
    return left.toDF(*docs.columns)


def _keep(shared, place: int, min_share: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = _match(shared, min_share)
        for batch in batches:
            slim = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(place)],
                                              names=["doc_id", "text"])
            clean = np.ones(batch.num_rows, dtype=bool)
            for found in match(iter([slim])):
                clean[found.column("doc_id").to_numpy()] = False
            yield batch.filter(pa.array(clean))
    return keep
