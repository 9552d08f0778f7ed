"""Near-duplicate join on word n-gram Jaccard similarity: a MinHash LSH forest with exact verification.

Steps, all slim but the last:

1. Each whole text gets a MinHash signature of ``trees * max_depth`` values
   over its distinct shingles (``n`` consecutive words, words unchanged).
   Equal texts are one class; only one row per class goes on, with the number
   of its copies, so copies are never expanded into pairs.
2. Forest: tree t labels a class with its t-th run of signature values; two
   classes meet where their labels share a prefix.  The prefix starts at
   ``max_depth`` and is shortened until a pair at the threshold is found with
   probability ``target_recall`` over all trees.  The sorted tries are rows
   sorted by prefix; prefixes with one class are dropped.
3. Inside a prefix, classes are tied to leaders by the estimated similarity
   (a few edges per class, not all pairs): a class is tied to every leader
   that it could share a link's neighbourhood with, so both ends of a link
   end in one component.  Prefixes beyond ``BLOCK`` classes are split into
   blocks; their leaders are tied in a second step by pairs of blocks.
4. The texts of each component are compared exactly: all pairs of a block, or
   of two blocks of a large component, by products of shingle incidence
   matrices.  A task gives one row per class (its links, its local group),
   never the pairs.

Result, one row per input row: doc_id, class_id (smallest doc_id with the
same text), n_copies (rows with that text), n_links (other texts with a
similarity of at least ``threshold``), group_id (smallest doc_id reachable
over copies and links), keep (true for one row of each group).

Defined cases: a text of one to ``n - 1`` words has one shingle, all its
words; null texts and texts without words have no shingle, are linked to
nothing, equal nothing and are kept, with class_id and group_id their own
doc_id, n_copies 1; null doc_ids count as larger than any other; repeated
rows are copies, and one of them is kept.  An empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from livemart.llm._shared import components, written
from livemart.llm._words import (U64, column_buffers, constants, mix64, row_groups, window_hashes, windows_inside,
                                 word_hashes, word_spans)

BLOCK = 4096            # classes of one prefix compared in one task
VERIFY_BLOCK = 1024     # texts of one component in one block
VERIFY_CHARS = 16 << 20
_GROUP_BYTES = 4 << 20
_SAME, _NEAR, _FAR = 0.8, 0.35, 0.25  # estimates: a leader's own, tied to a leader, leaders tied
_NULL_ID = (1 << 63) - 1


def shingles(offsets: np.ndarray, data: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every shingle of a group of rows, in row order, repeats included."""
    start, end, first = word_spans(offsets, data)
    words = word_hashes(data, start, end)
    inside, row = windows_inside(first, len(words), n)
    counts = np.diff(first)
    full = window_hashes(words, n, seed=11)[inside]
    full_row = row[:len(inside)][inside]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if not len(short):
        return full_row, full
    # few-word texts: one shingle over all their words, told apart by the length
    value = np.zeros(len(short), dtype=U64)
    for j, c in enumerate(constants(n, 12)):
        has = counts[short] > j
        value[has] += words[first[short[has]] + j] * c
    rows = np.concatenate((full_row, short))
    order = np.argsort(rows, kind="stable")
    return rows[order], np.concatenate((full, mix64(value + counts[short].astype(U64))))[order]


def _signatures(n: int, size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = constants(size, 21)
        for batch in batches:
            offsets, data = column_buffers(batch.column("text"))
            out = np.zeros((batch.num_rows, size), dtype=np.uint32)
            has = np.zeros(batch.num_rows, dtype=bool)
            for i, j in row_groups(offsets, _GROUP_BYTES):
                row, value = shingles(offsets[i:j + 1], data, n)
                if not len(row):
                    continue
                head = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
                target = i + row[head]
                has[target] = True
                for k in range(size):
                    out[target, k] = np.minimum.reduceat(value * multipliers[k], head) >> U64(32)
            rows = np.flatnonzero(has)
            if len(rows):
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column("id").take(rows), "cls": batch.column("cls").take(rows),
                    "chars": pa.array(np.diff(offsets)[rows]),
                    "sig": pa.array([s.tobytes() for s in out[rows]], pa.binary())})
    return sign


def forest_depth(threshold: float, trees: int, max_depth: int, target_recall: float) -> int:
    """The longest prefix that finds a pair at the threshold with ``target_recall``."""
    for depth in range(max_depth, 0, -1):
        if 1 - (1 - threshold ** depth) ** trees >= target_recall:
            return depth
    raise ValueError("no prefix reaches the target recall; use more trees")


def _prefixes(trees: int, max_depth: int, depth: int):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coefficients = constants(depth, 31)
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, trees, max_depth)
            value = np.zeros(sig.shape[:2], dtype=U64)
            for d in range(depth):
                value += mix64(sig[:, :, d].astype(U64) + U64(1)) * coefficients[d]
            value = mix64(value + constants(trees, 32)[None, :])
            yield pa.RecordBatch.from_pydict({
                "prefix": pa.array(value.reshape(-1).view(np.int64)),
                "cls": batch.column("cls").take(np.repeat(np.arange(len(sig)), trees))})
    return label


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of equal values in the first ``keys`` (long) columns of sorted batches, as tables."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for v in values:
            change |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1), batch.num_rows]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(v[i] for v in values)
            if held and key != last:
                yield held
                held = []
            held.append(batch.slice(i, j - i))
            last = key
    if held:
        yield held


def _signature_rows(run: list[pa.RecordBatch]) -> np.ndarray:
    # the low byte of each signature value: estimates need no more
    raw = b"".join(x for b in run for x in b.column("sig8").to_pylist())
    return np.frombuffer(raw, np.uint8).reshape(sum(b.num_rows for b in run), -1)


def _column(run: list[pa.RecordBatch], name: str) -> list:
    return [x for b in run for x in b.column(name).to_pylist()]


class _Forest:
    """Union-find over the classes of one task: says which ties join something new."""

    def __init__(self):
        self.parent: dict[bytes, bytes] = {}

    def root(self, x: bytes) -> bytes:
        parent = self.parent
        path = []
        while (up := parent.get(x, x)) != x:
            path.append(x)
            x = up
        for y in path:
            parent[y] = x
        return x

    def joins(self, a: bytes, b: bytes) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _tie_to_leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (prefix, block, n, cls, sig8) sorted by prefix and block: a spanning forest of the
    ties of this task (at most one edge per class), and the leaders of split prefixes."""
    a, b, prefix, lead = [], [], [], []
    forest = _Forest()

    def out():
        batch = pa.RecordBatch.from_pydict({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()),
                                            "prefix": pa.array(prefix, pa.int64()),
                                            "sig8": pa.array(lead, pa.binary())})
        for x in (a, b, prefix, lead):
            x.clear()
        return batch
    for run in _runs(batches, 2):
        sig, cls = _signature_rows(run), _column(run, "cls")
        key, split = run[0].column("prefix")[0].as_py(), run[0].column("n")[0].as_py() > BLOCK
        if len(cls) == 1 and not split:
            continue
        free = np.ones(len(cls), dtype=bool)
        while free.any():
            leader = int(free.argmax())
            same = (sig == sig[leader]).mean(axis=1)
            free &= same < _SAME
            free[leader] = False
            rows = [(cls[x], None) for x in np.flatnonzero(same >= _NEAR) if forest.joins(cls[leader], cls[x])]
            if split:
                rows.append((cls[leader], sig[leader].tobytes()))
            for other, mark in rows:
                a.append(cls[leader])
                b.append(other)
                prefix.append(key)
                lead.append(mark)
        if len(a) > 50_000:
            yield out()
        if len(forest.parent) > 1_000_000:  # bounded memory; starting afresh only repeats edges
            forest = _Forest()
    if a:
        yield out()


def _tie_leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (prefix, i, j, block, cls, sig8): ties between the leaders of one or two blocks."""
    for run in _runs(batches, 3):
        sig, cls = _signature_rows(run), _column(run, "cls")
        forest = _Forest()
        for x in range(len(cls)):
            near = np.flatnonzero((sig[x + 1:] == sig[x]).mean(axis=1) >= _FAR) + x + 1
            near = [y for y in near if forest.joins(cls[x], cls[y])]
            if near:
                yield pa.RecordBatch.from_pydict({"a": pa.array([cls[x]] * len(near), pa.binary()),
                                                  "b": pa.array([cls[y] for y in near], pa.binary())})


def _compare(n: int, threshold: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (part, i, j, block, cls, text): exact links inside a block or between two."""
        for run in _runs(batches, 3):
            table = pa.Table.from_batches(run)
            cls, block = table.column("cls").to_pylist(), table.column("block").to_numpy()
            cross = run[0].column("i")[0].as_py() != run[0].column("j")[0].as_py()
            adjacent = _links(table.column("text"), n, threshold)
            if cross:
                adjacent &= block[:, None] != block[None, :]
            links = adjacent.sum(axis=1)
            # local groups: the smallest reachable index
            group = np.arange(len(cls))
            while True:
                low = np.array([min(group[x], group[adjacent[x]].min(initial=len(cls))) for x in range(len(cls))])
                low = np.minimum(low, low[low])
                if (low == group).all():
                    break
                group = low
            yield pa.RecordBatch.from_pydict({"cls": pa.array(cls, pa.binary()), "links": pa.array(links, pa.int64()),
                                              "local": pa.array([cls[g] for g in group], pa.binary())})
    return compare


def _links(texts: pa.ChunkedArray, n: int, threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs of texts whose shingle sets reach the threshold."""
    offsets, data = column_buffers(texts)
    rows, values = [], []
    for i, j in row_groups(offsets, _GROUP_BYTES):
        row, value = shingles(offsets[i:j + 1], data, n)
        rows.append(row + i)
        values.append(value)
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((row, value))
    row, value = row[order], value[order]
    fresh = np.concatenate(([True], (value[1:] != value[:-1]) | (row[1:] != row[:-1])))
    row, value = row[fresh], value[fresh]
    size = np.bincount(row, minlength=len(offsets) - 1)
    head = np.concatenate(([True], value[1:] != value[:-1]))
    term = np.cumsum(head) - 1
    spread = np.bincount(term) > 1  # shingles of one text only cannot meet
    keep = spread[term]
    row, term = row[keep], (np.cumsum(spread) - 1)[term[keep]]
    common = np.zeros((len(size), len(size)), dtype=np.float32)
    shared = int(spread.sum())
    step = min(max(1024, (8 << 20) // max(1, len(size))), max(1, shared))
    for t in range(0, shared, step):
        lo, hi = np.searchsorted(term, (t, t + step))
        present = np.zeros((len(size), step), dtype=np.float32)
        present[row[lo:hi], term[lo:hi] - t] = 1
        common += present @ present.T
    union = size[:, None] + size[None, :] - common
    linked = (common > 0) & (common >= threshold * union - 1e-6 * union)
    np.fill_diagonal(linked, False)
    return linked


def _block_pairs(df: DataFrame, blocks: str) -> DataFrame:
    """Each row once for every pair of blocks (i <= j) that holds its block."""
    return (df.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
            .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other"))


def ngram_jaccard_join(docs: DataFrame, n: int = 5, threshold: float = 0.8, trees: int = 20, max_depth: int = 4,
                       target_recall: float = 0.9999) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with its class, links and group; see the module."""
    depth = forest_depth(threshold, trees, max_depth, target_recall)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"),
                       F.unhex(F.md5(F.col("text").cast("binary"))).alias("cls"), F.col("text").cast("string").alias("text"))
    signed = written(docs.where("text is not null").mapInArrow(
        _signatures(n, trees * max_depth), "id long, cls binary, chars long, sig binary"), "signatures")
    classes = written(signed.groupBy("cls").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("chars").alias("chars"),
        F.first("sig").alias("sig")), "classes")

    met = (classes.mapInArrow(_prefixes(trees, max_depth, depth), "prefix long, cls binary")
           .withColumn("n", F.count("*").over(Window.partitionBy("prefix"))).where("n > 1"))
    low_bytes = classes.mapInArrow(_low_bytes, "cls binary, sig8 binary")
    blocked = (met.withColumn("block", F.pmod(F.xxhash64("cls"), F.ceil(F.col("n") / BLOCK)))
               .join(low_bytes, "cls").select("prefix", "block", "n", "cls", "sig8"))
    tied = written(blocked.repartition("prefix", "block").sortWithinPartitions("prefix", "block", "cls")
                   .mapInArrow(_tie_to_leaders, "a binary, b binary, prefix long, sig8 binary"), "ties")
    leaders = (tied.where("sig8 is not null").select("prefix", F.col("a").alias("cls"), "sig8")
               .withColumn("blocks", F.ceil(F.count("*").over(Window.partitionBy("prefix")) / BLOCK))
               .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks"))))
    between = (_block_pairs(leaders, "blocks").select("prefix", "i", "j", "block", "cls", "sig8")
               .repartition("prefix", "i", "j").sortWithinPartitions("prefix", "i", "j", "cls")
               .mapInArrow(_tie_leaders, "a binary, b binary"))
    parts = components(tied.where("a != b").select("a", "b").union(between))

    members = (parts.select(F.col("hi").alias("cls"), F.col("lo").alias("part"))
               .union(parts.select("lo", F.col("lo").alias("part")).distinct()).join(classes.select("cls", "rep", "chars"), "cls"))
    sizes = members.groupBy("part").agg(F.ceil(F.greatest(
        F.count("*") / VERIFY_BLOCK, F.sum("chars") / VERIFY_CHARS)).alias("blocks"))
    members = (members.join(sizes, "part").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")))
               .select("part", "blocks", "block", "cls", F.col("rep").alias("id")))
    texts = members.join(docs.where("text is not null"), ["id", "cls"]).dropDuplicates(["id", "cls"])
    compared = written(_block_pairs(texts.withColumn("part", F.xxhash64("part")), "blocks")
                       .select("part", "i", "j", "block", "cls", "text")
                       .repartition("part", "i", "j").sortWithinPartitions("part", "i", "j", "cls")
                       .mapInArrow(_compare(n, threshold), "cls binary, links long, local binary"), "compared")
    groups = components(compared, "cls", "local")
    links = compared.groupBy("cls").agg(F.sum("links").alias("n_links"))
    grouped = (classes.select("cls", "rep", "copies").join(links, "cls", "left")
               .join(groups.select(F.col("hi").alias("cls"), F.col("lo").alias("root")), "cls", "left")
               .withColumn("root", F.coalesce("root", "cls")))
    first = grouped.groupBy("root").agg(F.min(F.struct("rep", "cls")).alias("first"))
    grouped = grouped.join(first, "root").select(
        "cls", F.col("rep").alias("class_id"), F.col("copies").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("first.rep").alias("group_id"),
        (F.col("first.cls") == F.col("cls")).alias("head"))
    rank = F.row_number().over(Window.partitionBy("id", "cls").orderBy("head"))
    return (docs.select("id", "cls").join(grouped, "cls", "left").withColumn("repeat", rank)
            .select(F.nullif("id", F.lit(_NULL_ID)).alias("doc_id"), _id("class_id"),
                    F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), _id("group_id"),
                    (F.col("head").isNull() | (F.col("head") & (F.col("id") == F.col("class_id"))
                                               & (F.col("repeat") == 1))).alias("keep"),
                    "cls"))


def _id(name: str) -> Column:
    return F.nullif(F.coalesce(name, "id"), F.lit(_NULL_ID)).alias(name)


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that the join keeps: one of each group of copies and links."""
    plain = [f"c{k}" for k in range(len(docs.columns))]  # names of the input may clash with ours
    doc_id, text = (plain[docs.columns.index(c)] for c in ("doc_id", "text"))
    kept = (ngram_jaccard_join(docs.select("doc_id", "text"), **options).where("keep and cls is not null")
            .select(F.col("doc_id").alias("kept_id"), F.col("cls").alias("kept_cls")).distinct())
    rows = docs.toDF(*plain)
    marked = rows.withColumns({"own_cls": F.unhex(F.md5(F.col(text).cast("binary"))), "own_id": F.col(doc_id).cast("long")})
    same = marked["own_id"].eqNullSafe(kept["kept_id"]) & (marked["own_cls"] == kept["kept_cls"])
    # rows without shingles stay as they are; of repeated rows one stays
    bare = F.col(text).isNull() | F.col(text).rlike(r"^[ \t-\r]*$")
    found = marked.where(~bare).join(kept, same, "left_semi").dropDuplicates(["own_id", "own_cls"])
    return rows.where(bare).union(found.select(*plain)).toDF(*docs.columns)


def _low_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sig = [np.frombuffer(x, np.uint32).astype(np.uint8).tobytes() for x in batch.column("sig").to_pylist()]
        yield pa.RecordBatch.from_pydict({"cls": batch.column("cls"), "sig8": pa.array(sig, pa.binary())})
