"""Hard negatives by a vertical scan (branch and bound on decomposed data).

Store.  Vectors (whole numbers, ``_vectors.scaled``) are written in blocks of
at most ``block_rows`` rows, decomposed into columns: one packed array per
dimension.  Within a block the rows are sorted by label into segments; each
segment has the least and largest value of every dimension.

Scan.  For an anchor the dimensions of a block are read in descending order
of the anchor's magnitude, ``step`` at a time, and added to the partial scores
of the candidates.  What the unread dimensions can still add lies between
sums of anchor value times segment minimum or maximum, so each candidate has
a lower and an upper bound.  A bitmap of candidates shrinks after each step:

* positives (same label, the ``k`` highest scores): out is whose upper bound is
  below the k-th largest lower bound;
* negatives (other labels, the highest scores inside a window per positive):
  out is who for no window can still lie inside it, or lies surely below
  ``k`` others that are surely inside.

When all dimensions are read the bounds are the exact scores and the windows
are resolved.  Blocks are independent tasks that send at most ``k`` rows an
anchor (and positive), which are merged by rank.  Anchors are broadcast in blocks
of at most ``anchor_block``; every block of anchors meets all rows.  Nothing is
approximate and no candidate is capped.

Defined cases: rows with a null id, a null label, or a vector that is null,
empty or holds a null or non-finite entry take no part, nor do vectors of
another length than the commonest, or holding an entry whose scores would not
fit a long (2**31 / sqrt(length) or more after scaling).  Rows are compared by
id: rows with the anchor's own id are neither positives nor negatives of it, a
repeated anchor id is one anchor (its least label and vector), repeated
other rows are rows of their own.  Equal scores go to the smaller id, then the
smaller label.  An anchor without another row of its label has no result; an
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from livemart.llm._shared import written
from livemart.llm._vectors import matrix, of_common_length, scaled
from livemart.session import scratch_path

BLOCK = ("ids binary, labels binary, starts array<int>, segment_labels array<long>, "
         "low array<long>, high array<long>, width int, dims array<binary>")
FOUND = "anchor_id long, place long, positive_id long, positive_score long, vec_id long, label long, score long"
EXACT = float(1 << 53)


def labelled(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x): the rows of ``vectors`` (vec_id, embedding, label) that take part, written."""
    x, good = scaled()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          x.alias("x"), good.alias("good"))
    rows = rows.where("good and vec_id is not null and label is not null")
    fits = F.forall("x", lambda c: F.abs(c).cast("double") < (1 << 31) / F.sqrt(F.size("x")))
    return of_common_length(written(rows.where(fits).drop("good"), "bond-rows"))


def _block(ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> list:
    order = np.lexsort((ids, labels))
    ids, labels, x = ids[order], labels[order], x[order]
    starts = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1]])
    low, high = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
    width = next(w for w in (1, 2, 4, 8) if max(-int(low.min()), int(high.max()) + 1) <= 1 << (8 * w - 1))
    packed = np.ascontiguousarray(x.T.astype(f"<i{width}"))
    return [ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), starts.tolist(), labels[starts].tolist(),
            low.ravel().tolist(), high.ravel().tolist(), width, [d.tobytes() for d in packed]]


def build(rows: DataFrame, block_rows: int = 4096) -> DataFrame:
    """The written block table over all ``rows`` (vec_id, label, x)."""
    schema = pa.schema([("ids", pa.binary()), ("labels", pa.binary()), ("starts", pa.list_(pa.int32())),
                        ("segment_labels", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())),
                        ("high", pa.list_(pa.int64())), ("width", pa.int32()), ("dims", pa.list_(pa.binary()))])

    def decompose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(size: int) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            at = 0
            while at < table.num_rows and (table.num_rows - at >= size):
                part = table.slice(at, block_rows).combine_chunks()
                row = _block(part.column("vec_id").to_numpy(), part.column("label").to_numpy(),
                             matrix(part.column("x").combine_chunks()))
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)],
                                                 schema=schema)
                at += block_rows
            if at < table.num_rows:
                held.extend(table.slice(at).to_batches())
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= block_rows:
                yield from flush(block_rows)
        if held:
            yield from flush(1)
    return written(rows.select("vec_id", "label", "x").mapInArrow(decompose, BLOCK), "bond-blocks")


class Block:
    """A block read back: columns by dimension, and the segments' ranges."""

    def __init__(self, row: dict):
        self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        self.starts = np.array([*row["starts"], len(self.ids)])
        self.segment_labels = np.array(row["segment_labels"], np.int64)
        self.low, self.high = (np.array(row[c], np.int64).reshape(len(self.segment_labels), -1) for c in ("low", "high"))
        self.dims = [np.frombuffer(d, f"<i{row['width']}") for d in row["dims"]]
        self.segment = np.repeat(np.arange(len(self.segment_labels)), np.diff(self.starts))
        self.top = np.maximum(np.abs(self.low), np.abs(self.high)).max(axis=0).astype(np.float64)

    def scan(self, anchor: np.ndarray, alive: np.ndarray, keep: Callable[[np.ndarray, np.ndarray], np.ndarray],
             step: int) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, exact scores) of the candidates that ``keep(lower, upper)`` leaves of ``alive``."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        # whole numbers below 2**53 are exact as doubles, which have the faster products
        kind = np.float64 if float(np.abs(anchor).astype(np.float64) @ self.top) < EXACT else np.int64
        a = anchor.astype(kind)
        ends = np.stack([a * self.low.astype(kind), a * self.high.astype(kind)])
        least, most = ends.min(axis=0)[:, order], ends.max(axis=0)[:, order]
        cuts = [*range(0, len(order), step), len(order)]
        rest = [(least[:, c:].sum(axis=1), most[:, c:].sum(axis=1)) for c in cuts]
        score = np.zeros(len(alive), kind)
        for k, (begin, end) in enumerate(zip([0, *cuts], cuts, strict=False)):
            for d in order[begin:end]:
                score += self.dims[d][alive] * a[d]
            where = self.segment[alive]
            stay = keep(score + rest[k][0][where], score + rest[k][1][where])
            if not stay.all():
                alive, score = alive[stay], score[stay]
            if not len(alive):
                break
        return alive, score.astype(np.int64)


def _kth(values: np.ndarray, k: int):
    """The k-th largest value, or None of fewer than ``k``."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def _best(block: Block, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    first = np.lexsort((block.labels[rows], block.ids[rows], -scores))[:k]
    return rows[first], scores[first]


def _positives(block: Block, anchor_id: int, label: int, anchor: np.ndarray, k: int, step: int):
    at = np.searchsorted(block.segment_labels, label)
    if at == len(block.segment_labels) or block.segment_labels[at] != label:
        return
    alive = np.arange(block.starts[at], block.starts[at + 1])
    alive = alive[block.ids[alive] != anchor_id]

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        edge = _kth(lower, k)
        return upper >= edge if edge is not None else np.ones(len(upper), bool)
    rows, scores = _best(block, *block.scan(anchor, alive, keep, step), k)
    for row, score in zip(rows, scores, strict=True):
        yield None, None, None, int(block.ids[row]), label, int(score)


def window(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest negative score s with low * positive <= 100 * s <= high * positive."""
    return -(-low * positive_score // 100), high * positive_score // 100


def _negatives(block: Block, anchor_id: int, label: int, anchor: np.ndarray, k: int, step: int,
               positives: list[tuple[int, int, int]], share: tuple[int, int]):
    windows = [(*p, *window(p[2], *share)) for p in positives]
    open_ = list({(low, high) for *_, low, high in windows if low <= high})
    alive = np.flatnonzero((block.labels != label) & (block.ids != anchor_id))
    if not open_ or not len(alive):
        return

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(lower), bool)
        for low, high in open_:
            edge = _kth(lower[(lower >= low) & (upper <= high)], k)
            stay |= (upper >= (low if edge is None else edge)) & (lower <= high)
        return stay
    rows, scores = block.scan(anchor, alive, keep, step)
    for *positive, low, high in windows:
        inside = (scores >= low) & (scores <= high)
        near, exact = _best(block, rows[inside], scores[inside], k)
        for row, score in zip(near, exact, strict=True):
            yield *positive, int(block.ids[row]), int(block.labels[row]), int(score)


def _scanning(shared, find):
    """A mapInArrow function: ``find(block, number of the anchor)`` for every block and anchor."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("anchor_id", "place", "positive_id", "positive_score", "vec_id", "label", "score")
        for batch in batches:
            for number in range(batch.num_rows):
                block = Block(batch.slice(number, 1).to_pylist()[0])
                out = [(int(anchor_id), *row) for i, anchor_id in enumerate(shared.value[0])
                       for row in find(block, i)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)
    return scan


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "label")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _parts(anchors: DataFrame, most: int) -> int:
    """Number of hash parts of which none holds over ``most`` anchors."""
    parts = max(1, -(-anchors.count() // most))
    while True:
        largest = anchors.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(parts)).alias("p")).count().agg(F.max("count")).first()
        if (largest[0] or 0) <= most:
            return parts
        parts *= 2


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, share: tuple[int, int] = (30, 90),
         block_rows: int = 4096, step: int = 16, anchor_block: int = 20_000) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` (vec_id, label, x) is ``labelled``'s table, ``anchors`` rows of it.
    ``share`` are the bounds of a negative's score in per cent of the positive's.
    """
    spark = rows.sparkSession
    blocks = build(rows, block_rows)
    one = F.min(F.struct("label", "x"))
    anchors = anchors.groupBy("vec_id").agg(one.alias("a")).select("vec_id", "a.label", "a.x")
    parts = _parts(anchors, anchor_block)
    path = scratch_path(spark, "llm", "bond-negatives")
    for number in range(parts):
        part = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == number).orderBy("vec_id").toArrow()
        ids, labels = (part.column(c).to_numpy() for c in ("vec_id", "label"))
        own = spark.sparkContext.broadcast((ids, labels, matrix(part.column("x").combine_chunks()) if len(ids) else ids))

        def same(block: Block, i: int, own=own):
            ids, labels, x = own.value
            return _positives(block, int(ids[i]), int(labels[i]), x[i], positives, step)
        near = _ranked(blocks.mapInArrow(_scanning(own, same), FOUND), ["anchor_id"], positives)
        chosen: dict[int, list[tuple[int, int, int]]] = {}  # at most ``positives`` an anchor of this part
        for anchor_id, *found in near.select("anchor_id", "rank", "vec_id", "score").toLocalIterator():
            chosen.setdefault(anchor_id, []).append(tuple(found))
        paired = spark.sparkContext.broadcast((*own.value, [chosen.get(int(i), []) for i in ids]))

        def other(block: Block, i: int, paired=paired):
            ids, labels, x, pairs = paired.value
            return _negatives(block, int(ids[i]), int(labels[i]), x[i], negatives, step, pairs[i], share)
        hard = _ranked(blocks.mapInArrow(_scanning(paired, other), FOUND),
                       ["anchor_id", "place", "positive_id", "positive_score"], negatives)
        hard.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                    F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")).write.mode("append").parquet(path)
    return spark.read.parquet(path)
