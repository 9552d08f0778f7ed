"""Approximate nearest neighbours with a permutation index.

Index.  ``pivots`` vectors are taken from the data (a bounded sample, in the
order of a hash of the id).  Every vector is represented by its ``prefix``
nearest pivots, nearest first; the index is a written table of ids, vectors
and these orders, one row per vector.

Search.  The table is read in chunks; a chunk's orders are posted in inverted
files, one per pivot, holding (vector, place).  A query adds up, over its own
nearest pivots, ``prefix - |its place - the posted place|``: the more, the
smaller the footrule distance of the two orders (an absent pivot counts as
standing at the end).  The best ``max(least, share * chunk)`` vectors of a
chunk are reranked by their exact Euclidean distance in double precision; a
chunk sends the ``k`` nearest of each query, and these are merged.  So the
inverted files are divided by vectors: no posting list is ever in one task.

Queries are broadcast in blocks of at most ``block`` (a proven bound); each
block meets all vectors.

Defined cases: vectors that are null, empty, zero, or hold a null or a
non-finite component take no part, nor do those of another length than the
commonest (the longer one of equally common lengths), nor null ids; equal
distances go to the smaller id; the candidates of a query are all rows with
another id; repeated rows are candidates each, a repeated query id is one
query (its least vector); fewer candidates than ``k`` give fewer rows; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from livemart.llm._shared import written

CHUNK = 20_000
RESULT = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec): the rows that take part, as doubles of one length."""
    vec = F.col("embedding").cast("array<double>")
    good = (F.col("vec_id").isNotNull() & (F.size(vec) > 0)
            & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
            & F.exists(vec, lambda x: x != 0))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"), good.alias("good")).where("good")
    common = (rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1))
    return rows.join(F.broadcast(common.select("n")), F.size("vec") == F.col("n")).select("vec_id", "vec")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The numbers of the ``prefix`` nearest pivots of each vector, nearest first."""
    return np.argsort(_distances(vectors, pivots), axis=1, kind="stable")[:, :prefix].astype(np.int16)


def build_index(vectors: DataFrame, pivots: int = 256, prefix: int = 96) -> tuple[DataFrame, np.ndarray]:
    """(written index table, pivots) over all usable rows of ``vectors`` (vec_id, embedding)."""
    rows = usable(vectors)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * pivots).select("vec").toArrow()  # bounded
    chosen = _matrix(sample.column("vec").combine_chunks()) if sample.num_rows else np.zeros((0, 1))
    _, first = np.unique(chosen, axis=0, return_index=True)
    chosen = chosen[np.sort(first)][:pivots]
    shared = vectors.sparkSession.sparkContext.broadcast(chosen)

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = orders(_matrix(batch.column("vec")), shared.value, prefix)
                lists = pa.array([x.tobytes() for x in found], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["vec_id", "vec", "pivot_order"])
    return written(rows.mapInArrow(order, "vec_id long, vec array<double>, pivot_order binary"), "permutations"), chosen


class InvertedFiles:
    """The posting lists of a chunk: per pivot, the vectors that have it and at which place."""

    def __init__(self, order: np.ndarray, n_pivots: int):
        n, self.prefix = order.shape
        flat = order.reshape(-1)
        by_pivot = np.argsort(flat, kind="stable")
        self.vector, self.place = by_pivot // self.prefix, by_pivot % self.prefix
        self.cut = np.searchsorted(flat[by_pivot], np.arange(n_pivots + 1))
        self.size = n

    def agreement(self, order: np.ndarray) -> np.ndarray:
        """For one query's order: ``prefix`` minus the place difference, summed over common pivots."""
        total = np.zeros(self.size, dtype=np.int32)
        for place, pivot in enumerate(order):
            a, b = self.cut[pivot], self.cut[pivot + 1]
            total[self.vector[a:b]] += (self.prefix - np.abs(self.place[a:b] - place)).astype(np.int32)
        return total


def _search(shared, k: int, least: int, share: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q_vecs, q_orders, n_pivots = shared.value

        def chunk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks().sort_by("vec_id")
            ids = table.column("vec_id").to_numpy()
            vecs = _matrix(table.column("vec").combine_chunks())
            order = np.frombuffer(b"".join(table.column("pivot_order").to_pylist()), np.int16).reshape(len(ids), -1)
            files = InvertedFiles(order, n_pivots)
            want = max(least, int(np.ceil(share * len(ids))))
            out: list[tuple] = []
            for q, vec, own in zip(q_ids, q_vecs, q_orders, strict=True):
                best = np.argsort(-files.agreement(own), kind="stable")[:want + 1]
                best = best[ids[best] != q]
                exact = np.sqrt(((vecs[best] - vec) ** 2).sum(axis=1))
                near = best[np.lexsort((ids[best], exact))[:k]]
                out.append((np.full(len(near), q), ids[near], np.sqrt(((vecs[near] - vec) ** 2).sum(axis=1))))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                              names=["query_id", "vec_id", "score"])
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK:
                yield chunk(held)
                held = []
        if sum(b.num_rows for b in held) and len(q_ids):
            yield chunk(held)
    return search


def search(index: DataFrame, pivots: np.ndarray, queries: DataFrame, k: int = 10, least: int = 400,
           share: float = 0.15, block: int = 20_000) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each row of ``queries`` (vec_id, vec)."""
    spark = index.sparkSession
    queries = queries.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    blocks = max(1, -(-queries.count() // (block // 2)))  # hashed blocks stay below ``block``
    found = None
    for number in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).orderBy("vec_id").toArrow()
        vecs = _matrix(part.column("vec").combine_chunks()) if part.num_rows else np.zeros((0, pivots.shape[1]))
        prefix = min(len(pivots), len(index.limit(1).toArrow().column("pivot_order")[0].as_py()) // 2) if len(pivots) else 0
        shared = spark.sparkContext.broadcast((part.column("vec_id").to_numpy(), vecs,
                                               orders(vecs, pivots, prefix) if len(vecs) else vecs, len(pivots)))
        rows = index.mapInArrow(_search(shared, k, least, share), RESULT)
        found = rows if found is None else found.union(rows)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
