"""Work on large tables in passes, so that the disk it needs at once does not grow with them.

Spark keeps the shuffle files of a job until the driver happens to collect its
garbage, which can be long after the job.  Within ``shuffles_removed`` they go when it
ends; and a step that moves all rows of a large table does so a part at a
time (``in_passes``: by hash of a key; ``in_ranges``: by order), each part a job of its own.
Small tables are one part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# rows that a pass moves (about)
PASS_ROWS = 15_000_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# rows sampled a pass to place the bounds of ranges
BOUND_ROWS = 200


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that runs in here are removed when it ends."""
    previous = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, previous)


def passes_for(rows: int) -> int:
    return max(1, -(-rows // PASS_ROWS))


def in_passes(df: DataFrame, key: Sequence[str], n: int) -> list[DataFrame]:
    """``df`` in ``n`` parts by hash of ``key``; the filter runs below joins and aggregates by the key."""
    if n == 1:
        return [df]
    return [df.where(F.pmod(F.xxhash64(*key), F.lit(n)) == k) for k in range(n)]


def in_ranges(df: DataFrame, order: Sequence[str], rows: int) -> list[DataFrame]:
    """``df`` (of ``rows`` rows) in ranges of ``order``, the first range first.

    A sample places the bounds, as in ``repartitionByRange``; every row is in one range.
    """
    n = passes_for(rows)
    if n == 1:
        return [df]
    keys = df.select(*order)
    some = keys.sample(min(1.0, BOUND_ROWS * n / rows), 7).sort(*order).collect()
    cuts = [some[len(some) * k // n] for k in range(1, n)] if some else []
    at = F.struct(*order)
    bounds = [F.struct(*[F.lit(row[c]).cast(keys.schema[c].dataType).alias(c) for c in order]) for row in cuts]
    low = [F.lit(True), *[at >= b for b in bounds]]
    high = [*[at < b for b in bounds], F.lit(True)]
    return [df.where(a & b) for a, b in zip(low, high)]


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate rows, in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
