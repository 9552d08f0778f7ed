"""Per-key row selection: first row per key (A1) and latest value per key.

Both are ``groupBy(key).agg(min_by/max_by(struct(row), struct(order)))``:
aggregates with a partial (map-side) phase, so a hot key costs one row per
map task in the shuffle instead of all of its rows.  A struct payload is not
a fixed-width buffer, so Spark plans them as sort-based aggregates: each map
task sorts its rows by key (spilling as needed) and emits one row per key.
Ties in the order columns must be broken by the caller (include a unique
column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
          columns: Sequence[str] | None, fn) -> DataFrame:
    cols = list(columns or df.columns)
    payload = F.struct(*[F.col(c) for c in cols if c not in keys])
    order = F.struct(*[F.col(c) for c in order_by])
    # key columns come straight from the grouping keys, so filters and semi
    # joins on them can be pushed below the aggregate by the optimizer
    return (df.groupBy(*keys)
              .agg(fn(payload, order).alias("_row"))
              .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in cols]))


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                  columns: Sequence[str] | None = None) -> DataFrame:
    """A1: the earliest row per key (by ``order_by``), one output row per key."""
    return _pick(df, keys, order_by, columns, F.min_by)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                   columns: Sequence[str] | None = None) -> DataFrame:
    """The latest row per key (last write wins by ``order_by``)."""
    return _pick(df, keys, order_by, columns, F.max_by)


def once_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], latest: bool = False) -> DataFrame:
    """One row per key (null is a key too), the first or the latest, where few keys repeat.

    Keys are counted (a hash aggregate of the keys alone); only the rows of
    repeated ones go through the per-key selection, so rows of unique keys
    are neither sorted nor moved.  Runs one job, to see whether any key repeats.
    """
    again = df.groupBy(*[F.col(k).alias(f"_again_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    if again.isEmpty():
        return df
    same = [F.col(k).eqNullSafe(F.col(f"_again_{k}")) for k in keys]
    twice = df.join(again, same, "left_semi")
    pick = latest_per_key if latest else first_per_key
    return df.join(again, same, "left_anti").unionByName(pick(twice, keys, order_by, df.columns))
