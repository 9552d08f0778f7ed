"""Parquet table scans (SRC5-SRC7 and the driver's input tables).

Scans name their columns so Catalyst prunes the Parquet read schema; filters
applied downstream are pushed into the scan by the optimizer.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# The table names of the input folder.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Iterable[str] | None = None) -> DataFrame:
    """Read one input table, projecting ``columns`` at the scan."""
    df = spark.read.parquet(table_path(sf_dir, name))
    cols = list(columns or [])
    return df.select(*cols) if cols else df


def read_keyed_view(spark: SparkSession, path: str, key: Iterable[str], order: Iterable[str] = (),
                    keep: str | None = None, partition_by: Iterable[str] = ()) -> DataFrame:
    """SRC5-SRC7: the latest view of a keyed table written by a streaming sink.

    The layout and merge rule are those of ``streaming.upsert.KeyedTable``;
    filters on key columns (e.g. ``logdate = d``) run below the merge and
    prune day folders when the table is laid out by day.
    """
    from livemart.streaming.upsert import KeyedTable
    return KeyedTable(path, list(key), list(order), keep, list(partition_by)).view(spark)
