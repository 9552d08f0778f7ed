"""Vectors as whole numbers, for the operators that compute on them exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256


def scaled(embedding: str = "embedding") -> tuple[Column, Column]:
    """(x, good): the entries as floor(256 * entry), and whether the vector takes part.

    A vector that is null, empty, or holds a null, a non-finite entry or one
    too large for a long takes no part.
    """
    vec = F.col(embedding).cast("array<double>")
    good = F.coalesce((F.size(vec) > 0) & F.forall(vec, lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c) < float(1 << 54)), F.lit(False))), F.lit(False))
    return F.when(good, F.transform(vec, lambda c: F.floor(c * SCALE).cast("long"))), good


def of_common_length(rows: DataFrame) -> DataFrame:
    """The rows whose ``x`` has the commonest length (of equally common ones the longest)."""
    common = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("x") == common["n"]) if common else rows


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of longs, all of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), -1)
