"""Written intermediate tables and connected components for the operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import livemart
from livemart.session import scratch_path


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _are_stars(edges: DataFrame) -> bool:
    """True when every ``hi`` has one ``lo`` and no ``lo`` is a ``hi`` itself."""
    ends = edges.select(F.col("hi").alias("v"), F.lit(1).alias("h")).union(edges.select("lo", F.lit(0)))
    seen = ends.groupBy("v").agg(F.sum("h").alias("above"), F.min("h").alias("low"))
    return seen.where("above > 1 or (above = 1 and low = 0)").isEmpty()


def components(edges: DataFrame, a: str | Column = "a", b: str | Column = "b") -> DataFrame:
    """(hi, lo) stars: ``lo`` is the smallest vertex of the component of ``hi``.

    Alternating large-star and small-star rounds on a distributed edge table;
    smallest vertices have no row of their own.  Each round is written, so a
    lost executor costs one round.
    """
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    now = written(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
                  .where("hi > lo").distinct(), "edges")
    while not _are_stars(now):
        both = now.select("hi", "lo").union(now.select(F.col("lo"), F.col("hi"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        small = large.groupBy("hi").agg(F.min("lo").alias("m"))
        following = (large.join(small, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                     .union(small.select("hi", "m")).where("hi > lo").distinct())
        now = written(following, "edges")
    return now


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_livemart_shipped", False):
        return
    package = Path(livemart.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="livemart-code-")) / "livemart_code.zip"  # read by the driver only
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    context._livemart_shipped = True
