"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

1. Every row gets a unique row number and one of P source parts (P grows with
   the rows, at most ``MAX_PARTS``); the numbered rows are written whole.
2. The matrix of counts part -> shard is drawn exactly: the counts of a part
   are multivariate hypergeometric given the seats still free in each shard,
   which is the law of a uniform shuffle.  It has at most MAX_PARTS rows (a
   proven bound) and is all that the driver sees or Spark broadcasts.
3. Each part is permuted locally (order of a hash of the row number); the
   first rows go to shard 0, the next to shard 1, as its matrix row says.
4. After the exchange each shard is permuted again.  A shard is one order of
   a second hash, cut into buckets of equal hash ranges, so that no task sorts
   a whole shard; slots are bucket offset plus place in the bucket.
5. Steps 2 to 4 need row numbers only.  Then the whole rows meet their shard and
   slot, and are exchanged to the buckets of their shards and sorted by slot.

Law ``rows``: shard sizes differ by one row at most.  The data path uses
DataFrame functions only.

Defined cases: a null text has size 1 and checksum 0; null and repeated ids
and repeated rows are rows like others, each with its own slot; an empty table
gives an empty result.  All columns are kept; ones named ``shard`` or ``slot``
are replaced.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from livemart.llm._shared import written

MAX_PARTS = 4096
ROWS_PER_PART = 2000


def communication_matrix(part_sizes: list[int], shard_sizes: list[int], seed: int) -> np.ndarray:
    """Counts (part, shard) with exactly these margins, hypergeometrically distributed."""
    rng = np.random.default_rng(seed)
    free = np.array(shard_sizes, dtype=np.int64)
    out = np.zeros((len(part_sizes), len(shard_sizes)), dtype=np.int64)
    for p, n in enumerate(part_sizes):
        left = n
        for s in range(len(free) - 1):  # one conditional draw per shard
            rest = int(free[s:].sum())
            out[p, s] = _hypergeometric(rng, int(free[s]), rest - int(free[s]), left)
            left -= int(out[p, s])
        out[p, -1] = left
        free -= out[p]
    return out


_LOG_FACTORIALS = [math.lgamma(k + 1) for k in range(1024)]


def _log_ratio(a: int, b: int) -> float:
    """log(a! / b!); for large numbers the difference of Stirling's series, which does not cancel."""
    if a < 1024 and b < 1024:
        return _LOG_FACTORIALS[a] - _LOG_FACTORIALS[b]
    if a < 1024 or b < 1024:
        return math.lgamma(a + 1) - math.lgamma(b + 1)
    d = a - b
    return (b + 0.5) * math.log1p(d / b) + d * math.log(a) - d + (1 / a - 1 / b) / 12 - (a ** -3 - b ** -3) / 360


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from ``good + bad`` are good: an exact draw at any size.

    Ratio of uniforms under a table-mountain hat around the mode, each trial
    accepted by the exact log probability relative to the mode's.
    """
    if draws == 0 or good == 0:
        return 0
    total = good + bad
    if bad == 0 or draws == total:
        return min(good, draws)
    few, taken = min(good, bad), min(draws, total - draws)  # the smaller of either way to count
    mean = taken * few / total
    spread = math.sqrt(mean * (total - few) / total * (total - taken) / (total - 1) + 0.5)
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    mode = (taken + 1) * (few + 1) // (total + 2)
    top = min(taken, few)
    while True:
        x = 1.0 - rng.random()
        z = math.floor(mean + 0.5 + width * (rng.random() - 0.5) / x)
        if not 0 <= z <= top:
            continue
        log_share = -(_log_ratio(z, mode) + _log_ratio(few - z, few - mode) + _log_ratio(taken - z, taken - mode)
                      + _log_ratio(total - few - taken + z, total - few - taken + mode))
        if 2 * math.log(x) <= log_share:
            break
    z = z if good <= bad else taken - z
    return z if taken == draws else good - z


def shuffle(docs: DataFrame, shards: int = 16, seed: int = 20) -> DataFrame:
    """Every row of ``docs`` (all columns) with its shard and slot, in the order of the slots in a bucket."""
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    names = [f"c{k}" for k in range(len(docs.columns))]  # names of the input may clash with ours
    whole = written(docs.toDF(*names).withColumn("row", F.monotonically_increasing_id()), "whole", "zstd")  # freezes the numbers
    slim = whole.select("row")
    n = slim.count()
    parts = max(1, min(MAX_PARTS, -(-n // ROWS_PER_PART)))
    slim = slim.withColumn("part", F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(parts)))
    sizes = dict(slim.groupBy("part").count().collect())  # at most MAX_PARTS rows
    seats = [n // shards + (s < n % shards) for s in range(shards)]
    matrix = communication_matrix([sizes.get(p, 0) for p in range(parts)], seats, seed)
    bounds = json.dumps([{"part": p, "upto": row.tolist()} for p, row in enumerate(np.cumsum(matrix, axis=1))])
    table = spark.range(1).select(F.explode(F.from_json(
        F.lit(bounds), "array<struct<part:bigint,upto:array<bigint>>>")).alias("m")).select("m.*")
    local = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed + 1), "row"), "row")
    buckets = max(1, -(-n // (shards * ROWS_PER_PART)))
    high = F.shiftrightunsigned(F.col("key"), 32)
    placed = (slim.withColumn("place", F.row_number().over(local).cast("long") - 1)
              .join(F.broadcast(table), "part")
              .withColumn("shard", F.size(F.filter("upto", lambda b: b <= F.col("place"))))
              .withColumn("key", F.xxhash64(F.lit(seed + 2), "row"))
              .withColumn("bucket", F.floor(high * F.lit(buckets) / F.lit(float(1 << 32))))
              .select("shard", "bucket", "key", "row"))
    placed = written(placed, "placed")
    before = (placed.groupBy("shard", "bucket").count()
              .withColumn("offset", F.sum("count").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("count")))
    inner = Window.partitionBy("shard", "bucket").orderBy("key", "row")
    seat = (placed.withColumn("place", F.row_number().over(inner))
            .join(before.drop("count"), ["shard", "bucket"])
            .select("row", "shard", "bucket", (F.col("offset") + F.col("place") - 1).alias("slot")))
    return (whole.join(seat, "row").repartition("shard", "bucket").sortWithinPartitions("shard", "slot")
            .select(*names, "shard", "slot").toDF(*docs.columns, "shard", "slot"))


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = 20) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row that ``shuffle`` returns."""
    text = F.col("text").cast("string")
    return shuffle(docs, shards, seed).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
