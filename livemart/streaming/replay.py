"""Replay a table as a stream: write it as several files in time order.

The input tables are one Parquet file each, which a file source would read
as a single micro-batch.  ``to_chunks`` writes a DataFrame as ``chunks``
files, one Spark write per time slice, so the file source (which orders
files by modification time) delivers them as successive micro-batches.
The slices come from the data's own time span (one aggregate row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemart.passes import drop_folder, in_passes, shuffles_removed

# rows a replayed file holds at most (about; slices are round-robin split)
ROWS_PER_FILE = 1_000_000


def to_chunks(df: DataFrame, path: str, time_ms_col: str, chunks: int = 4,
              files_per_chunk: int = 4, fmt: str = "parquet", heartbeat_ms: int | None = None,
            pass_by: str | None = None, passes: int = 1) -> int:
    """Write ``df`` to ``path`` in ``chunks`` time slices of ``time_ms_col`` (epoch ms).

    Each slice is one distributed write of ``files_per_chunk`` files (a
    round-robin repartition, so no single task carries a slice); the slices
    are written in time order, so file modification times order them and a
    reader taking ``files_per_chunk`` files per trigger sees one slice per
    micro-batch.  ``fmt="text"`` writes the single string column other than
    the time column as text lines.  A slice has ``files_per_chunk`` files, or
    more where it would hold more than about ``ROWS_PER_FILE`` rows a file, so the
    tasks grow with the input; returns the number of files of a slice.  An
    empty input is one empty file.  ``heartbeat_ms``: a last row of nulls, but for
    the time columns, which stand so much behind the last row's: it moves the
    watermark past all rows, as the heartbeats of a quiet live stream do.
    ``df`` is computed once, in ``passes`` by the column ``pass_by``, and staged in a folder beside
    ``path`` that goes when the slices are written.
    """
    spark, stage = df.sparkSession, f"{path.rstrip('/')}_staged"
    with shuffles_removed(spark):
        for k, part in enumerate(in_passes(df, [pass_by], passes) if pass_by else [df]):
            part.write.mode("append" if k else "overwrite").option("compression", "zstd").parquet(stage)
        df = spark.read.schema(df.schema).parquet(stage)
        span = df.agg(F.min(time_ms_col).alias("lo"), F.max(time_ms_col).alias("hi"),
                      F.count(F.lit(1)).alias("n")).first()
        lo, hi = int(span["lo"] or 0), int(span["hi"] or 0)
        files_per_chunk = max(files_per_chunk, -(-span["n"] // (chunks * ROWS_PER_FILE)))
        width = max((hi - lo + 1) / chunks, 1.0)
        slot = F.least(F.floor((F.col(time_ms_col) - F.lit(lo)) / F.lit(width)), F.lit(chunks - 1))
        tagged = df.withColumn("_slot", slot)
        for i in range(chunks):
            part = tagged.where(F.col("_slot") == i).drop("_slot").repartition(files_per_chunk)
            if fmt == "text":
                part.drop(time_ms_col).write.mode("append").text(path)
            else:
                part.write.mode("append").option("compression", "zstd").parquet(path)
        if heartbeat_ms is not None:
            late = F.lit(hi + heartbeat_ms).cast("long")
            (spark.range(1).select(*[(late if f.name in (time_ms_col, "ts_ms") else F.lit(None)).cast(f.dataType).alias(f.name)
                                    for f in df.schema]).write.mode("append").parquet(path))
    drop_folder(spark, stage)
    return files_per_chunk


def replay_stream(df: DataFrame, path: str, time_ms_col: str, chunks: int = 4,
                  files_per_chunk: int = 4, fmt: str = "parquet", heartbeat_ms: int | None = None,
                  with_position: bool = False, pass_by: str | None = None, passes: int = 1,
                  spend: bool = False) -> DataFrame:
    """Write ``df`` as time slices (``to_chunks``) and return the folder as a
    stream that takes one slice per micro-batch.

    The files of a slice each span the slice's whole time range, so they
    must be read together: read one at a time, the watermark would pass
    rows still to come in the same slice and drop them as late.
    ``with_position`` adds where each row stands, ``spend`` deletes files that the stream is done
    with (``sources.read_folder``).
    """
    from livemart.streaming.sources import read_folder, read_log_text
    files_per_chunk = to_chunks(df, path, time_ms_col, chunks, files_per_chunk, fmt, heartbeat_ms, pass_by, passes)
    if fmt == "text":
        return read_log_text(df.sparkSession, path, max_files_per_trigger=files_per_chunk)
    return read_folder(df.sparkSession, path, df.schema, max_files_per_trigger=files_per_chunk,
                       with_position=with_position, spend=spend)
