"""Stream sources: Kafka topics (SRC1, SRC4) and file folders.

The Kafka connector jar is not part of this environment; ``read_topic``
builds the documented source options and is exercised only where the
connector is on the classpath.  Tests and replays use the file source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livemart.functions.json import parse
from livemart.schemas import STREAMS


# where a row stands in its source: file and row number (a topic has partition and offset)
POSITION = ("source_file", "source_row")


def kafka_options(bootstrap: str, topic: str, starting: str = "latest",
                  max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> dict:
    """SRC1 options: one topic, string key/value, start at ``starting``.

    Offsets live in the query checkpoint (no consumer auto-commit), which
    together with an idempotent sink gives effectively-once output.  Lost
    offsets stop the query unless ``fail_on_data_loss`` is switched off.
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def read_topic(spark: SparkSession, bootstrap: str, topic: str, **kw) -> DataFrame:
    """SRC1: (key, value, topic, partition, offset, timestamp) as strings/longs."""
    df = spark.readStream.format("kafka").options(**kafka_options(bootstrap, topic, **kw)).load()
    return df.select(F.col("key").cast("string"), F.col("value").cast("string"),
                     "topic", "partition", "offset", "timestamp")


def write_topic_options(bootstrap: str) -> dict:
    """SNK8/SNK9 Kafka sink options; the row's ``topic`` column picks the topic."""
    return {"kafka.bootstrap.servers": bootstrap}


def read_folder(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int = 1, with_position: bool = False, spend: bool = False) -> DataFrame:
    """A folder as a stream, one file per micro-batch by default (oldest first).

    ``with_position`` adds ``POSITION``: the file and the row's number in it, what
    partition and offset are on a topic.  It is the same whenever the row is read.
    ``spend`` deletes the files of a batch when it is committed: only for a folder that no one else reads.
    """
    df = (spark.readStream.format(fmt).schema(schema)
               .option("maxFilesPerTrigger", max_files_per_trigger)
               .option("cleanSource", "delete" if spend else "off")
               .load(path))
    if not with_position:
        return df
    return df.select("*", F.col("_metadata.file_name").alias(POSITION[0]), F.col("_metadata.row_index").alias(POSITION[1]))


def open_stream(spark: SparkSession, name: str, bootstrap: str | None = None, folder: str | None = None,
                fmt: str = "parquet", max_files_per_trigger: int = 1, **kw) -> DataFrame:
    """SRC2: a stream of the catalogue (``schemas.STREAMS``) by name, as its typed records.

    From its topic at ``bootstrap``, or from a ``folder`` whose files hold the
    records as JSON in a column ``value`` (the archive of a log router).  The
    position of each record (partition and offset, or file and row) comes along.
    """
    spec = STREAMS[name]
    if folder is None:
        raw, place = read_topic(spark, bootstrap, spec.topic, **kw), ("partition", "offset")
    else:
        place = POSITION
        raw = read_folder(spark, folder, T.StructType([T.StructField("value", T.StringType())]), fmt,
                          max_files_per_trigger, with_position=True)
    return raw.select(parse("value", spec.schema).alias("r"), *place).select("r.*", *place)


def read_log_text(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """SRC4: raw client-log lines (JSON text) from a folder: (value)."""
    return (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
                 .load(path))


def start_topic_sink(routed: DataFrame, bootstrap: str, checkpoint: str, trigger: dict | None = None):
    """SNK8/SNK9 on Kafka: each row goes to the topic in its ``topic`` column.

    ``routed`` needs ``topic`` and ``value`` (and optionally ``key``) columns,
    as the routers produce them.  Needs the Kafka connector on the classpath.
    """
    cols = [c for c in ("key", "value", "topic") if c in routed.columns]
    return (routed.select(*[F.col(c).cast("string") for c in cols])
                  .writeStream.format("kafka").options(**write_topic_options(bootstrap))
                  .option("checkpointLocation", checkpoint)
                  .trigger(**(trigger or {"processingTime": "5 seconds"}))
                  .start())
