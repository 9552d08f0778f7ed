"""Intake and change-data routing (SRC3, SRC4, P1-P3, P7, P21, F1-F3, SNK8-SNK10).

Routing is a column (``topic``), not a branch in code: one DataFrame feeds a
sink that writes each row to its topic (Kafka's ``topic`` column) or to a
``topic=`` partition of a file table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livemart.functions.json import field, render_map
from livemart.functions.timefmt import millis_to_date, millis_to_hour, server_stamp
from livemart.schemas import (RAW_LOG, TOPIC_EVENT, TOPIC_ORDER, TOPIC_ORDER_DETAIL,
                              TOPIC_STARTUP, TOPIC_USER)

# Column that receives the text of records that do not parse.
CORRUPT = "_corrupt_record"
# Topic for records that do not parse (the upstream intake failed on them).
TOPIC_QUARANTINE = "QUARANTINE"

# Change-data routing, (table, operations) -> topic; the upstream routing
# rule.  Pass ``routes=`` to use other topic names.
CHANGE_ROUTES = (
    ("order_info", ("INSERT",), TOPIC_ORDER),
    ("user_info", ("INSERT", "UPDATE"), TOPIC_USER),
    ("order_detail", ("INSERT",), TOPIC_ORDER_DETAIL),
)


def parse_records(df: DataFrame, schema: T.StructType, value_col: str = "value",
                  out: str = "rec") -> DataFrame:
    """P1 with quarantine: JSON text -> typed struct ``out`` plus a ``malformed`` flag.

    Text that is not valid JSON for ``schema`` (bad syntax, wrong types, or
    no text) is flagged instead of failing the batch; ``out`` is then null.
    The text is parsed once: the parsed struct is projected on its own and
    the outputs are built from its fields.
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value_col), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    df = df.withColumn("_parsed", parsed)
    bad = F.col("_parsed").isNull() | F.col(f"_parsed.{CORRUPT}").isNotNull()
    rec = F.when(bad, F.lit(None)).otherwise(
        F.struct(*[F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields]))
    return df.withColumn(out, rec).withColumn("malformed", bad).drop("_parsed")


def stamp_logs(raw: DataFrame, value_col: str = "value", stamp=None) -> DataFrame:
    """P1 + P7 + P2: parse a raw log, overwrite ``ts`` with the server time, re-render.

    Output adds ``log`` (typed struct) and ``malformed``, and replaces
    ``value`` with the stamped text; malformed logs keep their original text.
    ``stamp="record"`` keeps the ``ts`` the record carries (a replay of
    already-stamped logs); otherwise see ``server_stamp``.
    """
    parsed = parse_records(raw, RAW_LOG, value_col, out="_rec")
    if isinstance(stamp, str) and stamp == "record":
        stamp = F.col("_rec.ts")
    fields = [F.col(f"_rec.{f.name}").alias(f.name) for f in RAW_LOG.fields if f.name != "ts"]
    log = F.when(F.col("_rec").isNull(), F.lit(None)).otherwise(
        F.struct(*fields, server_stamp(stamp).alias("ts")))
    stamped = parsed.withColumn("log", log).drop("_rec")
    return stamped.withColumn(
        value_col, F.when(F.col("malformed"), F.col(value_col)).otherwise(F.to_json(F.col("log"))))


def route_logs(stamped: DataFrame, value_col: str = "value",
               topics: tuple = (TOPIC_STARTUP, TOPIC_EVENT, TOPIC_QUARANTINE)) -> DataFrame:
    """F3 + P21 + SNK8: ``type == 'startup'`` -> STARTUP, anything else (even none) -> EVENT.

    Malformed logs go to the quarantine topic.  Uses the parsed ``log.type``
    when the input was stamped, else extracts ``$.type`` from the text.
    """
    kind = F.col("log.type") if "log" in stamped.columns else field(value_col, "type")
    is_startup = F.coalesce(kind == "startup", F.lit(False))
    topic = F.when(is_startup, topics[0]).otherwise(topics[1])
    if "malformed" in stamped.columns:
        topic = F.when(F.col("malformed"), topics[2]).otherwise(topic)
    return stamped.withColumn("topic", topic)


def log_day_hour(logs: DataFrame, ms_col: str = "ts", tz: str = "UTC") -> DataFrame:
    """Epoch-ms log time -> ``logdate`` and ``loghour`` in zone ``tz``."""
    return (logs.withColumn("logdate", millis_to_date(ms_col, tz))
                .withColumn("loghour", millis_to_hour(ms_col, tz)))


def route_changes(entries: DataFrame, table_pattern: str | None = None,
                  routes: tuple = CHANGE_ROUTES) -> DataFrame:
    """SRC3 + F1 + F2 + P3 + SNK9: change entries -> (topic, value) rows.

    Keeps row data only, subscribes by a table-name regex, routes by
    (table, operation) and renders each after-image as a JSON object.
    Order updates and every delete have no route and are dropped.
    """
    rows = entries.where(F.col("entry_type") == "ROWDATA")
    if table_pattern:
        rows = rows.where(F.col("table").rlike(table_pattern))
    topic = F.lit(None).cast("string")
    for table, ops, name in reversed(routes):
        topic = F.when((F.col("table") == table) & F.col("op").isin(*ops), F.lit(name)).otherwise(topic)
    routed = rows.withColumn("topic", topic).where(F.col("topic").isNotNull())
    return routed.select("topic", "table", "op", "seq", F.explode("rows").alias("after")).select(
        "topic", "table", "op", "seq", render_map("after").alias("value"), "after")
