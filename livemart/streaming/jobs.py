"""The streaming jobs: the batch operators plus watermark, trigger and sink.

Each ``*_query`` takes streaming DataFrame(s), starts a ``StreamingQuery``
writing to an idempotent sink and returns it.  State is bounded by
watermarks (the upstream jobs kept state forever); delays are parameters,
and rows later than the watermark are counted by Spark in
``stateOperators.numRowsDroppedByWatermark``.

Triggers: ``{"processingTime": "5 seconds"}`` (ST1, the upstream interval)
in production; ``{"availableNow": True}`` for replays and tests.
"""

from __future__ import annotations

import threading
from contextlib import nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from livemart.operators import alerts, dau, ingest, orders, sales
from livemart.operators.dau import DAU_ORDER
from livemart.operators.keyed import first_per_key, once_per_key
from livemart.passes import in_passes, passes_for, shuffles_removed
from livemart.schemas import DAU_COLUMNS
from livemart.streaming.bounded import HELD, OpenRows, both_sides, interval_ms
from livemart.streaming.upsert import BATCH_COL, KeyedTable

LIVE_TRIGGER = {"processingTime": "5 seconds"}
_STARTING = threading.Lock()


def state_partitions(spark) -> int:
    """Default number of state-store partitions: the cluster's task slots.

    A stateful query fixes its partition count at its first start (it is
    kept in the checkpoint) and AQE does not re-plan streams, so the count
    is chosen per query instead of inherited from a batch-sized session
    setting.
    """
    return max(int(spark.sparkContext.defaultParallelism), 1)


def batch_partitions(spark) -> int:
    """Shuffle partitions of a job without state: the session's (AQE merges small ones), no fewer than the task slots."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), state_partitions(spark))


def _start(df: DataFrame, checkpoint: str, trigger: dict | None, mode: str = "update",
           foreach_batch=None, name: str | None = None, partitions: int | None = None,
           tidy: bool = False, **sink) -> StreamingQuery:
    spark = df.sparkSession
    key = "spark.sql.shuffle.partitions"
    # the query clones the session conf when it starts; restored right after, one start at a time
    with _STARTING, shuffles_removed(spark) if tidy else nullcontext():
        previous = spark.conf.get(key)
        spark.conf.set(key, str(partitions or state_partitions(spark)))
        try:
            return _start_writer(df, checkpoint, trigger, mode, foreach_batch, name, **sink)
        finally:
            spark.conf.set(key, previous)


def _start_writer(df: DataFrame, checkpoint: str, trigger: dict | None, mode: str,
                  foreach_batch, name: str | None, **sink) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or LIVE_TRIGGER))
    if name:
        w = w.queryName(name)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    fmt = sink.pop("format", "parquet")
    parts = sink.pop("partitionBy", None)
    w = w.format(fmt)
    if parts:
        w = w.partitionBy(*parts)
    return w.start(sink.pop("path"))


def with_event_time(df: DataFrame, ms_col: str = "ts_ms", out: str = "event_time") -> DataFrame:
    """Epoch-ms column -> zoned timestamp usable by ``withWatermark`` / ``window``."""
    return df.withColumn(out, F.timestamp_millis(F.col(ms_col)))


def observed(df: DataFrame, name: str) -> DataFrame:
    """SNK11: row count per micro-batch, reported in the query progress."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def dau_query(startups: DataFrame, table: KeyedTable, checkpoint: str,
              watermark: str = "1 day", trigger: dict | None = None) -> StreamingQuery:
    """ST3 + A1: first start-up per device per log day, upserted by (logdate, mid).

    Aggregation state is keyed by the day window, so the watermark evicts
    whole days.  Update mode: each batch re-emits the keys it changed.
    """
    ev = observed(with_event_time(startups), "startups").withWatermark("event_time", watermark)
    ev = ev.withColumn("day", F.window("event_time", "1 day"))
    cols = [c for c in DAU_COLUMNS if c != "ts"] + list(DAU_ORDER)
    first = first_per_key(ev, ["day", "logdate", "mid"], DAU_ORDER, cols)
    rows = first.select(*[c for c in DAU_COLUMNS if c != "ts"], F.col("ts_ms").alias("ts"))
    # SNK11: start-ups in, first start-ups out (new or earlier) per batch
    rows = observed(rows, "dau_rows")
    return _start(rows, checkpoint, trigger, "update", table.foreach_batch(), "dau")


def alert_query(events: DataFrame, table: KeyedTable, checkpoint: str, window: str, slide: str,
                watermark: str = "1 minute", min_users: int = 3,
                trigger: dict | None = None) -> StreamingQuery:
    """ST2: sliding-window rule per device, every updated window upserted.

    ``table`` is keyed by (mid, ts), the window: several windows share a
    minute and so an alert id.  The rule is not monotone (a later click
    cancels an alert), so rows carry ``ok`` and the table's view keeps only
    windows whose latest version is ok; ``alerts.per_minute`` of that view
    gives one alert per device and minute (ST6).
    """
    ev = observed(with_event_time(events), "events").withWatermark("event_time", watermark)
    out = alerts.windowed_alerts(ev, window, slide, min_users)
    return _start(out, checkpoint, trigger, "update", table.foreach_batch(), "alerts")


def closed_alert_query(events: DataFrame, archive, table: KeyedTable, checkpoint: str, window_ms: int,
                       slide_ms: int, watermark: str = "1 minute", min_users: int = 3,
                       trigger: dict | None = None) -> StreamingQuery:
    """ST2 with bounded state: each window decided once, when the watermark has closed it.

    The state is ``alerts.alerting_windows``: small rows per device and open
    pane or window, no events.  ``archive(spark)`` gives the stored events
    (SNK10) that ``events`` streams from, so what the stream has seen is there;
    a batch fetches from it the events of the windows that alert.  Events behind the
    watermark are not in the state: ``late_events_query`` and ``repair_alerts``.
    """
    ev = observed(with_event_time(events), "events").withWatermark("event_time", watermark)
    windows = alerts.alerting_windows(ev, window_ms, slide_ms, min_users)

    def _rows(df, _bid):
        return alerts.alerts_of(archive(df.sparkSession), df, window_ms, slide_ms).withColumn("ok", F.lit(True))
    return _start(windows, checkpoint, trigger, "append", table.foreach_batch(_rows), "closed_alerts")


def late_events_query(events: DataFrame, late: KeyedTable, clock: KeyedTable, checkpoint: str,
                      watermark_ms: int, trigger: dict | None = None) -> StreamingQuery:
    """ST5: the events that the alert stream may have dropped as late, kept apart.

    An event is late if it is more than ``watermark_ms`` older than the latest
    one up to its batch (``clock`` keeps one row a batch).  That is never
    fewer than the alert stream drops, whose watermark trails by a batch.
    """
    def _batch(df, bid):
        spark = df.sparkSession
        df.persist()
        try:
            seen = clock.view(spark, before_batch=bid).select("ts_ms").unionByName(df.select("ts_ms"))
            latest = seen.agg(F.max("ts_ms")).first()[0]
            clock.write(spark.createDataFrame([(bid, latest)], "batch long, ts_ms long"), bid)
            late.write(df.where(F.col("ts_ms") < F.lit((latest or 0) - watermark_ms)), bid)
        finally:
            df.unpersist()
    return _start(events, checkpoint, trigger, "append", _batch, "late_events")


def repair_alerts(spark, table: KeyedTable, archive, late: KeyedTable, window_ms: int, slide_ms: int,
                  min_users: int = 3, repair_id: int | None = None) -> int:
    """ST5: the windows that late events touch are decided again from the stored events.

    New and changed alerts are written with ``ok``, alerts that a late click
    cancels without; no other window is read.  Returns the repair's number.
    """
    repair_id = repair_id or table.next_repair(spark)
    # each is computed once: the windows serve four joins, the decided alerts two
    windows = alerts.touched_windows(late.view(spark), window_ms, slide_ms).persist()
    right = alerts.decided_again(archive(spark), windows, window_ms, slide_ms, min_users).persist()
    try:
        stored = table.view(spark, with_batch=True, before_repair=repair_id)
        touched = windows.select(F.col("mid").alias("_mid"), (F.col("wstart") + F.lit(window_ms)).alias("_ts"))
        own = stored.join(touched, stored["mid"].eqNullSafe(touched["_mid"]) & (stored["ts"] == touched["_ts"]), "left_semi")
        batches = own.select(F.col("mid").alias("_mid"), F.col("ts").alias("_ts"), F.col(BATCH_COL))
        same = right["mid"].eqNullSafe(batches["_mid"]) & (right["ts"] == batches["_ts"])
        held = (right.join(batches, same, "left").drop("_mid", "_ts")
                .withColumns({BATCH_COL: F.coalesce(BATCH_COL, F.lit(0).cast("long")), "ok": F.lit(True)}))
        kept = right.select(F.col("mid").alias("_mid"), F.col("ts").alias("_ts"))
        gone = own.join(kept, own["mid"].eqNullSafe(kept["_mid"]) & (own["ts"] == kept["_ts"]), "left_anti").withColumn("ok", F.lit(False))
        table.repair(held.unionByName(gone.select(*held.columns)), repair_id, "late_alerts")
    finally:
        right.unpersist()
        windows.unpersist()
    return repair_id


def user_dim_query(changes: DataFrame, table: KeyedTable, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """ST12 + A18: user change stream -> user dimension upserted by id (latest ``seq``).

    Each batch is first reduced to its latest row per user, then appended;
    the table view resolves versions across batches.
    """
    def _latest(df, _bid):
        return sales.latest_users(df)
    return _start(changes, checkpoint, trigger, "append", table.foreach_batch(_latest), "user_dim")


def sale_query(orders_rows: DataFrame, lines: DataFrame, users: KeyedTable, table: KeyedTable,
               checkpoint: str, as_of: str, max_delay: str = "10 seconds",
               watermark: str = "1 minute", trigger: dict | None = None) -> StreamingQuery:
    """J2-J4 + ST4: order ⋈ line within ``max_delay`` of each other, then ⟕ latest user.

    ``orders_rows`` carry ``order_ms`` and ``lines`` carry ``change_ms``
    (commit times, epoch ms).  Each micro-batch is joined with the rows that the
    watermark has not passed (``bounded.OpenRows``), so a line arriving before
    its order (or after) is paired exactly once.  Lines repeated
    within the watermark are dropped by id.  Each micro-batch looks up the
    user dimension as it is at that batch (processing-time lookup), for its orders.
    """
    bound = (f"change_time BETWEEN order_time - INTERVAL {max_delay} "
             f"AND order_time + INTERVAL {max_delay} AND NOT (order_held AND line_held)")

    def _batch(df, bid):
        spark = df.sparkSession
        span = interval_ms(spark, max_delay)
        rows = OpenRows(df, bid, checkpoint, watermark, line_key="id")
        try:
            o = orders.order_info(rows.orders, keep=("order_ms", HELD))
            o = with_event_time(o, "order_ms", "order_time").withColumnRenamed(HELD, "order_held")
            d = with_event_time(rows.lines, "change_ms", "change_time").withColumnRenamed(HELD, "line_held")
            needed = o.select(F.col("user_id").alias("id"))
            table.write(sales.sale_detail(o, d, users.view(spark, keys=needed), as_of, bound), bid)
            # a line's id is remembered until the watermark has passed its time and the delay
            rows.keep(rows.orders.where(rows.is_open("order_ms", span)),
                      rows.lines.where(rows.is_open("change_ms", max(span, rows.delay))))
        finally:
            rows.close()
        table.fold(spark, bid)
    return _start(both_sides(orders_rows, lines), checkpoint, trigger, "append", _batch, "sale_detail",
                  batch_partitions(orders_rows.sparkSession), tidy=True)


def _flagged(kept: DataFrame, partners: DataFrame, near) -> DataFrame:
    """``kept`` with ``matched`` set where a partner is ``near``."""
    return (kept.join(partners, near, "left_semi").withColumn("matched", F.lit(True))
            .unionByName(kept.join(partners, near, "left_anti")))


def sale_dead_letters_query(orders_rows: DataFrame, lines: DataFrame, path: str, checkpoint: str,
                            max_delay: str = "10 seconds", watermark: str = "1 minute",
                            trigger: dict | None = None) -> StreamingQuery:
    """J2 outer sides as a stream: orders that never got a line and lines that
    never found their order, emitted once the watermark has passed the time
    bound.  Each micro-batch is a full outer join with the rows kept open
    (``bounded.OpenRows``).  Output: (side, id, order_id), the shape of
    ``sales.unmatched``, in one folder a batch (``BATCH_COL``), which a replayed batch overwrites.
    """
    def _batch(df, bid):
        span = interval_ms(df.sparkSession, max_delay)
        rows = OpenRows(df, bid, checkpoint, watermark)

        def sides(some_orders, some_lines):
            o = some_orders.select(F.col("id").alias("_oid"), "order_ms", F.col("matched").alias("_omet"), F.col(HELD).alias("_oheld"))
            d = some_lines.select(F.col("id").alias("_lid"), "order_id", "change_ms", F.col("matched").alias("_lmet"),
                                  F.col(HELD).alias("_lheld"))
            return o, d
        try:
            near = f"order_id AND change_ms BETWEEN order_ms - {span} AND order_ms + {span}"
            o, d = sides(rows.orders, rows.lines)
            over = lambda time, met: ~rows.is_open(time, span) & ~F.col(met)
            emitted = (F.when(F.col("_omet").isNull(), over("change_ms", "_lmet")).when(F.col("_lmet").isNull(), over("order_ms", "_omet"))
                       .otherwise(F.col("_lid").isNull() & ~(F.col("_oheld") & F.col("_lheld"))))
            dead = o.join(d, F.expr(f"_oid = {near}"), "fullOuter").where(emitted).select(
                F.when(F.col("_lid").isNull(), F.lit("order")).otherwise(F.lit("order_detail")).alias("side"),
                F.coalesce(F.col("_lid"), F.col("_oid")).alias("id"),
                F.coalesce(F.col("order_id"), F.col("_oid")).alias("order_id"))
            dead.write.mode("overwrite").parquet(f"{path}/{BATCH_COL}={int(bid)}")

            # of the rows kept, those that have met a partner; it stands at most twice the bound behind the watermark
            o, d = sides(rows.orders.where(rows.is_open("order_ms", 2 * span)), rows.lines.where(rows.is_open("change_ms", 2 * span)))
            open_orders, open_lines = rows.orders.where(rows.is_open("order_ms", span)), rows.lines.where(rows.is_open("change_ms", span))
            rows.keep(_flagged(open_orders, d, F.expr(f"id = {near}")),
                      _flagged(open_lines, o, F.expr(f"_oid = {near}")))
        finally:
            rows.close()
    both = both_sides(orders_rows.select("id", "order_ms"), lines.select("id", "order_id", "change_ms"))
    return _start(both, checkpoint, trigger, "append", _batch, "sale_dead_letters", batch_partitions(both.sparkSession))


def clustered(df: DataFrame, cols: list[str], spread: str, splits: int) -> DataFrame:
    """Rows of one folder go to ``splits`` tasks (by hash of ``spread``): few
    files per folder, yet no single task writes the live day alone.  The
    partition count is given, so that AQE does not merge a small batch of
    many folders into one writing task."""
    return df.repartition(batch_partitions(df.sparkSession), *cols, F.pmod(F.xxhash64(spread), F.lit(splits)))


def order_query(orders_rows: DataFrame, table: KeyedTable, checkpoint: str, splits: int = 16,
                trigger: dict | None = None) -> StreamingQuery:
    """SNK2: masked order rows upserted into a table laid out by ``create_date``, or by month.

    ``table`` is keyed by (create_date, id), an order's creation time never
    changes, so a redelivered order replaces itself within its day.  With ``month``
    as a key before them its folders are months, with the days in order inside the
    files: far fewer folders where a batch holds many days, and a day still skips the other row groups.
    """
    rows = orders.order_info(orders_rows)
    if "month" not in table.key:
        rows = clustered(rows, ["create_date"], "id", splits)
        return _start(rows, checkpoint, trigger, "append", table.foreach_batch(), "orders")

    def _by_month(df, _bid):
        df = clustered(df.withColumn("month", F.substring("create_date", 1, 7)), ["month"], "id", splits)
        return df.sortWithinPartitions("month", "create_date")
    return _start(rows, checkpoint, trigger, "append", table.foreach_batch(_by_month), "orders")


def document_query(documents: DataFrame, table: KeyedTable, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """SNK3: documents upserted by id; those without one get the position in the source as id.

    ``documents`` carry ``table.position`` (``read_folder(with_position=True)``, or partition
    and offset of a topic): equal documents without id stay apart, and a replayed
    batch or a redelivered position replaces itself.
    """
    return _start(documents, checkpoint, trigger, "append", table.foreach_batch(), "documents")


def line_query(lines: DataFrame, table: KeyedTable, checkpoint: str,
               trigger: dict | None = None) -> StreamingQuery:
    """Order lines upserted by id, whatever their lateness; ``pair_late`` reads them."""
    return _start(lines, checkpoint, trigger, "append", table.foreach_batch(), "lines")


def pair_late(spark, sales_table: KeyedTable, orders_table: KeyedTable, lines_table: KeyedTable,
              users: KeyedTable, as_of: str, repair_id: int | None = None) -> None:
    """J3 for any lateness, in one pass over both tables: lines that the stream did not pair
    (outside its time bound or behind its watermark) are paired with the stored orders and
    added to the sale table as a repair.  ``pending_sale_query`` pairs them as they come."""
    repair_id = repair_id or sales_table.next_repair(spark)
    done = sales_table.view(spark, before_repair=repair_id).select(F.col("order_detail_id").alias("id"))
    todo = lines_table.view(spark).join(done, "id", "left_anti")
    pairs = sales.pair_rows(orders_table.view(spark), todo)
    rows = sales.with_user(pairs, users.view(spark), as_of)
    sales_table.repair(rows.withColumn(BATCH_COL, F.lit(0).cast("long")), repair_id, "late_lines")


def log_route_query(raw_text: DataFrame, path: str, checkpoint: str, stamp=None, splits: int = 16,
                    trigger: dict | None = None) -> StreamingQuery:
    """SNK8 + SNK10: stamp and route raw logs; archive by topic and log day."""
    st = ingest.route_logs(ingest.stamp_logs(raw_text, stamp=stamp))
    out = ingest.log_day_hour(st.select("topic", "value", F.col("log.ts").alias("ts")), "ts")
    out = clustered(out.select("topic", "logdate", "value"), ["topic", "logdate"], "value", splits)
    return _start(out, checkpoint, trigger, "append",
                  name="log_route", path=path, partitionBy=["topic", "logdate"])


def change_route_query(entries: DataFrame, path: str, checkpoint: str, table_pattern: str | None = None,
                       splits: int = 16, trigger: dict | None = None) -> StreamingQuery:
    """SRC3 + SNK9: change entries as a stream, routed and written by topic."""
    routed = ingest.route_changes(entries, table_pattern=table_pattern).select("topic", "value")
    return _start(clustered(routed, ["topic"], "value", splits), checkpoint, trigger, "append",
                  name="cdc_route", path=path, partitionBy=["topic"])


def repair_dau(spark, table: KeyedTable, startups: DataFrame, repair_id: int | None = None) -> None:
    """ST5: first start-ups that the stream dropped as late, from the archived
    start-ups: (day, device) rows that are missing from the table, or whose
    stored start is not the first one, are written as a repair."""
    repair_id = repair_id or table.next_repair(spark)
    view = table.view(spark, with_batch=True, before_repair=repair_id)
    now = view.select("logdate", "mid", F.col("ts").alias("_ts"), BATCH_COL)
    first = dau.daily_active(startups).join(now, ["logdate", "mid"], "left")
    wrong = first.where(F.col("_ts").isNull() | (F.col("ts") < F.col("_ts")))
    table.repair(wrong.withColumn(BATCH_COL, F.coalesce(BATCH_COL, F.lit(0).cast("long"))).drop("_ts"), repair_id,
                 "late_startups")


def refresh_missing_users(spark, sales_table: KeyedTable, users: KeyedTable, as_of: str,
                          repair_id: int | None = None) -> int:
    """Re-enrich sale rows written before their user arrived (late dimension).

    Rows without user attributes are joined again with the current user
    view; those that now find their user are written as repair ``repair_id``
    of the version they correct, so neither a running nor a replayed
    micro-batch of the stream can undo them.  Returns the repair's number.
    """
    repair_id = repair_id or sales_table.next_repair(spark)
    with shuffles_removed(spark):
        view = sales_table.view(spark, with_batch=True, before_repair=repair_id, few_repeats=True)
        missing = view.where(F.col("user_gender").isNull() & F.col("user_level").isNull())
        missing = missing.drop("user_gender", "user_level", "user_age").where(F.col("order_detail_id").isNotNull())
        # the merged sale rows are read once a pass: no look-up of their keys, no second join for the batch
        for k, part in enumerate(in_passes(missing, sales_table.key, passes_for(sales_table.raw(spark).count()))):
            redone = sales.with_user(part, users.view(spark), as_of, carry=(BATCH_COL,))
            redone = redone.where(F.col("user_gender").isNotNull() | F.col("user_level").isNotNull())
            sales_table.repair(redone, repair_id, "late_users", k > 0)
    return repair_id


def first_batch(spark, checkpoint: str, table: KeyedTable) -> int:
    """What to add to the batch numbers of a query with this checkpoint.

    A new checkpoint (the first start, or after the old one was lost) starts
    again at batch 0; its batches go behind all that the table holds instead of
    overwriting them.  The number is kept in the checkpoint, so a restart on it uses the same.
    """
    place = f"{checkpoint.rstrip('/')}/first_batch"
    try:
        found = spark.read.schema("first long").parquet(place).first()
        if found is not None:
            return int(found["first"])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    first = table.next_batch(spark)
    spark.createDataFrame([(first,)], "first long").coalesce(1).write.mode("overwrite").parquet(place)
    return first


def seen_query(startups: DataFrame, table: KeyedTable, checkpoint: str, trigger: dict | None = None,
               counts: KeyedTable | None = None) -> StreamingQuery:
    """J1 + ST3 without state: each batch's first start-ups against the stored ones of their days.

    A device that the day's folder does not have yet is written, or one with an
    earlier start than the stored one.  What was seen is the table itself, so the
    answer survives the loss of the checkpoint: the replayed start-ups are all seen.
    ``counts`` (SNK11) gets a row a batch: start-ups in, rows left after the filter.
    """
    first = first_batch(startups.sparkSession, checkpoint, table)

    def _unseen(df, bid):
        rows = dau.daily_active(df)
        seen = table.view(df.sparkSession, keys=rows.select("logdate", "mid"), before_batch=first + bid)
        seen = seen.select("logdate", "mid", F.col("ts").alias("_seen"))
        new = rows.join(seen, ["logdate", "mid"], "left").where(F.col("_seen").isNull() | (F.col("ts") < F.col("_seen")))
        new = new.select(*rows.columns)
        if counts is not None:
            # one aggregate each over the persisted batch
            row = [(first + bid, df.count(), new.count())]
            counts.write(df.sparkSession.createDataFrame(row, "batch long, rows_in long, rows_out long"), first + bid)
        return new
    return _start(startups, checkpoint, trigger, "append", table.foreach_batch(_unseen, first=first), "seen")


def pending_sale_query(orders_rows: DataFrame, lines: DataFrame, stored_orders: KeyedTable, pending: KeyedTable,
                       users: KeyedTable, table: KeyedTable, checkpoint: str, as_of: str,
                       trigger: dict | None = None) -> StreamingQuery:
    """J2-J4 + ST4 for any lateness: orders and unpaired lines wait in tables, not in state.

    A batch pairs its lines with its own orders and with the stored orders that
    they name, and its orders with the lines that wait for them.  Lines left
    over are added to ``pending`` (keyed by order_id and id, ``keep`` its column
    ``open``), claimed ones are closed there.  Both tables are bucketed by the order id, so a batch
    reads the buckets of its own ids only, never a table whole; each line is paired once,
    whichever side comes first and however late.  A replayed batch reads what came before it and writes the same.
    """
    order_columns = ["create_time", "order_status", "user_id", "create_date"]
    line_columns = ["id", "order_id", "sku_id", "sku_name", "order_price", "sku_num"]

    def _batch(df, bid):
        spark = df.sparkSession
        raw = [df.where(f"{side} is not null").select(f"{side}.*").persist() for side in ("o", "d")]
        kept = []
        try:
            info = orders.order_info(raw[0]).select("id", *order_columns)
            info = once_per_key(info, ["id"], order_columns, latest=True)
            new = once_per_key(raw[1].select(*line_columns), ["id"], line_columns[1:], latest=True)
            own = info.select(F.col("id").alias("order_id"))
            # only the lines whose order is not in the batch need the stored orders, and few wait: kept for their sizes
            alone = new.join(own, "order_id", "left_anti").select(*line_columns).persist()
            waiting = pending.view(spark, keys=own, before_batch=bid).select(*line_columns).persist()
            kept += [alone, waiting]
            alone.count(), waiting.count()
            stored = stored_orders.view(spark, keys=alone.select(F.col("order_id").alias("id")), before_batch=bid)
            stored = stored.select(*info.columns).persist()
            kept.append(stored)
            stored.count()
            again = new.join(waiting.select("id"), "id", "left_semi").select("id")
            claims = waiting.join(again, "id", "left_anti").select(*line_columns)
            # an order of the batch stands before a stored one of its id: ``alone`` has no line of it
            known = info.unionByName(stored)
            needed = known.select(F.col("user_id").alias("id"))
            lines = new.unionByName(claims)
            table.write(sales.sale_detail(known, lines, users.view(spark, keys=needed), as_of), bid)
            # the waiting lines are there because their order has come: all of them are claimed
            left = alone.join(stored.select(F.col("id").alias("order_id")), "order_id", "left_anti")
            claimed = waiting.withColumn("open", F.lit(False))
            pending.write(left.select(*line_columns).withColumn("open", F.lit(True)).unionByName(claimed), bid)
            stored_orders.write(info, bid)
        finally:
            for rows in [*raw, *kept]:
                rows.unpersist()
    return _start(both_sides(orders_rows, lines), checkpoint, trigger, "append", _batch, "pending_sales",
                  batch_partitions(orders_rows.sparkSession))
