"""Sale detail: order ⋈ order line ⟕ latest user.

The upstream job kept both sides of a full outer join in an external cache
to pair orders and lines that arrive in different micro-batches.  Its net
meaning is an inner equi-join in which each (order, line) pair is produced
once, whichever side comes first; in batch that is a plain inner join, and
in a stream it is Spark's stream-stream join (``livemart.streaming``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from livemart.functions.numeric import age_years
from livemart.operators.keyed import latest_per_key
from livemart.schemas import SALE_DETAIL_COLUMNS


def pair_rows(orders: DataFrame, lines: DataFrame, time_bound: str | None = None,
              carry: tuple = ()) -> DataFrame:
    """P10 + P11 + P13 over the inner join of orders and their lines.

    ``orders``: order-info rows with id, order_status, create_time, user_id and
    create_date.  ``lines``: order-detail rows (all strings).  In batch the
    join is a shuffle (sort-merge) join on the order id unless the planner
    measures one side under the broadcast threshold; AQE splits skewed ids.
    ``time_bound`` (streams) adds a condition on ``order_time`` and
    ``change_time`` (and ``order_held``, ``line_held``: a pair of kept rows was
    made before) so that rows can be dropped behind the watermark.
    ``carry`` names extra order columns to keep (e.g. user attributes).
    """
    o_time = [c for c in ("order_time", "order_held") if c in orders.columns]
    d_time = [c for c in ("change_time", "line_held") if c in lines.columns]
    o = orders.select(F.col("id").alias("_oid"), "order_status", "create_time", "user_id",
                      F.col("create_date").alias("dt"), *o_time, *carry)
    d = lines.select(F.col("id").alias("order_detail_id"), "order_id", "sku_id", "sku_name",
                     F.col("order_price").try_cast("double").alias("sku_price"), "sku_num", *d_time)
    cond = F.col("_oid") == F.col("order_id")
    if time_bound:
        cond = cond & F.expr(time_bound)
    j = o.join(d, cond, "inner")
    return j.select("order_id", "order_status", "create_time", "user_id", "dt", "order_detail_id",
                    "sku_id", "sku_name", "sku_price", "sku_num", *carry)


def _user_attrs(users: DataFrame, as_of: str) -> DataFrame:
    return users.select(F.col("id").alias("user_id"), F.col("gender").alias("user_gender"),
                        "user_level", age_years("birthday", as_of).alias("_age"))


def _finish(df: DataFrame, carry: tuple = ()) -> DataFrame:
    return df.select(*[F.coalesce(F.col("_age"), F.lit(0)).alias("user_age") if c == "user_age"
                       else F.col(c) for c in SALE_DETAIL_COLUMNS], *carry)


def with_user(sales: DataFrame, users: DataFrame, as_of: str, carry: tuple = ()) -> DataFrame:
    """J4 + P12 + P9: left join the latest user row; no user -> gender/level null, age 0.

    ``as_of`` fixes "now" for the 365-day age so results are reproducible.
    ``carry`` names extra columns to keep after the sale columns.
    """
    return _finish(sales.join(_user_attrs(users, as_of), "user_id", "left"), carry)


def sale_detail(orders: DataFrame, lines: DataFrame, users: DataFrame, as_of: str,
                time_bound: str | None = None) -> DataFrame:
    """The whole sale row: (order ⋈ line) ⟕ user, SALE_DETAIL_COLUMNS.

    The user is attached to the *order* before the line join: every line of
    an order has the order's user, so the result is the same, but the
    shuffle on ``user_id`` then moves order-sized rows instead of
    line-sized ones (about four lines per order).  AQE's skew join splits
    the partition of a hot user.
    """
    enriched = orders.join(_user_attrs(users, as_of), "user_id", "left")
    pairs = pair_rows(enriched, lines, time_bound, carry=("user_gender", "user_level", "_age"))
    # No dedupe here: the batch inputs are keyed tables.  Redelivered copies
    # exist only on streams, where lines are deduplicated by id within the
    # watermark and the sink keeps one row per line id.  (An aggregate on top
    # of this join would also stop AQE from splitting a skewed order id.)
    return _finish(pairs)


def unmatched(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """J2 outer sides (dead letters): orders without lines and lines without orders.

    Output: (side, id, order_id) with side 'order' or 'order_detail'.
    The line side is reduced to distinct order ids before the anti join.
    """
    line_orders = lines.select(F.col("order_id").alias("id")).distinct()
    lonely_orders = orders.select("id").join(line_orders, "id", "left_anti").select(
        F.lit("order").alias("side"), "id", F.col("id").alias("order_id"))
    order_ids = orders.select(F.col("id").alias("order_id"))
    lonely_lines = lines.select("id", "order_id").join(order_ids, "order_id", "left_anti").select(
        F.lit("order_detail").alias("side"), "id", "order_id")
    return lonely_orders.unionByName(lonely_lines)


def user_intervals(changes: DataFrame, time_col: str = "change_ms") -> DataFrame:
    """Validity interval of every user version: [valid_from, valid_to) in epoch ms.

    The window runs over a user's *versions* only (a handful per user), never
    over their sales; the last version is open-ended (``valid_to`` null).
    Versions with the same time are ordered by ``seq``; the earlier one gets
    an empty interval.
    """
    w = Window.partitionBy("id").orderBy(F.col(time_col), F.col("seq"))
    return (changes.withColumn("valid_from", F.col(time_col))
                   .withColumn("valid_to", F.lead(F.col(time_col)).over(w)))


def with_user_as_of(sales: DataFrame, changes: DataFrame, as_of: str, sale_time: str = "order_ms",
                    change_time: str = "change_ms") -> DataFrame:
    """J4, as-of variant: each sale gets the user version valid at the sale's time.

    An equi-join on the user id with the validity interval as a range
    condition: every sale matches at most one version, so no sale is paired
    with all of its user's versions, and a user with very many sales is a
    skewed left side that AQE can split.  Sales before a user's first
    version find none (age 0, gender and level null, as for unknown users).
    """
    iv = user_intervals(changes, change_time).select(
        F.col("id").alias("_uid"), "valid_from", "valid_to",
        F.col("gender").alias("user_gender"), "user_level",
        age_years("birthday", as_of).alias("_age"))
    t = F.col(sale_time)
    cond = ((F.col("user_id") == F.col("_uid")) & (t >= F.col("valid_from"))
            & (F.col("valid_to").isNull() | (t < F.col("valid_to"))))
    keep = [c for c in sales.columns if c not in ("user_gender", "user_level", "user_age")]
    return _finish(sales.select(*keep).join(iv, cond, "left"))


def latest_users(changes: DataFrame) -> DataFrame:
    """A18 + ST12: the latest version of each user from a change log (by ``seq``)."""
    cols = [c for c in changes.columns if c != "seq"] + ["seq"]
    return latest_per_key(changes, ["id"], ["seq"], cols)
