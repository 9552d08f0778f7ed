"""Record schemas of the five input streams and the derived outputs.

Field names follow the records the upstream services emit (client logs and
change-data records); all change-record values arrive as strings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The field names of the records that the upstream services emit, in their order.
# Raw client log (start-up or event); the intake adds ``ts`` (epoch ms).
RAW_LOG = _struct(
    ("type", S), ("mid", S), ("uid", S), ("os", S), ("appid", S), ("area", S),
    ("ch", S), ("vs", S), ("evid", S), ("pgid", T.IntegerType()),
    ("npgid", T.IntegerType()), ("itemid", S), ("ts", L),
)

STARTUP_LOG = _struct(
    ("mid", S), ("uid", S), ("appid", S), ("area", S), ("os", S), ("ch", S),
    ("type", S), ("vs", S), ("logdate", S), ("loghour", S), ("ts", L),
)

EVENT_INFO = _struct(
    ("mid", S), ("uid", S), ("appid", S), ("area", S), ("os", S), ("ch", S),
    ("type", S), ("evid", S), ("pgid", T.IntegerType()), ("npgid", T.IntegerType()),
    ("itemid", S), ("logdate", S), ("loghour", S), ("ts", L),
)

# The columns of the order table, in its order.
ORDER_INFO_COLUMNS = (
    "id", "province_id", "consignee", "order_comment", "consignee_tel",
    "order_status", "payment_way", "user_id", "img_url", "total_amount",
    "expire_time", "delivery_address", "create_time", "operate_time",
    "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
    "create_date", "create_hour",
)
ORDER_INFO = _struct(*[(c, T.DoubleType() if c == "total_amount" else S)
                       for c in ORDER_INFO_COLUMNS])

ORDER_DETAIL = _struct(
    ("id", S), ("order_id", S), ("sku_name", S), ("sku_id", S),
    ("order_price", S), ("img_url", S), ("sku_num", S),
)

USER_INFO = _struct(
    ("id", S), ("login_name", S), ("user_level", S), ("birthday", S), ("gender", S),
)

# One change-data entry: a transaction marker or row data for one table
# and operation, with the after-image of every changed row.
CHANGE_RECORD = T.StructType([
    T.StructField("entry_type", S), T.StructField("table", S),
    T.StructField("op", S),
    T.StructField("rows", T.ArrayType(T.MapType(S, S))),
    T.StructField("change_ts", T.TimestampType()),
    T.StructField("seq", L),
])

# The columns of the sale rows, in their order.
SALE_DETAIL_COLUMNS = (
    "order_detail_id", "order_id", "order_status", "create_time", "user_id",
    "sku_id", "user_gender", "user_age", "user_level", "sku_price", "sku_name",
    "dt", "sku_num",
)

# The columns of the DAU table, in its order.
DAU_COLUMNS = ("mid", "uid", "appid", "area", "os", "ch", "type", "vs",
               "logdate", "loghour", "ts")


@dataclass(frozen=True)
class StreamSpec:
    """One input stream of the catalogue: topic, record schema, key, event time."""
    name: str
    topic: str
    schema: T.StructType
    key: tuple
    event_time: str | None


# Default names of the five topics of the stream catalogue; deployments with
# other topic names pass them to the routers (``topics=`` arguments).
TOPIC_STARTUP = "STARTUP"
TOPIC_EVENT = "EVENT"
TOPIC_ORDER = "ORDER"
TOPIC_USER = "USER"
TOPIC_ORDER_DETAIL = "ORDER_DETAIL"

STREAMS = {
    "startup": StreamSpec("startup", TOPIC_STARTUP, STARTUP_LOG, ("logdate", "mid"), "ts"),
    "event": StreamSpec("event", TOPIC_EVENT, EVENT_INFO, ("mid",), "ts"),
    "order": StreamSpec("order", TOPIC_ORDER, ORDER_INFO, ("id",), "create_time"),
    "user": StreamSpec("user", TOPIC_USER, USER_INFO, ("id",), None),
    "order_detail": StreamSpec("order_detail", TOPIC_ORDER_DETAIL, ORDER_DETAIL, ("id",), None),
}
