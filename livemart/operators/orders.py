"""Order records: derived date/hour, masked phone (P5, P6) and amount sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemart.functions.masking import mask_phone
from livemart.functions.numeric import money_sum
from livemart.functions.timefmt import datetime_date, datetime_hour
from livemart.schemas import ORDER_INFO_COLUMNS


def order_info(rows: DataFrame, keep: tuple = ()) -> DataFrame:
    """P5 + P6: add ``create_date``/``create_hour``, mask ``consignee_tel``.

    Columns the input lacks are carried as nulls so the output always has the
    20 order columns in table order (P18); ``keep`` names extra input
    columns to carry along after them (e.g. an event time).
    """
    present = set(rows.columns)
    derived = {
        "consignee_tel": mask_phone("consignee_tel") if "consignee_tel" in present else None,
        "create_date": datetime_date("create_time"),
        "create_hour": datetime_hour("create_time"),
    }
    out = []
    for c in ORDER_INFO_COLUMNS:
        if derived.get(c) is not None:
            out.append(derived[c].alias(c))
        elif c in present:
            out.append(F.col(c))
        else:
            out.append(F.lit(None).cast("double" if c == "total_amount" else "string").alias(c))
    return rows.select(*out, *keep)


def amount_total(orders: DataFrame, date: str | None = None) -> DataFrame:
    """Order amount per day (exact decimal sum, as double): (create_date, sum_amount)."""
    if date is not None:
        orders = orders.where(F.col("create_date") == date)
    return orders.groupBy("create_date").agg(money_sum("total_amount").alias("sum_amount"))


def amount_hour(orders: DataFrame, date: str | None = None) -> DataFrame:
    """A10: order amount per day and hour: (create_date, create_hour, sum_amount)."""
    if date is not None:
        orders = orders.where(F.col("create_date") == date)
    return (orders.groupBy("create_date", "create_hour")
                  .agg(money_sum("total_amount").alias("sum_amount")))
