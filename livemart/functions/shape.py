"""Labels and nested result shaping (P19, P20, Q8 bands)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display labels of the result cards and facets.
CARD_DAU = ("dau", "新增日活")
CARD_NEW_MID = ("newMid", "新增设备")
CARD_ORDER_AMOUNT = ("order_amount", "新增交易额")
GENDER_GROUP_TITLE = "性别占比"
GENDER_LABELS = {"M": "男", "F": "女"}
AGE_GROUP_TITLE = "年龄占比"
AGE_BAND_LABELS = ("20岁以下", "20岁到30岁", "30岁以上")
# Map legend bands of the province view, width 100, six bands.
PROVINCE_BAND_WIDTH = 100
PROVINCE_BANDS = 6


def age_band(age) -> Column:
    """Three age bands: under 20, 20 to 29, 30 and over."""
    a = F.col(age) if isinstance(age, str) else age
    lo, mid, hi = AGE_BAND_LABELS
    return F.when(a < 20, F.lit(lo)).when(a < 30, F.lit(mid)).otherwise(F.lit(hi))


def value_band(value) -> Column:
    """Q8: legend band index 0..5 for a count (values past the top land in 5)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.least(F.floor(v / F.lit(PROVINCE_BAND_WIDTH)), F.lit(PROVINCE_BANDS - 1)).cast("int")


def option(name, value) -> Column:
    """P20: ``struct<name, value>`` option of an option group."""
    return F.struct(F.lit(name).alias("name") if isinstance(name, str) else name.alias("name"),
                    value.cast("double").alias("value"))
