"""Phone masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the mask that replaces the first seven characters.
MASK = "*******"


def mask_phone(tel) -> Column:
    """First seven characters -> ``*******``; the rest is kept.

    Shorter numbers become just the seven stars; null stays null.
    """
    c = F.col(tel) if isinstance(tel, str) else tel
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(MASK), F.substring(c, 8, 1 << 30)))
