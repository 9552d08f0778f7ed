"""JSON scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse(value, schema: T.StructType, corrupt_column: str | None = None) -> Column:
    """JSON text -> typed struct, permissive: malformed text gives null fields."""
    c = F.col(value) if isinstance(value, str) else value
    return F.from_json(c, schema, {"mode": "PERMISSIVE"})


def render(*cols) -> Column:
    """Record -> compact JSON text."""
    return F.to_json(F.struct(*cols))


def render_map(m) -> Column:
    """Change after-image (map of column name -> string value) -> JSON object."""
    c = F.col(m) if isinstance(m, str) else m
    return F.to_json(c)


def field(value, name: str) -> Column:
    """One top-level field of a JSON text as string (null when absent)."""
    c = F.col(value) if isinstance(value, str) else value
    return F.get_json_object(c, f"$.{name}")
