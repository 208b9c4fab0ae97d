"""Short notation for declared schemas that needs no running session."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "timestamp": T.TimestampType(),
}


def declare(text: str) -> T.StructType:
    """``"id long!, label string"``; ``!`` marks a required column."""
    schema = T.StructType()
    for column in text.split(","):
        name, kind = column.split()
        schema = schema.add(name, _TYPES[kind.rstrip("!")], nullable=not kind.endswith("!"))
    return schema
