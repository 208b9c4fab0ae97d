"""Cleaning and presence tests for text columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trimmed(column: str, all_whitespace: bool = False) -> Column:
    """Strip spaces; with ``all_whitespace`` also tabs, line breaks and the like."""
    if all_whitespace:
        return F.regexp_replace(column, r"^\s+|\s+$", "")
    return F.trim(column)


def trim_columns(
    df: DataFrame, columns: Sequence[str], all_whitespace: bool = False
) -> DataFrame:
    """Trim several columns in one projection."""
    return df.withColumns({c: trimmed(c, all_whitespace) for c in columns})


def any_missing(columns: Sequence[str]) -> Column:
    """True when at least one column is NULL or empty; never NULL itself."""
    return reduce(or_, (F.col(c).isNull() | (F.col(c) == "") for c in columns), F.lit(False))
