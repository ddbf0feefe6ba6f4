"""Naming the value of an expression so that it is worked out once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions stay in one place.

    A plain column is copied into every expression and pushed-down filter that uses it, which for a
    value used dozens of times makes plans, generated code and work grow by that factor. The rows of a
    generator are not rewritten that way; here it gives one row for each.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))
