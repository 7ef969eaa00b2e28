"""Empty text and NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def empty_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def null_to_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def null_to_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts that are absent count as zero."""
    return df.fillna(0, subset=columns)
