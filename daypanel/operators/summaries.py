"""Counts, latest days and sorted distinct values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: ``table_name``, ``row_count``."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def max_day_per_source(sources: Mapping[str, DataFrame], day: str, name: str = "max_day") -> DataFrame:
    """One row per source: its latest day, the horizon its gaps are filled to."""
    maxima = [
        df.agg(F.max(day).alias(name)).select(F.lit(source).alias("source"), name) for source, df in sources.items()
    ]
    return reduce(DataFrame.unionAll, maxima)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def sorted_series(df: DataFrame, order: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Total order by ``order``; ``tie`` columns let rows that agree in it be split over tasks."""
    return df.orderBy(*order, *tie)
