"""Rounding, range-checked integers and guarded division."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Integer ranges of the source columns.
INT64_MAX = 9223372036854775807
INT64_MIN = -9223372036854775808
UINT32_MAX = 4294967295


def round_half_away(value: Column) -> Column:
    """DOUBLE -> BIGINT, halves away from zero; NaN becomes 0 and out-of-range values the nearest bound.

    Exact: what remains of a double after its floor is itself a double.  Unlike SQL's ``round`` this
    builds no decimal number per row.
    """
    size = F.abs(value)
    whole = F.floor(size)
    rounded = whole + (size - whole.cast("double") >= 0.5).cast("bigint")
    return (
        F.when(F.isnan(value), F.lit(0).cast("bigint"))
        .when(value >= F.lit(float(INT64_MAX)), F.lit(INT64_MAX))
        .when(value <= F.lit(float(INT64_MIN)), F.lit(INT64_MIN))
        .when(value < 0, -rounded)
        .otherwise(rounded)
    )


def require_range(value: Column, low: int, high: int, label: str) -> Column:
    """The value itself; one outside ``[low, high]`` fails the job.  NULL passes."""
    message = F.concat(F.lit(f"{label} out of range: "), value.cast("string"))
    return F.when(value.between(low, high) | value.isNull(), value).otherwise(F.raise_error(message).cast("bigint"))


def require_value(value: Column, dtype: str, label: str) -> Column:
    """The value itself; NULL fails the job."""
    return F.when(value.isNull(), F.raise_error(F.lit(f"{label} is required")).cast(dtype)).otherwise(value)


def rate(count: Column, population: Column, scale: float = 100000.0) -> Column:
    """``count * scale / population``; NULL for a NULL or zero population."""
    return count.cast("double") * F.lit(scale) / F.nullif(population, F.lit(0))
