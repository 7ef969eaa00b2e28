"""Julian days, date parts and strict date parsing.

The time axis of every stored panel is ``date_julian``, an integer that grows by one per
calendar day.  Being a plain integer column it is also what day filters may use: a
predicate on it reaches the Parquet scan, and so does one on a stored text ``date``, but not one on a derived text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: Julian day number of 1970-01-01.
EPOCH_JULIAN = 2440588

ISO_DATE = "yyyy-M-d"
COMPACT_DATE = "yyyyMMdd"


def julian_day(date: Column | str) -> Column:
    """DATE -> Julian day (INT)."""
    return F.unix_date(_col(date)) + F.lit(EPOCH_JULIAN)


def date_from_julian(jd: Column | str) -> Column:
    """Julian day -> DATE."""
    return F.date_from_unix_date((_col(jd) - F.lit(EPOCH_JULIAN)).cast("int"))


def julian_from_ymd(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """Year, month, day integers -> Julian day; an impossible date raises in ANSI mode."""
    return julian_day(F.make_date(_col(year), _col(month), _col(day)))


def ymd_from_julian(jd: Column | str) -> Column:
    """Julian day -> struct of integer year, month and day."""
    d = date_from_julian(jd)
    return F.struct(F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"))


def parse_day(text: Column | str, fmt: str = ISO_DATE) -> Column:
    """Text -> DATE.  Text that is not a date fails the job, whatever the session's ANSI mode."""
    c = _col(text)
    parsed = F.try_to_date(c, fmt)
    bad = F.raise_error(F.concat(F.lit(f"not a date in format {fmt}: "), c)).cast("date")
    return F.when(c.isNotNull() & parsed.isNull(), bad).otherwise(parsed)


def try_parse_day(text: Column | str, fmt: str = ISO_DATE) -> Column:
    """Like :func:`parse_day`, with NULL for text that is not a date (triage)."""
    return F.try_to_date(_col(text), fmt)


def day_text(jd: Column | str) -> Column:
    """Julian day -> ``yyyy-MM-dd``."""
    return date_from_julian(jd).cast("string")


def date_part_columns(jd: Column | str, text: Column | None = None) -> list[Column]:
    """The four text columns every view starts with, zero padded.

    A DATE as text is already ``yyyy-MM-dd``; its parts are cut out of it, which spares every row
    four runs of a date formatter.  text: the day as stored text, if there is one.
    """
    text = day_text(jd) if text is None else text
    return [
        text.alias("date"),
        F.substring(text, 1, 4).alias("date_year"),
        F.substring(text, 6, 2).alias("date_month"),
        F.substring(text, 9, 2).alias("date_day"),
    ]


def with_date_parts(df: DataFrame, jd: str = "date_julian", derived: list[Column] | None = None) -> DataFrame:
    """Date parts first, then ``derived`` columns, then every column of ``df``.

    A text column ``date`` of ``df`` is taken as it stands, so that filters on it reach the files it is read from.
    """
    stored = F.col("date") if "date" in df.columns else None
    rest = [F.col(c) for c in df.columns if c not in ("date", "date_next")] if stored is not None else [F.col(c) for c in df.columns]
    return df.select(*date_part_columns(jd, stored), *(derived or []), *rest)


def with_julian_day(df: DataFrame, date: str, name: str = "date_julian") -> DataFrame:
    """Add the Julian day of a DATE column."""
    return df.withColumn(name, julian_day(date))


def to_julian(day: str | dt.date | int) -> int:
    """A calendar day given by the caller as the Julian day literal to filter with."""
    if isinstance(day, int):
        return day
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    return (day - dt.date(1970, 1, 1)).days + EPOCH_JULIAN


def on_days(df: DataFrame, first: str | dt.date | int, last: str | dt.date | int | None = None,
            jd: str = "date_julian") -> DataFrame:
    """Keep the days ``first`` to ``last`` (default: just ``first``) with a predicate on the stored integer."""
    lo = to_julian(first)
    hi = lo if last is None else to_julian(last)
    return df.where(F.col(jd) == lo) if lo == hi else df.where(F.col(jd).between(lo, hi))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
