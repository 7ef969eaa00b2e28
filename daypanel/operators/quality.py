"""Checks as DataFrames, and the gate that stops a build."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from daypanel.functions.numeric import INT64_MAX, UINT32_MAX


class QualityError(RuntimeError):
    """A build whose data breaks a declared rule."""


@dataclass(frozen=True)
class Expectation:
    """``column`` of the row of ``table`` that ``where`` selects must be ``expected`` (None: NULL)."""

    table: str
    where: str
    column: str
    expected: int | None


def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with ``row_count``.  A NULL key part collides with nothing."""
    known = reduce(and_, [F.col(c).isNotNull() for c in key])
    return df.where(known).groupBy(*key).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def not_null_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column with its number of NULLs, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], list(required), "column_name", "null_count")


def range_violations(df: DataFrame, bounds: Mapping[str, tuple[int, int]]) -> DataFrame:
    """One row per column with the number of values that would not survive a checked integer cast."""
    counts = df.agg(*[
        F.count_if(~F.col(c).between(low, high)).alias(c) for c, (low, high) in bounds.items()
    ])
    return counts.unpivot([], list(bounds), "column_name", "out_of_range")


# The ranges of the unsigned source columns.
UNSIGNED_32 = (0, UINT32_MAX)
UNSIGNED_64 = (0, INT64_MAX)


def row_count_gate(counts: DataFrame, minimum: Mapping[str, int]) -> DataFrame:
    """``row_counts`` of the tables that have a minimum, with the verdict ``passed``."""
    lookup = F.create_map(*[F.lit(x) for pair in minimum.items() for x in (pair[0], int(pair[1]))])
    least = F.element_at(lookup, F.col("table_name")).cast("bigint")
    return (
        counts.where(F.col("table_name").isin(*minimum))
        .withColumn("min_rows", least)
        .withColumn("passed", F.col("row_count") >= F.col("min_rows"))
    )


def point_expectations(tables: Mapping[str, DataFrame], expectations: Sequence[Expectation]) -> DataFrame:
    """Evaluate the expectations, one aggregate per table, NULL-safe.

    An expectation passes when its filter finds a row and every row found holds the expected value.
    """
    def of_table(name: str) -> DataFrame:
        wanted = [e for e in expectations if e.table == name]
        aggregates = expectation_counts(wanted)
        verdicts = [
            F.struct(
                F.lit(e.table).alias("table_name"),
                F.lit(e.where).alias("condition"),
                F.lit(e.column).alias("column_name"),
                F.lit(e.expected).cast("bigint").alias("expected"),
                F.col(f"actual{i}").alias("actual"),
                ((F.col(f"rows{i}") > 0) & (F.col(f"equal{i}") == F.col(f"rows{i}"))).alias("passed"),
            )
            for i, e in enumerate(wanted)
        ]
        return tables[name].agg(*aggregates).select(F.inline(F.array(*verdicts)))

    return reduce(DataFrame.unionAll, [of_table(n) for n in dict.fromkeys(e.table for e in expectations)])


def expectation_counts(expectations: Sequence[Expectation]) -> list[Column]:
    """Aggregates that tell whether the expectations hold, to be taken over the rows or observed while they pass by."""
    aggregates = []
    for i, e in enumerate(expectations):
        hit = F.expr(e.where)
        equal = F.col(e.column).eqNullSafe(F.lit(e.expected).cast("bigint"))
        aggregates += [
            F.count_if(hit).alias(f"rows{i}"),
            F.max(F.when(hit, F.col(e.column))).cast("bigint").alias(f"actual{i}"),
            F.count_if(hit & equal).alias(f"equal{i}"),
        ]
    return aggregates


def failed_expectations(expectations: Sequence[Expectation], counts: Mapping[str, int | None]) -> list[str]:
    """Descriptions of the expectations that the values of :func:`expectation_counts` do not bear out."""
    return [
        f"{e.table} where {e.where}: {e.column} is {counts[f'actual{i}']} in {counts[f'rows{i}']} rows, not {e.expected}"
        for i, e in enumerate(expectations) if not counts[f"rows{i}"] or counts[f"equal{i}"] != counts[f"rows{i}"]
    ]


def stop_on(label: str, violations: DataFrame, shown: int = 20) -> None:
    """Raise :class:`QualityError` if ``violations`` has a row.  Runs a job; at most ``shown`` rows are fetched."""
    found = violations.limit(shown).collect()
    if found:
        rows = "; ".join(str(r.asDict()) for r in found)
        raise QualityError(f"{label}: {rows}")


def publish_gate(df: DataFrame, label: str, key: Sequence[str], required: Sequence[str] = ()) -> None:
    """Stop unless the key is unique and the required columns are complete.  Runs one job."""
    def described(violations: DataFrame, rule: str, detail: Sequence[str]) -> DataFrame:
        return violations.select(F.lit(rule).alias("rule"), F.to_json(F.struct(*detail)).alias("found"))

    broken = described(unique_violations(df, key), "duplicate key", [*key, "row_count"])
    if required:
        incomplete = not_null_violations(df, required).where("null_count > 0")
        broken = broken.unionAll(described(incomplete, "NULL in required column", ["column_name", "null_count"]))
    stop_on(label, broken)
