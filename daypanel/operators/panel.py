"""Operations on a panel: one row per entity and day, the day being an integer column.

How the two window operators stay balanced.  An entity has one row per day (a second one fails the
job), so a window's group is bounded by the calendar: a century is 36 525 rows.  One shuffle and one
sort by entity serve all measures, and a table already bucketed by entity needs no shuffle.

For axes finer than a day ``split_days`` cuts an entity's axis into blocks of so many units, and the
windows run per (entity, block).  What crosses a block border is carried explicitly (one repeated
row, or one border day per block), so the results are those of the unsplit window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from daypanel.functions.numeric import rate
from daypanel.session import durable

_BLOCK = "__block"
_GHOST = "__ghost"
_NEXT = "__next_day"
_FIRST = "__first_day"
_NEXT_FIRST = "__next_first_day"
_HORIZON = "__horizon"
_STEP = "__step"


def prev_day_delta(df: DataFrame, entity: Sequence[str], day: str, measures: Mapping[str, str],
                   split_days: int | None = None) -> DataFrame:
    """Add ``measure - measure on the previous calendar day`` for each ``measure -> output name``.

    NULL on an entity's first day and on the day after a gap: what counts is the calendar day
    before, not the row before.  A row whose entity or day is NULL equals no other row and gets NULL.
    A second row for the same entity and day fails the job.  All measures share one window, hence one
    shuffle and one sort.
    """
    keyed = _all_known([*entity, day])
    found_twice = F.raise_error(_duplicate([*entity, day]))

    def deltas(group: WindowSpec) -> dict[str, Column]:
        prev, following = group.rangeBetween(-1, -1), F.lead(day).over(group)
        return {out: F.when(keyed & (following == F.col(day)), found_twice)
                .when(keyed, F.col(m) - F.max(m).over(prev)) for m, out in measures.items()}

    if split_days is None:
        return df.withColumns(deltas(Window.partitionBy(*entity).orderBy(day)))
    # The last day of a block is also sent to the next block, where it only serves as "yesterday".
    border = keyed & (F.pmod(F.col(day), F.lit(split_days)) == split_days - 1)
    copies = F.when(border, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    # Rows without a full key need no company: what key they have spreads them, instead of the entity's block.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64(*entity, day), F.lit(16 * tasks)).cast("int")
    block = F.when(keyed, _block(day, split_days) + F.col(_GHOST) * split_days).otherwise(spread)
    blocked = df.withColumn(_GHOST, F.explode(copies)).withColumn(_BLOCK, block)
    blocked = blocked.repartition(*[F.col(c) for c in entity], F.col(_BLOCK))
    return blocked.withColumns(deltas(Window.partitionBy(*entity, _BLOCK).orderBy(day))).where(F.col(_GHOST) == 0).drop(_GHOST, _BLOCK)


def forward_fill_gaps(df: DataFrame, entity: Sequence[str], day: str, *,
                      zero: Sequence[str] = (), null: Sequence[str] = (), advance: Sequence[str] = (),
                      horizon: str | Column | None = None, filled: str | None = None,
                      split_days: int | None = None) -> DataFrame:
    """One row for every day from an entity's first observation to the horizon.

    A missing day repeats the latest observation, except that ``zero`` columns become 0, ``null``
    columns NULL, and ``advance`` columns grow by one per filled day (NULL stays NULL).  Nothing is
    added before an entity's first row.  A NULL or duplicate entity and day fails the job.

    horizon: last day to fill to.  Default is the latest day of the whole table (one scalar
    subquery); a column name or expression gives it per row, see :func:`with_group_horizon`.
    filled: name of an optional BOOLEAN output column that marks added rows.
    """
    limit = df.agg(F.max(day)).scalar() if horizon is None else horizon
    dated = with_next_day(df, entity, day, _NEXT, split_days)
    return fill_to_next(dated, day, _NEXT, limit, zero=zero, null=null, advance=advance, filled=filled).drop(_NEXT)


def with_next_day(df: DataFrame, entity: Sequence[str], day: str, name: str = "next_day",
                  split_days: int | None = None) -> DataFrame:
    """Add the entity's next observed day, NULL on its last.

    A NULL entity or day fails the job, and so does a second row for the same entity and day: it
    would be the next row in order, so the check costs nothing.
    """
    key = [*entity, day]
    no_key = F.raise_error(F.lit(f"NULL in panel key {key}")).cast("int")

    def checked(following: Column) -> Column:
        return (
            F.when(~_all_known(key), no_key)
            .when(following == F.col(day), F.raise_error(_duplicate(key)).cast("int"))
            .otherwise(following)
        )

    if split_days is None:
        return df.withColumn(name, checked(F.lead(day).over(Window.partitionBy(*entity).orderBy(day))))
    # Inside a block: the next row.  For a block's last row: the first day of the entity's next block,
    # from a per-block summary that reads only the key and day columns.
    blocked = df.withColumn(_BLOCK, _block(day, split_days))
    following = (
        blocked.groupBy(*entity, _BLOCK).agg(F.min(day).alias(_FIRST))
        .withColumn(_NEXT_FIRST, F.lead(_FIRST).over(Window.partitionBy(*entity).orderBy(_BLOCK)))
        .drop(_FIRST)
    )
    inside = Window.partitionBy(*entity, _BLOCK).orderBy(day)
    joined = (
        blocked.repartition(*[F.col(c) for c in entity], F.col(_BLOCK))
        .withColumn(name, F.lead(day).over(inside))
        .join(following, [*entity, _BLOCK], "left")
    )
    return joined.select(*df.columns, checked(F.coalesce(name, _NEXT_FIRST)).alias(name))


def fill_to_next(df: DataFrame, day: str, next_day: str, horizon: str | Column, *,
                 zero: Sequence[str] = (), null: Sequence[str] = (), advance: Sequence[str] = (),
                 filled: str | None = None) -> DataFrame:
    """Repeat every row up to the day before ``next_day``, or up to the horizon where that is NULL.

    Row by row, without a shuffle; the roles are those of :func:`forward_fill_gaps`.
    """
    unknown = {*zero, *null, *advance} - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns to fill: {sorted(unknown)}")
    # The horizon is attached once: a scalar subquery repeated in an expression stays one column.
    limited = df.withColumn(_HORIZON, F.col(horizon) if isinstance(horizon, str) else horizon)
    last = F.coalesce(F.col(next_day) - 1, F.col(_HORIZON))
    steps = F.sequence(F.lit(0), F.greatest(last - F.col(day), F.lit(0)).cast("int"))
    k = F.col(_STEP)
    types = dict(df.dtypes)

    def on_fill(name: str) -> Column:
        c = F.col(name)
        if name == day or name in advance:
            return (c + k).cast(types[name]).alias(name)
        if name in zero:
            return F.when(k > 0, F.lit(0).cast(types[name])).otherwise(c).alias(name)
        if name in null:
            return F.when(k > 0, F.lit(None).cast(types[name])).otherwise(c).alias(name)
        return c

    flag = [(k > 0).alias(filled)] if filled else []
    exploded = limited.select(*df.columns, F.explode(steps).alias(_STEP))
    return exploded.select(*[on_fill(c) for c in df.columns], *flag)


def with_group_horizon(df: DataFrame, group: Sequence[str], day: str, name: str = "horizon") -> DataFrame:
    """Add the latest day of each row's group, for ``forward_fill_gaps(horizon=name)``.

    Runs a job for the maxima, which are partially aggregated and one row per group.  How they are
    joined is left to adaptive execution, which goes by measured bytes and splits a hot group.
    """
    maxima = durable(df.groupBy(*group).agg(F.max(day).alias(name)))
    return df.join(maxima, list(group), "left").select(*df.columns, name)


def per_capita(df: DataFrame, measures: Mapping[str, str], population: str, scale: float = 100000.0) -> DataFrame:
    """Rates per ``scale`` inhabitants for each ``count column -> rate column``.

    A rate that the input already holds wins.  Otherwise a known population gives
    ``count * scale / population`` with an absent count taken as 0; an unknown or zero population
    gives NULL.
    """
    def one(count: str, out: str) -> Column:
        computed = rate(F.coalesce(F.col(count), F.lit(0)), F.col(population), scale)
        return F.coalesce(F.col(out), computed) if out in df.columns else computed

    return df.withColumns({out: one(count, out) for count, out in measures.items()})


def daily_rollup(df: DataFrame, by: Sequence[str], measures: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Sums over all entities per day: NULLs are skipped, and a group of NULLs only gives NULL."""
    names = measures if isinstance(measures, Mapping) else {m: m for m in measures}
    return df.groupBy(*by).agg(*[F.sum(m).alias(out) for m, out in names.items()])


def unit_columns(spec: Mapping[str, tuple[str, str, float]]) -> list[Column]:
    """Columns for ``output -> (input, "/" or "*", factor)``."""
    def one(source: str, op: str, factor: float) -> Column:
        if op == "/":
            return F.col(source) / F.lit(factor)
        if op == "*":
            return F.col(source) * F.lit(factor)
        raise ValueError(f"unit conversion must be '/' or '*', not {op!r}")

    return [one(*how).alias(out) for out, how in spec.items()]


def convert_units(df: DataFrame, spec: Mapping[str, tuple[str, str, float]]) -> DataFrame:
    """Put the converted columns in front of the columns of ``df``."""
    return df.select(*unit_columns(spec), *df.columns)


def _duplicate(key: Sequence[str]) -> Column:
    shown = F.concat_ws(", ", *[F.col(c).cast("string") for c in key])
    return F.concat(F.lit(f"duplicate panel key {[*key]}: "), shown)


def _all_known(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def _block(day: str, split_days: int) -> Column:
    """First day of the block a day lies in."""
    return (F.col(day) - F.pmod(F.col(day), F.lit(split_days))).cast("int")
