"""Lookups, dimensions and their surrogate keys.

Joins carry no hints where the other side's size is unknown: Catalyst broadcasts a side only when
its size is below the session's threshold and shuffles otherwise, and adaptive execution splits a
hot key of a shuffled join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from daypanel.session import durable

_PART = "__part"
_SEQ = "__seq"
_OFFSET = "__offset"


def last_wins_lookup(df: DataFrame, key: str, value: str, order: str | Sequence[str]) -> DataFrame:
    """``key -> value`` of the last row in ``order``, over the rows that have both.

    An aggregate, so hot keys shrink to one row per task before the shuffle.
    """
    known = df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    return known.groupBy(key).agg(F.max_by(value, _order_value(order)).alias(value))


def first_row_attributes(df: DataFrame, key: str, attributes: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """Attributes of the first row in ``order`` of every key, one row per key."""
    first = F.min_by(F.struct(*attributes), _order_value(order)).alias("first")
    return df.groupBy(key).agg(first).select(key, *[F.col(f"first.{a}").alias(a) for a in attributes])


def lookup_left_join(df: DataFrame, lookup: DataFrame, key: str, columns: Sequence[str],
                     spread_nulls: bool = False, lookup_is_larger: bool = False) -> DataFrame:
    """Left join to a lookup that may hold several rows per key; every match is kept.

    Rows whose key is NULL match nothing.  A shuffled join deals them to one partition, which adaptive
    execution splits; ``spread_nulls`` keeps them out of the join instead, at the price of reading ``df``
    twice, each time with a filter that reaches its files.  Either way only needed columns are read.

    lookup_is_larger: the lookup outgrows ``df``, perhaps with a hot key.  An outer join could neither
    broadcast ``df`` nor split the lookup's hot key; matches by an inner join and the rows without a
    match by an anti join to the distinct keys can do both, at the price of reading ``df`` twice.
    """
    right = lookup.where(F.col(key).isNotNull()).select(key, *columns)
    if lookup_is_larger:
        types = dict(right.dtypes)
        matched = df.join(right, key, "inner").select(*df.columns, *columns)
        alone = df.join(right.select(key).distinct(), key, "left_anti")
        return matched.unionByName(alone.withColumns({c: F.lit(None).cast(types[c]) for c in columns}))
    known = df.where(F.col(key).isNotNull()) if spread_nulls else df
    joined = known.join(right, key, "left").select(*df.columns, *columns)
    if not spread_nulls:
        return joined
    types = dict(right.dtypes)
    absent = df.where(F.col(key).isNull()).withColumns({c: F.lit(None).cast(types[c]) for c in columns})
    return joined.unionByName(absent)


def population_fallback(df: DataFrame, lookup: DataFrame, key: str, population: str, found: str) -> DataFrame:
    """Fill an absent ``population`` from the lookup's ``found`` column (one row per key)."""
    joined = lookup_left_join(df, lookup.select(key, F.col(found).alias("__found")), key, ["__found"])
    return joined.withColumn(population, F.coalesce(population, "__found")).select(*df.columns)


def denormalize(fact: DataFrame, dim: DataFrame, key: str, attributes: Mapping[str, str]) -> DataFrame:
    """Inner join to a dimension: its attributes (``stored name -> output name``) first, then the fact."""
    picked = dim.select(key, *[F.col(a).alias(out) for a, out in attributes.items()])
    return fact.join(picked, key, "inner").select(*attributes.values(), *fact.columns)


def assign_dense_ids(df: DataFrame, order: Sequence[str], id_name: str, start: Column | int = 0) -> DataFrame:
    """Number the rows ``start + 1, start + 2, ...`` in a total order, without a one-task window.

    Runs a job: the range-partitioned, sorted rows are checkpointed, so that the per-partition
    counts and the numbering see the very same partitions.  What is broadcast is one row per
    partition.
    """
    fixed = durable(df.repartitionByRange(*order).sortWithinPartitions(*order))
    # A row's position inside its partition is the low part of the monotonically increasing id.
    numbered = fixed.withColumns({
        _PART: F.spark_partition_id(),
        _SEQ: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    })
    # One task, but over one row per partition only.
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fixed.groupBy(F.spark_partition_id().alias(_PART)).agg(F.count("*").alias("n"))
        .select(_PART, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_OFFSET))
    )
    base = F.lit(start) if isinstance(start, int) else start
    new_id = (base + F.col(_OFFSET) + F.col(_SEQ) + 1).cast("bigint").alias(id_name)
    return numbered.join(F.broadcast(offsets), _PART, "inner").select(new_id, *df.columns)


def upsert_dimension(dim: DataFrame, facts: DataFrame, key: str, id_name: str, attributes: Sequence[str],
                     order: Sequence[str], id_order: Sequence[str] | None = None) -> DataFrame:
    """``dim`` plus a row for every key of ``facts`` that it lacks.

    A new row's attributes are those of its key's first row in ``order``.  New ids continue after
    the largest existing one, sorted by ``id_order`` (default: ``order``, then the key) of those
    first rows; it must tell new keys apart.

    Runs jobs.  The facts are read twice: once for their distinct keys, reduced in each task, and
    once for the rows of new keys; with no new key the dimension is returned as it is.
    """
    keys = facts.select(key).where(F.col(key).isNotNull()).distinct()
    new_keys = durable(keys.join(dim.select(key), key, "left_anti"))
    if new_keys.isEmpty():
        return dim
    wanted = [c for c in dict.fromkeys([*attributes, *order]) if c != key]
    misses = facts.select(key, *wanted).join(new_keys, key, "left_semi")
    first = first_row_attributes(misses, key, wanted, order)
    top = dim.agg(F.coalesce(F.max(id_name), F.lit(0))).scalar()
    new = assign_dense_ids(first, list(id_order or [*order, key]), id_name, top)
    return dim.unionByName(new.select(id_name, key, *attributes), allowMissingColumns=True)


def _order_value(order: str | Sequence[str]) -> Column:
    """One comparable value; a single column stays bare, which keeps the aggregation hash based."""
    names = [order] if isinstance(order, str) else list(order)
    return F.col(names[0]) if len(names) == 1 else F.struct(*names)
