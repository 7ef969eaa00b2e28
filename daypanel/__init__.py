"""Daily panel data (entity x day time series) as plain Spark DataFrame transformations.

Transformations take and return DataFrames and run no action, except where a docstring
says so (sinks, gates, and the operators that fix an order with a checkpoint).
"""

from daypanel.operators.dims import (
    assign_dense_ids, denormalize, first_row_attributes, last_wins_lookup, lookup_left_join, population_fallback,
    upsert_dimension,
)
from daypanel.operators.panel import (
    convert_units, daily_rollup, fill_to_next, forward_fill_gaps, per_capita, prev_day_delta, with_group_horizon,
    with_next_day,
)
from daypanel.plans.build import Landing, build, build_and_register
from daypanel.plans.store import open_tables
from daypanel.plans.views import register_views, view

__all__ = [
    "Landing", "assign_dense_ids", "build", "build_and_register", "convert_units", "daily_rollup", "denormalize",
    "fill_to_next", "first_row_attributes", "forward_fill_gaps", "last_wins_lookup", "lookup_left_join", "open_tables",
    "per_capita", "population_fallback", "prev_day_delta", "register_views", "upsert_dimension", "view",
    "with_group_horizon", "with_next_day",
]
