"""The registered queries: name -> (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from daypanel.catalog import inputs
from daypanel.catalog.inputs import event_panel, order_panel, table
from daypanel.functions.calendar import (
    COMPACT_DATE, date_from_julian, julian_day, julian_from_ymd, on_days, parse_day, with_date_parts,
    with_julian_day, ymd_from_julian,
)
from daypanel.functions.numeric import round_half_away
from daypanel.functions.text import empty_to_null, null_to_empty, null_to_zero
from daypanel.operators import dims, panel, quality, summaries
from daypanel.plans import store
from daypanel.plans.build import build
from daypanel.plans.case_facts import CDATASET_RAW_KEY, base_locations, fips_population, prepare_sources
from daypanel.plans.views import VIEWS, register_views, view
from daypanel.session import scratch_path
from daypanel.sources import contracts
from daypanel.sources.case_series import align_schema, scan_case_series, union_sources
from daypanel.sources.contract import (
    INT, TEXT, Field, HeaderError, SourceContract, blank_lead_count, drop_blank_lead, read_contract, scan_contract, triage_contract,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    # A trailing underscore keeps a query apart from the operator it is named after.
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


# --- Previous-day deltas and gap filling ---------------------------------------------------------

DELTAS = {"n": "n_new", "cents": "cents_new"}


@query
def prev_day_delta(spark, sf_dir):
    daily = event_panel(spark, sf_dir)
    return with_date_parts(panel.prev_day_delta(daily, ["user_id"], "jd", DELTAS), "jd")


@query
def prev_day_delta_whole(spark, sf_dir):
    """The unsplit window gives the same rows."""
    daily = event_panel(spark, sf_dir)
    return with_date_parts(panel.prev_day_delta(daily, ["user_id"], "jd", DELTAS, split_days=None), "jd")


@query
def prev_day_delta_filtered(spark, sf_dir):
    coded = event_panel(spark, sf_dir).withColumn(
        "code", F.when((F.col("user_id") % 7 != 0) | (F.col("n") != 1), F.col("user_id"))
    )
    return panel.prev_day_delta(coded, ["user_id"], "jd", DELTAS).where(F.col("code").isNotNull())


@query
def prev_day_delta_long(spark, sf_dir):
    """Five entities over some two thousand days: every entity spans several window blocks."""
    return panel.prev_day_delta(order_panel(spark, sf_dir), ["o_orderpriority"], "jd", {"n": "n_new"})


def _with_roles(daily: DataFrame) -> DataFrame:
    """One column per role in gap filling: carried, zeroed, NULLed, advanced, advanced but sometimes NULL."""
    return daily.withColumns({
        "n_delta": F.col("n"),
        "n_pct": F.col("n") * 2,
        "index_0": F.col("n") + 100,
        "index_1": F.when(F.col("n") > 1, F.col("n")),
    })


FILL = {"zero": ["n_delta"], "null": ["n_pct"], "advance": ["index_0", "index_1"], "filled": "is_filled"}


@query
def gap_fill(spark, sf_dir):
    return panel.forward_fill_gaps(_with_roles(event_panel(spark, sf_dir)), ["user_id"], "jd", **FILL)


@query
def gap_fill_whole(spark, sf_dir):
    """The unsplit window gives the same rows."""
    daily = _with_roles(event_panel(spark, sf_dir))
    return panel.forward_fill_gaps(daily, ["user_id"], "jd", split_days=None, **FILL)


@query
def gap_fill_by_dataset(spark, sf_dir):
    """Each dataset (event type) is filled to its own latest day."""
    daily = event_panel(spark, sf_dir, "event_type")
    limited = panel.with_group_horizon(daily, ["event_type"], "jd")
    filled = panel.forward_fill_gaps(limited, ["event_type", "user_id"], "jd", zero=["n"], horizon="horizon")
    return filled.drop("horizon")


@query
def gap_fill_datasets_together(spark, sf_dir):
    """All datasets are filled to the latest day of the whole source."""
    daily = event_panel(spark, sf_dir, "event_type")
    return panel.forward_fill_gaps(daily, ["event_type", "user_id"], "jd", zero=["n"])


@query
def gap_fill_long(spark, sf_dir):
    """Sparse rows on a long axis: gaps reach over whole window blocks."""
    sparse = order_panel(spark, sf_dir, by_nation=True)
    return panel.forward_fill_gaps(
        sparse, ["c_nationkey", "o_orderpriority"], "jd", zero=["n"], filled="is_filled", split_days=7
    )


@query
def gap_fill_then_delta(spark, sf_dir):
    filled = panel.forward_fill_gaps(event_panel(spark, sf_dir), ["user_id"], "jd")
    return panel.prev_day_delta(filled, ["user_id"], "jd", {"cents": "cents_new"})


@query
def gap_fill_then_delta_whole(spark, sf_dir):
    """With unsplit windows the delta finds the filled rows where the filling left them: one shuffle for both."""
    filled = panel.forward_fill_gaps(event_panel(spark, sf_dir), ["user_id"], "jd", split_days=None)
    return panel.prev_day_delta(filled, ["user_id"], "jd", {"cents": "cents_new"}, split_days=None)


# --- Rates, roll-ups, derived columns ------------------------------------------------------------

def _nation_population(spark, sf_dir) -> DataFrame:
    """Suppliers per nation as its population: absent for some nations, zero for others."""
    per_nation = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.count("*").alias("suppliers")
    )
    return per_nation.withColumn(
        "population", F.when(F.col("nation") % 5 == 0, F.lit(0)).when(F.col("nation") % 3 != 0, F.col("suppliers"))
    ).select("nation", "population")


@query
def per_100k(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count("*").alias("customers"), F.count_if(F.col("c_acctbal") < 0).alias("debtors")
    )
    counted = customers.join(_nation_population(spark, sf_dir), "nation", "left").select(
        "nation", "population", "customers",
        F.when(F.col("debtors") > 2, F.col("debtors")).alias("debtors"),
        F.when(F.col("nation") % 7 == 0, F.lit(7.5)).alias("debtors_pop100k"),
    )
    return panel.per_capita(
        counted, {"customers": "customers_pop100k", "debtors": "debtors_pop100k"}, "population"
    )


@query
def population_fallback(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(
        F.when(F.col("n_nationkey") % 4 != 0, F.col("n_nationkey")).alias("fips"), "n_name",
        F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey").cast("bigint") * 1000).alias("population"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("fips"), F.floor("s_acctbal").alias("people"), "s_suppkey"
    )
    lookup = dims.last_wins_lookup(suppliers, "fips", "people", "s_suppkey")
    return dims.population_fallback(nations, lookup, "fips", "population", "people")


@query
def daily_rollup(spark, sf_dir):
    daily = event_panel(spark, sf_dir).withColumns({
        "odd_n": F.when(F.col("user_id") % 2 == 1, F.col("n")),
        "nothing": F.lit(None).cast("bigint"),
    })
    sums = panel.daily_rollup(daily, ["jd"], {"n": "n", "cents": "cents", "odd_n": "odd_n", "nothing": "nothing"})
    return with_date_parts(sums, "jd")


@query
def unit_convert(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    return panel.convert_units(lines, {"tax_10": ("l_tax", "/", 10.0), "discount_100": ("l_discount", "*", 100.0)})


@query
def derived_tests(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") % 4 != 0, F.col("p_size").cast("bigint")).alias("neg"),
        F.col("p_partkey").alias("pos"),
    )
    return parts.select(
        F.lit(34429).cast("bigint").alias("population"), (F.col("neg") + F.col("pos")).alias("tot"),
        (F.col("pos") - F.col("neg")).alias("diff"), *parts.columns,
    )


# --- Calendar, numbers, text ---------------------------------------------------------------------

def _orders_jd(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return with_julian_day(orders, "day").select("o_orderkey", "o_custkey", "date_julian")


@query
def date_parts(spark, sf_dir):
    return with_date_parts(_orders_jd(spark, sf_dir))


@query
def julian_day_(spark, sf_dir):
    d = date_from_julian("date_julian")
    ymd = ymd_from_julian("date_julian")
    return _orders_jd(spark, sf_dir).select(
        "o_orderkey", "date_julian", F.date_format(d, "yyyy-MM-dd").alias("day"),
        ymd["year"].alias("year"), ymd["month"].alias("month"), ymd["day"].alias("day_of_month"),
        julian_from_ymd(ymd["year"], ymd["month"], ymd["day"]).alias("again"),
        (julian_day(F.date_add(d, 1)) - F.col("date_julian")).alias("step"),
    )


@query
def parse_dates(spark, sf_dir):
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("compact"),
    )
    return texts.select(
        "o_orderkey", julian_day(parse_day("iso")).alias("jd_iso"),
        julian_day(parse_day("compact", COMPACT_DATE)).alias("jd_compact"),
    )


@query
def round_counts(spark, sf_dir):
    half = F.col("l_quantity") * 0.5
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        round_half_away(half).alias("up"), round_half_away(-half).alias("down"),
        round_half_away(F.when(F.col("l_linenumber") != 1, half)).alias("maybe"),
    )


def _labelled(spark, sf_dir) -> DataFrame:
    note = F.when(F.col("quality") == 1, F.lit("good")).otherwise(F.lit(""))
    labels = table(spark, sf_dir, "labels").withColumn("note", note)
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(labels, "doc_id", "left")


@query
def null_to_zero_(spark, sf_dir):
    return null_to_zero(_labelled(spark, sf_dir).select("doc_id", "quality", "toxic"), ["quality", "toxic"])


@query
def null_empty_text(spark, sf_dir):
    return _labelled(spark, sf_dir).select(
        "doc_id", null_to_empty(F.col("note")).alias("filled"), empty_to_null(F.col("note")).alias("emptied")
    )


# --- Projections and filters ---------------------------------------------------------------------

@query
def rename_columns(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return customers.withColumnsRenamed({"c_custkey": "uid", "c_name": "combined_key", "c_nationkey": "code3"})


@query
def drop_columns(spark, sf_dir):
    return table(spark, sf_dir, "customer").drop("c_acctbal", "c_mktsegment")


@query
def reorder_columns(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_mktsegment", "c_acctbal", "c_nationkey", "c_name", "c_custkey")


@query
def filter_day(spark, sf_dir):
    """A day filter on the stored integer, which the scan receives as a pushed predicate."""
    path = scratch_path(spark, "orders_by_day")
    stored = store.write_table(_orders_jd(spark, sf_dir), path)
    return with_date_parts(on_days(stored, "1997-05-28"))


@query
def filter_dataset(spark, sf_dir):
    """A dataset filter on a table partitioned by dataset: only that folder is read."""
    path = scratch_path(spark, "events_by_type")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("event_type").alias("dataset"))
    return store.write_table(events, path, ["dataset"]).where(F.col("dataset") == "purchase")


# --- Joins and dimensions ------------------------------------------------------------------------

@query
def dim_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("locid"), "o_orderstatus")
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "locid")
    return dims.denormalize(orders, customers, "locid", {"c_name": "label", "c_mktsegment": "region"})


@query
def lookup_left_join(spark, sf_dir):
    """Every supplier of a nation is kept; a nation without a code finds none."""
    nations = table(spark, sf_dir, "nation").select(
        F.when(F.col("n_nationkey") % 4 != 0, F.col("n_nationkey")).alias("fips"), "n_name"
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("fips"), "s_suppkey")
    return dims.lookup_left_join(nations, suppliers, "fips", ["s_suppkey"], lookup_is_larger=True)


@query
def lookup_left_join_facts(spark, sf_dir):
    """Every user and day with the population rows of the landed lookup file: none, one or two of them."""
    path = inputs.land_text(spark, sf_dir, contracts.LOC_LOOKUP)
    lookup = read_contract(spark, contracts.LOC_LOOKUP, path)
    coded = event_panel(spark, sf_dir).withColumn("fips", F.when(F.col("user_id") % 3 != 0, F.col("user_id")))
    return dims.lookup_left_join(coded, lookup, "fips", ["population"])


@query
def last_wins_lookup(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn(
        "amount", F.when(F.col("event_type") != "error", round_half_away(F.col("value") * 100))
    )
    return dims.last_wins_lookup(events, "user_id", "amount", "event_id")


@query
def first_row_attrs(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return dims.first_row_attributes(events, "user_id", ["event_type", "props"], ["ts", "event_id"])


@query
def dim_upsert(spark, sf_dir):
    """Locations known from the customers in credit; those of the events are added."""
    base = table(spark, sf_dir, "customer").where("c_acctbal >= 0").select(
        (F.col("c_custkey") + 1).alias("locid"), F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("label"),
    )
    facts = table(spark, sf_dir, "events").withColumn("label", F.col("event_type"))
    return dims.upsert_dimension(base, facts, "user_id", "locid", ["label"], ["event_id"])


@query
def dense_ids(spark, sf_dir):
    """Every order numbered in date order."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("day")
    )
    return dims.assign_dense_ids(orders, ["day", "o_orderkey"], "locid")


@query
def location_ids(spark, sf_dir):
    """The landed location map with ids in file order."""
    path = inputs.land_text(spark, sf_dir, contracts.LOCATION_MAP)
    return base_locations(read_contract(spark, contracts.LOCATION_MAP, path, with_order=True))


@query
def fips_lookup(spark, sf_dir):
    """The landed lookup file reduced to the last population per code."""
    path = inputs.land_text(spark, sf_dir, contracts.LOC_LOOKUP)
    return fips_population(read_contract(spark, contracts.LOC_LOOKUP, path, with_order=True))


# --- Sorting, distinct, counts -------------------------------------------------------------------

@query
def sorted_series(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("dataset"), F.col("user_id").alias("location_key"),
        F.col("ts").cast("date").cast("string").alias("date"), "event_id",
    )
    return summaries.sorted_series(events, ["dataset", "location_key", "date"], tie=["event_id"])


@query
def distinct_datasets(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "dataset")
    return summaries.distinct_sorted(events, "dataset")


ALL_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


@query
def row_counts(spark, sf_dir):
    return summaries.row_counts({t: table(spark, sf_dir, t) for t in ALL_TABLES})


@query
def row_count_gate(spark, sf_dir):
    counts = summaries.row_counts({t: table(spark, sf_dir, t) for t in ALL_TABLES})
    return quality.row_count_gate(counts, {"lineitem": 10000, "orders": 10_000_000, "events": 1000})


@query
def max_day_per_source(spark, sf_dir):
    return summaries.max_day_per_source({
        "events": table(spark, sf_dir, "events").select(julian_day(F.col("ts").cast("date")).alias("jd")),
        "orders": table(spark, sf_dir, "orders").select(julian_day(F.col("o_orderdate").cast("date")).alias("jd")),
        "lineitem": table(spark, sf_dir, "lineitem").select(julian_day(F.col("l_shipdate").cast("date")).alias("jd")),
    }, "jd")


# --- Case series ---------------------------------------------------------------------------------

@query
def case_series_scan(spark, sf_dir):
    """The landed case series, read by column name and united; missing columns are NULL."""
    sources = [scan_case_series(spark, path) for path in inputs.land_series(spark, sf_dir)]
    return prepare_sources(sources).select(
        "source_ord", "dataset", "location_key", "date_julian", "horizon", "province", "absolute_confirmed",
        "absolute_recovered", "delta_pop100k_infected", "factbook_population",
    )


@query
def align_schema_(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("value").alias("surplus"))
    mandatory = T.StructType().add("event_id", T.LongType()).add("user_id", T.IntegerType())
    optional = T.StructType().add("province", T.StringType()).add("delta", T.LongType())
    return align_schema(events, mandatory, optional)


@query
def union_sources_(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    purchases = events.where("event_type = 'purchase'").select(
        "event_id", "user_id", round_half_away(F.col("value") * 100).alias("cents")
    )
    others = events.where("event_type is distinct from 'purchase'").select("user_id", "event_id")
    return union_sources([purchases, others])


# --- Data quality --------------------------------------------------------------------------------

@query
def unique_violations(spark, sf_dir):
    return quality.unique_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def not_null_violations(spark, sf_dir):
    return quality.not_null_violations(_labelled(spark, sf_dir), ["doc_id", "lang", "quality", "toxic", "note"])


@query
def point_expectations(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") > 25, F.col("p_size").cast("bigint")).alias("big")
    )
    return quality.point_expectations({"orders": orders, "part": parts}, [
        quality.Expectation("orders", "o_orderkey = 0", "o_custkey", 899),
        quality.Expectation("orders", "o_orderkey = 1", "o_custkey", 1),
        quality.Expectation("orders", "o_orderkey = -1", "o_custkey", 1),
        quality.Expectation("part", "p_partkey = 0", "big", None),
        quality.Expectation("part", "p_partkey = 1", "big", 28),
    ])


@query
def quality_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", (F.col("l_partkey") * 10_000_000).alias("wide"),
        (F.col("l_linenumber").cast("bigint") - 2).alias("low"),
    )
    return quality.range_violations(lines, {
        "l_orderkey": quality.UNSIGNED_64, "wide": quality.UNSIGNED_32, "low": quality.UNSIGNED_32,
    })


# --- Text sources --------------------------------------------------------------------------------

@query
def contract_scan(spark, sf_dir):
    return read_contract(spark, contracts.NYTCOUNTIES, inputs.land_text(spark, sf_dir, contracts.NYTCOUNTIES))


@query
def refused_headers(spark, sf_dir):
    """Which of four landed headers over the same rows the contract refuses, and how many rows come in through the others."""
    found = []
    for variant, path in inputs.land_headers(spark, sf_dir).items():
        try:
            n_rows = read_contract(spark, contracts.NYTCOUNTIES, path).count()
        except HeaderError:
            n_rows = None
        found.append((variant, n_rows is None, n_rows))
    return spark.createDataFrame(found, "variant string, refused boolean, n_rows bigint")


@query
def contract_scan_tsv(spark, sf_dir):
    return read_contract(spark, contracts.LOCATION_MAP, inputs.land_text(spark, sf_dir, contracts.LOCATION_MAP))


@query
def contract_scan_lookup(spark, sf_dir):
    return read_contract(spark, contracts.LOC_LOOKUP, inputs.land_text(spark, sf_dir, contracts.LOC_LOOKUP))


@query
def contract_scan_compact_dates(spark, sf_dir):
    return read_contract(spark, contracts.COVIDTRACKING, inputs.land_text(spark, sf_dir, contracts.COVIDTRACKING))


@query
def contract_scan_wide(spark, sf_dir):
    return read_contract(spark, contracts.OWID, inputs.land_text(spark, sf_dir, contracts.OWID))


@query
def contract_scan_rounded(spark, sf_dir):
    return read_contract(spark, contracts.RTLIVE, inputs.land_text(spark, sf_dir, contracts.RTLIVE))


@query
def blank_lead_rows(spark, sf_dir):
    """How many landed rows the world source loses for their empty first field."""
    path = inputs.land_text(spark, sf_dir, contracts.OWID)
    return blank_lead_count(contracts.OWID, scan_contract(spark, contracts.OWID, path))


@query
def drop_blank_lead_(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        F.when(F.col("lang") == "en", F.lit("")).when(F.col("lang") != "fr", F.col("lang")).alias("lead"), "doc_id"
    )
    return drop_blank_lead(documents, "lead")


ORDER_LINES = SourceContract(
    name="order_lines",
    fields=(Field("orderkey", INT), Field("status", TEXT), Field("custkey", INT, optional=True)),
    layout=("orderkey", "status", "custkey"),
    key=("orderkey",),
)


def _damaged_orders(spark, sf_dir) -> str:
    """The orders as text: by priority a line is sound, too long, too short, or has text for a number."""
    key, status, customer = (F.col(c).cast("string") for c in ("o_orderkey", "o_orderstatus", "o_custkey"))
    kind = F.substring("o_orderpriority", 1, 1)
    line = (
        F.when(kind == "1", F.concat_ws(",", key, status, customer, F.lit("surplus")))
        .when(kind == "2", F.concat_ws(",", key, status))
        .when(kind == "3", F.concat_ws(",", key, status, F.lit("many")))
        .otherwise(F.concat_ws(",", key, status, customer))
    )
    path = scratch_path(spark, "order_lines")
    orders = table(spark, sf_dir, "orders").select(line.alias("line"))
    # The column's name is the header line of every file.
    plain = orders.withColumnRenamed("line", ",".join(ORDER_LINES.header)).write.option("header", True)
    plain.option("sep", "\u0001").option("quote", "").option("escapeQuotes", False).csv(path)
    return path


@query
def ragged_rows(spark, sf_dir):
    """Rows that decode once surplus fields are ignored."""
    return triage_contract(spark, ORDER_LINES, _damaged_orders(spark, sf_dir), allow_extra=True)[0]


@query
def sound_rows(spark, sf_dir):
    """Rows that decode as they stand."""
    return triage_contract(spark, ORDER_LINES, _damaged_orders(spark, sf_dir))[0]


@query
def bad_rows(spark, sf_dir):
    """Rows that do not decode: their first field, if that much decodes, and the raw line."""
    rejects = triage_contract(spark, ORDER_LINES, _damaged_orders(spark, sf_dir))[1]
    return rejects.withColumnRenamed("_corrupt_record", "line")


# --- Sinks, build, views -------------------------------------------------------------------------

@query
def table_sink(spark, sf_dir):
    """A panel written twice, partitioned by dataset: first a new table, then rows appended to it."""
    path = scratch_path(spark, "sink")
    daily = event_panel(spark, sf_dir, "event_type").withColumnRenamed("event_type", "dataset")
    store.write_table(daily.where("n = 1"), path, ["dataset"])
    return store.write_table(daily.where("n > 1"), path, ["dataset"], mode="append")


@query
def publish_gate(spark, sf_dir):
    """A build that breaks a rule is not published: the former build stays the one that is read."""
    landed = inputs.landing(spark, sf_dir)
    root = inputs.built_root(spark, sf_dir)
    before = store.published_build(spark, root)
    try:
        build(spark, landed, root, minimum_rows={"cdataset": 1 << 60}, expectations=())
        stopped = False
    except quality.QualityError:
        stopped = True
    tables = store.open_tables(spark, root)
    return summaries.row_counts(tables).withColumns({
        "stopped": F.lit(stopped), "unchanged": F.lit(store.published_build(spark, root) == before),
    })


@query
def build_meta(spark, sf_dir):
    """Every table of a published build with its row count and the build's schema version."""
    tables = store.open_tables(spark, inputs.built_root(spark, sf_dir))
    version = tables["build_meta"].where("field = 'schemaver'").select("value").scalar()
    return summaries.row_counts(tables).withColumn("schemaver", version)


@query
def cdataset_raw(spark, sf_dir):
    """The stored fact table itself: one row per dataset, location and day."""
    return store.open_tables(spark, inputs.built_root(spark, sf_dir))["cdataset_raw"]


@query
def cdataset_raw_key(spark, sf_dir):
    """Keys of the stored fact table that are not unique: none."""
    facts = store.open_tables(spark, inputs.built_root(spark, sf_dir))["cdataset_raw"]
    return quality.unique_violations(facts, CDATASET_RAW_KEY)


@query
def cdataset_loc(spark, sf_dir):
    """The stored location dimension."""
    return store.open_tables(spark, inputs.built_root(spark, sf_dir))["cdataset_loc"]


@query
def ragged_build(spark, sf_dir):
    """What a build over a damaged source put aside, and why."""
    rejects = store.open_report(spark, inputs.twice_built_root(spark, sf_dir), 1)["rejects"]
    return rejects.select("source", "line", "reason")


@query
def build_report(spark, sf_dir):
    """What the same build read, left out and stored."""
    return store.open_report(spark, inputs.twice_built_root(spark, sf_dir), 1)["build_report"]


@query
def former_build(spark, sf_dir):
    """The tables of that build, which another has replaced."""
    return summaries.row_counts(store.open_tables(spark, inputs.twice_built_root(spark, sf_dir), 1))


@query
def replaced_build(spark, sf_dir):
    """The tables of the build that replaced it, with all commits there are."""
    root = inputs.twice_built_root(spark, sf_dir)
    numbers = F.lit(",".join(map(str, store.commits(spark, root))))
    return summaries.row_counts(store.open_tables(spark, root)).withColumn("commits", numbers)


def _in_other_session(spark, sf_dir, where: str) -> DataFrame:
    """Rows, days and days' range of every view in the catalog, asked for by SQL in a session of its own."""
    database, session = inputs.catalog_database(spark, sf_dir), spark.newSession()
    return session.sql(" union all ".join(
        f"select '{v}' as view_name, count(*) as n_rows, count(distinct date) as n_days, min(date) as first_day, max(date_julian) as last_day "
        f"from {database}.{v} where {where}" for v in VIEWS))


@query
def permanent_views(spark, sf_dir):
    """The seven views as another session sees them."""
    return _in_other_session(spark, sf_dir, "true")


@query
def filter_day_views(spark, sf_dir):
    """A user's filter on the text date of every view, which reaches the files."""
    return _in_other_session(spark, sf_dir, "date = '2024-01-11'")


@query
def filter_days_counties(spark, sf_dir):
    """A span of text dates of the county view, with the deltas of its first day."""
    return spark.sql(f"select * from {inputs.catalog_database(spark, sf_dir)}.nytcounties where date between '2024-01-10' and '2024-01-12'")


def _bucketed(spark, daily: DataFrame) -> DataFrame:
    name = f"panel_{uuid.uuid4().hex}"
    return store.write_bucketed(daily, name, scratch_path(spark, name), ["user_id"], "jd", 8)


@query
def stored_delta(spark, sf_dir):
    """Deltas over a panel stored in buckets by entity: no shuffle."""
    return panel.prev_day_delta(_bucketed(spark, event_panel(spark, sf_dir)), ["user_id"], "jd", DELTAS)


@query
def stored_fill(spark, sf_dir):
    """Gap filling over the same."""
    return panel.forward_fill_gaps(_bucketed(spark, _with_roles(event_panel(spark, sf_dir))), ["user_id"], "jd", **FILL)


@query
def replaced_bytes(spark, sf_dir):
    """A source that is not the UTF-8 it is read as: its other bytes are kept as U+FFFD, and no row is lost."""
    path = scratch_path(spark, "other_bytes")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("orderkey"), F.concat(F.lit("caf\u00e9 "), "c_mktsegment").alias("status"), F.col("c_nationkey").alias("custkey"))
    customers.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return read_contract(spark, ORDER_LINES, path)


@query
def views_registered(spark, sf_dir):
    """A user's SQL over the registered view."""
    register_views(spark, store.open_tables(spark, inputs.built_root(spark, sf_dir)))
    return spark.sql("""
        select dataset, date, count(*) as locations, sum(absolute_confirmed) as confirmed,
               sum(delta_deaths) as new_deaths
        from cdataset where date >= '2024-01-10' group by dataset, date order by dataset, date
    """)


@query
def nytcounties_days(spark, sf_dir):
    """A span of days of the county view; the day before it is read for the deltas, and no other."""
    tables = store.open_tables(spark, inputs.built_root(spark, sf_dir))
    return view("nytcounties", tables, days=("2024-01-10", "2024-01-12"))


def _view_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return view(name, store.open_tables(spark, inputs.built_root(spark, sf_dir)))

    run.__doc__ = f"The view {name} over a published build."
    return run


QUERIES |= {f"view_{name}": _view_query(name) for name in VIEWS}
