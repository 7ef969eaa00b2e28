"""Inputs of the catalogue's queries: the given tables, a panel, and landed sources derived from them.

The landed sources have the very headers and types of the source contracts; every row in them is
computed by Spark from the given tables, so they grow with those.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from daypanel.catalog import expected
from daypanel.functions.calendar import julian_day
from daypanel.functions.numeric import round_half_away
from daypanel.plans.build import UNGATED, Landing, Tolerance, build
from daypanel.plans.catalog_views import publish_catalog
from daypanel.session import scratch_path, tuned
from daypanel.sources.case_series import MANDATORY, OPTIONAL
from daypanel.sources.contract import INT, SourceContract
from daypanel.sources.contracts import (
    CONTRACTS, COVIDTRACKING, HARVEYCODATA, LOC_LOOKUP, LOCATION_MAP, NYTCOUNTIES, OWID, RTLIVE,
)

# The event types as five sources; any other type belongs to the last.
SERIES_TYPES = ["click", "error", "purchase", "signup"]
SERIES_COUNT = len(SERIES_TYPES) + 1
# Rows of the panel that are worth a task of their own.
_LEAST_ROWS = 5000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_panel(spark: SparkSession, sf_dir: str, *extra_keys: str) -> DataFrame:
    """One row per user and day (and extra keys): event count and summed value in cents.

    The aggregation shrinks hot users and days inside each task before anything is shuffled.
    """
    events = table(spark, sf_dir, "events")
    return events.groupBy(*extra_keys, "user_id", julian_day(F.col("ts").cast("date")).alias("jd")).agg(
        F.count("*").alias("n"), F.sum(round_half_away(F.col("value") * 100)).alias("cents")
    )


def dated_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.count("*").alias("n"), F.sum(round_half_away(F.col("value") * 100)).alias("cents")
    )


def counted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event count per user and day, the panel that the landed sources are computed from: aggregated once per session."""
    return _counted(spark, sf_dir)[1]


def counted_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per series (see ``SERIES_TYPES``), user and day."""
    return _counted(spark, sf_dir)[0]


def _counted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both panels as written by one reading of the events, the second from the first.

    The files are as many as tasks pay for: each of the wide text sources is then written by that many tasks, however few bytes the panel has.
    """
    def write() -> tuple[str, str]:
        kinds, days = scratch_path(spark, "counted_kinds"), scratch_path(spark, "counted_days")
        kind = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(i)) for i, t in enumerate(SERIES_TYPES)], F.lit(len(SERIES_TYPES)))
        panel = table(spark, sf_dir, "events").groupBy(kind.alias("s"), "user_id", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
        seen = Observation()
        panel.observe(seen, F.count("*").alias("rows")).write.parquet(kinds)
        tasks = max(1, min(2 * spark.sparkContext.defaultParallelism, seen.get["rows"] // _LEAST_ROWS))
        by_day = spark.read.schema(panel.schema).parquet(kinds).groupBy("user_id", "day").agg(F.sum("n").alias("n"))
        by_day.repartition(tasks, "user_id", "day").write.parquet(days)
        return kinds, days

    kinds, days = _once(spark, sf_dir, "counted", write)
    user = table(spark, sf_dir, "events").schema["user_id"].dataType.simpleString()
    schema = f"user_id {user}, day date, n bigint"
    return spark.read.schema(f"s int, {schema}").parquet(kinds), spark.read.schema(schema).parquet(days)


def order_panel(spark: SparkSession, sf_dir: str, by_nation: bool = False) -> DataFrame:
    """Few entities on a long time axis: order count per priority (and the customer's nation) and day."""
    orders, entity = table(spark, sf_dir, "orders"), ["o_orderpriority"]
    if by_nation:
        customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        orders, entity = orders.join(customers, "o_custkey"), ["c_nationkey", *entity]
    return orders.groupBy(*entity, julian_day(F.col("o_orderdate").cast("date")).alias("jd")).agg(
        F.count("*").alias("n")
    )


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def nytcounties_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted_days(spark, sf_dir).select(
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit('County "No", '), _text("user_id")).alias("county"),
        F.concat(F.lit("S"), (F.col("user_id") % 50).cast("string")).alias("state"),
        F.when(F.col("user_id") % 11 != 0, F.col("user_id")).alias("fips"),
        F.col("n").alias("cases"),
        F.when(F.col("n") % 3 != 0, F.col("n") - 1).alias("deaths"),
    )


def loc_lookup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation, balance = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal")
    code = F.when(key % 10 == 9, key - 1).when(key % 10 != 4, key)
    people = F.when(key % 13 == 0, F.lit(0)).when(key % 7 != 0, F.floor(F.abs(balance)))
    return table(spark, sf_dir, "customer").orderBy("c_custkey").select(
        key.alias("UID"),
        F.concat(F.lit("U"), nation.cast("string")).alias("iso2"),
        F.concat(F.lit("US"), nation.cast("string")).alias("iso3"),
        F.when(key % 5 != 0, nation).alias("code3"),
        code.alias("FIPS"),
        F.when(key % 3 != 0, F.col("c_mktsegment")).alias("Admin2"),
        F.when(key % 4 != 0, F.col("c_name")).alias("Province_State"),
        F.col("c_mktsegment").alias("Country_Region"),
        balance.alias("Lat"),
        F.when(balance >= 0, -balance).alias("Long_"),
        F.col("c_name").alias("Combined_Key"),
        people.cast("bigint").alias("Population"),
    )


def harveycodata_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    def of(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind)

    days = table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day"))
    counts = days.agg(
        of("click").alias("a"), of("error").alias("b"), F.count("*").alias("c"), of("purchase").alias("d"),
        of("signup").alias("e"), of("view").alias("f"),
    )
    number = F.dayofmonth("day")
    return counts.select(
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        F.when(number % 5 != 0, F.col("a")).alias("kdhe_neg_results"),
        F.col("b").alias("kdhe_pos_results"),
        F.when(number % 7 != 0, F.col("c")).alias("harveyco_tot_results"),
        F.when(number % 7 != 0, F.col("d")).alias("harveyco_pos_results"),
        F.col("e").alias("harveyco_confirmed"),
        F.col("f").alias("harveyco_recovered"),
    )


def covidtracking_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column ``i`` of the header (from 0): ``n * (i + 1)`` or text, absent where ``(user + i) % 4 = 0``."""
    fixed = {
        "date": F.date_format("day", "yyyyMMdd"),
        "state": F.concat(F.lit("U"), _text("user_id")),
        "totalTestResultsSource": F.lit("source"),
        "fips": F.col("user_id"),
    }

    def column(i: int, f) -> Column:
        present = (F.col("user_id") + i) % 4 != 0
        value = F.col("n") * (i + 1) if f.kind == INT else F.concat(F.lit(f"t{i} "), _text("n"))
        return F.when(present, value)

    return _by_header(counted_days(spark, sf_dir), COVIDTRACKING, fixed, column).toDF(*expected.STATES)


def owid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column ``i`` of the header (from 0): ``n + i / 4``, absent where ``(user + i) % 3 = 0``."""
    fixed = {
        "iso_code": F.when(F.col("user_id") % 13 != 0, F.concat(F.lit("I"), _text("user_id"))),
        "continent": F.when(F.col("user_id") % 2 != 0, F.lit("odd")),
        "location": F.concat(F.lit("L"), _text("user_id")),
        "date": F.date_format("day", "yyyy-MM-dd"),
        "tests_units": F.when(F.col("n") > 1, F.lit("tests")),
    }

    def column(i: int, f) -> Column:
        return F.when((F.col("user_id") + i) % 3 != 0, F.col("n") + F.lit(i / 4))

    return _by_header(counted_days(spark, sf_dir), OWID, fixed, column).toDF(*expected.WORLD)


def rtlive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required column ``i`` is ``n + i / 4``; the counts end in .5 to be rounded, one of them below zero."""
    fixed = {
        "date": F.date_format("day", "yyyy-MM-dd"),
        "region": F.concat(F.lit("R"), _text("user_id")),
        "index": F.col("n"),
        "positive": F.col("n") + F.lit(0.5),
        "tests": -(F.col("n") + F.lit(0.5)),
        "new_tests": F.when(F.col("user_id") % 2 == 0, F.col("n") + F.lit(0.25)),
        "new_cases": F.when(F.col("user_id") % 3 == 0, F.col("n") + F.lit(0.75)),
        "new_deaths": F.when(F.col("user_id") % 5 == 0, F.lit(0.49999999999999994)),
    }
    return _by_header(counted_days(spark, sf_dir), RTLIVE, fixed, lambda i, f: F.col("n") + F.lit(i / 4))


def location_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers that are not in debt, in key order; each key ending in 9 repeats the key before it."""
    key = F.col("c_custkey")
    location = F.concat(F.lit("k"), F.when(key % 10 == 9, key - 1).otherwise(key).cast("string"))
    fixed = {
        "key": location,
        "type": F.lit("county"),
        "label": F.col("c_name"),
        "country_code": F.concat(F.lit("C"), F.col("c_nationkey").cast("string")),
        "country_normalized": F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")),
        "province_normalized": F.when(key % 3 != 0, F.col("c_mktsegment")),
        "region": F.concat(F.lit("region "), (F.col("c_nationkey") % 5).cast("string")),
        "us_state_code": F.when(key % 2 != 0, F.lit("XX")),
        "us_county_fips": F.when(key % 6 != 0, key),
        "dataset": F.lit("map"),
    }
    base = table(spark, sf_dir, "customer").where("c_acctbal >= 0").orderBy("c_custkey")
    filler = F.lit("x")
    return base.select(*[fixed.get(h, filler).alias(h) for h in LOCATION_MAP.header])


def case_series_rows(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Five case series, one per event type; two datasets each, and optional columns in every second one."""
    panel = counted_kinds(spark, sf_dir)
    user, n, day = F.col("user_id"), F.col("n"), F.col("day")
    index = F.dayofmonth(day)
    values = {
        "dataset": F.concat(F.lit("d"), F.col("s").cast("string"), F.lit("/"), (user % 2).cast("string")),
        "location_key": F.concat(F.lit("k"), user.cast("string")),
        "date": F.date_format(day, "yyyy-MM-dd"),
        "date_year": F.year(day),
        "date_month": F.month(day),
        "date_day": F.dayofmonth(day),
        "location_type": F.lit("county"),
        "location_label": F.concat(F.lit("label "), user.cast("string"), F.lit(" "), index.cast("string")),
        "country_code": F.when(user % 2 == 0, F.lit("EV")),
        "country": F.lit("even"),
        "region": F.lit("r"),
        "province": F.when(user % 3 == 0, F.concat(F.lit("p"), index.cast("string"))),
        "administrative": F.lit("a"),
        "day_index_0": index,
        "day_index_1": index + 1,
        "factbook_population": F.when(user % 33 == 0, F.lit(0)).when(user % 3 == 0, user + 1000),
    }
    types = {f.name: f.dataType for f in [*MANDATORY, *OPTIONAL]}
    # Remaining columns: a small rule per position, absent where (user + position) % 3 = 0.
    for i, (name, dtype) in enumerate(types.items()):
        if name in values:
            continue
        value = n * (i + 1) if dtype.simpleString() != "double" else n + F.lit(i / 8)
        values[name] = F.when((user + i) % 3 != 0, value)

    def one(s: int) -> DataFrame:
        names = [f.name for f in MANDATORY] + [f.name for f in OPTIONAL if s % 2 == 1]
        return panel.where(F.col("s") == s).select(*[values[c].cast(types[c]).alias(c) for c in names])

    return [one(s) for s in range(SERIES_COUNT)]


_ROWS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    LOC_LOOKUP.name: loc_lookup_rows,
    NYTCOUNTIES.name: nytcounties_rows,
    HARVEYCODATA.name: harveycodata_rows,
    COVIDTRACKING.name: covidtracking_rows,
    OWID.name: owid_rows,
    RTLIVE.name: rtlive_rows,
    LOCATION_MAP.name: location_map_rows,
}
_done: dict[tuple[str, str, str], object] = {}


def land_text(spark: SparkSession, sf_dir: str, contract: SourceContract) -> str:
    """Write a source's rows as its delimited text files, once per session; returns their folder."""
    def write() -> str:
        path = scratch_path(spark, contract.name)
        rows = _ROWS[contract.name](spark, sf_dir)
        writer = rows.write.option("header", True).option("sep", contract.separator)
        writer.option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)
        return path

    return _once(spark, sf_dir, contract.name, write)


def land_headers(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The rows of the county source under its own header and three that differ in case, in order, or by a name."""
    own = NYTCOUNTIES.header
    headers = {
        "as contracted": own,
        "letter case": [own[0].upper(), *own[1:]],
        "order": [own[1], own[0], *own[2:]],
        "other name": [*own[:-1], "died"],
    }

    def write() -> dict[str, str]:
        rows = nytcounties_rows(spark, sf_dir)
        paths = {name: scratch_path(spark, "headers") for name in headers}
        for name, header in headers.items():
            renamed = rows.toDF(*header) if name != "order" else rows.select(*header)
            renamed.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(paths[name])
        return paths

    return _once(spark, sf_dir, "headers", write)


def land_series(spark: SparkSession, sf_dir: str) -> list[str]:
    """Write the case series as Parquet folders, once per session."""
    def write() -> list[str]:
        series = case_series_rows(spark, sf_dir)
        paths = [scratch_path(spark, f"series{s}") for s in range(len(series))]
        with ThreadPoolExecutor(len(series)) as pool:
            list(pool.map(lambda rows, path: rows.write.parquet(path), series, paths))
        return paths

    return _once(spark, sf_dir, "case_series", write)


def landing(spark: SparkSession, sf_dir: str) -> Landing:
    """All sources, landed: their jobs share the cluster instead of queueing."""
    with tuned(spark), ThreadPoolExecutor(len(CONTRACTS) + 1) as pool:
        _counted(spark, sf_dir)
        series = pool.submit(land_series, spark, sf_dir)
        text = dict(zip(CONTRACTS, pool.map(lambda contract: land_text(spark, sf_dir, contract), CONTRACTS.values())))
        return Landing(text, [spark.read.parquet(path) for path in series.result()])


def built_root(spark: SparkSession, sf_dir: str) -> str:
    """Root of a published build over the landed sources, built once per session."""
    def run() -> str:
        root = scratch_path(spark, "store")
        build(spark, landing(spark, sf_dir), root, **UNGATED)
        return root

    return _once(spark, sf_dir, "build", run)


def damaged_counties(spark: SparkSession, sf_dir: str) -> str:
    """The county source, in which every seventh user's lines have a field too many, two too few, or text for a number."""
    def field(c: str) -> Column:
        return F.coalesce(_text(c), F.lit(""))

    county = F.concat(F.lit('"'), F.replace("county", F.lit('"'), F.lit('""')), F.lit('"'))
    start = [field("date"), county, field("state"), field("fips")]
    kind = F.regexp_extract("county", "([0-9]+)$", 1).cast("int") % 7
    line = (
        F.when(kind == 1, F.concat_ws(",", *start, field("cases"), field("deaths"), F.lit("surplus")))
        .when(kind == 2, F.concat_ws(",", *start))
        .when(kind == 3, F.concat_ws(",", *start, F.lit("many"), field("deaths")))
        .otherwise(F.concat_ws(",", *start, field("cases"), field("deaths")))
    )

    def write() -> str:
        path = scratch_path(spark, "damaged_counties")
        # The column's name is the header line of every file.
        lines = nytcounties_rows(spark, sf_dir).select(line.alias(",".join(NYTCOUNTIES.header)))
        lines.write.option("header", True).option("sep", "\u0001").option("quote", "").option("escapeQuotes", False).csv(path)
        return path

    return _once(spark, sf_dir, "damaged", write)


def twice_built_root(spark: SparkSession, sf_dir: str) -> str:
    """Root of two published builds: the first over a damaged county source, of which up to half may be rejected, the second over a sound one."""
    def run() -> str:
        root = scratch_path(spark, "store")
        sound = landing(spark, sf_dir)
        text = {**sound.text, NYTCOUNTIES.name: damaged_counties(spark, sf_dir)}
        build(spark, Landing(text, sound.case_series, tolerance={NYTCOUNTIES.name: Tolerance(allow_extra=True, share=0.5)}), root, **UNGATED)
        build(spark, sound, root, **UNGATED)
        return root

    return _once(spark, sf_dir, "built twice", run)


def catalog_database(spark: SparkSession, sf_dir: str) -> str:
    """The published build in the catalog."""
    def run() -> str:
        database = f"panels_{uuid.uuid4().hex}"
        publish_catalog(spark, built_root(spark, sf_dir), database)
        return database

    return _once(spark, sf_dir, "catalog", run)


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _done:
        _done[key] = make()
    return _done[key]


def _by_header(panel: DataFrame, contract: SourceContract, fixed: dict[str, Column], column) -> DataFrame:
    return panel.select(*[
        (fixed[f.header] if f.header in fixed else column(i, f)).alias(f.header)
        for i, f in enumerate(contract.fields)
    ])
