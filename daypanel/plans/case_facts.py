"""From the case-series sources to the stored fact table and its location dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from daypanel.functions.calendar import day_text, julian_day, julian_from_ymd, parse_day
from daypanel.functions.numeric import require_value
from daypanel.functions.text import null_to_empty, null_to_zero
from daypanel.operators.dims import assign_dense_ids, last_wins_lookup, lookup_left_join, upsert_dimension
from daypanel.operators.panel import fill_to_next, per_capita, with_next_day
from daypanel.session import durable
from daypanel.sources.case_series import MANDATORY, OPTIONAL, SOURCE, align_schema, union_sources
from daypanel.sources.contract import ROW_ORDER

DAY = "date_julian"
HORIZON = "horizon"
NEXT = "next_day"
IS_NEW = "is_new"
_BEFORE = "__before"
_FILE = "__file"
SERIES_KEY = [SOURCE, "dataset", "location_key", DAY]

# Columns of the fact table by their role on an added day, and in table order.
COUNTS = [f"{p}_{m}" for p in ("absolute", "delta") for m in ("confirmed", "deaths", "recovered", "infected")]
RATES = {c: c.replace("_", "_pop100k_", 1) for c in COUNTS}
ZERO_ON_FILL = [c for c in COUNTS if c.startswith("delta_")]
NULL_ON_FILL = [f"delta_{r}_{m}" for r in ("pct", "pop100k") for m in ("confirmed", "deaths", "recovered", "infected")]
ADVANCE_ON_FILL = """
    day_index_0 day_index_1 day_index_10 day_index_100 day_index_1k day_index_10k
    day_index_peak day_index_peak_confirmed day_index_peak_deaths""".split()
CDATASET_RAW = """
    dataset locid location_lat location_long date_julian
    day_index_0 day_index_1 day_index_10 day_index_100 day_index_1k day_index_10k
    day_index_peak day_index_peak_confirmed day_index_peak_deaths
    absolute_confirmed absolute_deaths absolute_recovered absolute_infected
    absolute_pop100k_confirmed absolute_pop100k_deaths absolute_pop100k_recovered absolute_pop100k_infected
    relative_deaths relative_recovered relative_infected
    delta_confirmed delta_deaths delta_recovered delta_infected
    delta_pct_confirmed delta_pct_deaths delta_pct_recovered delta_pct_infected
    delta_pop100k_confirmed delta_pop100k_deaths delta_pop100k_recovered delta_pop100k_infected
    peak_pct_confirmed peak_pct_deaths peak_pct_recovered peak_pct_infected
    factbook_area factbook_population factbook_death_rate factbook_median_age""".split()
CDATASET_RAW_KEY = ["dataset", "locid", DAY]
_LAID_OUT = ["dataset", DAY, "locid"]
_FILE_ROWS, _LEAST_FILE_ROWS = 500_000, 20_000
CDATASET_RAW_REQUIRED = ["dataset", "locid", DAY, "day_index_0", "day_index_1", *COUNTS]
CDATASET_LOC = """
    locid xtype label country_code country_normalized province_normalized administrative_normalized
    region subregion us_state_code us_state_name us_county_fips""".split()
CDATASET_LOC_REQUIRED = CDATASET_LOC[:9]
# Attributes of a location that only a case series knows: stored name -> case-series column.
NEW_LOCATION = {
    "xtype": "location_type",
    "label": "location_label",
    "country_code": "country_code",
    "country_normalized": "country",
    "province_normalized": "province",
    "administrative_normalized": "administrative",
    "region": "region",
}


def prepare_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """All case series in one table, with the Julian day and each source's own fill horizon."""
    prepared = []
    for df in sources:
        aligned = align_schema(df, MANDATORY, OPTIONAL)
        # One scalar subquery over the one column it needs; text order of ISO dates is date order.
        horizon = aligned.agg(julian_day(parse_day(F.max("date")))).scalar()
        prepared.append(aligned.withColumns({
            "location_key": require_value(F.col("location_key"), "string", "location_key"),
            DAY: julian_from_ymd("date_year", "date_month", "date_day"),
            HORIZON: horizon,
        }))
    return union_sources(prepared)


def find_next_days(series: DataFrame) -> DataFrame:
    """``series`` with the next observed day of its dataset, location and source.

    Dealt out by location alone, so that a join by location to a large map needs no second shuffle.  A NULL or second key fails the job.
    """
    return with_next_day(series.repartition("location_key"), ["location_key", SOURCE, "dataset"], DAY, NEXT)


def flag_unknown(series: DataFrame, location_rows: DataFrame) -> DataFrame:
    """``series`` with ``is_new``: whether the location map lacks the row's key.

    Written with the rows, the flag lets a later search for new locations skip the files and row groups that hold none.
    """
    known = location_rows.select("location_key", F.lit(True).alias("known")).where(F.col("location_key").isNotNull()).distinct()
    joined = series.join(known, "location_key", "left")
    return joined.select(*series.columns, F.col("known").isNull().alias(IS_NEW))


def series_spans(series: DataFrame) -> DataFrame:
    """Per dataset, location and source: the days its filled rows will cover.  Reduced in each task."""
    # Most texts are the day as it would be written, which spares them the parser.
    stated = F.when((F.col("date") == day_text(DAY)) & (F.col("date_year") > 0), F.col(DAY)).otherwise(julian_day(parse_day("date")))
    return series.groupBy("dataset", "location_key", SOURCE).agg(
        F.min(DAY).alias("first_day"),
        F.greatest(F.max(DAY), F.max(HORIZON)).alias("last_day"),
        F.count_if(stated != F.col(DAY)).alias("unlike_dates"),
    )


def series_violations(spans: DataFrame) -> DataFrame:
    """Spans that break a rule: two sources cover the same days, or ``date`` differs from its year, month and day.

    Checked on the spans, this spares a comparison of all filled rows with each other.
    """
    earlier = Window.partitionBy("dataset", "location_key").orderBy("first_day", SOURCE)
    covered = F.coalesce(F.lag("last_day").over(earlier) >= F.col("first_day"), F.lit(False))
    return spans.withColumn("covered_twice", covered).where("covered_twice or unlike_dates > 0")


def base_locations(location_rows: DataFrame) -> DataFrame:
    """The location map with ids 1, 2, 3, ... in file order; ``location_rows`` carries ``ROW_ORDER``."""
    return assign_dense_ids(location_rows, ROW_ORDER, "locid").drop(*ROW_ORDER)


def extend_locations(base: DataFrame, series: DataFrame) -> DataFrame:
    """``base`` plus the locations that only the case series know.

    New ids follow the order of first appearance: source, then dataset, location and day.  A new
    location has no county code, and its attributes are those of its first row.  Of series that :func:`flag_unknown` has seen only the
    flagged rows are read.
    """
    if IS_NEW in series.columns:
        series = series.where(IS_NEW)
    attributes = {new: null_to_empty(F.col(old)) for new, old in NEW_LOCATION.items()}
    rows = series.select(SOURCE, "dataset", "location_key", DAY, *[c.alias(n) for n, c in attributes.items()])
    extended = upsert_dimension(
        base.withColumn("__new", F.lit(False)), rows.withColumn("__new", F.lit(True)),
        "location_key", "locid", [*attributes, "__new"], [SOURCE, "dataset", DAY],
        id_order=[SOURCE, "dataset", "location_key"],
    )
    blank = F.lit("")
    return extended.withColumns({
        "subregion": F.when(F.col("__new"), blank).otherwise(F.col("subregion")),
        "us_state_code": F.when(F.col("__new"), blank).otherwise(F.col("us_state_code")),
    }).drop("__new")


def location_keys(locations: DataFrame, fips_population: DataFrame) -> DataFrame:
    """``location_key -> locid`` and the population known for its county; the last row of a key wins."""
    last = locations.groupBy("location_key").agg(
        F.max("locid").alias("locid"), F.max_by("us_county_fips", "locid").alias("fips")
    )
    known = fips_population.select("fips", F.col("population").alias("county_population"))
    return lookup_left_join(last, known, "fips", ["county_population"])


def fips_population(loc_lookup_rows: DataFrame) -> DataFrame:
    """``fips -> population`` of the lookup file; its last complete row per code wins."""
    return last_wins_lookup(loc_lookup_rows, "fips", "population", ROW_ORDER)


def facts(series: DataFrame, keys: DataFrame) -> DataFrame:
    """A row for every day of every dataset and location, in table order.

    The days to fill are found before the locations are joined, if :func:`find_next_days` has not stored them with the rows;
    the rows multiply only after the join.
    """
    dated = series if NEXT in series.columns else with_next_day(series, SERIES_KEY[:-1], DAY, NEXT)
    filled = fill_to_next(
        observed_facts(dated, keys), DAY, NEXT, HORIZON,
        zero=ZERO_ON_FILL, null=NULL_ON_FILL, advance=ADVANCE_ON_FILL,
    )
    return filled.select(*[F.col(c).cast("bigint") if c in ADVANCE_ON_FILL else F.col(c) for c in CDATASET_RAW])


def day_sizes(series: DataFrame) -> DataFrame:
    """How many facts each dataset and day will have, as ``dataset, date_julian, n``: from four columns of series with their next days."""
    days = fill_to_next(series.select("dataset", DAY, NEXT, HORIZON), DAY, NEXT, HORIZON)
    return durable(days.groupBy("dataset", DAY).agg(F.count("*").alias("n")))


def by_day(facts: DataFrame, sizes: DataFrame, file_rows: int = _FILE_ROWS) -> DataFrame:
    """Facts as they are laid out: a file holds few days of a dataset, so that day filters prune.

    The borders of the files come from ``sizes`` (:func:`day_sizes`), so the facts are computed once; ranges would be found by a sample, which computes
    them all once more.  A day with more rows than a file may have is spread over several by location.  What is broadcast is one row per dataset and day.
    """
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tasks = 2 * facts.sparkSession.sparkContext.defaultParallelism
    file_rows = max(1, min(file_rows, max(_LEAST_FILE_ROWS, -(-total // tasks))))
    # One task, but over one row per dataset only.
    datasets = sizes.groupBy("dataset").agg(F.sum("n").alias("rows"))
    earlier = Window.orderBy("dataset").rowsBetween(Window.unboundedPreceding, -1)
    starts = datasets.select("dataset", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    days = Window.partitionBy("dataset").orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn(_BEFORE, F.coalesce(F.sum("n").over(days), F.lit(0))).join(starts, "dataset")
    before = before.select("dataset", DAY, (F.col("start") + F.col(_BEFORE)).alias(_BEFORE), "n")
    place = F.col(_BEFORE) + F.pmod(F.xxhash64("locid"), F.col("n"))
    placed = facts.join(F.broadcast(before), ["dataset", DAY], "left").select(*[facts[c] for c in facts.columns], F.floor(place / file_rows).cast("int").alias(_FILE))
    return placed.repartitionById(max(1, -(-total // file_rows)), _FILE).drop(_FILE).sortWithinPartitions(*_LAID_OUT)


def observed_facts(series: DataFrame, keys: DataFrame) -> DataFrame:
    """The observed rows as stored: location id, population, counts without NULL, rates per 100k."""
    located = series.join(keys, "location_key", "inner")
    population = F.coalesce("factbook_population", "county_population")
    known = located.withColumn("factbook_population", population)
    return null_to_zero(per_capita(known, RATES, "factbook_population"), COUNTS)
