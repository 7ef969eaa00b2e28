"""The seven views, each a thin composition over the stored tables.

Every view takes its stored tables as DataFrames.  ``days=(first, last)`` limits a view to a span of
days with a predicate on the stored integer day, so that the scan is pruned.  Over tables with a stored text ``date``
(:func:`daypanel.plans.store.open_dated`) SQL filters on the view's ``date`` prune the scan as well.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from daypanel.functions.calendar import on_days, to_julian, with_date_parts
from daypanel.operators.dims import denormalize, lookup_left_join
from daypanel.operators.panel import daily_rollup, prev_day_delta, unit_columns

DAY = "date_julian"

# Output names, parameters and column order of the views.
HARVEY_POPULATION = 34429
LOCATION_ATTRIBUTES = {
    "xtype": "location_type",
    "label": "location_label",
    "country_code": "country_code",
    "country_normalized": "country",
    "province_normalized": "province",
    "administrative_normalized": "administrative",
    "region": "region",
    "subregion": "subregion",
    "us_county_fips": "us_county_fips",
}
COUNTY_DELTAS = {"cases": "cases_new", "deaths": "deaths_new"}
OWID_UNITS = {
    "total_cases_per_100k": ("total_cases_per_million", "/", 10.0),
    "new_cases_per_100k": ("new_cases_per_million", "/", 10.0),
    "total_deaths_per_100k": ("total_deaths_per_million", "/", 10.0),
    "new_deaths_per_100k": ("new_deaths_per_million", "/", 10.0),
    "total_tests_per_100k": ("total_tests_per_thousand", "*", 100.0),
    "new_tests_per_100k": ("new_tests_per_thousand", "*", 100.0),
    "new_tests_smoothed_per_100k": ("new_tests_smoothed_per_thousand", "*", 100.0),
}
# The sixth sum's output name is spelt as users of the view know it.
US_SUMS = {m: m for m in """
    positive negative pending hospitalizedCurrently hospitalizedCumulative incluCurrently incluCumulative
    onVentilatorCurrently onVentilatorCumulative recovered death hospitalized totalTestsViral positiveTestsViral
    negativeTestsViral positiveCasesViral deathConfirmed deathProbable totalTestEncountersViral
    totalTestsPeopleViral totalTestsAntibody positiveTestsAntibody negativeTestsAntibody
    totalTestsPeopleAntibody positiveTestsPeopleAntibody negativeTestsPeopleAntibody totalTestsPeopleAntigen
    positiveTestsPeopleAntigen totalTestsAntigen positiveTestsAntigen positiveIncrease negativeIncrease total
    totalTestResults totalTestResultsIncrease posNeg deathIncrease hospitalizedIncrease""".split()}
US_SUMS["incluCurrently"] = "inclueCurrently"

Days = tuple[object, object] | None


def _within(df: DataFrame, days: Days) -> DataFrame:
    return df if days is None else on_days(df, *days)


def cdataset(cdataset_raw: DataFrame, cdataset_loc: DataFrame, days: Days = None) -> DataFrame:
    """Case series with date parts and the location's attributes (58 columns)."""
    facts = _within(cdataset_raw, days)
    joined = denormalize(facts, cdataset_loc, "locid", LOCATION_ATTRIBUTES)
    return with_date_parts(joined)


def harveycodata(harveycodata_raw: DataFrame, days: Days = None) -> DataFrame:
    """Single-county testing with derived totals (14 columns)."""
    return with_date_parts(_within(harveycodata_raw, days), derived=[
        F.lit(HARVEY_POPULATION).cast("bigint").alias("population"),
        (F.col("kdhe_neg_results") + F.col("kdhe_pos_results")).alias("kdhe_tot_results"),
        (F.col("harveyco_tot_results") - F.col("harveyco_pos_results")).alias("harveyco_neg_results"),
    ])


def nytcounties(nytcounties_raw: DataFrame, loc_lookup: DataFrame, days: Days = None) -> DataFrame:
    """County counts with population and previous-day deltas (13 columns).

    Rows without a county code are left out, but only after the deltas have seen them.
    """
    raw = nytcounties_raw
    if days is not None:
        first, last = to_julian(days[0]), to_julian(days[1])
        raw = on_days(raw, first - 1, last)
    if "date_next" in raw.columns:
        # A join by the day's text instead of a window: a filter on the finished view's date is inferred for both sides and reaches both
        # scans.  A build makes sure that there is one row a county and day.
        before = raw.select("state", "county", F.col("date_next").alias("date"), *[F.col(c).alias(f"{c}_before") for c in COUNTY_DELTAS])
        joined = raw.join(before, ["state", "county", "date"], "left")
        with_delta = joined.select(*raw.columns, *[(F.col(c) - F.col(f"{c}_before")).alias(out) for c, out in COUNTY_DELTAS.items()])
    else:
        with_delta = prev_day_delta(raw, ["state", "county"], DAY, COUNTY_DELTAS)
    coded = _within(with_delta, days).where(F.col("fips").isNotNull())
    with_population = lookup_left_join(coded, loc_lookup, "fips", ["population"], spread_nulls=False)
    leading = ["population", *COUNTY_DELTAS.values()]
    return with_date_parts(with_population.select(*leading, *nytcounties_raw.columns))


def rtlive(rtlive_raw: DataFrame, days: Days = None) -> DataFrame:
    """Reproduction rates with date parts (19 columns)."""
    return with_date_parts(_within(rtlive_raw, days))


def covidtracking(covidtracking_raw: DataFrame, days: Days = None) -> DataFrame:
    """State testing with date parts (59 columns)."""
    return with_date_parts(_within(covidtracking_raw, days))


def covidtracking_us(covidtracking_raw: DataFrame, days: Days = None) -> DataFrame:
    """Daily national sums (43 columns).  The date parts follow from the day, so the day alone is grouped by."""
    stored = [c for c in ("date",) if c in covidtracking_raw.columns]
    sums = daily_rollup(_within(covidtracking_raw, days), [DAY, *stored], US_SUMS)
    dated = with_date_parts(sums)
    return dated.select("date", DAY, "date_year", "date_month", "date_day", *US_SUMS.values())


def owid(owid_raw: DataFrame, days: Days = None) -> DataFrame:
    """World panel with per-100k rates (71 columns)."""
    return with_date_parts(_within(owid_raw, days), derived=unit_columns(OWID_UNITS))


VIEWS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "cdataset": (cdataset, ("cdataset_raw", "cdataset_loc")),
    "harveycodata": (harveycodata, ("harveycodata_raw",)),
    "nytcounties": (nytcounties, ("nytcounties_raw", "loc_lookup")),
    "rtlive": (rtlive, ("rtlive_raw",)),
    "covidtracking": (covidtracking, ("covidtracking_raw",)),
    "covidtracking_us": (covidtracking_us, ("covidtracking_raw",)),
    "owid": (owid, ("owid_raw",)),
}


def view(name: str, tables: Mapping[str, DataFrame], days: Days = None) -> DataFrame:
    make, inputs = VIEWS[name]
    return make(*[tables[t] for t in inputs], days=days)


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame], dated: Mapping[str, DataFrame] | None = None) -> list[str]:
    """Make the stored tables and the views available to ``spark.sql``; returns the names.

    dated: the tables with their stored text dates, for views that SQL filters on ``date`` prune.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for name in VIEWS:
        view(name, dated or tables).createOrReplaceTempView(name)
    return [*tables, *VIEWS]
