"""Published builds in the session catalog: external tables, and the seven views as SQL text.

Temporary views end with the session that made them; these are there for every session of the catalog and need no Python to be read.  The views name
the tables, not their folders, so a later build only moves the tables.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from daypanel.plans import store
from daypanel.plans.case_facts import DAY
from daypanel.plans.schemas import SCHEMAS
from daypanel.plans.views import COUNTY_DELTAS, HARVEY_POPULATION, LOCATION_ATTRIBUTES, OWID_UNITS, US_SUMS


def publish_catalog(spark: SparkSession, root: str, database: str, number: int | None = None) -> list[str]:
    """Make the tables of the latest (or the given) published build and the seven views part of ``database``; returns the views' names.

    Tables of these names in the database are replaced; they are external, so no file goes with them.
    """
    spark.sql(f"create database if not exists {database} location '{root}/catalog'")
    build_id = store.published_build(spark, root, number)
    for name in SCHEMAS:
        schema = store.dated_schema(name)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = store.PARTITIONS.get(name, [])
        spark.sql(f"drop table if exists {database}.{name}")
        spark.sql(f"create table {database}.{name} ({columns}) using parquet {f'partitioned by ({", ".join(by)})' if by else ''} "
                  f"location '{store.table_path(root, build_id, name)}'")
        if by:
            spark.sql(f"alter table {database}.{name} recover partitions")
    for name, text in view_texts(database).items():
        spark.sql(f"create or replace view {database}.{name} as {text}")
    return list(view_texts(database))


def view_texts(database: str) -> dict[str, str]:
    """Name -> SQL of every view over the tables of ``database``."""
    def parts(t: str) -> str:
        return f"{t}.date, substring({t}.date, 1, 4) as date_year, substring({t}.date, 6, 2) as date_month, substring({t}.date, 9, 2) as date_day"

    def stored(t: str, table: str) -> str:
        return ", ".join(f"{t}.`{c}`" for c in SCHEMAS[table].names)

    def listed(items) -> str:
        return ", ".join(items)

    deltas = listed(f"c.{m} - b.{m} as {out}" for m, out in COUNTY_DELTAS.items())
    units = listed(f"r.{source} {op} cast({factor} as double) as {out}" for out, (source, op, factor) in OWID_UNITS.items())
    return {
        "cdataset": f"""
            select {parts('f')}, {listed(f'l.{a} as {out}' for a, out in LOCATION_ATTRIBUTES.items())}, {stored('f', 'cdataset_raw')}
            from {database}.cdataset_raw f join {database}.cdataset_loc l on f.locid = l.locid""",
        "harveycodata": f"""
            select {parts('r')}, cast({HARVEY_POPULATION} as bigint) as population, r.kdhe_neg_results + r.kdhe_pos_results as kdhe_tot_results,
                   r.harveyco_tot_results - r.harveyco_pos_results as harveyco_neg_results, {stored('r', 'harveycodata_raw')}
            from {database}.harveycodata_raw r""",
        # The day before by its text: a filter on date is inferred for both sides of the join.
        "nytcounties": f"""
            select {parts('c')}, p.population, {deltas}, {stored('c', 'nytcounties_raw')}
            from {database}.nytcounties_raw c
            left join {database}.nytcounties_raw b on b.state = c.state and b.county = c.county and b.date_next = c.date
            left join {database}.loc_lookup p on p.fips = c.fips
            where c.fips is not null""",
        "rtlive": f"select {parts('r')}, {stored('r', 'rtlive_raw')} from {database}.rtlive_raw r",
        "covidtracking": f"select {parts('r')}, {stored('r', 'covidtracking_raw')} from {database}.covidtracking_raw r",
        "covidtracking_us": f"""
            select r.date, r.{DAY}, substring(r.date, 1, 4) as date_year, substring(r.date, 6, 2) as date_month, substring(r.date, 9, 2) as date_day,
                   {listed(f'sum(r.{c}) as {out}' for c, out in US_SUMS.items())}
            from {database}.covidtracking_raw r group by r.date, r.{DAY}""",
        "owid": f"select {parts('r')}, {units}, {stored('r', 'owid_raw')} from {database}.owid_raw r",
    }
