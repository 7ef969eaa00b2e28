"""The queries as SQL over the given tables, for an independent engine to run."""

from __future__ import annotations

from daypanel.catalog.expected import (
    ADVANCE, EVENT_TYPES, FACT_COLUMNS, LOCATION, NATIONAL, NATIONAL_NAMES, NULL, RATES, SERIES, SERIES_OPTIONAL, STATES, STATES_NAMES,
    STATES_TEXT, TABLES, WORLD, WORLD_UNITS, ZERO,
)

ORACLES: dict[str, str] = {}


def jd(date: str) -> str:
    return f"cast(date_diff('day', date '1970-01-01', {date}) + 2440588 as integer)"


def day_of(julian: str) -> str:
    return f"(date '1970-01-01' + ({julian} - 2440588))"


def parts(julian: str) -> str:
    d = day_of(julian)
    return (
        f"strftime({d}, '%Y-%m-%d') as date, strftime({d}, '%Y') as date_year, "
        f"strftime({d}, '%m') as date_month, strftime({d}, '%d') as date_day"
    )


P = f"""P as (
    select user_id, {jd('cast(ts as date)')} as jd, count(*) as n,
           cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents
    from events group by all)"""
PT = f"""P as (
    select event_type, user_id, {jd('cast(ts as date)')} as jd, count(*) as n,
           cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents
    from events group by all)"""
ORDERS = f"""P as (
    select o_orderpriority, {jd('cast(o_orderdate as date)')} as jd, count(*) as n from orders group by all)"""


def _delta(measure: str, keys: list[str], source: str = "P") -> str:
    same = " and ".join(f"b.{k} = a.{k}" for k in keys)
    return f"a.{measure} - (select {measure} from {source} b where {same} and b.jd = a.jd - 1) as {measure}_new"


def _spine(keys: list[str], horizon: str) -> str:
    """Every day from an entity's first to the horizon, with the latest observed day at or before it."""
    k = ", ".join(keys)
    return f"""
    first_last as (select {k}, min(jd) as lo, {horizon} as hi from P group by {k}),
    spine as (select {k}, cast(unnest(generate_series(lo, hi)) as integer) as jd from first_last),
    filled as (
        select s.*, P.jd as src, s.jd - P.jd as k, P.* exclude ({k}, jd)
        from spine s asof join P on {' and '.join(f's.{c} = P.{c}' for c in keys)} and s.jd >= P.jd)"""


# --- Previous-day deltas and gap filling ---------------------------------------------------------

ORACLES["prev_day_delta"] = ORACLES["prev_day_delta_whole"] = f"""
    with {P} select {parts('jd')}, a.*, {_delta('n', ['user_id'])}, {_delta('cents', ['user_id'])} from P a"""
ORACLES["prev_day_delta_filtered"] = f"""
    with {P}, coded as (
        select a.*, case when user_id % 7 <> 0 or n <> 1 then user_id end as code,
               {_delta('n', ['user_id'])}, {_delta('cents', ['user_id'])} from P a)
    select * from coded where code is not null"""
ORACLES["prev_day_delta_long"] = f"with {ORDERS} select a.*, {_delta('n', ['o_orderpriority'])} from P a"
ORACLES["gap_fill"] = ORACLES["gap_fill_whole"] = f"""
    with {P}, {_spine(['user_id'], '(select max(jd) from P)')}
    select user_id, jd, n, cents, case when k > 0 then 0 else n end as n_delta,
           case when k = 0 then n * 2 end as n_pct, n + 100 + k as index_0,
           case when n > 1 then n + k end as index_1, k > 0 as is_filled from filled"""
_BY_TYPE = "select event_type, user_id, jd, case when k > 0 then 0 else n end as n, cents from filled"
ORACLES["gap_fill_by_dataset"] = f"""
    with {PT}, tops as (select event_type as t, max(jd) as top from P group by 1),
    {_spine(['event_type', 'user_id'], '(select top from tops where t = event_type)')} {_BY_TYPE}"""
ORACLES["gap_fill_datasets_together"] = f"""
    with {PT}, {_spine(['event_type', 'user_id'], '(select max(jd) from P)')} {_BY_TYPE}"""
ORACLES["gap_fill_long"] = f"""
    with P as (
        select c_nationkey, o_orderpriority, {jd('cast(o_orderdate as date)')} as jd, count(*) as n
        from orders join customer on o_custkey = c_custkey group by all),
    {_spine(['c_nationkey', 'o_orderpriority'], '(select max(jd) from P)')}
    select c_nationkey, o_orderpriority, jd, case when k > 0 then 0 else n end as n, k > 0 as is_filled from filled"""
ORACLES["gap_fill_then_delta"] = ORACLES["gap_fill_then_delta_whole"] = f"""
    with {P}, {_spine(['user_id'], '(select max(jd) from P)')}, f as (select user_id, jd, n, cents from filled)
    select a.*, {_delta('cents', ['user_id'], 'f')} from f a"""

# --- Rates, roll-ups, derived columns ------------------------------------------------------------

ORACLES["per_100k"] = """
    with pop as (
        select s_nationkey as nation,
               case when s_nationkey % 5 = 0 then 0 when s_nationkey % 3 <> 0 then count(*) end as population
        from supplier group by s_nationkey),
    c as (select c_nationkey as nation, count(*) as customers, count(*) filter (c_acctbal < 0) as d
          from customer group by 1),
    t as (select nation, population, customers, case when d > 2 then d end as debtors from c left join pop using (nation))
    select *, cast(coalesce(customers, 0) as double) * 100000.0 / nullif(population, 0) as customers_pop100k,
           coalesce(case when nation % 7 = 0 then cast(7.5 as double) end,
                    cast(coalesce(debtors, 0) as double) * 100000.0 / nullif(population, 0)) as debtors_pop100k
    from t"""
ORACLES["population_fallback"] = """
    with l as (select s_nationkey, arg_max(cast(floor(s_acctbal) as bigint), s_suppkey) as people from supplier group by 1),
    n as (select case when n_nationkey % 4 <> 0 then n_nationkey end as fips, n_name,
                 case when n_nationkey % 2 = 0 then cast(n_nationkey as bigint) * 1000 end as population from nation)
    select fips, n_name, coalesce(population, people) as population from n left join l on s_nationkey = fips"""
ORACLES["daily_rollup"] = f"""
    with {P} select {parts('jd')}, jd, cast(sum(n) as bigint) as n, cast(sum(cents) as bigint) as cents,
        cast(sum(case when user_id % 2 = 1 then n end) as bigint) as odd_n, cast(null as bigint) as nothing
    from P group by jd"""
ORACLES["unit_convert"] = """
    select l_tax / cast(10.0 as double) as tax_10, l_discount * cast(100.0 as double) as discount_100,
           l_orderkey, l_linenumber, l_tax, l_discount from lineitem"""
ORACLES["derived_tests"] = """
    with t as (select p_partkey, case when p_size % 4 <> 0 then cast(p_size as bigint) end as neg, p_partkey as pos from part)
    select cast(34429 as bigint) as population, neg + pos as tot, pos - neg as diff, * from t"""

# --- Calendar, numbers, text ---------------------------------------------------------------------

_OJD = f"o as (select o_orderkey, o_custkey, {jd('cast(o_orderdate as date)')} as date_julian from orders)"
ORACLES["date_parts"] = f"with {_OJD} select {parts('date_julian')}, * from o"
ORACLES["julian_day"] = f"""
    with {_OJD} select o_orderkey, date_julian, strftime({day_of('date_julian')}, '%Y-%m-%d') as day,
        cast(year({day_of('date_julian')}) as integer) as year, cast(month({day_of('date_julian')}) as integer) as month,
        cast(day({day_of('date_julian')}) as integer) as day_of_month, date_julian as again, cast(1 as integer) as step
    from o"""
ORACLES["parse_dates"] = f"""
    with t as (select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as iso, strftime(o_orderdate, '%Y%m%d') as compact from orders)
    select o_orderkey, {jd("cast(strptime(iso, '%Y-%m-%d') as date)")} as jd_iso,
           {jd("cast(strptime(compact, '%Y%m%d') as date)")} as jd_compact from t"""
ORACLES["round_counts"] = """
    select l_orderkey, l_linenumber, l_quantity, cast(round(l_quantity * cast(0.5 as double)) as bigint) as up,
           cast(round(-(l_quantity * cast(0.5 as double))) as bigint) as down,
           case when l_linenumber <> 1 then cast(round(l_quantity * cast(0.5 as double)) as bigint) end as maybe
    from lineitem"""
_LABELLED = """t as (
    select d.doc_id, d.lang, quality, toxic,
           case when l.doc_id is null then null when quality = 1 then 'good' else '' end as note
    from documents d left join labels l on l.doc_id = d.doc_id)"""
ORACLES["null_to_zero"] = f"""
    with {_LABELLED} select doc_id, coalesce(quality, 0) as quality, coalesce(toxic, 0) as toxic from t"""
ORACLES["null_empty_text"] = f"""
    with {_LABELLED} select doc_id, coalesce(note, '') as filled, nullif(note, '') as emptied from t"""

# --- Projections and filters ---------------------------------------------------------------------

ORACLES["rename_columns"] = "select c_custkey as uid, c_name as combined_key, c_nationkey as code3 from customer"
ORACLES["drop_columns"] = "select c_custkey, c_name, c_nationkey from customer"
ORACLES["reorder_columns"] = "select c_mktsegment, c_acctbal, c_nationkey, c_name, c_custkey from customer"
ORACLES["filter_day"] = f"""
    with {_OJD}, v as (select {parts('date_julian')}, * from o) select * from v where date = '1997-05-28'"""
ORACLES["filter_dataset"] = "select event_id, user_id, event_type as dataset from events where event_type = 'purchase'"

# --- Joins and dimensions ------------------------------------------------------------------------

ORACLES["dim_join"] = """
    select c_name as label, c_mktsegment as region, o_orderkey, o_custkey as locid, o_orderstatus
    from orders, customer where o_custkey = c_custkey"""
ORACLES["lookup_left_join"] = """
    with n as (select case when n_nationkey % 4 <> 0 then n_nationkey end as fips, n_name from nation)
    select fips, n_name, s_suppkey from n left join supplier on s_nationkey = fips"""
ORACLES["last_wins_lookup"] = """
    select user_id, arg_max(cast(round(value * 100) as bigint), event_id) as amount
    from events where event_type <> 'error' and value is not null and user_id is not null group by user_id"""
ORACLES["first_row_attrs"] = """
    select user_id, event_type, props from events
    qualify row_number() over (partition by user_id order by ts, event_id) = 1"""
ORACLES["dim_upsert"] = """
    with base as (select c_custkey + 1 as locid, c_custkey as user_id, c_mktsegment as label from customer where c_acctbal >= 0),
    firsts as (select user_id, event_type as label, event_id from events
               where user_id not in (select user_id from base)
               qualify row_number() over (partition by user_id order by event_id) = 1)
    select * from base union all
    select cast((select max(locid) from base) + row_number() over (order by event_id) as bigint), user_id, label from firsts"""
ORACLES["dense_ids"] = """
    select cast(row_number() over (order by cast(cast(o_orderdate as date) as varchar), o_orderkey) as bigint) as locid,
           o_orderkey, cast(cast(o_orderdate as date) as varchar) as day from orders"""
_MAP = """lines as (
    select 'k' || cast(case when c_custkey % 10 = 9 then c_custkey - 1 else c_custkey end as varchar) as location_key,
           'county' as xtype, c_name as label, 'C' || c_nationkey as country_code,
           'nation ' || c_nationkey as country_normalized,
           case when c_custkey % 3 <> 0 then c_mktsegment else '' end as province_normalized,
           'x' as administrative_normalized, 'region ' || (c_nationkey % 5) as region, 'x' as subregion,
           case when c_custkey % 2 <> 0 then 'XX' else '' end as us_state_code, 'x' as us_state_name,
           case when c_custkey % 6 <> 0 then c_custkey end as us_county_fips, c_custkey as ord
    from customer where c_acctbal >= 0)"""
ORACLES["contract_scan_tsv"] = f"with {_MAP} select * exclude (ord) from lines"
_BASE = f"""{_MAP}, base as (
    select cast(row_number() over (order by ord) as bigint) as locid, * exclude (ord) from lines)"""
ORACLES["location_ids"] = f"with {_BASE} select * from base"
_LOOKUP = """lookup as (
    select c_custkey as uid, 'U' || c_nationkey as iso2, 'US' || c_nationkey as iso3,
           case when c_custkey % 5 <> 0 then cast(c_nationkey as bigint) end as code3,
           case when c_custkey % 10 = 9 then c_custkey - 1 when c_custkey % 10 <> 4 then c_custkey end as fips,
           case when c_custkey % 3 <> 0 then c_mktsegment end as admin2,
           case when c_custkey % 4 <> 0 then c_name end as province_state, c_mktsegment as country_region,
           c_acctbal as latitude, case when c_acctbal >= 0 then -c_acctbal end as longitude, c_name as combined_key,
           cast(case when c_custkey % 13 = 0 then 0 when c_custkey % 7 <> 0 then floor(abs(c_acctbal)) end as bigint) as population
    from customer)"""
ORACLES["contract_scan_lookup"] = f"with {_LOOKUP} select * from lookup"
_FIPS = f"""{_LOOKUP}, people as (
    select fips, arg_max(population, uid) as population from lookup
    where fips is not null and population is not null group by fips)"""
ORACLES["lookup_left_join_facts"] = f"""
    with {_LOOKUP}, {P}, coded as (select *, case when user_id % 3 <> 0 then user_id end as fips from P)
    select user_id, jd, n, cents, c.fips, population from coded c left join lookup l on l.fips = c.fips"""
ORACLES["fips_lookup"] = f"with {_FIPS} select * from people"

# --- Sorting, distinct, counts -------------------------------------------------------------------

ORACLES["sorted_series"] = """
    select event_type as dataset, user_id as location_key, cast(cast(ts as date) as varchar) as date, event_id
    from events order by 1, 2, 3, 4"""
ORACLES["distinct_datasets"] = "select distinct event_type as dataset from events order by 1"
_COUNTS = " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES)
ORACLES["row_counts"] = _COUNTS
ORACLES["row_count_gate"] = f"""
    with c as ({_COUNTS}), m(table_name, min_rows) as (
        values ('lineitem', cast(10000 as bigint)), ('orders', cast(10000000 as bigint)), ('events', cast(1000 as bigint)))
    select table_name, row_count, min_rows, row_count >= min_rows as passed from c join m using (table_name)"""
ORACLES["max_day_per_source"] = f"""
    select 'events' as source, {jd('cast(max(ts) as date)')} as max_day from events union all
    select 'orders', {jd('cast(max(o_orderdate) as date)')} from orders union all
    select 'lineitem', {jd('cast(max(l_shipdate) as date)')} from lineitem"""

# --- Case series ---------------------------------------------------------------------------------

_KIND = "case event_type " + " ".join(f"when '{t}' then {i}" for i, t in enumerate(EVENT_TYPES)) + f" else {len(EVENT_TYPES)} end"
_TYPES = {name: kind for kind, names in [*SERIES, *SERIES_OPTIONAL] for name in names}
_OPTIONAL = {name for _, names in SERIES_OPTIONAL for name in names}
_SERIES_FIXED = {
    "dataset": "'d' || s || '/' || (user_id % 2)",
    "location_key": "'k' || user_id",
    "date": "strftime(day, '%Y-%m-%d')",
    "date_year": "year(day)",
    "date_month": "month(day)",
    "date_day": "day(day)",
    "location_type": "'county'",
    "location_label": "'label ' || user_id || ' ' || day(day)",
    "country_code": "case when user_id % 2 = 0 then 'EV' end",
    "country": "'even'",
    "region": "'r'",
    "province": "case when user_id % 3 = 0 then 'p' || day(day) end",
    "administrative": "'a'",
    "day_index_0": "day(day)",
    "day_index_1": "day(day) + 1",
    "factbook_population": "case when user_id % 33 = 0 then 0 when user_id % 3 = 0 then user_id + 1000 end",
}


def _series_column(i: int, name: str) -> str:
    value = _SERIES_FIXED.get(name)
    if value is None:
        value = f"n + cast({i / 8} as double)" if _TYPES[name] == "double" else f"n * {i + 1}"
        value = f"case when (user_id + {i}) % 3 <> 0 then {value} end"
    if name in _OPTIONAL:
        value = f"case when s % 2 = 1 then {value} end"
    sql_type = {"string": "varchar", "int": "integer", "bigint": "bigint", "double": "double"}[_TYPES[name]]
    return f"cast({value} as {sql_type}) as {name}"


_SERIES = f"""
    sp as (select {_KIND} as s, user_id, cast(ts as date) as day, count(*) as n from events group by all),
    raw as (select s as source_ord, {', '.join(_series_column(i, c) for i, c in enumerate(_TYPES))} from sp),
    series as (
        select *, {jd('cast(date as date)')} as date_julian,
               max({jd('cast(date as date)')}) over (partition by source_ord) as horizon from raw)"""
ORACLES["case_series_scan"] = f"""
    with {_SERIES} select cast(source_ord as integer) as source_ord, dataset, location_key, date_julian, horizon, province,
        absolute_confirmed, absolute_recovered, delta_pop100k_infected, factbook_population from series"""
ORACLES["align_schema"] = """
    select event_id, cast(user_id as integer) as user_id, cast(null as varchar) as province, cast(null as bigint) as delta
    from events"""
ORACLES["union_sources"] = """
    select event_id, user_id, cast(round(value * 100) as bigint) as cents, cast(0 as integer) as source_ord
    from events where event_type = 'purchase'
    union all by name
    select user_id, event_id, cast(1 as integer) as source_ord from events where event_type is distinct from 'purchase'"""

_DIMENSION = f"""
    {_BASE}, {_SERIES},
    firsts as (
        select location_key, location_type, location_label, country_code, country, province, administrative, region,
               source_ord, dataset
        from series where location_key not in (select location_key from base)
        qualify row_number() over (partition by location_key order by source_ord, dataset, date_julian) = 1),
    dimension as (
        select locid, location_key, xtype, label, country_code, country_normalized, province_normalized,
               administrative_normalized, region, subregion, us_state_code, us_state_name, us_county_fips from base
        union all
        select cast((select max(locid) from base) + row_number() over (order by source_ord, dataset, location_key) as bigint),
               location_key, coalesce(location_type, ''), coalesce(location_label, ''), coalesce(country_code, ''),
               coalesce(country, ''), coalesce(province, ''), coalesce(administrative, ''), coalesce(region, ''),
               '', '', null, null from firsts)"""
ORACLES["cdataset_loc"] = f"with {_DIMENSION} select * exclude (location_key) from dimension"


def _observed_column(name: str) -> str:
    if name == "locid":
        return "k.locid"
    if name == "factbook_population":
        return "population as factbook_population"
    if name in RATES.values():
        count = next(c for c, r in RATES.items() if r == name)
        return (f"coalesce({name}, cast(coalesce({count}, 0) as double) * 100000.0 / nullif(population, 0)) as {name}")
    if name in RATES:
        return f"coalesce({name}, 0) as {name}"
    return name


def _filled_column(name: str) -> str:
    if name == "date_julian":
        return "cast(date_julian + step as integer) as date_julian"
    if name in ADVANCE:
        return f"cast({name} + step as bigint) as {name}"
    if name in ZERO:
        return f"case when step > 0 then 0 else {name} end as {name}"
    if name in NULL:
        return f"case when step = 0 then {name} end as {name}"
    return name


_FACTS = f"""
    {_DIMENSION}, {_FIPS},
    keys as (select location_key, max(locid) as locid, arg_max(coalesce(us_county_fips, -1), locid) as fips
             from dimension group by location_key),
    located as (
        select series.* exclude (factbook_population), k.locid, coalesce(factbook_population, people.population) as population
        from series join keys k using (location_key) left join people on people.fips = k.fips),
    observed as (select source_ord, horizon, {', '.join(_observed_column(c).replace('k.', '') for c in FACT_COLUMNS)}
                 from located),
    ends as (
        select *, coalesce(lead(date_julian) over (partition by source_ord, dataset, locid order by date_julian) - 1, horizon) as last
        from observed),
    steps as (select *, unnest(generate_series(0, last - date_julian)) as step from ends),
    facts as (select {', '.join(_filled_column(c) for c in FACT_COLUMNS)} from steps)"""
ORACLES["cdataset_raw"] = f"with {_FACTS} select * from facts"
ORACLES["cdataset_raw_key"] = f"""
    with {_FACTS} select dataset, locid, date_julian, count(*) as row_count from facts group by all having count(*) > 1"""
_CDATASET = f"""
    select {parts('f.date_julian')}, {', '.join(f'd.{a} as {out}' for a, out in LOCATION.items())}, f.*
    from facts f, dimension d where f.locid = d.locid"""
ORACLES["view_cdataset"] = f"with {_FACTS} {_CDATASET}"
ORACLES["views_registered"] = f"""
    with {_FACTS}, cdataset as ({_CDATASET})
    select dataset, date, count(*) as locations, cast(sum(absolute_confirmed) as bigint) as confirmed,
           cast(sum(delta_deaths) as bigint) as new_deaths
    from cdataset where date >= '2024-01-10' group by dataset, date"""

# --- Data quality --------------------------------------------------------------------------------

ORACLES["unique_violations"] = """
    select l_orderkey, l_linenumber, count(*) as row_count from lineitem
    where l_orderkey is not null and l_linenumber is not null group by 1, 2 having count(*) > 1"""
ORACLES["not_null_violations"] = f"with {_LABELLED} " + " union all ".join(
    f"select '{c}' as column_name, count(*) filter ({c} is null) as null_count from t"
    for c in ("doc_id", "lang", "quality", "toxic", "note")
)
_CHECKS = [
    ("orders", "o_orderkey = 0", "o_custkey", "899"), ("orders", "o_orderkey = 1", "o_custkey", "1"),
    ("orders", "o_orderkey = -1", "o_custkey", "1"), ("part", "p_partkey = 0", "big", "null"),
    ("part", "p_partkey = 1", "big", "28"),
]
ORACLES["point_expectations"] = """
    with p as (select p_partkey, case when p_size > 25 then cast(p_size as bigint) end as big from part)
    """ + " union all ".join(
    f"""select '{t}' as table_name, '{w}' as condition, '{c}' as column_name, cast({e} as bigint) as expected,
        max({c}) as actual, count(*) > 0 and bool_and({c} is not distinct from cast({e} as bigint)) as passed
        from {'p' if t == 'part' else t} where {w}""" for t, w, c, e in _CHECKS
)
ORACLES["quality_report"] = " union all ".join(
    f"""select '{c}' as column_name, count(*) filter (not ({v} between 0 and {hi})) as out_of_range from lineitem"""
    for c, v, hi in (
        ("l_orderkey", "l_orderkey", 9223372036854775807), ("wide", "l_partkey * 10000000", 4294967295),
        ("low", "cast(l_linenumber as bigint) - 2", 4294967295),
    )
)

# --- Text sources and their views ----------------------------------------------------------------

_D = """dp as (
    select user_id, cast(ts as date) as day, count(*) as n from events group by all)"""
_NYT = f"""{_D}, nyt as (
    select {jd('day')} as date_julian, 'County "No", ' || user_id as county, 'S' || (user_id % 50) as state,
           case when user_id % 11 <> 0 then user_id end as fips, n as cases,
           case when n % 3 <> 0 then n - 1 end as deaths from dp)"""
ORACLES["contract_scan"] = f"with {_NYT} select * from nyt"
ORACLES["refused_headers"] = """
    with days as (select distinct user_id, cast(ts as date) as day from events)
    select 'as contracted' as variant, false as refused, (select count(*) from days) as n_rows
    union all select variant, true, null from (values ('letter case'), ('order'), ('other name')) as v(variant)"""


def _county_delta(measure: str) -> str:
    return (f"r.{measure} - (select {measure} from nyt b where b.state = r.state and b.county = r.county "
            f"and b.date_julian = r.date_julian - 1) as {measure}_new")


_COUNTIES = f"""
    select {parts('r.date_julian')}, l.population, {_county_delta('cases')}, {_county_delta('deaths')}, r.*
    from nyt r left join lookup l on r.fips = l.fips where r.fips is not null"""
ORACLES["view_nytcounties"] = f"with {_NYT}, {_LOOKUP} {_COUNTIES}"
ORACLES["nytcounties_days"] = f"""
    with {_NYT}, {_LOOKUP}, v as ({_COUNTIES}) select * from v where date between '2024-01-10' and '2024-01-12'"""

_HARVEY = f"""h as (
    select cast(ts as date) as day, count(*) filter (event_type = 'click') as a, count(*) filter (event_type = 'error') as b,
           count(*) as c, count(*) filter (event_type = 'purchase') as d, count(*) filter (event_type = 'signup') as e,
           count(*) filter (event_type = 'view') as f from events group by 1),
    harvey as (
        select {jd('day')} as date_julian, case when day(day) % 5 <> 0 then a end as kdhe_neg_results, b as kdhe_pos_results,
               case when day(day) % 7 <> 0 then c end as harveyco_tot_results,
               case when day(day) % 7 <> 0 then d end as harveyco_pos_results, e as harveyco_confirmed, f as harveyco_recovered
        from h)"""
ORACLES["view_harveycodata"] = f"""
    with {_HARVEY} select {parts('date_julian')}, cast(34429 as bigint) as population,
        kdhe_neg_results + kdhe_pos_results as kdhe_tot_results,
        harveyco_tot_results - harveyco_pos_results as harveyco_neg_results, * from harvey"""


def _tracking_column(i: int, name: str) -> str:
    fixed = {"state": "'U' || user_id", "totalTestResultsSource": "'source'", "fips": "user_id"}
    value = f"'t{i} ' || n" if name in STATES_TEXT else f"n * {i + 1}"
    value = fixed.get(name, f"case when (user_id + {i}) % 4 <> 0 then {value} end")
    return f"{value} as {STATES_NAMES.get(name, name)}"


_TRACKING = f"""{_D}, tracking as (
    select {jd('day')} as date_julian, {', '.join(
        _tracking_column(i, c) for i, c in enumerate(STATES) if c not in ('date', 'hash'))} from dp)"""
ORACLES["contract_scan_compact_dates"] = f"with {_TRACKING} select * from tracking"
ORACLES["view_covidtracking"] = f"with {_TRACKING} select {parts('date_julian')}, * from tracking"
ORACLES["view_covidtracking_us"] = f"""
    with {_TRACKING} select {parts('date_julian')}, date_julian,
        {', '.join(f'cast(sum({m}) as bigint) as {NATIONAL_NAMES.get(m, m)}' for m in NATIONAL)}
    from tracking group by date_julian"""


def _world_column(i: int, name: str) -> str:
    fixed = {
        "iso_code": "'I' || user_id", "continent": "case when user_id % 2 <> 0 then 'odd' end", "location": "'L' || user_id",
        "tests_units": "case when n > 1 then 'tests' end",
    }
    value = fixed.get(name, f"case when (user_id + {i}) % 3 <> 0 then n + cast({i / 4} as double) end")
    return f"{value} as {name}"


_WORLD = f"""{_D}, world as (
    select {jd('day')} as date_julian, {', '.join(
        _world_column(i, c) for i, c in enumerate(WORLD) if c != 'date')} from dp where user_id % 13 <> 0)"""
ORACLES["contract_scan_wide"] = f"with {_WORLD} select * from world"
ORACLES["view_owid"] = f"""
    with {_WORLD} select {parts('date_julian')},
        {', '.join(f'{c} {op} cast({k} as double) as {out}' for out, (c, op, k) in WORLD_UNITS.items())}, * from world"""
ORACLES["blank_lead_rows"] = f"with {_D} select count(*) filter (user_id % 13 = 0) as dropped_rows from dp"

_RATES = f"""{_D}, rates as (
    select {jd('day')} as date_julian, 'R' || user_id as state, n as rtindex, {', '.join(
        f'n + cast({i / 4} as double) as {c}' for i, c in enumerate(
            ['mean', 'median', 'lower_80', 'upper_80', 'infections', 'test_adjusted_positive', 'test_adjusted_positive_raw'], 3))},
        n + 1 as positive, -(n + 1) as tests, case when user_id % 2 = 0 then n end as new_tests,
        case when user_id % 3 = 0 then n + 1 end as new_cases,
        case when user_id % 5 = 0 then cast(0 as bigint) end as new_deaths from dp)"""
ORACLES["contract_scan_rounded"] = f"with {_RATES} select * from rates"
ORACLES["view_rtlive"] = f"with {_RATES} select {parts('date_julian')}, * from rates"

ORACLES["drop_blank_lead"] = """
    select lang as lead, doc_id from documents where lang not in ('en', 'fr')"""
_CLEAN = "o_orderkey as orderkey, o_orderstatus as status, o_custkey as custkey"
ORACLES["sound_rows"] = f"select {_CLEAN} from orders where left(o_orderpriority, 1) not in ('1', '2', '3')"
ORACLES["ragged_rows"] = f"select {_CLEAN} from orders where left(o_orderpriority, 1) not in ('2', '3')"
ORACLES["bad_rows"] = """
    select o_orderkey as first_field, o_orderkey || ',' || o_orderstatus || case left(o_orderpriority, 1)
        when '1' then ',' || o_custkey || ',surplus' when '3' then ',many' else '' end as line
    from orders where left(o_orderpriority, 1) in ('1', '2', '3')"""

# --- Sinks and build -----------------------------------------------------------------------------

ORACLES["table_sink"] = f"with {PT} select event_type as dataset, user_id, jd, n, cents from P"
_STORED = {
    "build_meta": "values (1)", "loc_lookup": "select * from lookup", "nytcounties_raw": "select * from nyt",
    "harveycodata_raw": "select * from harvey", "covidtracking_raw": "select * from dp",
    "owid_raw": "select * from dp where user_id % 13 <> 0", "rtlive_raw": "select * from dp",
    "cdataset_loc": "select * from dimension", "cdataset_raw": "select * from facts",
}
_STORED_COUNTS = f"with {_FACTS}, {_NYT}, {_HARVEY}, stored as (" + " union all ".join(
    f"select '{t}' as table_name, (select count(*) from ({q})) as row_count" for t, q in _STORED.items()
) + ")"
ORACLES["build_meta"] = f"{_STORED_COUNTS} select *, '2' as schemaver from stored"
ORACLES["publish_gate"] = f"{_STORED_COUNTS} select *, true as stopped, true as unchanged from stored"

# --- Reports, commits, permanent views, buckets --------------------------------------------------

ORACLES["ragged_build"] = f"""
    with {_NYT.split(', nyt as')[0]}, lines as (
        select user_id, strftime(day, '%Y-%m-%d') || ',"County ""No"", ' || user_id || '",S' || (user_id % 50) || ','
               || case when user_id % 11 <> 0 then cast(user_id as varchar) else '' end as start,
               case when n % 3 <> 0 then cast(n - 1 as varchar) else '' end as deaths from dp)
    select 'nytcounties_raw' as source, start as line, 'too few fields' as reason from lines where user_id % 7 = 2
    union all select 'nytcounties_raw', start || ',many,' || deaths, 'not of the type: cases' from lines where user_id % 7 = 3"""
_SOUND_COUNTIES = "select * from dp where user_id % 7 not in (2, 3)"
_WORLD = "select * from dp where user_id % 13 <> 0"
_REPORT = {
    **{(t, m): f"select * from {rows}" for t, rows in {
        "covidtracking_raw": "dp", "harveycodata_raw": "harvey", "rtlive_raw": "dp", "loc_lookup": "lookup", "location_map": "base"}.items()
       for m in ("rows_read", "rows_stored")},
    **{(t, "blank_leads"): "select 1 where false" for t in (
        "covidtracking_raw", "harveycodata_raw", "rtlive_raw", "loc_lookup", "location_map", "nytcounties_raw")},
    ("owid_raw", "rows_read"): "select * from dp", ("owid_raw", "blank_leads"): "select * from dp where user_id % 13 = 0",
    ("owid_raw", "rows_stored"): _WORLD,
    ("nytcounties_raw", "rows_read"): "select * from dp", ("nytcounties_raw", "rejects"): "select * from dp where user_id % 7 in (2, 3)",
    ("nytcounties_raw", "rows_stored"): _SOUND_COUNTIES,
    ("location_map", "repeated_keys"): "select location_key, unnest(range(count(*) - 1)) from base group by 1",
    ("case_series", "rows_stored"): "select * from series",
    ("case_series", "rows_of_new_keys"): "select * from series where location_key not in (select location_key from base)", ("cdataset_loc", "rows_stored"): "select * from dimension",
    ("location_keys", "rows_stored"): "select distinct location_key from dimension", ("cdataset_raw", "rows_stored"): "select * from facts",
}
ORACLES["build_report"] = f"with {_FACTS}, {_NYT}, {_HARVEY} " + " union all ".join(
    f"select '{t}' as source, '{m}' as measure, (select count(*) from ({q})) as value" for (t, m), q in _REPORT.items())
ORACLES["former_build"] = f"""{_STORED_COUNTS} select table_name, case when table_name = 'nytcounties_raw'
    then (select count(*) from ({_SOUND_COUNTIES})) else row_count end as row_count from stored"""
ORACLES["replaced_build"] = f"{_STORED_COUNTS} select *, '1,2' as commits from stored"


def _of_views(where: str) -> str:
    names = ("cdataset", "harveycodata", "nytcounties", "rtlive", "covidtracking", "covidtracking_us", "owid")
    return " union all ".join(
        f"""select '{v}' as view_name, count(*) as n_rows, count(distinct date) as n_days, min(date) as first_day, max(date_julian) as last_day
            from ({ORACLES[f'view_{v}']}) where {where}""" for v in names)


ORACLES["permanent_views"] = _of_views("true")
ORACLES["filter_day_views"] = _of_views("date = '2024-01-11'")
ORACLES["filter_days_counties"] = ORACLES["nytcounties_days"]
ORACLES["stored_delta"] = f"with {P} select a.*, {_delta('n', ['user_id'])}, {_delta('cents', ['user_id'])} from P a"
ORACLES["stored_fill"] = ORACLES["gap_fill"]
ORACLES["replaced_bytes"] = """
    select c_custkey as orderkey, 'caf' || chr(65533) || ' ' || c_mktsegment as status, cast(c_nationkey as bigint) as custkey from customer"""
