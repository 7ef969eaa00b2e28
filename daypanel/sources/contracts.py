"""The seven text sources.

Fixed values: header names, types, nullability, stored names and table layouts of the sources.
"""

from __future__ import annotations

from daypanel.functions.calendar import COMPACT_DATE
from daypanel.sources.contract import INT, REAL, TEXT, U32, U64, Field, SourceContract


def _optional(kind: str, headers: str) -> tuple[Field, ...]:
    return tuple(Field(h, kind, optional=True) for h in headers.split())


LOC_LOOKUP = SourceContract(
    name="loc_lookup",
    fields=(
        Field("UID", U32, name="uid"),
        Field("iso2", TEXT),
        Field("iso3", TEXT),
        Field("code3", U32, optional=True),
        Field("FIPS", U32, optional=True, name="fips"),
        Field("Admin2", TEXT, name="admin2"),
        Field("Province_State", TEXT, name="province_state"),
        Field("Country_Region", TEXT, name="country_region"),
        Field("Lat", REAL, optional=True, name="latitude"),
        Field("Long_", REAL, optional=True, name="longitude"),
        Field("Combined_Key", TEXT, name="combined_key"),
        Field("Population", U64, optional=True, name="population"),
    ),
    layout=(
        "uid", "iso2", "iso3", "code3", "fips", "admin2", "province_state", "country_region",
        "latitude", "longitude", "combined_key", "population",
    ),
    key=("uid",),
    required=("uid", "iso2", "iso3", "country_region", "combined_key"),
    empty_as_null=("admin2", "province_state"),
)

NYTCOUNTIES = SourceContract(
    name="nytcounties_raw",
    fields=(
        Field("date", TEXT),
        Field("county", TEXT),
        Field("state", TEXT),
        Field("fips", INT, optional=True),
        Field("cases", INT),
        Field("deaths", INT, optional=True),
    ),
    layout=("date_julian", "county", "state", "fips", "cases", "deaths"),
    key=("state", "county", "date_julian"),
    required=("date_julian", "county", "state", "cases"),
    date_field="date",
)

HARVEYCODATA = SourceContract(
    name="harveycodata_raw",
    fields=(Field("date", TEXT),) + _optional(INT, """
        kdhe_neg_results kdhe_pos_results harveyco_tot_results harveyco_pos_results
        harveyco_confirmed harveyco_recovered"""),
    layout=(
        "date_julian", "kdhe_neg_results", "kdhe_pos_results", "harveyco_tot_results", "harveyco_pos_results",
        "harveyco_confirmed", "harveyco_recovered",
    ),
    key=("date_julian",),
    required=("date_julian",),
    date_field="date",
)

COVIDTRACKING = SourceContract(
    name="covidtracking_raw",
    fields=(
        Field("date", TEXT),
        Field("state", TEXT),
        *_optional(INT, "positive probableCases negative pending"),
        Field("totalTestResultsSource", TEXT),
        *_optional(INT, "totalTestResults hospitalizedCurrently hospitalizedCumulative"),
        Field("inIcuCurrently", INT, optional=True, name="incluCurrently"),
        Field("inIcuCumulative", INT, optional=True, name="incluCumulative"),
        *_optional(INT, "onVentilatorCurrently onVentilatorCumulative recovered"),
        *_optional(TEXT, "lastUpdateEt dateModified checkTimeEt"),
        *_optional(INT, "death hospitalized hospitalizedDischarged"),
        *_optional(TEXT, "dateChecked"),
        *_optional(INT, """
            totalTestsViral positiveTestsViral negativeTestsViral positiveCasesViral
            deathConfirmed deathProbable totalTestEncountersViral totalTestsPeopleViral
            totalTestsAntibody positiveTestsAntibody negativeTestsAntibody totalTestsPeopleAntibody
            positiveTestsPeopleAntibody negativeTestsPeopleAntibody totalTestsPeopleAntigen
            positiveTestsPeopleAntigen totalTestsAntigen positiveTestsAntigen"""),
        Field("fips", INT),
        *_optional(INT, "positiveIncrease negativeIncrease total totalTestResultsIncrease posNeg"),
        *_optional(TEXT, "dataQualityGrade"),
        *_optional(INT, "deathIncrease hospitalizedIncrease"),
        *_optional(TEXT, "hash"),
        *_optional(INT, "commercialScore negativeRegularScore negativeScore positiveScore score"),
        *_optional(TEXT, "grade"),
    ),
    layout=tuple("""
        date_julian state positive probableCases negative pending hospitalizedCurrently hospitalizedCumulative
        incluCurrently incluCumulative onVentilatorCurrently onVentilatorCumulative recovered dataQualityGrade
        lastUpdateEt dateModified checkTimeEt death hospitalized hospitalizedDischarged dateChecked
        totalTestsViral positiveTestsViral negativeTestsViral positiveCasesViral deathConfirmed deathProbable
        totalTestEncountersViral totalTestsPeopleViral totalTestsAntibody positiveTestsAntibody
        negativeTestsAntibody totalTestsPeopleAntibody positiveTestsPeopleAntibody negativeTestsPeopleAntibody
        totalTestsPeopleAntigen positiveTestsPeopleAntigen totalTestsAntigen positiveTestsAntigen fips
        positiveIncrease negativeIncrease total totalTestResultsSource totalTestResults totalTestResultsIncrease
        posNeg deathIncrease hospitalizedIncrease commercialScore negativeRegularScore negativeScore positiveScore
        score grade""".split()),
    key=("date_julian", "state"),
    required=("date_julian", "state", "fips", "totalTestResultsSource"),
    date_field="date",
    date_format=COMPACT_DATE,
)

OWID = SourceContract(
    name="owid_raw",
    fields=(
        *_optional(TEXT, "iso_code continent"),
        Field("location", TEXT),
        Field("date", TEXT),
        *_optional(REAL, """
            total_cases new_cases new_cases_smoothed total_deaths new_deaths new_deaths_smoothed
            total_cases_per_million new_cases_per_million new_cases_smoothed_per_million
            total_deaths_per_million new_deaths_per_million new_deaths_smoothed_per_million
            reproduction_rate icu_patients icu_patients_per_million hosp_patients hosp_patients_per_million
            weekly_icu_admissions weekly_icu_admissions_per_million
            weekly_hosp_admissions weekly_hosp_admissions_per_million
            new_tests total_tests total_tests_per_thousand new_tests_per_thousand
            new_tests_smoothed new_tests_smoothed_per_thousand positive_rate tests_per_case"""),
        *_optional(TEXT, "tests_units"),
        *_optional(REAL, """
            total_vaccinations people_vaccinated people_fully_vaccinated new_vaccinations
            new_vaccinations_smoothed total_vaccinations_per_hundred people_vaccinated_per_hundred
            people_fully_vaccinated_per_hundred new_vaccinations_smoothed_per_million
            stringency_index population population_density median_age aged_65_older aged_70_older
            gdp_per_capita extreme_poverty cardiovasc_death_rate diabetes_prevalence female_smokers
            male_smokers handwashing_facilities hospital_beds_per_thousand life_expectancy
            human_development_index excess_mortality"""),
    ),
    layout=tuple("""
        iso_code continent location date_julian total_cases new_cases new_cases_smoothed total_deaths new_deaths
        new_deaths_smoothed total_cases_per_million new_cases_per_million new_cases_smoothed_per_million
        total_deaths_per_million new_deaths_per_million new_deaths_smoothed_per_million reproduction_rate
        icu_patients icu_patients_per_million hosp_patients hosp_patients_per_million weekly_icu_admissions
        weekly_icu_admissions_per_million weekly_hosp_admissions weekly_hosp_admissions_per_million
        total_tests new_tests new_tests_smoothed total_tests_per_thousand new_tests_per_thousand
        new_tests_smoothed_per_thousand tests_per_case positive_rate tests_units total_vaccinations
        people_vaccinated people_fully_vaccinated new_vaccinations new_vaccinations_smoothed
        total_vaccinations_per_hundred people_vaccinated_per_hundred people_fully_vaccinated_per_hundred
        new_vaccinations_smoothed_per_million stringency_index population population_density median_age
        aged_65_older aged_70_older gdp_per_capita extreme_poverty cardiovasc_death_rate diabetes_prevalence
        female_smokers male_smokers handwashing_facilities hospital_beds_per_thousand life_expectancy
        human_development_index excess_mortality""".split()),
    key=("date_julian", "iso_code"),
    required=("location", "date_julian"),
    date_field="date",
)

RTLIVE = SourceContract(
    name="rtlive_raw",
    fields=(
        Field("date", TEXT),
        Field("region", TEXT, name="state"),
        Field("index", INT, name="rtindex"),
        Field("mean", REAL),
        Field("median", REAL),
        Field("lower_80", REAL),
        Field("upper_80", REAL),
        Field("infections", REAL),
        Field("test_adjusted_positive", REAL),
        Field("test_adjusted_positive_raw", REAL),
        Field("positive", REAL),
        Field("tests", REAL),
        *_optional(REAL, "new_tests new_cases new_deaths"),
    ),
    layout=tuple("""
        date_julian state rtindex mean median lower_80 upper_80 infections test_adjusted_positive
        test_adjusted_positive_raw positive tests new_tests new_cases new_deaths""".split()),
    key=("state", "date_julian"),
    required=tuple("""
        date_julian state rtindex mean median lower_80 upper_80 infections test_adjusted_positive
        test_adjusted_positive_raw positive tests""".split()),
    date_field="date",
    rounded=("positive", "tests", "new_tests", "new_cases", "new_deaths"),
)

LOCATION_MAP = SourceContract(
    name="location_map",
    fields=(
        Field("key", TEXT, name="location_key"),
        Field("key_original", TEXT),
        Field("type", TEXT, name="xtype"),
        Field("label", TEXT),
        Field("country_code", TEXT),
        Field("country_different", TEXT),
        Field("country_normalized", TEXT),
        Field("country_original", TEXT),
        Field("province_different", TEXT),
        Field("province_normalized", TEXT),
        Field("province_original", TEXT),
        Field("administrative_different", TEXT),
        Field("administrative_normalized", TEXT),
        Field("administrative_original", TEXT),
        Field("region", TEXT),
        Field("subregion", TEXT),
        Field("us_state_code", TEXT),
        Field("us_state_name", TEXT),
        Field("us_county_fips", U32, optional=True),
    ),
    ignored=("us_county_name", "dataset"),
    layout=(
        "location_key", "xtype", "label", "country_code", "country_normalized", "province_normalized",
        "administrative_normalized", "region", "subregion", "us_state_code", "us_state_name", "us_county_fips",
    ),
    key=("location_key",),
    separator="\t",
    doubled_quotes=False,
)

CONTRACTS = {c.name: c for c in (LOC_LOOKUP, NYTCOUNTIES, HARVEYCODATA, COVIDTRACKING, OWID, RTLIVE, LOCATION_MAP)}
