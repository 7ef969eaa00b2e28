"""What the SQL counterparts expect, written out: they share no list with the code whose results they check."""

from __future__ import annotations

# Names, types and roles of columns as the established sources and views have them.

TABLES = """
    region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
    conversations
""".split()

EVENT_TYPES = """
    click error purchase signup
""".split()

FACT_COLUMNS = """
    dataset locid location_lat location_long date_julian day_index_0 day_index_1 day_index_10 day_index_100
    day_index_1k day_index_10k day_index_peak day_index_peak_confirmed day_index_peak_deaths absolute_confirmed
    absolute_deaths absolute_recovered absolute_infected absolute_pop100k_confirmed absolute_pop100k_deaths
    absolute_pop100k_recovered absolute_pop100k_infected relative_deaths relative_recovered relative_infected
    delta_confirmed delta_deaths delta_recovered delta_infected delta_pct_confirmed delta_pct_deaths
    delta_pct_recovered delta_pct_infected delta_pop100k_confirmed delta_pop100k_deaths delta_pop100k_recovered
    delta_pop100k_infected peak_pct_confirmed peak_pct_deaths peak_pct_recovered peak_pct_infected factbook_area
    factbook_population factbook_death_rate factbook_median_age
""".split()

#: On a filled day: counted on, zero, NULL.
ADVANCE = """
    day_index_0 day_index_1 day_index_10 day_index_100 day_index_1k day_index_10k day_index_peak
    day_index_peak_confirmed day_index_peak_deaths
""".split()

ZERO = """
    delta_confirmed delta_deaths delta_recovered delta_infected
""".split()

NULL = """
    delta_pct_confirmed delta_pct_deaths delta_pct_recovered delta_pct_infected delta_pop100k_confirmed
    delta_pop100k_deaths delta_pop100k_recovered delta_pop100k_infected
""".split()

#: Count and its rate per 100 000.
RATES = {
    "absolute_confirmed": "absolute_pop100k_confirmed",
    "absolute_deaths": "absolute_pop100k_deaths",
    "absolute_recovered": "absolute_pop100k_recovered",
    "absolute_infected": "absolute_pop100k_infected",
    "delta_confirmed": "delta_pop100k_confirmed",
    "delta_deaths": "delta_pop100k_deaths",
    "delta_recovered": "delta_pop100k_recovered",
    "delta_infected": "delta_pop100k_infected",
}

#: Column of the location map and its name in the view.
LOCATION = {
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

#: Column of the world view, the column it comes from, and the factor.
WORLD_UNITS = {
    "total_cases_per_100k": ("total_cases_per_million", "/", 10.0),
    "new_cases_per_100k": ("new_cases_per_million", "/", 10.0),
    "total_deaths_per_100k": ("total_deaths_per_million", "/", 10.0),
    "new_deaths_per_100k": ("new_deaths_per_million", "/", 10.0),
    "total_tests_per_100k": ("total_tests_per_thousand", "*", 100.0),
    "new_tests_per_100k": ("new_tests_per_thousand", "*", 100.0),
    "new_tests_smoothed_per_100k": ("new_tests_smoothed_per_thousand", "*", 100.0),
}

#: Sums of the national view; one has another name there.
NATIONAL = """
    positive negative pending hospitalizedCurrently hospitalizedCumulative incluCurrently incluCumulative
    onVentilatorCurrently onVentilatorCumulative recovered death hospitalized totalTestsViral positiveTestsViral
    negativeTestsViral positiveCasesViral deathConfirmed deathProbable totalTestEncountersViral
    totalTestsPeopleViral totalTestsAntibody positiveTestsAntibody negativeTestsAntibody totalTestsPeopleAntibody
    positiveTestsPeopleAntibody negativeTestsPeopleAntibody totalTestsPeopleAntigen positiveTestsPeopleAntigen
    totalTestsAntigen positiveTestsAntigen positiveIncrease negativeIncrease total totalTestResults
    totalTestResultsIncrease posNeg deathIncrease hospitalizedIncrease
""".split()

NATIONAL_NAMES = {"incluCurrently": "inclueCurrently"}

SERIES = [
    ("string", """
        dataset location_key date location_type location_label country_code country region
    """.split()),
    ("int", """
        date_year date_month date_day day_index_0 day_index_1 day_index_10 day_index_100 day_index_1k day_index_10k
        day_index_peak day_index_peak_confirmed day_index_peak_deaths
    """.split()),
    ("bigint", """
        absolute_confirmed absolute_deaths absolute_infected delta_confirmed delta_deaths delta_infected
        factbook_population
    """.split()),
    ("double", """
        location_lat location_long relative_deaths relative_infected delta_pct_confirmed delta_pct_deaths
        delta_pct_infected peak_pct_confirmed peak_pct_deaths peak_pct_infected factbook_area factbook_death_rate
        factbook_median_age
    """.split()),
]

SERIES_OPTIONAL = [
    ("string", """
        province administrative
    """.split()),
    ("bigint", """
        absolute_recovered delta_recovered
    """.split()),
    ("double", """
        relative_recovered delta_pct_recovered peak_pct_recovered absolute_pop100k_confirmed absolute_pop100k_deaths
        absolute_pop100k_recovered absolute_pop100k_infected delta_pop100k_confirmed delta_pop100k_deaths
        delta_pop100k_recovered delta_pop100k_infected
    """.split()),
]

STATES = """
    date state positive probableCases negative pending totalTestResultsSource totalTestResults hospitalizedCurrently
    hospitalizedCumulative inIcuCurrently inIcuCumulative onVentilatorCurrently onVentilatorCumulative recovered
    lastUpdateEt dateModified checkTimeEt death hospitalized hospitalizedDischarged dateChecked totalTestsViral
    positiveTestsViral negativeTestsViral positiveCasesViral deathConfirmed deathProbable totalTestEncountersViral
    totalTestsPeopleViral totalTestsAntibody positiveTestsAntibody negativeTestsAntibody totalTestsPeopleAntibody
    positiveTestsPeopleAntibody negativeTestsPeopleAntibody totalTestsPeopleAntigen positiveTestsPeopleAntigen
    totalTestsAntigen positiveTestsAntigen fips positiveIncrease negativeIncrease total totalTestResultsIncrease
    posNeg dataQualityGrade deathIncrease hospitalizedIncrease hash commercialScore negativeRegularScore
    negativeScore positiveScore score grade
""".split()

#: Columns that are stored under another name.
STATES_NAMES = {"inIcuCurrently": "incluCurrently", "inIcuCumulative": "incluCumulative"}

WORLD = """
    iso_code continent location date total_cases new_cases new_cases_smoothed total_deaths new_deaths
    new_deaths_smoothed total_cases_per_million new_cases_per_million new_cases_smoothed_per_million
    total_deaths_per_million new_deaths_per_million new_deaths_smoothed_per_million reproduction_rate icu_patients
    icu_patients_per_million hosp_patients hosp_patients_per_million weekly_icu_admissions
    weekly_icu_admissions_per_million weekly_hosp_admissions weekly_hosp_admissions_per_million new_tests
    total_tests total_tests_per_thousand new_tests_per_thousand new_tests_smoothed new_tests_smoothed_per_thousand
    positive_rate tests_per_case tests_units total_vaccinations people_vaccinated people_fully_vaccinated
    new_vaccinations new_vaccinations_smoothed total_vaccinations_per_hundred people_vaccinated_per_hundred
    people_fully_vaccinated_per_hundred new_vaccinations_smoothed_per_million stringency_index population
    population_density median_age aged_65_older aged_70_older gdp_per_capita extreme_poverty cardiovasc_death_rate
    diabetes_prevalence female_smokers male_smokers handwashing_facilities hospital_beds_per_thousand
    life_expectancy human_development_index excess_mortality
""".split()

STATES_TEXT = """
    date state totalTestResultsSource lastUpdateEt dateModified checkTimeEt dateChecked dataQualityGrade hash grade
""".split()
