import pytest
from pyspark.sql import types as T

from daypanel.sources import contracts
from daypanel.sources.case_series import align_schema, union_sources
from daypanel.sources.contract import (
    HeaderError, blank_lead_count, check_headers, drop_blank_lead, normalise, read_contract, scan_contract, triage_contract,
)

HEADER = "date,county,state,fips,cases,deaths"
GOOD = "2020-03-14,Harvey,Kansas,20079,5,"


@pytest.fixture
def land(tmp_path):
    def write(*lines, name="source.csv", raw=None):
        path = tmp_path / name
        path.write_bytes(raw if raw is not None else ("\n".join(lines) + "\n").encode())
        return str(path)
    return write


def read(spark, path, contract=contracts.NYTCOUNTIES):
    return [tuple(r) for r in read_contract(spark, contract, path).collect()]


@pytest.mark.parametrize("contract", contracts.CONTRACTS.values(), ids=lambda c: c.name)
def test_layouts_are_covered_by_the_fields(contract):
    stored = {f.stored for f in contract.fields} | {"date_julian"}
    assert set(contract.layout) <= stored and len(set(contract.layout)) == len(contract.layout)
    assert set(contract.key) <= set(contract.layout) and set(contract.required) <= set(contract.layout)


def test_header_widths():
    widths = {name: (len(c.header), len(c.layout)) for name, c in contracts.CONTRACTS.items()}
    assert widths == {
        "loc_lookup": (12, 12), "nytcounties_raw": (6, 6), "harveycodata_raw": (7, 7), "covidtracking_raw": (56, 55),
        "owid_raw": (60, 60), "rtlive_raw": (15, 15), "location_map": (21, 12),
    }


def test_good_file(spark, land):
    assert read(spark, land(HEADER, GOOD)) == [(2458923, "Harvey", "Kansas", 20079, 5, None)]


def test_header_only(spark, land):
    assert read(spark, land(HEADER)) == []


@pytest.mark.parametrize("header", [
    "date,county,state,fips,cases,death", "county,date,state,fips,cases,deaths", "Date,county,state,fips,cases,deaths",
    "date,county,state,fips,cases", "date,county,state,fips,cases,deaths,more",
], ids=["name", "order", "case", "short", "long"])
def test_other_headers_are_refused(spark, land, header):
    path = land(header, GOOD)
    with pytest.raises(Exception):
        read(spark, path)
    with pytest.raises(Exception):
        scan_contract(spark, contracts.NYTCOUNTIES, path).count()


@pytest.mark.parametrize("line", [
    "2020-03-15,Harvey,Kansas,20079,5", "2020-03-15,Harvey,Kansas,20079,5,1,9", "2020-03-15,Harvey,Kansas,x,5,1",
    "2020-03-15,Harvey,Kansas,20079,5.5,1",
], ids=["short", "long", "text", "fraction"])
def test_malformed_rows_fail_even_a_bare_count(spark, land, line):
    path = land(HEADER, GOOD, line)
    with pytest.raises(Exception):
        read(spark, path)
    with pytest.raises(Exception):
        scan_contract(spark, contracts.NYTCOUNTIES, path).count()


@pytest.mark.parametrize("line,message", [
    ("2020-02-30,Harvey,Kansas,20079,5,1", "not a date"),
    ("2020-03-15,Harvey,Kansas,20079,,1", "cases is required"),
])
def test_bad_values_name_the_problem(spark, land, line, message):
    with pytest.raises(Exception, match=message):
        read(spark, land(HEADER, line))


def test_blank_lead_is_dropped_and_counted(spark, land):
    path = land(HEADER, GOOD, ",Harvey,Kansas,20079,5,1", '"",Harvey,Kansas,20079,5,1')
    assert len(read(spark, path)) == 1
    scanned = scan_contract(spark, contracts.NYTCOUNTIES, path)
    assert blank_lead_count(contracts.NYTCOUNTIES, scanned).first()[0] == 2


def test_quotes(spark, land):
    path = land(HEADER, '2020-03-14,"St. ""Q"", back\\slash",,007,5,1')
    assert read(spark, path) == [(2458923, 'St. "Q", back\\slash', "", 7, 5, 1)]


def test_quoted_line_break_needs_multi_line(spark, land):
    path = land(HEADER, '2020-03-14,"Har\nvey",Kansas,1,5,1')
    with pytest.raises(Exception):
        read(spark, path)
    rows = read_contract(spark, contracts.NYTCOUNTIES, path, multi_line=True).collect()
    assert rows[0].county == "Har\nvey"


def test_invalid_bytes_are_replaced(spark, land):
    path = land(raw=f"{HEADER}\n2020-03-14,Har".encode() + b"\xff" + b"vey,Kansas,1,5,1\n")
    assert read(spark, path)[0][1] == "Har�vey"


def test_every_file_of_a_folder_is_checked(spark, land, tmp_path):
    land(HEADER, GOOD, name="a.csv")
    land("Date,county,state,fips,cases,deaths", GOOD, name="b.csv")
    with pytest.raises(Exception):
        read(spark, str(tmp_path))


@pytest.mark.parametrize("use", [
    lambda df, mine: df, lambda df, mine: mine.join(df, "fips"), lambda df, mine: mine.unionByName(df.select("fips")),
    lambda df, mine: mine.join(df, "fips", "left").groupBy().count(),
], ids=["alone", "joined", "united", "counted"])
def test_header_case_holds_in_every_session(spark, land, tmp_path, use):
    """Plans that run in the caller's session, where names are compared without case."""
    land(HEADER, GOOD, name="a.csv")
    mine = spark.createDataFrame([(20079,)], "fips bigint")
    assert use(read_contract(spark, contracts.NYTCOUNTIES, str(tmp_path)), mine).count() >= 1
    land("DATE,county,State,fips,cases,deaths", GOOD, name="b.csv")
    with pytest.raises(HeaderError):
        use(read_contract(spark, contracts.NYTCOUNTIES, str(tmp_path)), mine).collect()
    with pytest.raises(HeaderError):
        triage_contract(spark, contracts.NYTCOUNTIES, str(tmp_path))


def test_a_header_among_many_small_files(spark, land, tmp_path):
    """Files that one task could read together are all opened."""
    for k in range(40):
        land(HEADER, GOOD, name=f"{k:02}.csv")
    check_headers(spark, contracts.NYTCOUNTIES, str(tmp_path))
    land(HEADER.upper(), GOOD, name="31.csv")
    with pytest.raises(HeaderError):
        check_headers(spark, contracts.NYTCOUNTIES, str(tmp_path))


def test_lookup_ranges_and_empty_text(spark, land):
    header = ",".join(contracts.LOC_LOOKUP.header)
    path = land(header, "1,US,USA,840,20079,,Kansas,US,38.0,-97.4,Key,34429", "2,US,USA,,,Harvey,,US,,,Key,")
    assert read(spark, path, contracts.LOC_LOOKUP) == [
        (1, "US", "USA", 840, 20079, None, "Kansas", "US", 38.0, -97.4, "Key", 34429),
        (2, "US", "USA", None, None, "Harvey", None, "US", None, None, "Key", None),
    ]
    for uid in ("-1", "4294967296"):
        with pytest.raises(Exception, match="UID out of range"):
            read(spark, land(header, f"{uid},US,USA,,,,,US,,,Key,"), contracts.LOC_LOOKUP)


def test_compact_dates_renames_and_dropped_hash(spark, land):
    contract = contracts.COVIDTRACKING
    values = {"date": "20200314", "state": "KS", "totalTestResultsSource": "s", "fips": "20", "inIcuCurrently": "3", "hash": "h"}
    path = land(",".join(contract.header), ",".join(values.get(h, "") for h in contract.header))
    row = read_contract(spark, contract, path).first().asDict()
    assert list(row) == list(contract.layout) and "hash" not in row
    assert (row["date_julian"], row["state"], row["incluCurrently"], row["positive"]) == (2458923, "KS", 3, None)


def test_rounded_counts(spark, land):
    contract = contracts.RTLIVE
    values = {"date": "2020-03-14", "region": "KS", "index": "3", "positive": "2.5", "tests": "-2.5", "new_tests": ""}
    path = land(",".join(contract.header), ",".join(values.get(h, "1.5") for h in contract.header))
    row = read_contract(spark, contract, path).first()
    assert (row.state, row.rtindex, row.positive, row.tests, row.new_tests, row.new_cases) == ("KS", 3, 3, -3, None, 2)


def test_tab_separated_map(spark, land):
    contract = contracts.LOCATION_MAP
    values = {"key": "k", "us_county_fips": "20079", "type": "county"}
    path = land("\t".join(contract.header), "\t".join(values.get(h, "") for h in contract.header))
    row = read_contract(spark, contract, path, with_order=True).first().asDict()
    assert (row["location_key"], row["xtype"], row["us_county_fips"], row["label"]) == ("k", "county", 20079, "")
    assert "dataset" not in row and "us_county_name" not in row


def test_tab_separated_quotes_are_not_doubled(spark, land):
    contract = contracts.LOCATION_MAP
    cells = {"key": '"k\tk"', "type": '"a""b"', "label": '"a"b', "region": 'a"b', "subregion": '"a\\"', "country_code": '""'}
    path = land("\t".join(contract.header), "\t".join(cells.get(h, "") for h in contract.header))
    row = read_contract(spark, contract, path).first()
    assert (row.location_key, row.xtype, row.label, row.region, row.subregion, row.country_code) == (
        "k\tk", 'a"b"', "ab", 'a"b', "a\\", "")


def test_file_order_of_one_file_in_many_tasks(spark, tmp_path):
    """The order columns sort a file's rows as they stand in it, however many tasks read it."""
    path = tmp_path / "source.csv"
    lines = [f"2020-03-14,c{i},s,1,{i},1" for i in range(4000)]
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    small.conf.set("spark.sql.files.openCostInBytes", "0")
    df = scan_contract(small, contracts.NYTCOUNTIES, str(path), with_order=True)
    assert df.rdd.getNumPartitions() > 4
    ordered = normalise(contracts.NYTCOUNTIES, df).orderBy("__file", "__block", "__row").collect()
    assert [r.cases for r in ordered] == list(range(4000))


def test_triage(spark, land):
    lines = [GOOD, "2020-03-15,H,K,1,5", "2020-03-15,H,K,1,5,1,9", "2020-03-15,H,K,x,5,1", '2020-03-15,"a,b,c",K,1']
    path = land(HEADER, *lines)
    good, rejects = triage_contract(spark, contracts.NYTCOUNTIES, path)
    assert good.count() == 1
    assert sorted(r._corrupt_record for r in rejects.collect()) == sorted(lines[1:])
    good, rejects = triage_contract(spark, contracts.NYTCOUNTIES, path, allow_extra=True)
    assert sorted((r.date, r.cases, r.deaths) for r in good.collect()) == [("2020-03-14", 5, None), ("2020-03-15", 5, 1)]
    assert sorted(r._corrupt_record for r in rejects.collect()) == sorted([lines[1], lines[3], lines[4]])


def test_align_and_union(spark, rows):
    mandatory = T.StructType().add("a", T.LongType())
    optional = T.StructType().add("b", T.StringType())
    df = spark.createDataFrame([(1, 9)], "a int, surplus int")
    aligned = align_schema(df, mandatory, optional)
    assert aligned.dtypes == [("a", "bigint"), ("b", "string")] and rows(aligned) == [(1, None)]
    with pytest.raises(ValueError, match="'a'"):
        align_schema(df.drop("a"), mandatory, optional)
    both = union_sources([aligned, spark.createDataFrame([("x", 2)], "b string, a long")])
    assert rows(both, "source_ord", "a", "b") == [(0, 1, None), (1, 2, "x")]


def test_drop_blank_lead(spark, rows):
    df = spark.createDataFrame([("", 1), (None, 2), ("x", 3)], "lead string, v int")
    assert rows(drop_blank_lead(df, "lead")) == [("x", 3)]


@pytest.mark.parametrize("separator", ["|", ".", "^", ";"])
def test_triage_takes_the_separator_literally(spark, land, separator):
    from dataclasses import replace

    contract = replace(contracts.NYTCOUNTIES, separator=separator)
    lines = [x.replace(",", separator) for x in (HEADER, GOOD, GOOD + ",surplus", "2020-03-15,Harvey")]
    good, bad = triage_contract(spark, contract, land(*lines), allow_extra=True)
    assert good.count() == 2 and [r["first_field"] for r in bad.collect()] == ["2020-03-15"]


def test_the_ingest_session_keeps_the_callers_settings(spark):
    from daypanel.session import ingest_session

    caller = spark.newSession()
    caller.conf.set("spark.sql.parquet.compression.codec", "zstd")
    strict = ingest_session(caller)
    assert strict.conf.get("spark.sql.parquet.compression.codec") == "zstd" and strict.conf.get("spark.sql.caseSensitive") == "true"
    assert caller.conf.get("spark.sql.caseSensitive") == "false"
